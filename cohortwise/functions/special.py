"""Tail probabilities for test statistics.

Support code: every function takes a handful of numbers that Spark has already summarised,
and no SciPy is needed.
"""

from __future__ import annotations

import math

NORMAL_975 = 1.959963984540054  # fixed value: 97.5 % point of the standard normal
_TINY = 1e-300
_EPS = 1e-16


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2.0))


def _lentz(first: float, terms, rounds: int = 20000) -> float:
    """Evaluate b0 + a1/(b1 + a2/(b2 + ...)) for ``terms(i) -> (a_i, b_i)``."""
    value = first if first != 0.0 else _TINY
    c, d = value, 0.0
    for i in range(1, rounds):
        a, b = terms(i)
        d = b + a * d
        d = 1.0 / (d if d != 0.0 else _TINY)
        c = b + a / c
        c = c if c != 0.0 else _TINY
        step = c * d
        value *= step
        if abs(step - 1.0) < _EPS:
            break
    return value


def chi2_sf(x: float, dof: float) -> float:
    """P(chi-square with ``dof`` degrees of freedom > x)."""
    if x <= 0:
        return 1.0
    a, x = dof / 2.0, x / 2.0
    scale = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1.0:
        term = total = 1.0 / a
        k = a
        while term > total * _EPS:
            k += 1.0
            term *= x / k
            total += term
        return max(0.0, 1.0 - scale * total)
    fraction = _lentz(x + 1.0 - a, lambda i: (-i * (i - a), x + 2.0 * i + 1.0 - a))
    return scale / fraction


def beta_regularized(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_regularized(b, a, 1.0 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    ) / a

    def terms(i: int) -> tuple[float, float]:
        m = i // 2
        if i % 2 == 0:
            return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0
        return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0

    return front / _lentz(1.0, terms)


def t_two_sided(t: float, dof: float) -> float:
    """P(|Student t with ``dof`` degrees of freedom| > |t|)."""
    if math.isinf(t):
        return 0.0
    return beta_regularized(dof / 2.0, 0.5, dof / (dof + t * t))


def binomial_half_two_sided(b: int, c: int) -> float:
    """Exact McNemar p-value for the two discordant counts."""
    n, k = b + c, min(b, c)
    if n == 0 or b == c:
        return 1.0
    term = math.exp(
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) - n * math.log(2.0)
    )
    total, j = term, k
    while j > 0 and term > total * _EPS:
        term *= j / (n - j + 1.0)
        j -= 1
        total += term
    return min(1.0, 2.0 * total)


def fisher_two_sided(a: int, b: int, c: int, d: int) -> float:
    """Two-sided Fisher exact p-value of the table [[a, b], [c, d]].

    Probabilities are taken relative to the mode and both walks outward stop once the terms
    no longer count, so the work does not grow with the table total.
    """
    row, col, n = a + b, a + c, a + b + c + d
    low, high = max(0, row + col - n), min(row, col)
    if low == high:
        return 1.0

    def ratio(k: int) -> float:
        """weight(k + 1) / weight(k)"""
        return (row - k) * (col - k) / ((k + 1.0) * (n - row - col + k + 1.0))

    def log_weight(k: int) -> float:
        return -sum(
            math.lgamma(v + 1.0) for v in (k, row - k, col - k, n - row - col + k)
        )

    mode = min(max((row + 1) * (col + 1) // (n + 2), low), high)
    limit = math.exp(log_weight(a) - log_weight(mode)) * (1.0 + 1e-7)
    total = extreme = 0.0

    weight, k = 1.0, mode
    while weight > 0.0:
        total += weight
        if weight <= limit:
            extreme += weight
            if weight < extreme * _EPS:
                break
        if k == high:
            break
        weight, k = weight * ratio(k), k + 1

    weight, k = 1.0, mode
    while k > low:
        weight, k = weight / ratio(k - 1), k - 1
        if weight == 0.0:
            break
        total += weight
        if weight <= limit:
            extreme += weight
            if weight < extreme * _EPS:
                break
    return min(1.0, extreme / total)
