"""Rule bitmask ledger: every quality rule is evaluated once, policies are read off the bits.

``ledger`` stores, per document, measurements and one bit per failed rule. A policy is a named version
with a mask of the rules that reject. Policies, and what each rule of a policy alone would let
through, are bitwise operations and a small aggregation over the stored ledger; texts are read once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.common import arrow_map, bytes_of, pieces
from cohortwise.llm.words import BASE, SEPARATOR, mix, span_hashes, window_hashes, word_spans

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_letters",
)


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` of the measurements is true."""

    name: str
    bit: int
    fails: Callable[[], Column]


RULES = (
    Rule("few_words", 0, lambda: F.col("n_words") < 50),
    Rule("repeated_words", 1, lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    Rule("symbols", 2, lambda: 100 * F.col("n_symbols") > 20 * F.col("n_words")),
    Rule("short_words", 3, lambda: 2 * F.col("word_chars") < 5 * F.col("n_words")),
    Rule("long_words", 4, lambda: F.col("word_chars") > 15 * F.col("n_words")),
    Rule("repeated_lines", 5, lambda: 100 * F.col("n_dup_lines") > 40 * F.col("n_lines")),
    Rule("capitals", 6, lambda: 100 * F.col("n_upper") > 50 * F.col("n_letters")),
)
BASE_MASK = 0b11


@dataclass(frozen=True)
class Policy:
    """A version of what is rejected: the bits of ``mask``."""

    version: str
    mask: int


POLICIES = {
    "v1": Policy("v1", BASE_MASK),
    "v2": Policy("v2", 0b1111111),
}
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
LETTER = UPPER.copy()
LETTER[97:123] = True


def _per_text(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _distinct(owner: np.ndarray, hashes: np.ndarray, texts: int) -> np.ndarray:
    """How many distinct hashes each text has."""
    order = np.lexsort((hashes, owner))
    key, own = hashes[order], owner[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
    return np.bincount(own[new], minlength=texts)


def measure(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """The measurements of each text; see ``ledger`` for their meaning."""
    texts = len(bounds) - 1
    inside = ~SEPARATOR[data]
    starts, ends = word_spans(data, bounds)
    words = span_hashes(data, starts, ends)
    first = np.searchsorted(starts, bounds, "left")
    n_words = np.diff(first)

    # lines: cut after each \n and at the ends of texts
    breaks = np.flatnonzero(data == 10)
    line_starts = np.union1d(breaks + 1, bounds[:-1])
    line_starts = line_starts[line_starts < len(data)]
    line_ends = np.append(line_starts[1:], len(data))
    line_ends = line_ends - ((line_ends > line_starts) & (data[line_ends - 1] == 10)) if len(data) else line_ends
    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(inside, out=filled[1:])
    has_word = filled[line_ends] > filled[line_starts]
    line_starts, line_ends = line_starts[has_word], line_ends[has_word]
    line_owner = np.searchsorted(bounds, line_starts, "right") - 1
    n_lines = np.bincount(line_owner, minlength=texts)
    different = _distinct(line_owner, span_hashes(data, line_starts, line_ends), texts)

    # words in windows of three that occur twice or more in their text
    covered = np.zeros(len(words) + 2, bool)
    windows = window_hashes(words, 3)
    if len(windows):
        owner = np.repeat(np.arange(texts), n_words)
        at = np.flatnonzero(owner[:-2] == owner[2:])
        key = mix(windows[at] + owner[at].astype(np.uint64) * BASE)
        order = np.argsort(key)
        key = key[order]
        same = key[1:] == key[:-1]
        twice = np.zeros(len(key), bool)
        twice[1:] |= same
        twice[:-1] |= same
        found = at[order[twice]]
        for k in range(3):
            covered[found + k] = True
    return {
        "n_words": n_words,
        "word_chars": _per_text(inside & ((data & 0xC0) != 0x80), bounds),
        "n_symbols": _per_text(SYMBOL[data], bounds),
        "n_dup_lines": n_lines - different,
        "n_repeat_words": _per_text(covered[: len(words)], first),
        "n_lines": n_lines,
        "n_upper": _per_text(UPPER[data], bounds),
        "n_letters": _per_text(LETTER[data], bounds),
    }


def ledger(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``keep``, the measurements and ``fail_bits`` of every row of ``docs``.

    Words are runs of bytes other than space and ``\\x09``-``\\x0D``. ``word_chars`` counts their code
    points, ``n_symbols`` the characters of ``#*$%&|<>``, ``n_lines`` the lines with a word,
    ``n_dup_lines`` those equal to an earlier line, ``n_repeat_words`` the words in windows of three
    words found twice or more, ``n_upper`` and ``n_letters`` the ASCII capitals and letters.
    A null or empty text has zeros. Every row is measured for itself, repeated or not, and columns of
    ``docs`` that are not in ``keep`` are ignored; an empty table gives an empty ledger.
    """

    def work(batches):
        for batch in batches:
            data, bounds = bytes_of(batch.column("text"))
            for a, b in pieces(bounds):
                part = bounds[a : b + 1]
                found = measure(data[part[0] : part[-1]], part - part[0])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(f"key{i}").slice(a, b - a) for i in range(len(keep))]
                    + [pa.array(found[m].astype(np.int64)) for m in MEASURES],
                    names=[*(f"key{i}" for i in range(len(keep))), *MEASURES],
                )

    rows = docs.select(
        *(F.col(c).alias(f"key{i}") for i, c in enumerate(keep)), F.col("text").cast("string").alias("text")
    )
    kinds = dict(rows.dtypes)
    schema = ", ".join([f"key{i} {kinds[f'key{i}']}" for i in range(len(keep))] + [f"{m} long" for m in MEASURES])
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits + F.when(rule.fails(), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long")
    measured = arrow_map(rows, work, schema)
    return measured.select(*(F.col(f"key{i}").alias(c) for i, c in enumerate(keep)), *MEASURES, bits.alias("fail_bits"))


def verdict(policy: Policy, bits: str = "fail_bits") -> Column:
    """Whether a policy keeps a row of the ledger."""
    return F.col(bits).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablations(rows: DataFrame, policy: Policy, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per rule of the policy: rows it rejects, rows it alone rejects, and rows kept without it.

    The ledger is first summed by bit pattern, of which there are at most ``2**rules``.
    """
    patterns = rows.groupBy(F.col("fail_bits").bitwiseAND(F.lit(policy.mask).cast("long")).alias("bits")).agg(
        F.count("*").alias("n")
    )
    used = [r for r in rules if policy.mask >> r.bit & 1]
    if not used:
        return patterns.select(
            F.lit("").alias("rule"), *(F.lit(0).cast("long").alias(c) for c in ("rejects", "alone", "kept_without"))
        ).limit(0)
    sums = []
    for r in used:
        own, rest = F.lit(1 << r.bit).cast("long"), F.lit(policy.mask & ~(1 << r.bit)).cast("long")
        hit, others = F.col("bits").bitwiseAND(own) != 0, F.col("bits").bitwiseAND(rest)
        sums.append(
            F.struct(
                F.lit(r.name).alias("rule"),
                F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("rejects"),
                F.coalesce(F.sum(F.when(hit & (others == 0), F.col("n"))), F.lit(0)).alias("alone"),
                F.coalesce(F.sum(F.when(others == 0, F.col("n"))), F.lit(0)).alias("kept_without"),
            )
        )
    return patterns.agg(F.array(*sums).alias("rules")).select(F.inline("rules"))
