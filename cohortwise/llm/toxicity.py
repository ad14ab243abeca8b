"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A text is the set of its hashed byte n-grams in lower case. Over all learning rows, each n-gram has a
ratio: the log of its share among toxic rows over its share among the others. A logistic regression
is then fitted on the sets with each feature scaled by its ratio, so that an n-gram starts with the
say that naive Bayes gives it. N-grams whose ratio is small, or could well be chance, are left out.

Counts and ratios cover all learning rows. The regression is fitted in one task on at most about
``sample`` rows of each class, chosen by a hash; its intercept is put back to the share of the classes
in all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.common import arrow_map, bytes_of, pieces, run_starts, whole_groups
from cohortwise.llm.ngrams import gram_codes
from cohortwise.llm.words import LOWER

BROADCAST_LABELS = 500_000


@dataclass(frozen=True)
class ToxicitySettings:
    sizes: tuple[int, ...] = (3, 4, 5)
    bits: int = 18
    least_ratio: float = 0.5
    least_errors: float = 2.5
    shrink_errors: float = 3.0
    sample: int = 4000
    epochs: int = 20
    step: float = 0.3
    decay: float = 1e-4
    seed: int = 5


@dataclass(frozen=True)
class ToxicityModel:
    """One weight per code, ratio included, and the intercept."""

    weights: np.ndarray
    intercept: float


def _codes(data: np.ndarray, settings: ToxicitySettings) -> np.ndarray:
    return np.concatenate([gram_codes(data, s, settings.bits) for s in settings.sizes])


def class_counts(rows: DataFrame, settings: ToxicitySettings) -> tuple[np.ndarray, np.ndarray]:
    """Rows with each code by class (2, codes), and rows by class, over all rows of ``text`` and ``toxic``.

    Tasks send packed slices of their counts, which are added up in parallel; the driver gets two
    numbers per code.
    """
    size = 1 << settings.bits
    slices, width = 64, size // 64

    def count(batches):
        total, n = np.zeros((2, size), np.int64), np.zeros(2, np.int64)
        seen = np.zeros(size, np.uint8)
        for batch in batches:
            data, bounds = bytes_of(batch.column("text"))
            data = LOWER[data]
            for a, b, toxic in zip(bounds[:-1], bounds[1:], batch.column("toxic").to_pylist()):
                seen[_codes(data[a:b], settings)] = 1
                total[toxic] += seen
                n[toxic] += 1
                seen[:] = 0
        packed = [total[:, k * width : (k + 1) * width].astype("<i8").tobytes() for k in range(slices)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([*range(slices), slices], pa.int32()), pa.array([*packed, n.astype("<i8").tobytes()], pa.binary())],
            names=["slice", "counts"],
        )

    def add(batches):
        for table in whole_groups(batches, ["slice"]):
            number = table.column("slice").to_numpy()
            values = table.column("counts").to_pylist()
            edges = run_starts(number)
            sums = [
                np.sum([np.frombuffer(v, "<i8") for v in values[a:b]], axis=0).tobytes()
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(number[edges[:-1]], pa.int32()), pa.array(sums, pa.binary())], names=["slice", "counts"]
            )

    parts = arrow_map(rows.select("text", "toxic"), count, "slice int, counts binary")
    ready = parts.repartition("slice").sortWithinPartitions("slice")
    total, n = np.zeros((2, size), np.int64), np.zeros(2, np.int64)
    for r in arrow_map(ready, add, "slice int, counts binary").collect():
        if r["slice"] == slices:
            n = np.frombuffer(r.counts, "<i8").copy()
        else:
            total[:, r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(r.counts, "<i8").reshape(2, -1)
    return total, n


def ratios(counts: np.ndarray, n: np.ndarray, settings: ToxicitySettings) -> np.ndarray:
    """Log-count ratio of each code, from the share of rows of each class that have it, shrunk by its error.

    A ratio of ``shrink_errors`` standard errors keeps half of its size, one far above nearly all of it. It is zero
    where it is below ``least_ratio``, or less than ``least_errors`` standard errors away from zero: n-grams of a
    single text say nothing about another one.
    """
    share = (counts + 0.5) / (n[:, None] + 1.0)
    r = np.log(share[1]) - np.log(share[0])
    error = np.sqrt((1 / (counts + 0.5)).sum(0))
    shrunk = r / (1 + (settings.shrink_errors * error / np.maximum(np.abs(r), 1e-12)) ** 2)
    return np.where((np.abs(r) >= settings.least_ratio) & (np.abs(r) >= settings.least_errors * error), shrunk, 0.0)


def _regress(sets: list[np.ndarray], y: np.ndarray, scale: np.ndarray, settings: ToxicitySettings) -> tuple[np.ndarray, float]:
    """Logistic regression on scaled sets by adaptive gradient steps over seeded batches."""
    rng = np.random.default_rng(settings.seed)
    weights, squares = np.zeros(len(scale)), np.full(len(scale), 1e-8)
    intercept, intercept_squares = 0.0, 1e-8
    for _ in range(settings.epochs):
        order = rng.permutation(len(sets))
        for a in range(0, len(order), 64):
            at = order[a : a + 64]
            codes = np.concatenate([sets[i] for i in at])
            owner = np.repeat(np.arange(len(at)), [len(sets[i]) for i in at])
            z = intercept + np.bincount(owner, weights[codes] * scale[codes], len(at))
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[at]) / len(at)
            used, place = np.unique(codes, return_inverse=True)
            gradient = np.bincount(place, error[owner] * scale[codes]) + settings.decay * weights[used]
            squares[used] += gradient**2
            weights[used] -= settings.step * gradient / np.sqrt(squares[used])
            intercept_squares += error.sum() ** 2
            intercept -= settings.step * error.sum() / np.sqrt(intercept_squares)
    return weights * scale, intercept


def fit(docs: DataFrame, labels: DataFrame, learn: Column, settings: ToxicitySettings = ToxicitySettings()) -> ToxicityModel:
    """Learn ``labels.toxic`` (0 or 1) of rows for which ``learn``, a condition on ``doc_id``, holds.

    Null labels and ids are left out; of repeated labels the largest counts. Without rows of both classes
    all weights are zero and the intercept is the log-odds of the classes.
    """
    wanted = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter("doc_id is not null and toxic in (0, 1)")
        .filter(learn)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    few = wanted.limit(BROADCAST_LABELS + 1).count() <= BROADCAST_LABELS  # 16 bytes a row; else a shuffled join
    rows = texts.join(F.broadcast(wanted) if few else wanted, "doc_id")
    counts, n = class_counts(rows, settings)
    odds = float(np.log((n[1] + 0.5) / (n[0] + 0.5)))
    if not n.all():
        return ToxicityModel(np.zeros(1 << settings.bits), odds)
    scale = ratios(counts, n, settings)
    share = F.when(F.col("toxic") == 1, settings.sample / float(n[1])).otherwise(settings.sample / float(n[0]))
    unit = F.pmod(F.xxhash64(F.lit(settings.seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = wanted.filter(unit < share)
    chosen = texts.join(F.broadcast(chosen) if few else chosen, "doc_id")
    used = scale != 0

    def featurize(batches):
        for batch in batches:
            data, bounds = bytes_of(batch.column("text"))
            data = LOWER[data]
            sets = []
            for a, b in zip(bounds[:-1], bounds[1:]):
                codes = _codes(data[a:b], settings)
                sets.append(np.unique(codes[used[codes]]).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(sets, pa.binary())], names=["doc_id", "toxic", "codes"]
            )

    def train(batches):
        sets, y = [], []
        for batch in batches:
            sets += [np.frombuffer(c, "<i4") for c in batch.column("codes").to_pylist()]
            y += batch.column("toxic").to_pylist()
        if sets:
            weights, intercept = _regress(sets, np.array(y, float), scale, settings)
            at = np.flatnonzero(weights)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([at.astype("<i4").tobytes()], pa.binary()),
                    pa.array([weights[at].astype("<f8").tobytes()], pa.binary()),
                    pa.array([intercept]),
                    pa.array([float(np.sum(y))]),
                    pa.array([float(len(y))]),
                ],
                names=["codes", "weights", "intercept", "toxic", "rows"],
            )

    features = arrow_map(chosen.select("doc_id", "toxic", "text"), featurize, "doc_id long, toxic int, codes binary")
    one = features.repartition(1).sortWithinPartitions("doc_id", "codes")  # a bounded sample
    fitted = arrow_map(one, train, "codes binary, weights binary, intercept double, toxic double, rows double").first()
    weights = np.zeros(1 << settings.bits)
    if fitted is None:
        return ToxicityModel(weights, odds)
    weights[np.frombuffer(fitted.codes, "<i4")] = np.frombuffer(fitted.weights, "<f8")
    sampled = float(np.log((fitted.toxic + 0.5) / (fitted.rows - fitted.toxic + 0.5)))
    return ToxicityModel(weights, fitted.intercept - sampled + odds)


def score(docs: DataFrame, model: ToxicityModel, keep: tuple[str, ...], settings: ToxicitySettings = ToxicitySettings()) -> DataFrame:
    """``keep`` columns with ``score`` (probability of toxic) and ``predicted`` (1 from one half on) for every row.

    A null or empty text has no n-grams and the score of the intercept. Other columns are ignored;
    repeated rows score alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number per code

    def work(batches):
        weights, intercept = shared.value.weights, shared.value.intercept
        used = weights != 0
        for batch in batches:
            data, bounds = bytes_of(batch.column("text"))
            z = np.full(len(bounds) - 1, intercept)
            for a, b in pieces(bounds):
                part = bounds[a : b + 1]
                text = LOWER[data[part[0] : part[-1]]]
                hits, owners = [], []
                for size in settings.sizes:
                    codes = gram_codes(text, size, settings.bits)
                    at = np.flatnonzero(used[codes])
                    owner = np.searchsorted(part - part[0], at, "right") - 1
                    whole = at + size <= (part - part[0])[owner + 1]  # not across the end of a text
                    hits.append(codes[at[whole]])
                    owners.append(owner[whole])
                pair = np.unique(np.concatenate(owners) * len(weights) + np.concatenate(hits))
                owner, code = pair // len(weights), pair % len(weights)
                z[a:b] += np.bincount(owner, weights[code], b - a)
            value = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(f"key{k}") for k in range(len(keep))] + [pa.array(value), pa.array((value >= 0.5).astype(np.int32))],
                names=[*(f"key{k}" for k in range(len(keep))), "score", "predicted"],
            )

    rows = docs.select(*(F.col(c).alias(f"key{k}") for k, c in enumerate(keep)), F.col("text").cast("string").alias("text"))
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"key{k} {kinds[f'key{k}']}" for k in range(len(keep)))
    found = arrow_map(rows, work, f"{schema}, score double, predicted int")
    return found.select(*(F.col(f"key{k}").alias(c) for k, c in enumerate(keep)), "score", "predicted")
