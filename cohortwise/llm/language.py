"""Language identification by nearest centroids.

A text is the vector of the hashed byte n-grams of its letters, in lower case with a space for whatever
lies between words: ``(1 + log tf) * idf``, of length one. Each language has
a few centroids, from spherical k-means over its learning texts; a text gets the language of the
centroid with the largest cosine. A text that is farther from its centroid than almost all learning
texts of that centroid is marked as rejected.

Document frequencies are counted over all learning rows. The centroids are fitted on at most about
``sample`` texts per language, chosen by a hash of the text and the id; languages are fitted in
parallel, each in one task of bounded size.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.common import arrow_map, whole_groups
from cohortwise.llm.ngrams import text_codes

UNKNOWN = "und"
BROADCAST_LANGUAGES = 10_000
NO_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class LanguageSettings:
    sizes: tuple[int, ...] = (1, 2, 3, 4)
    bits: int = 13
    centroids: int = 3
    sample: int = 1000
    rounds: int = 8
    reject: float = 0.005
    seed: int = 11


@dataclass(frozen=True)
class LanguageModel:
    """Languages of the centroids, the centroids as rows, their rejection bounds, and idf weights."""

    languages: list[str] = field(default_factory=list)
    centroids: np.ndarray | None = None
    bounds: np.ndarray | None = None
    idf: np.ndarray | None = None


def counts_of(text: str, settings: LanguageSettings) -> np.ndarray:
    words = NO_LETTERS.sub(" ", f" {text.lower()} ")
    codes = text_codes(words.encode(), settings.sizes, settings.bits)
    return np.bincount(codes, minlength=1 << settings.bits)


def vectors(texts: list[str], idf: np.ndarray, settings: LanguageSettings) -> np.ndarray:
    out = np.zeros((len(texts), 1 << settings.bits), np.float32)
    for row, text in zip(out, texts):
        counts = counts_of(text, settings)
        used = np.flatnonzero(counts)
        row[used] = (1 + np.log(counts[used])) * idf[used]
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return (out / np.maximum(norm, 1e-12)).astype(np.float32)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def cluster(x: np.ndarray, k: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from the points that are farthest from those chosen before; ties go to the first."""
    chosen = [int(np.argmax(x @ x.mean(0)))]
    near = x @ x[chosen[0]]
    for _ in range(1, min(k, len(x))):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    centers = x[chosen].astype(np.float32)
    for _ in range(rounds):
        own = np.argmax(x @ centers.T, axis=1)
        for c in range(len(centers)):
            if (own == c).any():
                mean = x[own == c].mean(0)
                centers[c] = mean / max(float(np.linalg.norm(mean)), 1e-12)
    return centers, np.argmax(x @ centers.T, axis=1)


def document_frequencies(texts: DataFrame, settings: LanguageSettings) -> tuple[np.ndarray, int]:
    """In how many rows each code occurs, over all rows; the driver gets one number per code."""
    size = 1 << settings.bits

    def work(batches):
        total, rows = np.zeros(size, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total += counts_of(text, settings) > 0
                rows += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(size + 1), pa.int32()), pa.array(np.append(total, rows))], names=["code", "n"]
        )

    rows = arrow_map(texts.select("text"), work, "code int, n long").groupBy("code").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(size + 1, np.int64)
    for r in rows:
        out[r.code] = r.n
    return out[:size], int(out[size])


def fit(docs: DataFrame, learn: Column, settings: LanguageSettings = LanguageSettings()) -> LanguageModel:
    """Learn from ``text`` and ``lang`` of the rows for which ``learn`` holds; null texts and languages are left out."""
    rows = (
        docs.select(
            F.col("lang").cast("string").alias("lang"),
            F.col("text").cast("string").alias("text"),
            F.coalesce(learn, F.lit(False)).alias("learn"),
            F.xxhash64(F.lit(settings.seed), "doc_id", "text").alias("draw"),
        )
        .filter("learn and lang is not null and text is not null")
        .drop("learn")
    )
    frequency, total = document_frequencies(rows, settings)
    if not total:
        return LanguageModel()
    idf = (np.log((total + 1) / (frequency + 1)) + 1).astype(np.float32)
    counts = rows.groupBy("lang").agg(F.count("*").alias("n")).select(
        F.col("lang").alias("of"), (F.lit(float(settings.sample)) / F.col("n")).alias("share")
    )  # one row per language
    few = counts.limit(BROADCAST_LANGUAGES + 1).count() <= BROADCAST_LANGUAGES  # else a shuffled join
    unit = F.pmod(F.col("draw"), F.lit(1 << 30)) / float(1 << 30)
    sample = (
        rows.join(F.broadcast(counts) if few else counts, rows.lang == counts.of)
        .filter(unit < F.col("share"))
        .select("lang", "text", "draw")
        .repartition("lang")
        .sortWithinPartitions("lang", "draw", "text")
    )

    def work(batches):
        for table in whole_groups(batches, ["lang"]):
            names = np.array(table.column("lang").to_pylist(), object)
            texts = table.column("text").to_pylist()
            for name in dict.fromkeys(names):
                at = np.flatnonzero(names == name)
                x = vectors([texts[i] for i in at], idf, settings)
                centers, own = cluster(x, settings.centroids, settings.rounds)
                cosine = (x * centers[own]).sum(1)
                bounds = [
                    float(np.quantile(cosine[own == c], settings.reject)) if (own == c).any() else 0.0
                    for c in range(len(centers))
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(centers)),
                        pa.array([c.astype("<f4").tobytes() for c in centers], pa.binary()),
                        pa.array(bounds),
                    ],
                    names=["lang", "centroid", "bound"],
                )

    fitted = arrow_map(sample, work, "lang string, centroid binary, bound double").collect()
    fitted.sort(key=lambda r: (r.lang, bytes(r.centroid)))
    if not fitted:
        return LanguageModel()
    return LanguageModel(
        [r.lang for r in fitted],
        np.stack([np.frombuffer(r.centroid, "<f4") for r in fitted]),
        np.array([r.bound for r in fitted]),
        idf,
    )


def predict(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...], settings: LanguageSettings = LanguageSettings()) -> DataFrame:
    """``keep`` columns with ``lang_pred``, ``score`` (cosine) and ``rejected``, for every row of ``docs``.

    A text that is null or has no letter is ``und`` with score 0, and rejected; so is every text if
    nothing was learned. Ties go to the language that comes first. Columns of ``docs`` other than ``text``
    and ``keep`` are ignored; repeated rows are predicted alike.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # one vector per centroid

    def work(batches):
        known = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            n = len(texts)
            name, score, out = [UNKNOWN] * n, np.zeros(n), np.ones(n, bool)
            lettered = [i for i, t in enumerate(texts) if has_letter(t)] if known.languages else []
            for a in range(0, len(lettered), 128):
                at = lettered[a : a + 128]
                cosine = vectors([texts[i] for i in at], known.idf, settings) @ known.centroids.T
                best = cosine.argmax(1)
                value = cosine[np.arange(len(at)), best]
                for i, b in zip(at, best):
                    name[i] = known.languages[b]
                score[at] = np.clip(value, 0, 1)
                out[at] = value < known.bounds[best]
            yield pa.RecordBatch.from_arrays(
                [batch.column(f"key{k}") for k in range(len(keep))] + [pa.array(name, pa.string()), pa.array(score), pa.array(out)],
                names=[*(f"key{k}" for k in range(len(keep))), "lang_pred", "score", "rejected"],
            )

    rows = docs.select(*(F.col(c).alias(f"key{k}") for k, c in enumerate(keep)), F.col("text").cast("string").alias("text"))
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"key{k} {kinds[f'key{k}']}" for k in range(len(keep)))
    found = arrow_map(rows, work, f"{schema}, lang_pred string, score double, rejected boolean")
    return found.select(*(F.col(f"key{k}").alias(c) for k, c in enumerate(keep)), "lang_pred", "score", "rejected")
