"""Near-duplicate documents by SetSketch registers, bands, and exact confirmation.

1. Every text becomes the set of its shingles (64-bit hashes). Each shingle drives a Poisson
   process of points that are dealt to ``registers`` at random; a register keeps its smallest
   point, stored as ``floor(1 - log_base(point))``. Points beyond a truncation level cannot be
   minima of a large set and are never made, so a set costs about ``registers * ln(registers)``
   points, not ``registers`` per shingle. Registers of a union are the maxima of the registers.
2. Equal sets are one class. Classes that share all registers of a band are candidates; a pair
   is looked at in the first band it shares.
3. The joint likelihood of a pair's register comparison, given both set sizes, discards pairs
   that are far below the threshold (four standard errors).
4. What remains is confirmed on the full sets; pairs that are already connected inside a task
   are skipped. Components come from the confirmed links only.

A bucket of any size is dealt to tasks in pairs of blocks of ``BLOCK`` classes, so no bucket is
capped and none is gathered in one task.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.common import arrow_map, binary_array, bytes_of, pieces, run_starts, small_side, whole_groups, written
from cohortwise.llm.components import components
from cohortwise.llm.words import BASE, hash_words, mix, window_hashes

BLOCK = 1024
TRUNCATION = 12.0
INSTRUCTION = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class SketchSettings:
    """Shingle words, similarity in percent, and the shape of the sketch.

    With 25 bands of 5 registers a pair at 85 % is missed with a chance of about 4e-7.
    """

    words: int = 3
    percent: int = 85
    bands: int = 25
    rows: int = 5
    base: float = 1.001
    errors: float = 4.0

    @property
    def registers(self) -> int:
        return self.bands * self.rows

    @property
    def floor(self) -> float:
        """Pairs whose likelihood peaks below this similarity are not confirmed."""
        j = self.percent / 100
        return max(0.0, j - self.errors * (j * (1 - j) / self.registers) ** 0.5)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text with fewer words than ``size`` has one shingle, all its words; without words none.
    """
    words, at = hash_words(data, bounds, lower=True)
    windows = window_hashes(words, size)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= size:
            s = np.sort(windows[a : b - size + 1])
            keep = np.ones(len(s), bool)
            np.not_equal(s[1:], s[:-1], out=keep[1:])
            out.append(s[keep])
        elif b > a:
            whole = np.array([b - a], np.uint64)
            for w in words[a:b]:
                whole = mix(whole * BASE + w + np.uint64(1))
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def sketch(sets: list[np.ndarray], settings: SketchSettings) -> np.ndarray:
    """Registers of each set as rows of unsigned 16-bit numbers; an empty set has zeros."""
    m = settings.registers
    sizes = np.array([len(s) for s in sets], np.int64)
    least = np.full((len(sets), m), np.inf)
    level = np.where(sizes > 0, TRUNCATION / np.maximum(sizes, 1), 0)
    open_sets = np.flatnonzero(sizes > 0)
    while len(open_sets):
        state = np.concatenate([sets[i] for i in open_sets])
        owner = np.repeat(open_sets, sizes[open_sets])
        point = np.zeros(len(state))
        flat = least.reshape(-1)
        while len(state):
            state = mix(state + INSTRUCTION)
            uniform = ((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
            point = point - np.log(uniform) / m
            keep = point < level[owner]
            state, point, owner = state[keep], point[keep], owner[keep]
            register = ((mix(state ^ BASE) >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            np.minimum.at(flat, owner * m + register.astype(np.int64), point)
        open_sets = open_sets[np.isinf(least[open_sets]).any(axis=1)]
        level[open_sets] *= 6  # points are the same at any level, so registers do not depend on it
    least[sizes == 0] = 1.0
    values = np.floor(1.0 - np.log(least) / np.log(settings.base)) + 16384  # points above 1 stay positive
    values[sizes == 0] = 0
    return np.clip(values, 0, 65535).astype(np.uint16)


def band_keys(registers: np.ndarray, settings: SketchSettings) -> np.ndarray:
    out = np.empty((len(registers), settings.bands), np.uint64)
    for band in range(settings.bands):
        key = np.full(len(registers), band + 1, np.uint64)
        for r in range(band * settings.rows, (band + 1) * settings.rows):
            key = mix(key * BASE + registers[:, r].astype(np.uint64) + np.uint64(1))
        out[:, band] = key
    return out


def _slope(plus, minus, equal, u, v, j, base):
    """Derivative at similarity ``j`` of the log likelihood of a register comparison."""
    j = np.minimum(j, np.minimum(u / v, v / u))  # a subset is as similar as sets can be
    c = (base - 1) / base

    def p(x):
        return -np.log1p(-np.maximum(x, 1e-12) * c) / np.log(base)

    def dp(x):
        return c / (1 - np.maximum(x, 1e-12) * c) / np.log(base)

    # the part of the union that only one side has, from the sizes and the similarity
    first, second = np.maximum(u - v * j, 1e-9), np.maximum(v - u * j, 1e-9)
    zero = np.maximum(1 - p(first) - p(second), 1e-9)
    return (
        -plus * v * dp(first) / p(first)
        - minus * u * dp(second) / p(second)
        + equal * (v * dp(first) + u * dp(second)) / zero
    )


def likely(x: np.ndarray, y: np.ndarray, n: np.ndarray, k: np.ndarray, floor: float, base: float) -> np.ndarray:
    """Whether the most likely similarity of each pair of register rows is ``floor`` or more."""
    plus, minus = (x > y).sum(-1), (x < y).sum(-1)
    u, v = n / (n + k), k / (n + k)
    fits = np.minimum(n, k) >= floor * np.maximum(n, k)
    return fits & (_slope(plus, minus, x.shape[-1] - plus - minus, u, v, floor, base) >= 0)


def estimate(x: np.ndarray, y: np.ndarray, n: int, k: int, base: float) -> float:
    """The most likely similarity of two register rows with set sizes ``n`` and ``k``."""
    if n == 0 or k == 0:
        return 0.0
    low, high = 0.0, min(n, k) / max(n, k)
    plus, minus = int((x > y).sum()), int((x < y).sum())
    u, v = n / (n + k), k / (n + k)
    for _ in range(50):
        middle = (low + high) / 2
        if _slope(plus, minus, len(x) - plus - minus, u, v, middle, base) >= 0:
            low = middle
        else:
            high = middle
    return low


def sketch_documents(docs: DataFrame, settings: SketchSettings, carried: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``class`` (hash of the whole set), registers and band keys.

    The ``carried`` columns of ``docs`` (longs) come along.
    """

    def work(batches):
        for batch in batches:
            data, bounds = bytes_of(batch.column("text"))
            for a, b in pieces(bounds):
                part = bounds[a : b + 1]
                sets = shingle_sets(data[part[0] : part[-1]], part - part[0], settings.words)
                registers = sketch(sets, settings)
                keys = band_keys(registers, settings).view(np.int64)
                empty = np.array([len(s) == 0 for s in sets])
                flat = pa.array(keys[~empty].reshape(-1))
                counts = np.where(empty, 0, settings.bands)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), flat
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        binary_array(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets),
                        binary_array(r.tobytes() for r in registers),
                        lists,
                        *(batch.column(c).slice(a, b - a) for c in carried),
                    ],
                    names=["doc_id", "n_shingles", "class", "registers", "keys", *carried],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carried)
    schema = "doc_id long, n_shingles long, class binary, registers binary, keys array<long>"
    return arrow_map(rows, work, ", ".join([schema, *(f"{c} long" for c in carried)]))


def candidate_groups(classes: DataFrame, settings: SketchSettings) -> DataFrame:
    """``bucket``, ``i``, ``j``, ``class``: who is to be compared with whom, as groups.

    Only members of a likely pair remain. A group (i, j) holds blocks i and j of its bucket.
    """
    keys = classes.select("class", F.explode("keys").alias("bucket"))
    buckets = keys.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    spread = (F.col("members") / BLOCK).cast("long") + 1
    members = (
        keys.join(buckets, "bucket")
        .join(classes.select("class", "registers", "n_shingles"), "class")
        .withColumn("blocks", spread)
        .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")))
        .withColumn(
            "other", F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long"))).otherwise(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        )
        .select(
            "bucket",
            F.least("block", "other").alias("i"),
            F.greatest("block", "other").alias("j"),
            F.col("block").cast("long").alias("block"),
            "class",
            "registers",
            "n_shingles",
        )
    )
    m, rows = settings.registers, settings.rows

    def pairs_of(registers, sizes, block, i, j):
        """Likely pairs of one group that share no earlier band, as positions."""
        n = len(registers)
        left = np.arange(n) if i == j else np.flatnonzero(block == i)
        right = left if i == j else np.flatnonzero(block == j)
        for k, x in enumerate(left):
            with_ = right[k + 1 :] if i == j else right
            if not len(with_):
                continue
            yield x, with_

    def work(batches):
        for table in whole_groups(batches, ["bucket", "i", "j"]):
            bucket, i, j, block = (table.column(c).to_numpy() for c in ("bucket", "i", "j", "block"))
            data, _ = bytes_of(table.column("registers"))
            registers = data.view(np.uint16).reshape(-1, m)
            sizes = table.column("n_shingles").to_numpy()
            kept = np.zeros(len(bucket), bool)

            def look(x, y):
                """Mark both ends of the likely pairs (x, y) that belong to this bucket."""
                rx, ry = registers[x], registers[y]
                same = (rx == ry).reshape(len(x), settings.bands, rows).all(-1)
                first = same.argmax(-1)
                for_band = np.zeros(len(x), bool)
                for band in np.unique(first):
                    at = first == band
                    for_band[at] = band_keys_of(rx[at], band) == bucket[x[at]]
                ok = for_band & likely(rx, ry, sizes[x], sizes[y], settings.floor, settings.base)
                kept[x[ok]] = True
                kept[y[ok]] = True

            def band_keys_of(r, band):
                key = np.full(len(r), band + 1, np.uint64)
                for c in range(band * rows, (band + 1) * rows):
                    key = mix(key * BASE + r[:, c].astype(np.uint64) + np.uint64(1))
                return key.view(np.int64)

            starts = run_starts(bucket, i, j)
            lengths = np.diff(starts)
            of_run = np.repeat(np.arange(len(lengths)), lengths)
            small = lengths[of_run] <= 32
            for step in range(1, 32):  # all pairs of all small groups, by distance
                x = np.flatnonzero(small[:-step])
                x = x[of_run[x] == of_run[x + step]]
                if not len(x):
                    break
                for a in range(0, len(x), 20000):
                    x1, y1 = x[a : a + 20000], x[a : a + 20000] + step
                    apart = (i[x1] == j[x1]) | (block[x1] != block[y1])
                    look(x1[apart], y1[apart])
            for g in np.flatnonzero(lengths > 32):
                a, b = starts[g], starts[g + 1]
                for x, with_ in pairs_of(registers[a:b], sizes[a:b], block[a:b], i[a], j[a]):
                    look(np.full(len(with_), a + x), a + with_)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(c[kept])
                    for c in (bucket, i, j, block)
                ]
                + [table.column("class").combine_chunks().filter(pa.array(kept))],
                names=["bucket", "i", "j", "block", "class"],
            )

    ready = members.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "class")
    return arrow_map(ready, work, "bucket long, i long, j long, block long, class binary")


def class_sets(docs: DataFrame, wanted: DataFrame, settings: SketchSettings) -> DataFrame:
    """``class``, ``set`` (sorted hashes as bytes) of the wanted classes, from a member's text."""

    def work(batches):
        for batch in batches:
            data, bounds = bytes_of(batch.column("text"))
            for a, b in pieces(bounds):
                part = bounds[a : b + 1]
                sets = shingle_sets(data[part[0] : part[-1]], part - part[0], settings.words)
                yield pa.RecordBatch.from_arrays(
                    [
                        binary_array(hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets),
                        binary_array(s.tobytes() for s in sets),
                    ],
                    names=["class", "set"],
                )

    # few ids go to the texts; many make the texts come to them, each once
    members = small_side(written(wanted.select(F.col("member").alias("doc_id")).distinct()))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = rows.join(members, rows.doc_id.eqNullSafe(members.doc_id), "left_semi").select("text")
    found = arrow_map(texts, work, "class binary, set binary")
    # rows that share an id may bring other sets along, and several rows the same set
    return found.join(wanted.select("class").distinct(), "class", "left_semi").dropDuplicates(["class"])


def confirmed_links(groups: DataFrame, sets: DataFrame, sketches: DataFrame, settings: SketchSettings) -> DataFrame:
    """``a``, ``b``: links confirmed on full sets, enough of them to connect what is linked."""
    m, percent = settings.registers, settings.percent

    def overlap(x, y):
        return len(np.intersect1d(x, y, assume_unique=True))

    def work(batches):
        for table in whole_groups(batches, ["bucket", "i", "j"]):
            bucket, i, j, block = (table.column(c).to_numpy() for c in ("bucket", "i", "j", "block"))
            data, bounds = bytes_of(table.column("set"))
            hashes = data.view(np.uint64) if len(data) else np.zeros(0, np.uint64)
            at = bounds // 8
            registers = bytes_of(table.column("registers"))[0].view(np.uint16).reshape(-1, m)
            sizes = np.diff(at)
            node = table.column("node").to_numpy()
            a_out, b_out = [], []
            starts = run_starts(bucket, i, j)
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
                root = list(range(e - s))

                def find(v):
                    while root[v] != v:
                        root[v] = root[root[v]]
                        v = root[v]
                    return v

                rows = np.arange(s, e)
                left = rows if i[s] == j[s] else rows[block[s:e] == i[s]]
                right = rows if i[s] == j[s] else rows[block[s:e] == j[s]]
                for k, x in enumerate(left.tolist()):
                    ys = right[k + 1 :] if i[s] == j[s] else right
                    if not len(ys):
                        continue
                    ok = likely(registers[x][None], registers[ys], sizes[x], sizes[ys], settings.floor, settings.base)
                    for y in ys[ok].tolist():
                        p, q = find(x - s), find(y - s)
                        if p == q:
                            continue
                        both = overlap(hashes[at[x] : at[x + 1]], hashes[at[y] : at[y + 1]])
                        if 100 * both >= percent * (sizes[x] + sizes[y] - both) and both:
                            root[max(p, q)] = min(p, q)
                            a_out.append(node[x])
                            b_out.append(node[y])
            yield pa.RecordBatch.from_arrays(
                [pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"]
            )

    rows = (
        groups.join(sets, "class")
        .join(sketches.select("class", "registers", "node"), "class")
        .select("bucket", "i", "j", "block", "set", "registers", "node")
    )
    ready = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")
    return arrow_map(ready, work, "a long, b long")


def near_duplicates(docs: DataFrame, settings: SketchSettings = SketchSettings()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept``; one row per row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns, whatever their names, are ignored. A
    null text is empty. Empty texts have no shingles, link with nothing and are kept, each its own
    component. Rows with equal texts are linked at any size of the group. ``component_id`` is the
    smallest non-null id that can be reached; a row without an id is kept only if its component
    has no id at all. Rows that repeat an id are separate rows with their own texts, kept alike.
    """
    judged = labelled_documents(docs, settings)
    return judged.select("doc_id", "n_shingles", "component_id").withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def labelled_documents(docs: DataFrame, settings: SketchSettings, carried: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``, ``component`` and the ``carried`` columns of each row.

    ``component`` tells components apart that have no id, too; it is null for texts without shingles.
    """
    sketched = written(sketch_documents(docs, settings, carried))
    classes = written(
        sketched.filter("n_shingles > 0")
        .groupBy("class")
        .agg(
            F.min("doc_id").alias("member"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("registers").alias("registers"),
            F.first("keys").alias("keys"),
        )
        .withColumn("node", F.xxhash64("class"))
    )
    groups = written(candidate_groups(classes, settings))
    active = groups.select("class").distinct()
    wanted = written(classes.select("class", "member").join(active, "class", "left_semi"))
    sets = class_sets(docs, wanted, settings)
    links = confirmed_links(groups, sets, classes, settings)
    labels = components(links)
    labelled = classes.select("class", "member", "node").join(labels, "node", "left")
    heads = labelled.filter("label is not null").groupBy("label").agg(F.min("member").alias("head"))
    joined = labelled.join(heads, "label", "left").select(
        "class", F.coalesce("head", "member").alias("component_id"), F.coalesce("label", "node").alias("component")
    )
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        sketched.select("doc_id", "n_shingles", "class", *carried)
        .join(joined, "class", "left")
        .select("doc_id", "n_shingles", own.alias("component_id"), "component", *carried)
    )
