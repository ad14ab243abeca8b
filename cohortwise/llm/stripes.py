"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it.

Words of a language are 64-bit keys; a phrase is the key of its prefix and its last word. Tasks count
their texts into stripes (prefix, next words, counts), stripes of a prefix are merged elementwise, and what
is rarer than ``least`` goes. A phrase can only be frequent if the phrases one word shorter inside it are,
so the stripes of one length are counted where a bitmap of the frequent phrases of the length before says
so; a bitmap may let rare phrases through, which cost some bytes and are removed after the merge.

From the merged stripes follow all three: their entries are the phrases (extensions of their prefix), the
entry that a prefix has in its own, shorter stripe is its total, and the largest entry of a stripe, or of the
stripes shifted by one word, is the most frequent longer phrase around a phrase.

A prefix that makes up more than a thousandth of all words (there are at most ``HOT`` of them) has its stripe cut by
hash of the next word, so no prefix, however frequent, is merged in one task. Slices follow the shuffle partitions;
a slice is merged by itself and compacted as it grows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.llm.common import arrow_map, bytes_of, pieces, run_starts, written
from cohortwise.llm.words import BASE, LONG, LOWER, mix, span_hashes

PIECE = np.zeros(256, bool)
PIECE[[*b".,;:!?", 10, 11, 12, 13]] = True
BREAK = PIECE.copy()
BREAK[[32, 9]] = True
CHUNK = 2 << 20
HOT = 1024
SLICES = 4
BITS_PER_KEY = 32
MOST_BITS = 30
REGION_BITS = 20
UNKNOWN = "und"


@dataclass(frozen=True)
class CollocationSettings:
    """Longest phrase, least occurrences of a candidate, percent of its occurrences inside a longer one, rows a language."""

    words: int = 4
    least: int = 30
    inside: int = 80
    rows: int = 2000


def _words(data: np.ndarray, bounds: np.ndarray, salts: np.ndarray):
    """Keys, piece numbers, starts, ends and rows of the words of some texts."""
    lower = LOWER[data]
    inside = ~BREAK[lower]
    if not len(data):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, none, none
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    owner = np.searchsorted(bounds, starts, "right") - 1
    keys = mix(span_hashes(lower, starts, ends) ^ salts[owner])
    return keys, np.cumsum(PIECE[data])[starts] + owner, starts, ends, owner


def _parts(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, int, bool]]:
    """Bytes and bounds of row ranges, and whether they go on with the text of the range before."""
    for a, b in pieces(bounds):
        part = bounds[a : b + 1]
        if part[-1] - part[0] <= LONG or b > a + 1:
            yield data[part[0] : part[-1]], part - part[0], a, b, False
            continue
        at, end, goes_on = int(part[0]), int(part[-1]), False
        while at < end:  # a very long text, cut between words
            stop = min(at + LONG, end)
            while stop < end:
                cut = np.flatnonzero(BREAK[data[at:stop]])
                if len(cut):
                    stop = at + int(cut[-1]) + 1
                    break
                stop = min(stop + LONG, end)
            yield data[at:stop], np.array([0, stop - at]), a, b, goes_on
            at, goes_on = stop, True


def _salt(lang: str) -> int:
    data = np.frombuffer(lang.encode() + b"\0", np.uint8)
    return int(span_hashes(data, np.array([0]), np.array([len(data)]))[0])


def _texts(batches):
    """Bytes, bounds, salts, languages and whether a part goes on with the text of the part before."""
    for batch in batches:
        langs = batch.column("lang")
        known = langs.dictionary_encode()
        of = np.array([_salt(x) for x in known.dictionary.to_pylist()] or [0], np.uint64)
        salts = of[known.indices.to_numpy(zero_copy_only=False)] if len(langs) else np.zeros(0, np.uint64)
        data, bounds = bytes_of(batch.column("text"))
        for part, edges, a, b, goes_on in _parts(data, bounds):
            yield part, edges, salts[a:b], langs.slice(a, b - a), goes_on


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, the sums of their counts and where each is first found."""
    order = np.argsort(keys, kind="stable")
    edges = run_starts(keys[order])
    first = order[edges[:-1]]
    return keys[first], np.add.reduceat(counts[order], edges[:-1]) if len(keys) else counts, first


def word_totals(texts: DataFrame) -> DataFrame:
    """``key lang word n`` of every word."""

    def work(batches):
        held, size = [], 0

        def merged():
            keys, counts = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            words, langs = (pa.concat_arrays([h[i] for h in held]) for i in (2, 3))
            keys, counts, first = _summed(keys, counts)
            return keys, counts, words.take(pa.array(first)), langs.take(pa.array(first))

        def batches_of(rows):
            keys, counts, words, langs = rows
            for a in range(0, len(keys), 100_000):
                cut = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[cut].view(np.int64)), langs[cut], words[cut], pa.array(counts[cut])],
                    names=["key", "lang", "word", "n"],
                )

        for part, edges, salts, langs, _ in _texts(batches):
            keys, _, starts, ends, owner = _words(part, edges, salts)
            if not len(keys):
                continue
            keys, counts, first = _summed(keys, np.ones(len(keys), np.int64))
            lengths = ends[first] - starts[first]
            offsets = np.concatenate([[0], np.cumsum(lengths)])
            at = np.repeat(starts[first] - offsets[:-1], lengths) + np.arange(offsets[-1])
            words = pa.Array.from_buffers(
                pa.binary(), len(first), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(LOWER[part][at])]
            )
            held.append((keys, counts, words.cast(pa.string()), langs.take(pa.array(owner[first])).cast(pa.string())))
            size += len(keys)
            if size > CHUNK // 2:
                held = [merged()]
                size = len(held[0][0])
                if size > CHUNK // 4:
                    yield from batches_of(held[0])
                    held, size = [], 0
        if held:
            yield from batches_of(merged())

    return (
        arrow_map(texts, work, "key long, lang string, word string, n long")
        .groupBy("key", "lang", "word")
        .agg(F.sum("n").alias("n"))
    )


@dataclass(frozen=True)
class KeyFilter:
    """A bitmap over the leading bits of keys."""

    bitmap: bytes
    bits: int

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> np.uint64(64 - self.bits)
        found = np.frombuffer(self.bitmap, np.uint8)[(at >> np.uint64(3)).astype(np.int64)]
        return (found >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def key_filter(keys: DataFrame, most_bits: int = MOST_BITS) -> KeyFilter:
    """The bitmap of the column ``key``: about 32 bits a key, never more than ``2**most_bits``."""
    bits = min(most_bits, max(REGION_BITS, (BITS_PER_KEY * keys.count()).bit_length()))
    region = F.shiftrightunsigned("key", 64 - bits + REGION_BITS) if bits > REGION_BITS else F.lit(0).cast("long")

    def work(table: pa.Table) -> pa.Table:
        found = table.column("key").to_numpy().view(np.uint64) >> np.uint64(64 - bits)
        marks = np.zeros(1 << REGION_BITS, np.uint8)
        marks[(found & np.uint64((1 << REGION_BITS) - 1)).astype(np.int64)] = 1
        packed = np.packbits(marks, bitorder="little").tobytes()
        return pa.table({"region": table.column("region").slice(0, 1), "marks": pa.array([packed], pa.binary())})

    regions = keys.select("key", region.alias("region")).groupBy("region").applyInArrow(work, "region long, marks binary")
    whole, size = bytearray(1 << (bits - 3)), 1 << (REGION_BITS - 3)
    for r in regions.toLocalIterator():
        whole[r.region * size : (r.region + 1) * size] = r.marks
    return KeyFilter(bytes(whole), bits)


def stripes(texts: DataFrame, length: int, frequent: KeyFilter, hot: list[int], least: int) -> DataFrame:
    """``prefix entries`` (``next key n``) of the phrases of ``length`` words with ``least`` occurrences.

    A task sends one row for each slice of the prefixes, as it would send one block to each task of a shuffle.
    A stripe of a hot prefix is dealt to all slices by its next words, and stays in parts.
    """
    spark = texts.sparkSession
    slices = SLICES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    filter_, hot_keys = spark.sparkContext.broadcast(frequent), np.array(sorted(hot), np.int64).view(np.uint64)
    packed = ("prefix", "size", "next", "n")

    def count(batches):
        held, size, groups = [], 0, 0

        def rows():
            keys, group = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            n = len(keys) - length + 1
            if n <= 0:
                return
            gram = keys.copy()  # of length - 1 words from each word on
            for k in range(1, length - 1):
                gram = mix(gram[:-1] * BASE + keys[k:])
            common = filter_.value.has(gram)
            at = np.flatnonzero(common[:n] & common[1 : n + 1] & (group[:n] == group[length - 1 :]))
            if not len(at):
                return
            prefix, following = gram[at], keys[at + length - 1]
            _, counts, first = _summed(mix(prefix * BASE + following), np.ones(len(at), np.int64))
            prefix, following = prefix[first], following[first]
            dealt = np.where(np.isin(prefix, hot_keys), following, prefix)
            slice_ = ((dealt >> np.uint64(40)) % np.uint64(slices)).astype(np.int32)
            order = np.lexsort((following, prefix, slice_))
            slice_, prefix, following, counts = slice_[order], prefix[order], following[order], counts[order].astype(np.uint32)
            heads = run_starts(slice_, prefix)
            sizes, prefix, owner = np.diff(heads).astype(np.uint32), prefix[heads[:-1]], slice_[heads[:-1]]
            edges = run_starts(owner)
            for i in range(len(edges) - 1):
                a, b = edges[i], edges[i + 1]
                c, d = heads[a], heads[b]
                columns = (prefix[a:b], sizes[a:b], following[c:d], counts[c:d])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([owner[a]], pa.int32()), *(pa.array([v.tobytes()], pa.binary()) for v in columns)],
                    names=["slice", *packed],
                )

        for part, edges, salts, _, goes_on in _texts(batches):
            keys, group, *_ = _words(part, edges, salts)
            if size > CHUNK and not goes_on:
                yield from rows()
                held, size, groups = [], 0, 0
            # a part that goes on with a text continues its last piece
            base = groups if goes_on else groups + 1
            held.append((keys, group + base))
            size += len(keys)
            groups = base + int(PIECE[part].sum()) + len(edges) - 2
        if held:
            yield from rows()

    def merge(batches):
        def summed(parts):
            """The entries of several stripes, equal ones added."""
            prefix, following, n = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((following, prefix))
            prefix, following, n = prefix[order], following[order], n[order]
            edges = run_starts(prefix, following)
            return prefix[edges[:-1]], following[edges[:-1]], np.add.reduceat(n, edges[:-1])

        def batch_of(parts):
            prefix, following, n = summed(parts)
            keep = np.flatnonzero(n >= least)
            prefix, following, n = prefix[keep], following[keep], n[keep]
            edges = run_starts(prefix)
            key = mix(prefix * BASE + following)
            entries = pa.StructArray.from_arrays(
                [pa.array(following.view(np.int64)), pa.array(key.view(np.int64)), pa.array(n)], names=["next", "key", "n"]
            )
            return pa.RecordBatch.from_arrays(
                [pa.array(prefix[edges[:-1]].view(np.int64)), pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), entries)],
                names=["prefix", "entries"],
            )

        held, size, now = [], 0, None
        for batch in batches:
            columns = [batch.column(c) for c in packed]
            for i, slice_ in enumerate(batch.column("slice").to_pylist()):
                if slice_ != now and held:
                    yield batch_of(held)
                    held, size = [], 0
                now = slice_
                prefix, sizes, following, n = (
                    np.frombuffer(c[i].as_buffer(), kind) for c, kind in zip(columns, ("<u8", "<u4", "<u8", "<u4"))
                )
                held.append((np.repeat(prefix, sizes), following.copy(), n.astype(np.int64)))
                size += len(n)
                if size > CHUNK // 2:
                    held = [summed(held)]
                    size = len(held[0][0]) // 2  # grows to twice what is left, so merging stays in proportion
        if held:
            yield batch_of(held)

    sent = arrow_map(texts, count, "slice int, prefix binary, size binary, next binary, n binary")
    dealt = sent.repartition("slice").sortWithinPartitions("slice")
    return arrow_map(dealt, merge, "prefix long, entries array<struct<next: long, key: long, n: long>>")


def _extended(found: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases of the entries of stripes: totals of their beginnings and ends come from the phrases one word shorter."""
    entries = found.select("prefix", F.inline("entries"))
    p = shorter.select(
        F.col("key").alias("prefix"), F.col("rest").alias("_tail"), "lang", "text", F.col("heads").alias("_heads")
    )
    s = shorter.select(
        F.col("prefix").alias("_tail"), "next", F.col("key").alias("_rest"), "last", F.col("tails").alias("_tails")
    )
    return entries.join(p, "prefix").join(s, ["_tail", "next"]).select(
        "key", "prefix", "next", F.col("_rest").alias("rest"), "n", "lang",
        F.concat_ws(" ", "text", "last").alias("text"), "last",
        F.concat("_heads", F.array("n")).alias("heads"), F.concat("_tails", F.array("n")).alias("tails"),
    )


def _lowest_cut(length: int):
    """The lowest of the scores of all cuts, with its totals; the shortest first part where they are equal."""
    cuts = []
    for k in range(1, length):
        left, right = F.element_at("heads", k), F.element_at("tails", length - k)
        # exact: the product may pass 64 bits
        product = F.lit(2_000_000).cast("decimal(8, 0)") * F.col("n").cast("decimal(20, 0)")
        score = F.call_function("div", product, (left + right).cast("decimal(20, 0)"))
        cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))
    return F.array_min(F.array(*cuts))


def collocations(docs: DataFrame, settings: CollocationSettings = CollocationSettings()) -> DataFrame:
    """``lang rank phrase a l r n score``: the best phrases of each language.

    ``docs`` needs ``text`` and ``lang``; other columns are ignored. A null text has no words, a null
    language is ``und``. Every row counts, repeated or not; an empty table gives no rows. Phrases never cross
    ``.,;:!?`` or a line end. Words are told apart by 64-bit hashes.
    """
    texts = docs.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
    )
    totals = written(word_totals(texts))
    sizes = totals.groupBy("lang").agg(F.sum("n").alias("n"))
    everything = totals.agg(F.sum("n")).first()[0] or 0
    none = F.lit(0).cast("long")
    # a word extends the empty phrase, whose key is 0
    phrases = written(
        totals.filter(F.col("n") >= settings.least).select(
            "key", none.alias("prefix"), F.col("key").alias("next"), none.alias("rest"), "n", "lang",
            F.col("word").alias("text"), F.col("word").alias("last"), F.array("n").alias("heads"), F.array("n").alias("tails"),
        )
    )
    judged, longer = None, None
    for length in range(2, settings.words + 1):
        hot = [r.key for r in phrases.filter(F.col("n") > everything // HOT).select("key").collect()]
        found = written(stripes(texts, length, key_filter(phrases.select("key")), hot, settings.least))
        phrases = written(_extended(found, phrases))
        cut = _lowest_cut(length)
        part = phrases.select("key", "lang", F.col("text").alias("phrase"), F.col("n").alias("a"), cut.alias("cut"))
        judged = part if judged is None else judged.unionByName(part)
        if length > 2:
            after = found.select(F.col("prefix").alias("key"), F.array_max(F.col("entries")["n"]).alias("most"))
            around = after.unionByName(phrases.select(F.col("rest").alias("key"), F.col("n").alias("most")))
            longer = around if longer is None else longer.unionByName(around)
    if longer is not None:
        most = longer.groupBy("key").agg(F.max("most").alias("most"))
        judged = judged.join(most, "key", "left").filter(
            F.col("most").isNull() | (100 * F.col("most").cast("decimal(20, 0)") < settings.inside * F.col("a").cast("decimal(20, 0)"))
        )
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (
        judged.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), F.col("cut.score").alias("score"))
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= settings.rows)
    )
    return ranked.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
