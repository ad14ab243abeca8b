"""Equal texts by compressed tries over ranges of text prefixes.

``prefix_bounds`` cuts the order of all texts into ranges of bounded size. It walks down the trie of all
texts, level by level and over all rows: a node that holds more than a range may is cut at its next
byte, after skipping what all its texts share, so a passage that many texts begin with costs one level
however long it is. A node whose texts are all equal is not cut further.

``first_ids`` inserts every text in a trie of its range. Each task first merges its own rows in a trie,
so of equal texts one row a task travels, however many copies there are; a trie is emptied when it holds
``HELD`` bytes. The tries of the ranges are filled one range at a time.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.llm.common import arrow_map, bytes_of, pieces, written

RANGE_BYTES = 8 << 20
MOST_RANGES = 1 << 20
HEAD = 512
HELD = 24 << 20
SPREAD = 1021


def shared(label: bytes, text: bytes, at: int = 0) -> int:
    """How many bytes ``label`` and ``text[at:]`` have in common from their start."""
    lo, hi = 0, min(len(label), len(text) - at)
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if label[lo:mid] == text[at + lo : at + mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


class RadixTrie:
    """Texts as paths of labelled edges; a terminal holds the smallest id that was inserted there."""

    def __init__(self):
        self.labels: list[bytes] = [b""]
        self.below: list[dict[int, int] | None] = [None]
        self.least: list[int | None] = [None]
        self.terminal: list[bool] = [False]
        self.held = 0

    def _node(self, label: bytes) -> int:
        self.labels.append(label)
        self.below.append(None)
        self.least.append(None)
        self.terminal.append(False)
        self.held += len(label) + 100
        return len(self.labels) - 1

    def insert(self, text: bytes, key: int | None) -> int:
        """Put a text in; returns its terminal, which later insertions do not move."""
        node = at = 0
        while at < len(text):
            edges = self.below[node]
            if edges is None:
                edges = self.below[node] = {}
            child = edges.get(text[at])
            if child is None:
                edges[text[at]] = node = self._node(text[at:])
                break
            label = self.labels[child]
            if text.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = shared(label, text, at)
            upper = self._node(label[:same])
            self.held -= same
            self.labels[child] = label[same:]
            self.below[upper] = {label[same]: child}
            edges[text[at]] = node = upper
            at += same
        self.terminal[node] = True
        if key is not None and (self.least[node] is None or key < self.least[node]):
            self.least[node] = key
        return node

    def texts(self) -> Iterator[tuple[int, bytes]]:
        """All terminals with their texts, in byte order."""
        stack = [(0, b"")]
        while stack:
            node, path = stack.pop()
            path += self.labels[node]
            if self.terminal[node]:
                yield node, path
            edges = self.below[node]
            if edges:
                stack += [(edges[b], path) for b in sorted(edges, reverse=True)]


def _level(rows: DataFrame, frontier: list[bytes]) -> DataFrame:
    """Bytes below every next byte of the frontier's nodes, with what the texts there share."""
    frontier = sorted(frontier)

    def work(batches):
        found: dict[tuple[int, int], list] = {}
        for batch in batches:
            data, bounds = bytes_of(batch.column("head"))
            data = data.tobytes()
            sizes, whole = batch.column("size").to_pylist(), batch.column("whole").to_pylist()
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                text = data[a:b]
                node = bisect_right(frontier, text) - 1
                if node < 0 or not text.startswith(frontier[node]):
                    continue
                depth = len(frontier[node])
                key = node, text[depth] if len(text) > depth else -1
                held = found.get(key)
                if held is None:
                    found[key] = [sizes[i], text, whole[i]]
                else:
                    held[0] += sizes[i]
                    same = shared(held[1], text)
                    held[2] = held[2] and whole[i] and same == len(held[1]) == len(text)
                    held[1] = held[1][:same]
        keys = list(found)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([frontier[n] for n, _ in keys], pa.binary()),
                pa.array([c for _, c in keys], pa.int32()),
                pa.array([found[k][0] for k in keys], pa.int64()),
                pa.array([found[k][1] for k in keys], pa.binary()),
                pa.array([found[k][2] for k in keys], pa.bool_()),
            ],
            names=["node", "next", "size", "share", "equal"],
        )

    parts = arrow_map(rows, work, "node binary, next int, size long, share binary, equal boolean")
    return parts.groupBy("node", "next").agg(
        F.sum("size").alias("size"),
        F.min("share").alias("low"),
        F.max("share").alias("high"),
        (F.bool_and("equal") & (F.min("share") == F.max("share"))).alias("equal"),
    )


def prefix_bounds(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> list[bytes]:
    """Where the ranges of texts begin, in byte order; the first is the empty text.

    A range has about ``range_bytes`` bytes, more where that would make over ``MOST_RANGES`` of them: what the
    driver holds is a few bytes for every range, never something of every document.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    size = (F.octet_length(text) + 16).cast("long").alias("size")
    head = F.substring(text, 1, HEAD)
    heads = written(docs.select(head.alias("head"), size, (head == text).alias("whole")))
    whole = docs.select(text.alias("head"), size, F.lit(True).alias("whole"))
    total = heads.agg(F.sum("size")).first()[0] or 0
    limit = max(range_bytes, total // MOST_RANGES)
    bounds, frontier, deep = {b""}, [b""] if total > limit else [], []
    while frontier or deep:
        rows, now = (heads, frontier) if frontier else (whole, deep)
        children = written(_level(rows, now))
        order = Window.partitionBy("node").orderBy("next")  # at most 257 rows a node
        heavy = F.col("size") > limit
        before = F.sum(F.when(heavy, 0).otherwise(F.col("size"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
        filled = F.floor(F.coalesce(before, F.lit(0)) / limit)
        after_heavy = F.coalesce(F.lag(heavy).over(order), F.lit(False))
        marked = children.select("node", "next", heavy.alias("heavy"), filled.alias("filled"), after_heavy.alias("after")).withColumn(
            "cut", F.col("heavy") | F.col("after") | (F.col("filled") > F.coalesce(F.lag("filled").over(order), F.lit(-1)))
        )
        for r in marked.filter("cut").select("node", "next").toLocalIterator():
            bounds.add(bytes(r.node) + (bytes([r.next]) if r.next >= 0 else b""))
        split = children.filter(heavy & (F.col("next") >= 0) & ~F.col("equal")).select("low", "high").collect()
        found = [bytes(r.low)[: shared(bytes(r.low), bytes(r.high))] for r in split]
        # what a head of full length shares may go on in the texts: those nodes are read whole
        if frontier:
            frontier = [p for p in found if len(p) < HEAD]
            deep += [p for p in found if len(p) >= HEAD]
        else:
            deep = found
    return sorted(bounds)


class _Rows:
    """Rows of one trie: terminal, id, mask, count and part of each."""

    def __init__(self):
        self.trie = RadixTrie()
        self.rows: list[tuple] = []

    def add(self, text: bytes, key, mask: int, n: int, part) -> None:
        self.rows.append((self.trie.insert(text, key), key, mask, n, part))


def first_ids(
    docs: DataFrame, masks: Callable[[np.ndarray, np.ndarray], np.ndarray], bit: int, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """``doc_id part mask n``: how many rows of an id and part have a mask.

    ``docs`` has ``doc_id``, ``part`` and ``text``. ``masks`` gives the mask of each text from (bytes,
    bounds); ``bit`` is added where some smaller ``doc_id`` has the same text. A null text is an empty one.
    A row without an id is no copy and makes none; rows with the same id and text are no copies of each other.
    """
    spark = docs.sparkSession
    bounds = spark.sparkContext.broadcast(prefix_bounds(docs, range_bytes))
    schema = "bucket int, doc_id long, part string, mask int, n long, text binary"
    names = ["bucket", "doc_id", "part", "mask", "n", "text"]

    def batch_of(rows):
        kinds = (pa.int32(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary())
        columns = list(zip(*rows)) or [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def merged(held: _Rows):
        """One row of the smallest id of each text, with the text; all others without it."""
        trie, firsts, rest = held.trie, {}, {}
        for node, key, mask, n, part in held.rows:
            if key is not None and key == trie.least[node]:
                found = firsts.setdefault(node, {})
                found[part] = found.get(part, 0) + n
            else:
                group = key, part, mask if key is None else mask | bit
                rest[group] = rest.get(group, 0) + n
        mask_of = {node: mask for node, _, mask, _, _ in held.rows}
        out, size = [], 0
        for node, text in trie.texts():
            for part, n in firsts.get(node, {}).items():
                at = bisect_right(bounds.value, text) - 1
                out.append((at, trie.least[node], part, mask_of[node], n, text))
                size += len(text)
                if size > 1 << 20:
                    yield batch_of(out)
                    out, size = [], 0
        # rows that are settled go anywhere
        out += [(-1 - i % SPREAD, key, part, mask, n, None) for i, ((key, part, mask), n) in enumerate(rest.items())]
        yield batch_of(out)

    def local(batches):
        held = _Rows()
        for batch in batches:
            data, edges = bytes_of(batch.column("text"))
            ids, parts = batch.column("doc_id").to_pylist(), batch.column("part").to_pylist()
            for a, b in pieces(edges):
                edge = edges[a : b + 1]
                piece = data[edge[0] : edge[-1]]
                at = (edge - edge[0]).tolist()
                found = masks(piece, edge - edge[0]).tolist()
                piece = piece.tobytes()
                for i in range(b - a):
                    held.add(piece[at[i] : at[i + 1]], ids[a + i], found[i], 1, parts[a + i])
                if held.trie.held > HELD:
                    yield from merged(held)
                    held = _Rows()
        yield from merged(held)

    def settled(held: _Rows):
        least = held.trie.least
        return [(0, key, part, mask | bit if key > least[node] else mask, n, None) for node, key, mask, n, part in held.rows]

    def judge(batches):
        held, now = _Rows(), None
        for batch in batches:
            buckets, ids, parts, found, counts = (batch.column(c).to_pylist() for c in names[:5])
            texts, out = batch.column("text"), []
            for i, bucket in enumerate(buckets):
                if bucket < 0:
                    out.append((0, ids[i], parts[i], found[i], counts[i], None))
                    continue
                if bucket != now:
                    out += settled(held)
                    held, now = _Rows(), bucket
                held.add(texts[i].as_py(), ids[i], found[i], counts[i], parts[i])
            if out:
                yield batch_of(out)
        if held.rows:
            yield batch_of(settled(held))

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("part").cast("string").alias("part"),
        F.col("text").cast("string").alias("text"),
    )
    dealt = arrow_map(rows, local, schema).repartition("bucket").sortWithinPartitions("bucket")
    return arrow_map(dealt, judge, schema).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))
