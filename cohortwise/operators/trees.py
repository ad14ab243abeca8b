"""Boosted trees on binned rows, grown by tasks that hold rows and share histograms (P5).

The rows of a fit stay in the tasks that read them, rows with equal codes as one record. A tree is grown leaf by
leaf, the leaf with the largest gain first; for each split the smaller child is counted in one histogram of all
features. Tasks that share a fit add their histograms, those of a whole level at once, so every task takes the same
decisions. A fit of one task needs no barrier. What travels is histograms (bins of all features), whatever the
number of rows.

Numbers fall in at most ``max_bins`` bins between quantiles, a category is a bin of its own, missing and
unseen ones share one more. Categories are split by their order of gradient over hessian.
"""

from __future__ import annotations

import base64
import heapq
import math
import os
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.functions.columns import col
from cohortwise.spec import CONTINUOUS

LEAST_HESSIAN = 1e-3
CHUNK_ROWS = 1 << 14
MERGE_ROWS = 2_000_000  # rows that are gathered before equal ones are merged
LEAST_CODES, MOST_CODES = 64, 16_384  # combinations of codes that are counted at once
MOST_AHEAD = 256  # leaves whose children are counted in one exchange
POLL_SECONDS = 0.001
QUANTILE_ACCURACY = 100_000
TREE_SCHEMA = "tree int, features array<int>, left array<int>, right array<int>, values array<double>, goes_left array<binary>"


@dataclass(frozen=True)
class FeatureBins:
    """How each feature becomes a code: upper edges and a stand-in for missing numbers, or the levels."""

    names: tuple[str, ...]
    edges: dict[str, tuple[float, ...]]
    stand_ins: dict[str, float]
    levels: dict[str, tuple[str, ...]]

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(self.edges[f]) + 1 if f in self.edges else len(self.levels[f]) + 1 for f in self.names])

    @property
    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)])

    def codes(self, columns: Iterable[pa.Array]) -> np.ndarray:
        """One row per record, one column per feature; a code is counted from the feature's offset on."""
        out = []
        for f, column, offset in zip(self.names, columns, self.offsets):
            if f in self.edges:
                x = column.cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
                x = np.where(np.isnan(x), self.stand_ins[f], x)
                code = np.searchsorted(np.array(self.edges[f]), x, "left")
            else:
                known = pc.index_in(column.cast(pa.string()), value_set=pa.array(self.levels[f], pa.string()))
                code = known.fill_null(len(self.levels[f])).to_numpy(zero_copy_only=False)
            out.append(code.astype(np.int32) + np.int32(offset))
        return np.ascontiguousarray(np.stack(out, axis=1)) if len(out[0]) else np.zeros((0, len(out)), np.int32)


def feature_bins(rows: DataFrame, schema: dict[str, dict], max_bins: int) -> FeatureBins:
    """Edges of the numbers from one aggregate over the rows; levels are those of the schema."""
    numeric = [f for f, s in schema.items() if s["kind"] == CONTINUOUS]
    shares = [i / max_bins for i in range(1, max_bins)]
    edges = {}
    if numeric:
        found = rows.agg(
            *(F.percentile_approx(col(f).cast("double"), shares, QUANTILE_ACCURACY).alias(f"e{i}") for i, f in enumerate(numeric)),
            *(F.max(col(f).cast("double")).alias(f"m{i}") for i, f in enumerate(numeric)),
        ).first()
        for i, f in enumerate(numeric):
            edges[f] = tuple(sorted({e for e in found[f"e{i}"] or [] if e < found[f"m{i}"]}))
    return FeatureBins(
        tuple(schema), edges, {f: float(schema[f]["reference_value"]) for f in numeric},
        {f: tuple(s["levels"]) for f, s in schema.items() if f not in edges},
    )


@dataclass
class Tree:
    """Nodes as arrays, parents before their children; a leaf has feature -1.

    ``goes_left`` has a flag per code of the node's feature; a right child follows its left sister.
    """

    features: np.ndarray
    left: np.ndarray
    right: np.ndarray
    values: np.ndarray
    goes_left: list[np.ndarray]


class TreeModel:
    """An additive model in log-odds."""

    def __init__(self, bins: FeatureBins, trees: list[Tree]):
        self.bins, self.trees = bins, trees
        self._packed = self._allowed = None

    def _pack(self):
        """All trees in one set of arrays; a right child follows its sister, a leaf leads to itself."""
        if self._packed is None:
            starts = np.cumsum([0, *(len(t.features) for t in self.trees)])
            leaf = np.concatenate([t.features < 0 for t in self.trees])
            left = np.concatenate([t.left + s for t, s in zip(self.trees, starts)])
            left = np.where(leaf, np.arange(starts[-1]), left).astype(np.int32)
            feature = np.where(leaf, 0, np.concatenate([t.features for t in self.trees])).astype(np.int32)
            width = int(self.bins.sizes.max())
            goes_right = np.zeros((starts[-1], width), np.int32)
            depth = 0
            for t, s in zip(self.trees, starts):
                level = np.zeros(len(t.features), np.int64)
                for i, flags in enumerate(t.goes_left):
                    if t.features[i] >= 0:
                        goes_right[s + i, : len(flags)] = ~flags
                        level[[t.left[i], t.right[i]]] = level[i] + 1
                depth = max(depth, int(level.max()))
            values = np.concatenate([t.values for t in self.trees])
            self._packed = starts[:-1].astype(np.int32), feature, left, goes_right.ravel(), width, values, depth
        return self._packed

    def _tables(self):
        """Groups of features, and per tree the leaves that each combination of their codes allows, one bit a leaf.

        What all groups allow is the leaf of a record. Leaf values stand where a de Bruijn product leads from its bit.
        """
        if self._allowed is None:
            sizes = [int(s) for s in self.bins.sizes]
            groups = grouped(self.bins.sizes, MOST_CODES)
            small = max(int((t.features < 0).sum()) for t in self.trees) <= 32
            kind, product, shift = (np.uint32, 0x077CB531, 27) if small else (np.uint64, 0x03F79D71B4CB0A89, 58)
            found = []
            for t in self.trees:
                bits, leaf, values = [0] * len(t.features), 0, np.zeros(32 if small else 64)
                for i in range(len(t.features) - 1, -1, -1):
                    if t.features[i] < 0:
                        bits[i] = 1 << leaf
                        values[((product << leaf) % (1 << 32 if small else 1 << 64)) >> shift] = t.values[i]
                        leaf += 1
                    else:
                        bits[i] = bits[t.left[i]] | bits[t.right[i]]
                allowed = [np.full(s, bits[0], kind) for s in sizes]
                for i, f in enumerate(t.features):
                    if f >= 0:
                        here, there = kind(bits[0] ^ bits[t.right[i]]), kind(bits[0] ^ bits[t.left[i]])
                        allowed[f] &= np.where(t.goes_left[i], here, there)
                tables = []
                for members in groups:
                    table = allowed[members[0]]
                    for f in members[1:]:
                        table = table[..., None] & allowed[f]
                    tables.append(table.ravel())
                found.append((tables, values))
            self._allowed = groups, [tuple(sizes[f] for f in g) for g in groups], kind(product), kind(shift), found
        return self._allowed

    def margins(self, columns: list[pa.Array]) -> np.ndarray:
        """Log-odds of the records."""
        return self.margins_at(self.bins.codes(columns))

    def margins_at(self, codes: np.ndarray) -> np.ndarray:
        """Log-odds of records by their codes."""
        codes = codes - self.bins.offsets[:-1].astype(np.int32)
        out = np.zeros(len(codes))
        if not self.trees or not len(codes):
            return out
        if max((t.features < 0).sum() for t in self.trees) > 64:
            return self._walked(codes, out)
        groups, shapes, product, shift, found = self._tables()
        for a in range(0, len(codes), CHUNK_ROWS):
            part, total = codes[a : a + CHUNK_ROWS], out[a : a + CHUNK_ROWS]
            at = [np.ravel_multi_index([part[:, f] for f in g], shape) for g, shape in zip(groups, shapes)]
            for tables, values in found:
                bit = tables[0].take(at[0], mode="clip")
                for table, place in zip(tables[1:], at[1:]):
                    bit &= table.take(place, mode="clip")
                bit *= product
                bit >>= shift
                total += values.take(bit, mode="clip")
        return out

    def _walked(self, codes: np.ndarray, out: np.ndarray) -> np.ndarray:
        """Trees of many leaves are walked from the root, all at once."""
        roots, feature, left, goes_right, width, values, depth = self._pack()
        step = max(1, (1 << 16) // len(roots))  # small enough to stay in a core's cache
        for a in range(0, len(codes), step):
            part = codes[a : a + step]
            base = (np.arange(len(part), dtype=np.int32) * part.shape[1])[:, None]
            flat, at = part.ravel(), np.repeat(roots[None, :], len(part), axis=0)
            for _ in range(depth):
                code = flat.take(feature.take(at) + base)
                at = left.take(at) + goes_right.take(at * np.int64(width) + code)
            out[a : a + step] = values.take(at).sum(1)
        return out

    def rows(self) -> list[tuple]:
        """One row of ``TREE_SCHEMA`` per tree."""
        return [
            (
                i, t.features.tolist(), t.left.tolist(), t.right.tolist(), t.values.tolist(),
                [bytearray(np.packbits(flags).tobytes()) for flags in t.goes_left],
            )
            for i, t in enumerate(self.trees)
        ]

    @classmethod
    def from_rows(cls, bins: FeatureBins, rows: list) -> TreeModel:
        sizes, trees = bins.sizes, []
        for r in sorted(rows, key=lambda r: r.tree):
            features = np.array(r.features, np.int64)
            flags = [
                np.unpackbits(np.frombuffer(bytes(g), np.uint8))[: sizes[f]].astype(bool) if f >= 0 else np.zeros(0, bool)
                for f, g in zip(r.features, r.goes_left)
            ]
            trees.append(Tree(features, np.array(r.left), np.array(r.right), np.array(r.values, float), flags))
        return cls(bins, trees)


def all_gathered(values: np.ndarray) -> np.ndarray:
    """The sum of an array over the tasks of a barrier stage, in the order of the tasks."""
    from pyspark import BarrierTaskContext

    sent = BarrierTaskContext.get().allGather(base64.b64encode(values.tobytes()).decode())
    return np.sum([np.frombuffer(base64.b64decode(s)).reshape(values.shape) for s in sent], axis=0)


def summed_through(folder: str) -> Callable[[np.ndarray], np.ndarray]:
    """The sum of an array over the tasks of a barrier stage, by files in a folder that they share.

    A barrier's own all-gather sleeps for a second. The first task adds what the others wrote, in their order, and
    each file is removed once it was read. Where the folder
    is not in a file system of the hosts, or a task does not see it, all fall back on ``all_gathered``.
    """
    from pyspark import BarrierTaskContext

    if not folder.startswith("/"):
        return all_gathered
    context = BarrierTaskContext.get()
    me, tasks = context.partitionId(), len(context.getTaskInfos())
    path = f"{folder}/{context.allGather(uuid.uuid4().hex)[0]}"  # every attempt has a folder of its own
    try:
        os.makedirs(path, exist_ok=True)
        open(f"{path}/seen-{me}", "wb").close()
    except OSError:
        pass
    context.barrier()
    seen = all(os.path.exists(f"{path}/seen-{i}") for i in range(tasks))
    if set(context.allGather(str(seen))) != {"True"}:
        return all_gathered
    os.remove(f"{path}/seen-{me}")
    step = 0

    def put(name: str, values: np.ndarray) -> None:
        with open(f"{path}/{name}.part", "wb") as out:
            out.write(values.tobytes())
        os.rename(f"{path}/{name}.part", f"{path}/{name}")  # whole or not there

    def get(name: str, values: np.ndarray) -> np.ndarray:
        while not os.path.exists(f"{path}/{name}"):
            time.sleep(POLL_SECONDS)
        with open(f"{path}/{name}", "rb") as file:
            return np.frombuffer(file.read(), values.dtype).reshape(values.shape)

    def add(values: np.ndarray) -> np.ndarray:
        nonlocal step
        step += 1
        if me:
            put(f"{step}-{me}", values)
            return get(f"{step}-sum", values).copy()
        whole = values.copy()
        for i in range(1, tasks):
            whole += get(f"{step}-{i}", values)
            os.remove(f"{path}/{step}-{i}")
        put(f"{step}-sum", whole)
        if step > 1:
            os.remove(f"{path}/{step - 1}-sum")  # all have read it, since all have sent what follows
        return whole

    return add


class Patterns:
    """The rows of a task: those with the same codes are one record with their number and weights."""

    def __init__(self, bins: FeatureBins):
        self.sizes, self.offsets = bins.sizes, bins.offsets[:-1].astype(np.int32)
        self.packed = float(np.prod(self.sizes.astype(float))) < 2.0**62
        self.held: list[tuple] = []
        self.merged, self.waiting = 0, 0

    def add(self, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
        """Rows by their codes, counted from the offset of the feature on."""
        if not len(codes):
            return
        local = codes - self.offsets
        keys = np.ravel_multi_index(tuple(local.T), tuple(self.sizes)) if self.packed else local
        self.held.append((keys, weights, weights * labels, np.ones(len(keys))))
        self.waiting += len(keys)
        if self.packed and self.waiting > max(MERGE_ROWS, self.merged):
            self._merge()

    def _merge(self) -> None:
        keys, *sums = (np.concatenate(c) for c in zip(*self.held))
        order = np.argsort(keys)
        keys = keys[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.held = [(keys[first], *(np.add.reduceat(c[order], first) for c in sums))]
        self.merged, self.waiting = len(first), 0

    def records(self) -> tuple[np.ndarray, ...]:
        """Codes, weight, weight of the positive rows, and number of rows of every record."""
        if not self.held:
            return np.zeros((0, len(self.sizes)), np.int32), np.zeros(0), np.zeros(0), np.zeros(0)
        if self.packed:
            self._merge()
        keys, *sums = (np.concatenate(c) for c in zip(*self.held))
        self.held = []
        # neighbours would add to the same entry of a histogram, each waiting for the one before
        order = np.random.default_rng(0).permutation(len(keys))
        keys = keys[order]
        local = np.stack(np.unravel_index(keys, tuple(self.sizes)), axis=1) if self.packed else keys
        return local.astype(np.int32) + self.offsets, *(c[order] for c in sums)


class _Group:
    """Features whose codes are one number, so that a row is counted once for all of them."""

    def __init__(self, members: list[int], codes: np.ndarray, bins: FeatureBins):
        offsets = bins.offsets
        self.members, self.shape = members, tuple(int(bins.sizes[f]) for f in members)
        self.size = math.prod(self.shape)
        local = [codes[:, f] - np.int32(offsets[f]) for f in members]
        self.codes = np.ravel_multi_index(local, self.shape).astype(np.min_scalar_type(self.size - 1))
        self.local = np.stack(np.unravel_index(np.arange(self.size), self.shape), axis=1)
        self.flat = self.local + offsets[members]
        self.places = [slice(int(offsets[f]), int(offsets[f + 1])) for f in members]
        self.others = [tuple(a for a in range(len(members)) if a != i) for i in range(len(members))]

    def count(self, rows: np.ndarray, columns: list[np.ndarray | None], out: np.ndarray) -> None:
        """Add up columns (rows where there is none) by the codes of every member."""
        at = self.codes.take(rows, mode="clip").astype(np.intp)
        few = len(rows) * len(self.members) < self.size
        if few:
            at = self.flat[at].ravel()
        for i, column in enumerate(columns):
            if few:
                weights = None if column is None else np.repeat(column, len(self.members))
                out[i] += np.bincount(at, weights, out.shape[1])
                continue
            joint = np.bincount(at, column, self.size).reshape(self.shape)
            for place, others in zip(self.places, self.others):
                out[i, place] = joint.sum(others)


def grouped(sizes: np.ndarray, most: int) -> list[list[int]]:
    """Features in groups with at most ``most`` combinations of codes; larger ones stay alone."""
    groups: list[list] = []
    for f in sorted(range(len(sizes)), key=lambda f: (-sizes[f], f)):
        for group in groups:
            if group[0] * sizes[f] <= most:
                group[0] *= sizes[f]
                group.append(f)
                break
        else:
            groups.append([int(sizes[f]), f])
    return [group[1:] for group in groups]


class _Leaf:
    """A leaf while its tree grows: rows, their sums, and the split that it may get."""

    __slots__ = ("rows", "totals", "depth", "hist", "split", "children")

    def __init__(self, rows: np.ndarray, totals: np.ndarray, depth: int):
        self.rows, self.totals, self.depth = rows, totals, depth
        self.hist = self.split = self.children = None


class Grower:
    """Grows trees over the records of one task; ``add`` sums an array over the tasks of the fit.

    ``counts`` are the rows of each record. Tasks that share a fit (``shared``) count the children of all leaves that
    may be split in one exchange, ahead of the order of splits; the trees are the same.
    """

    def __init__(
        self, codes: np.ndarray, bins: FeatureBins, params, add: Callable[[np.ndarray], np.ndarray],
        counts: np.ndarray | None = None, shared: bool = False,
    ):
        self.params, self.add, self.n, self.shared = params, add, len(codes), shared
        self.counts = None if counts is None or (counts == 1).all() else counts
        offsets = bins.offsets
        self.offsets, self.total = offsets, int(offsets[-1])
        self.owner = np.repeat(np.arange(len(bins.names)), np.diff(offsets))
        self.is_level = np.array([f in bins.levels for f in bins.names])[self.owner]
        self.last = np.zeros(self.total, bool)  # a split after the last code of a feature has an empty side
        self.last[offsets[1:] - 1] = True
        most = min(MOST_CODES, max(LEAST_CODES, len(codes) // 16))
        self.groups = [_Group(members, codes, bins) for members in grouped(bins.sizes, most)]
        self.place = {f: (group, i) for group in self.groups for i, f in enumerate(group.members)}

    def histogram(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """Sums of gradient and hessian, and rows, by code, in this task."""
        out = np.zeros((3, self.total))
        columns = [None if c is None else c if len(rows) == self.n else c.take(rows, mode="clip") for c in (g, h, self.counts)]
        for group in self.groups:
            group.count(rows, columns, out)
        return out

    def best_split(self, hist: np.ndarray, totals: np.ndarray):
        """Gain, feature, left codes and left sums of the best split of a leaf, or nothing."""
        l2, least = self.params.l2, self.params.min_rows_per_leaf
        g, h, n = totals
        if n < 2 * least:
            return None
        # numbers in their order, levels by gradient over hessian
        key = np.where(self.is_level, hist[0] / (hist[1] + 10.0), np.arange(self.total))
        order = np.lexsort((np.arange(self.total), key, self.owner))
        sums = np.cumsum(hist[:, order], axis=1)
        starts = np.concatenate([np.zeros((3, 1)), sums], axis=1)[:, self.offsets[:-1]]
        left = sums - starts[:, self.owner]
        right = totals[:, None] - left
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[0] ** 2 / (left[1] + l2) + right[0] ** 2 / (right[1] + l2) - g * g / (h + l2)
        bad = self.last | (left[2] < least) | (right[2] < least) | (left[1] < LEAST_HESSIAN) | (right[1] < LEAST_HESSIAN)
        gain[bad | ~np.isfinite(gain)] = 0.0
        at = int(np.argmax(gain))
        if gain[at] <= 1e-12:
            return None
        feature = int(self.owner[at])
        a, b = self.offsets[feature], self.offsets[feature + 1]
        flags = np.zeros(b - a, bool)
        flags[order[a : at + 1] - a] = True
        return float(gain[at]), feature, flags, left[:, at].copy()

    def _judge(self, leaf: _Leaf, hist: np.ndarray) -> None:
        leaf.split = self.best_split(hist, leaf.totals)
        leaf.hist = hist if leaf.split else None

    def _may_split(self, leaf: _Leaf) -> bool:
        p = self.params
        return (p.max_depth is None or leaf.depth < p.max_depth) and leaf.totals[2] >= 2 * p.min_rows_per_leaf

    def _divide(self, leaves: list[_Leaf], g: np.ndarray, h: np.ndarray, last: bool) -> None:
        """Make the children of leaves. The one with fewer rows in all tasks is counted, the other one is what remains.

        Children that cannot be split (``last``: none can) are not counted, their sums are those of the split.
        """
        counted = []
        for leaf in leaves:
            _, feature, flags, left = leaf.split
            group, axis = self.place[feature]
            side = flags[group.local[:, axis]].take(group.codes.take(leaf.rows, mode="clip"), mode="clip")
            parts = leaf.rows.compress(side), leaf.rows.compress(~side)
            leaf.rows = None
            leaf.children = [_Leaf(r, t, leaf.depth + 1) for r, t in zip(parts, (left, leaf.totals - left))]
            if not last and any(map(self._may_split, leaf.children)):
                counted.append((leaf, leaf.children if left[2] <= leaf.totals[2] - left[2] else leaf.children[::-1]))
        if counted:
            found = self.add(np.stack([self.histogram(small.rows, g, h) for _, (small, _) in counted]))
            for (leaf, (small, large)), hist in zip(counted, found):
                rest = leaf.hist - hist
                rest[:, rest[2] < 0.5] = 0.0  # a code without rows holds no rounding errors
                for child, own in ((small, hist), (large, rest)):
                    if self._may_split(child):
                        self._judge(child, own)
        for leaf in leaves:
            leaf.hist = None

    def _ahead(self, heap: list, room: float) -> list[_Leaf]:
        """Leaves without children that may be split yet, at most ``room`` and with the next one among them."""
        waiting, found = [entry[-1] for entry in heap], []
        while waiting:
            leaf = waiting.pop()
            if leaf.children is None:
                found.append(leaf)
            else:
                waiting += [child for child in leaf.children if child.split]
        found.sort(key=lambda leaf: (leaf is not heap[0][-1], -leaf.split[0], leaf.depth))
        return found[: int(min(room, MOST_AHEAD))]

    def tree(self, g: np.ndarray, h: np.ndarray) -> tuple[Tree, np.ndarray]:
        """The next tree, and what it adds to each record."""
        p = self.params
        features, left, right, values, goes_left, ended = [], [], [], [], [], {}
        heap: list = []
        limit = math.inf if p.max_leaf_nodes is None else p.max_leaf_nodes

        def place(leaf: _Leaf) -> None:
            total_g, total_h, _ = leaf.totals
            node = len(features)
            features.append(-1)
            left.append(-1)
            right.append(-1)
            values.append(-p.learning_rate * total_g / (total_h + p.l2) if total_h + p.l2 > 0 else 0.0)
            goes_left.append(np.zeros(0, bool))
            if leaf.split:
                # without a limit the order makes no difference, and going down first holds the fewest histograms
                heapq.heappush(heap, (-leaf.split[0] if p.max_leaf_nodes else 0.0, node if p.max_leaf_nodes else -node, node, leaf))
            else:
                ended[node] = leaf

        every = np.arange(self.n)
        hist = self.add(self.histogram(every, g, h))
        root = _Leaf(every, hist[:, : self.offsets[1]].sum(axis=1), 0)
        if self._may_split(root):
            self._judge(root, hist)
        place(root)
        leaves = 1
        while heap and leaves < limit:
            if heap[0][-1].children is None:
                room = limit - leaves
                self._divide(self._ahead(heap, room) if self.shared else [heap[0][-1]], g, h, room == 1)
            _, _, node, leaf = heapq.heappop(heap)
            features[node], goes_left[node], values[node] = leaf.split[1], leaf.split[2], 0.0
            left[node], right[node] = len(features), len(features) + 1
            for child in leaf.children:
                place(child)
            leaves += 1
        added = np.empty(self.n)
        for node, leaf in [*ended.items(), *((node, leaf) for _, _, node, leaf in heap)]:
            held = [leaf]
            while held:  # children made ahead of a split that was not taken
                part = held.pop()
                if part.children is None:
                    added[part.rows] = values[node]
                else:
                    held += part.children
        return Tree(np.array(features), np.array(left), np.array(right), np.array(values), goes_left), added


def boosted(codes, labels, weights, bins: FeatureBins, params, add=lambda x: x) -> list[Tree]:
    """``params.max_iter`` trees that fit the labels by weighted logistic loss, from even odds of the weights on."""
    rows = Patterns(bins)
    rows.add(codes, labels, weights)
    return boosted_patterns(rows, bins, params, add)


def boosted_patterns(rows: Patterns, bins: FeatureBins, params, add=lambda x: x, shared: bool = False) -> list[Tree]:
    """As ``boosted``, for rows that have been gathered."""
    codes, weights, positive, counts = rows.records()
    totals = add(np.array([float(positive.sum()), float(weights.sum())]))
    share = min(max(totals[0] / totals[1], 1e-12), 1 - 1e-12) if totals[1] else 0.5
    start = float(np.log(share / (1 - share)))
    grower, margin = Grower(codes, bins, params, add, counts, shared), np.full(len(codes), start)
    del codes
    constant = Tree(np.array([-1]), np.array([-1]), np.array([-1]), np.array([start]), [np.zeros(0, bool)])
    trees = [constant]
    g, h = np.empty(len(margin)), np.empty(len(margin))
    for _ in range(params.max_iter):
        np.negative(margin, out=h)
        with np.errstate(over="ignore"):
            np.exp(h, out=h)
        h += 1.0
        np.divide(weights, h, out=g)  # weight times p
        np.subtract(1.0, np.divide(1.0, h, out=h), out=h)
        h *= g
        g -= positive
        tree, added = grower.tree(g, h)
        margin += added
        trees.append(tree)
    return trees
