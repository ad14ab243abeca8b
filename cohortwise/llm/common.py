"""Helpers that several operators of this package share: tables, Arrow batches, hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.session import scratch_folder

BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches by bytes too: a few texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def written(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = folder or scratch_folder(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = 1_000_000) -> DataFrame:
    """``df`` (a few numbers a row) marked for broadcast if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def crc32_of_id(key: str | Column = "doc_id") -> Column:
    """crc32 of the id as text; null for a null id."""
    column = F.col(key) if isinstance(key, str) else key
    return F.crc32(column.cast("string").cast("binary"))


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A text column as (all bytes, offsets), without copying; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        kind = np.int64
    elif pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        kind = np.int32
    else:
        column, kind = column.cast(pa.string()), np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize)
    bounds = bounds.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), bounds - bounds[0]
    whole = np.frombuffer(data, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(bounds: np.ndarray, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer text is a range of its own."""
    start, rows = 0, len(bounds) - 1
    while start < rows:
        stop = int(np.searchsorted(bounds, bounds[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


def binary_array(values: list[bytes] | Iterable[bytes]) -> pa.Array:
    return pa.array(list(values), pa.binary())


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Regroup batches sorted by ``keys`` so that no group is split between two tables.

    What is held is one batch and the group that crosses its end.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        columns = [batch.column(k) for k in keys]
        last = tuple(c[batch.num_rows - 1].as_py() for c in columns)
        first = tuple(c[0].as_py() for c in columns)
        if first == last:
            before = tuple(held[0].column(k)[0].as_py() for k in keys)
            if before == last:
                continue  # one group so far
        lo, hi = 0, batch.num_rows - 1  # first row of the last group
        while lo < hi:
            mid = (lo + hi) // 2
            if tuple(c[mid].as_py() for c in columns) == last:
                hi = mid
            else:
                lo = mid + 1
        done = [*held[:-1], batch.slice(0, lo)]
        held = [batch.slice(lo)]
        table = pa.Table.from_batches([b for b in done if b.num_rows] or [batch.slice(0, 0)])
        if table.num_rows:
            yield table
    if held:
        yield pa.Table.from_batches(held)


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Positions where a run of equal key rows begins, with the length as the last entry."""
    n = len(columns[0])
    if n == 0:
        return np.zeros(1, np.int64)
    change = np.zeros(n, bool)
    change[0] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(change), n)


def arrow_map(df: DataFrame, work: Callable, schema: str, batches: bool = True) -> DataFrame:
    """``mapInArrow`` with bounded batches, unless ``batches`` leaves the settings as they are."""
    if batches:
        small_batches(df.sparkSession)
    return df.mapInArrow(work, schema)
