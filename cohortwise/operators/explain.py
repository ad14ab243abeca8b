"""What a model bases its scores on.

Every operator takes ``score``, a function that adds a ``probability`` column to a DataFrame:
a trained model, or any other row-wise expression.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.functions.columns import col
from cohortwise.operators.metrics import roc_auc
from cohortwise.operators.ordering import hash_order_positions
from cohortwise.spec import CONTINUOUS, AnalysisError

REPEATS = 10
PARTNER_BLOCK = 1 << 10
BLOCK_PLACES = 1 << 17
PACKED_ROWS = 1 << 18
FEW = 256
ROUNDS = 4
KEY_STEP = 2654435761  # fixed value: an odd number near 2**32 over the golden ratio
POINTS = 15
PROBABILITY = "probability"
Scorer = Callable[[DataFrame], DataFrame]


def permuted(size: int, repeat: int, places: np.ndarray | None = None) -> np.ndarray:
    """Where a bijection of ``0 .. size - 1`` of its own for each repeat sends ``places`` (all of them).

    Four Feistel rounds over the halves of an even number of bits; places beyond ``size`` are sent on until they
    fall below it. Integers stay below 2**63, so SQL can repeat it.
    """
    half = 1
    while 1 << 2 * half < size:
        half += 1
    mask = (1 << half) - 1

    def once(place: np.ndarray) -> np.ndarray:
        left, right = place >> half, place & mask
        for i in range(ROUNDS):
            key = (repeat * ROUNDS + i + 1) * KEY_STEP % (1 << 32)
            left, right = right, left ^ (((right * key + (key >> 3)) % (1 << 32) >> 11) & mask)
        return left << half | right

    place = once(np.arange(size, dtype=np.int64) if places is None else places)
    while (beyond := np.flatnonzero(place >= size)).size:
        place[beyond] = once(place[beyond])
    return place


def _compact(values: pa.Array) -> pa.Array:
    """Few different values take a byte each."""
    coded = values.dictionary_encode()
    if len(coded.dictionary) > FEW:
        return values
    return pa.DictionaryArray.from_arrays(coded.indices.cast(pa.uint8()), coded.dictionary)


def _packed(places: np.ndarray, partners: pa.StructArray, size: int, repeats: int, block: int):
    """What these rows send in all repeats, one record per block of places: slots (repeat and place) and values."""
    targets = np.concatenate([permuted(size, r, places) for r in range(repeats)])
    homes = (targets // block).astype(np.int32)
    slots = (targets - homes * np.int64(block) + np.repeat(np.arange(repeats) * block, len(places))).astype(np.int32)
    order = np.argsort(homes, kind="stable")
    homes, senders = homes[order], pa.array(order % max(len(places), 1))
    whole = pa.RecordBatch.from_arrays(
        [pa.array(slots[order]), *[_compact(c).take(senders) for c in partners.flatten()]],
        names=[str(i) for i in range(partners.type.num_fields + 1)],
    )
    starts = np.flatnonzero(np.append(True, homes[1:] != homes[:-1])) if len(homes) else np.zeros(0, int)
    sent = []
    for a, b in zip(starts, [*starts[1:], len(homes)]):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, whole.schema) as stream:
            stream.write_batch(whole.slice(a, b - a))
        sent.append(sink.getvalue().to_pybytes())
    return pa.RecordBatch.from_arrays([pa.array(homes[starts], pa.int32()), pa.array(sent, pa.binary())], names=["__block", "__packed"])


def _unpacked(packed: pa.ChunkedArray, repeats: int, block: int) -> tuple[np.ndarray, list]:
    """The values sent to one block, and where among them each slot finds its own."""
    tables = [pa.ipc.open_stream(p.as_buffer()).read_all() for p in packed]

    def plain(values: pa.ChunkedArray) -> list:
        return [c.dictionary_decode() if pa.types.is_dictionary(c.type) else c for c in values.chunks]

    columns = [pa.concat_arrays([c for t in tables for c in plain(t.column(i))]) for i in range(tables[0].num_columns)]
    where = np.zeros(repeats * block, np.int64)
    where[columns[0].to_numpy()] = np.arange(len(columns[0]))
    return where, columns[1:]


def _dealt(df: DataFrame, key: str, columns: list[str], repeats: int, per_block: int, emit, schema: T.StructType) -> DataFrame:
    """What ``emit`` makes of every block: its rows, the repeats with each row's partner, and the partners' values.

    Rows are put in the order of their hashed keys once. In every repeat each row sends its values to the place where
    a bijection of all places leads, whatever task holds it. Places are dealt in blocks of ``per_block`` or more; the
    rows are shuffled to their block once, and what many rows send to a block in all repeats is one packed record.
    """
    text = col(key).cast("string")
    placed = hash_order_positions(df.withColumn("__h", F.md5(text)), "__h", "__place").select(
        "__place", F.struct(*[col(c) for c in df.columns]).alias("__row")
    ).persist()
    n = df.count()
    block = max(per_block, min(BLOCK_PLACES, -(-n // (4 * df.sparkSession.sparkContext.defaultParallelism))))
    sent = placed.select("__place", F.struct(*[F.col("__row")[c].alias(c) for c in columns]).alias("__partner"))

    def pack(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= PACKED_ROWS:
                yield of(held)
                held, rows = [], 0
        if rows:
            yield of(held)

    def of(held):
        places = np.concatenate([b.column("__place").to_numpy() for b in held]).astype(np.int64)
        return _packed(places, pa.concat_arrays([b.column("__partner") for b in held]), n, repeats, block)

    def deal(number, own: pa.Table, packed: pa.Table) -> pa.Table:
        start = number[0].as_py() * block
        size = own.num_rows
        order = np.empty(size, np.int64)
        order[own.column("__place").to_numpy() - start] = np.arange(size)
        mine = pa.concat_arrays(own.column("__row").chunks).take(pa.array(order)).flatten()
        where, values = _unpacked(packed.column("__packed"), repeats, block)
        repeated = (where[r * block : r * block + size] for r in range(repeats))
        return pa.Table.from_batches(emit(mine, repeated, values))

    partners = sent.mapInArrow(pack, "__block int, __packed binary").groupBy("__block")
    rows = placed.withColumn("__block", F.floor(F.col("__place") / block).cast("int")).groupBy("__block")
    return rows.cogroup(partners).applyInArrow(deal, schema)


def shuffled_partners(df: DataFrame, key: str, columns: list[str], repeats: int, per_block: int = PARTNER_BLOCK) -> DataFrame:
    """Every row once per repeat, with the values of another row of a random permutation of the whole table."""
    partner = df.select(F.struct(*[col(c) for c in columns]).alias("__partner")).schema["__partner"]
    schema = T.StructType([*df.schema.fields, T.StructField("repeat", T.IntegerType()), partner])

    def emit(mine, repeated, values):
        kinds = [pa.field(f.name, v.type, f.nullable) for f, v in zip(partner.dataType.fields, values)]
        for r, found in enumerate(repeated):
            theirs = pa.StructArray.from_arrays([v.take(pa.array(found)) for v in values], fields=kinds)
            number = pa.array(np.full(len(found), r, np.int32))
            yield pa.RecordBatch.from_arrays([*mine, number, theirs], names=schema.names)

    return _dealt(df, key, columns, repeats, per_block, emit, schema)


def _codes(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    coded = values.dictionary_encode(null_encoding="encode")
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _patterns(columns: list[pa.Array], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the rows' different values, and a row of each."""
    number, first = np.zeros(size, np.int64), np.zeros(min(size, 1), np.int64)
    for c in columns:
        codes, dictionary = _codes(c)
        _, first, number = np.unique(number * len(dictionary) + codes, return_index=True, return_inverse=True)
    return number, first


def _tallied(pairs: np.ndarray, different: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that occur and how often."""
    if different > 4 * len(pairs):
        return np.unique(pairs, return_counts=True)
    counts = np.bincount(pairs, minlength=different)
    found = np.flatnonzero(counts)
    return found, counts[found]


def permuted_patterns(
    df: DataFrame, key: str, others: list[str], features: list[str], repeats: int, per_block: int = PARTNER_BLOCK
) -> DataFrame:
    """Rows per feature and repeat in which only that feature has the value of the row's partner.

    Rows of a block that agree in ``others`` and all features are one, with their number ``__n``.
    """
    rows = df.select(col(key).alias("__key"), *[col(c) for c in [*others, *features]])
    kept = [T.StructField(f.name, f.dataType) for f in rows.schema.fields[1:]]
    schema = T.StructType([
        T.StructField("feature", T.StringType()), T.StructField("repeat", T.IntegerType()), T.StructField("__n", T.LongType()), *kept,
    ])

    def emit(mine, repeated, values):
        mine, sent = mine[1:], [_codes(v) for v in values]
        places = [len(others) + j for j in range(len(features))]
        known = [_patterns([c for i, c in enumerate(mine) if i != place], len(mine[0])) for place in places]
        for r, found in enumerate(repeated):
            for place, feature, (codes, dictionary), (number, first) in zip(places, features, sent, known):
                pairs, counts = _tallied(number * len(dictionary) + codes[found], len(first) * len(dictionary))
                own, theirs = pa.array(first[pairs // len(dictionary)]), pa.array(pairs % len(dictionary))
                columns = [dictionary.take(theirs) if i == place else c.take(own) for i, c in enumerate(mine)]
                size = len(counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([feature] * size, pa.string()), pa.array(np.full(size, r, np.int32)), pa.array(counts.astype(np.int64)), *columns],
                    names=schema.names,
                )

    return _dealt(rows, "__key", features, repeats, per_block, emit, schema)


def permuted_scores(
    df: DataFrame, y: str, key: str, features: Iterable[str], score: Scorer, repeats: int = REPEATS
) -> DataFrame:
    """ROC-AUC per feature and repeat after permuting that feature."""
    variants = permuted_patterns(df, key, [y], list(features), repeats)
    return roc_auc(score(variants), y, PROBABILITY, ["feature", "repeat"], "__n")


def permutation_importance(
    df: DataFrame, y: str, key: str, features: Iterable[str], score: Scorer, repeats: int = REPEATS
) -> DataFrame:
    """Mean and population deviation of the ROC-AUC lost by permuting each feature."""
    base = roc_auc(score(df), y, PROBABILITY).first().roc_auc
    drops = permuted_scores(df, y, key, features, score, repeats).withColumn(
        "drop", F.lit(base) - F.col("roc_auc")
    )
    return (
        drops.groupBy("feature")
        .agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
        .orderBy(F.desc("importance_mean"), "feature")
    )


def _with_impacts(df: DataFrame, keep: list[str], schema: dict[str, dict], score: Scorer) -> DataFrame:
    """``keep``, the probability, and an array of impacts in the order of ``schema``, row by row.

    The scorer runs once for the row as it is and once per feature, on the same row: nothing is
    shuffled, and rows that repeat a key stay apart.
    """
    features = list(schema)
    rows = score(df).select(
        F.struct(*[col(c) for c in keep]).alias("__keep"),
        F.struct(*[col(f) for f in features]).alias("__own"),
        col(PROBABILITY).alias("original_probability"),
    )
    done: list[str] = []
    for i, f in enumerate(features):
        kind = df.schema[f].dataType
        own = [
            (F.lit(schema[g]["reference_value"]).cast(kind) if g == f else F.col("__own")[g]).alias(g) for g in features
        ]
        scored = score(rows.select("*", *own))
        done.append(f"__when{i}")
        rows = scored.select(
            "__keep", "__own", "original_probability", *done[:-1], col(PROBABILITY).alias(done[-1])
        )
    entries = [
        F.struct(
            F.lit(f).alias("feature"),
            F.col("__own")[f].cast("string").alias("current_value"),
            F.lit(str(schema[f]["reference_value"])).alias("reference_value"),
            F.col(p).alias("reference_probability"),
            (F.col("original_probability") - F.col(p)).alias("impact_probability"),
        )
        for f, p in zip(features, done, strict=True)
    ]
    return rows.select("__keep.*", "original_probability", F.array(*entries).alias("__impacts"))


def recorded_impacts(df: DataFrame, key: str, schema: dict[str, dict], score: Scorer) -> DataFrame:
    """One row per record with the array of its impacts, for ``frames.top_record_impacts``."""
    return _with_impacts(df, [key], schema, score)


def local_impacts(
    df: DataFrame, key: str, schema: dict[str, dict], score: Scorer
) -> DataFrame:
    """Change of each record's probability when one feature takes its reference value.

    All records and features are scored in one pass; nothing is shuffled.
    """
    rows = _with_impacts(df, [key], schema, score)
    return rows.select(col(key), "original_probability", F.inline("__impacts")).select(
        col(key),
        "feature",
        "current_value",
        "reference_value",
        "original_probability",
        "reference_probability",
        "impact_probability",
        (F.col("impact_probability") * 100).alias("impact_percentage_points"),
    )


def explained_predictions(
    df: DataFrame, key: str, schema: dict[str, dict], score: Scorer, threshold: float,
    labels: tuple[str, str], model_name: str, trained_at: str,
) -> DataFrame:
    """One row per record: class, label, probability and impacts, strongest first."""
    records = _with_impacts(df, [key], schema, score).withColumnRenamed("original_probability", PROBABILITY)

    def entry(e: Column) -> Column:
        return F.struct(
            (-F.abs(e["impact_probability"])).alias("order"), e["feature"].alias("feature"),
            e["current_value"].alias("current_value"), e["reference_value"].alias("reference_value"),
            e["impact_probability"].alias("impact_probability"),
        )

    ordered = F.array_sort(F.transform("__impacts", entry))
    predicted = (F.col(PROBABILITY) >= threshold).cast("int")
    return records.select(
        key,
        predicted.alias("predicted_class"),
        F.when(predicted == 1, labels[1]).otherwise(labels[0]).alias("predicted_label"),
        PROBABILITY,
        F.transform(ordered, lambda e: e.dropFields("order")).alias("impacts"),
        F.lit(model_name).alias("model_name"),
        F.lit(trained_at).alias("trained_at"),
    )


def what_if_values(
    feature: str, schema: dict[str, dict], points: int = POINTS, values: list | None = None
) -> list:
    """The values to try: given ones, all levels, or equal steps between outer quantiles."""
    if feature not in schema:
        raise AnalysisError(f"the model does not use '{feature}'")
    if points < 2:
        raise AnalysisError("points must be at least 2")
    if values is not None:
        if not values:
            raise AnalysisError("there are no values to try")
        return list(values)
    info = schema[feature]
    if info["kind"] != CONTINUOUS:
        return list(info["levels"])
    low, high = info["q05"], info["q95"]
    if low == high:
        low, high = info["minimum"], info["maximum"]
    if low == high:
        return [low]
    step = (high - low) / (points - 1)
    return [low + i * step for i in range(points - 1)] + [high]


def what_if(
    df: DataFrame, key: str, feature: str, schema: dict[str, dict], score: Scorer,
    points: int = POINTS, values: list | None = None,
) -> DataFrame:
    """Probability of each record at each tried value of one feature, other values kept."""
    tried = what_if_values(feature, schema, points, values)
    current = col(feature).cast("string").alias("current_value")
    others = [col(f) for f in schema if f != feature]
    kind = df.schema[feature].dataType
    grid = F.array(*[F.lit(v).cast(kind) for v in tried])
    rows = df.select(col(key), current, *others, F.explode(grid).alias(feature))
    return score(rows).select(
        col(key),
        F.lit(feature).alias("feature"),
        col(feature).cast("string").alias("value"),
        "current_value",
        F.col(PROBABILITY),
        (F.col(PROBABILITY) * 100).alias("probability_percent"),
    )
