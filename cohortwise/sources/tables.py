"""Cohort views over the star-schema tables.

``trade_cohort`` joins only the tables that the requested columns need, so an analysis of two
line columns never touches orders or customers. The raw columns carry almost no signal; the
outcome, exposure and score are planted with hash-derived uniforms that any engine can
reproduce.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.functions.columns import hash_uniform, sigmoid
from cohortwise.spec import BINARY, CATEGORICAL, CONTINUOUS, CohortSpec, RangeRule

TRADE_SPEC = CohortSpec(
    variables={
        "quantity": CONTINUOUS,
        "discount": CONTINUOUS,
        "balance": CONTINUOUS,
        "line_status": BINARY,
        "exposed": BINARY,
        "return_flag": CATEGORICAL,
        "segment": CATEGORICAL,
        "priority": CATEGORICAL,
        "nation": CATEGORICAL,
    },
    target="outcome",
    features=("quantity", "discount", "balance", "line_status", "return_flag", "segment", "priority"),
    group_columns=("line_status", "segment"),
)

RAW_SPEC = CohortSpec(
    variables={"quantity": CONTINUOUS, "discount": CONTINUOUS, "segment": CATEGORICAL, "return_flag": CATEGORICAL},
    target="high_value",
    raw_target="price_class",
    low_label="<=60K",
    high_label=">60K",
    raw_columns=("order_key", "quantity", "discount", "segment", "return_flag", "price_class"),
    numeric_columns=("quantity", "discount"),
    rules=(RangeRule("quantity", 1, 50), RangeRule("discount", low=0)),
)

REVIEW_SPEC = CohortSpec(
    variables={"n_chars": CONTINUOUS, "toxic": BINARY, "lang": CATEGORICAL, "source": CATEGORICAL},
    target="quality",
    key="doc_id",
)

ORDER_COLUMNS = {"priority", "segment", "balance", "nation", "outcome", "score", "predicted", "linear"}
CUSTOMER_COLUMNS = ORDER_COLUMNS - {"priority"}


# Columns of the line alone. They are made before the join: the draws are shuffled instead of the five
# columns behind them, and a filter above the join does not hash again.
LINE_COLUMNS = {
    "row_id", "quantity", "discount", "line_status", "return_flag", "high_value", "exposed", "draw_y", "draw_s",
}


# The columns used here, declared so that reading a table needs no schema inference job.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, "
    "l_linestatus string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderpriority string",
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "events": "event_type string, value double",
    "labels": "doc_id bigint, quality int, toxic int",
    "documents": "doc_id bigint, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on a table that is scanned in fewer tasks than there are cores.

    A small file may hold a single row group, which one task reads. Large tables have more
    scan tasks than cores and are returned as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def line_id() -> Column:
    """The five columns that identify a line, hashed."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return F.md5(
        F.concat_ws("|", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents)
    )


def _linear() -> Column:
    return (
        F.lit(-2.0)
        + 0.06 * F.col("quantity")
        + 0.8 * (F.col("return_flag") == "R").cast("double")
        - 0.5 * (F.col("segment") == "BUILDING").cast("double")
    )


def _definitions() -> dict[str, Column]:
    """How each cohort column is made, in dependency order."""
    return {
        "row_id": line_id(),
        "quantity": F.col("l_quantity"),
        "discount": F.col("l_discount"),
        "line_status": F.col("l_linestatus"),
        "return_flag": F.col("l_returnflag"),
        "high_value": (F.col("l_extendedprice") > 60000).cast("int"),
        "priority": F.col("o_orderpriority"),
        "segment": F.col("c_mktsegment"),
        "balance": F.col("c_acctbal"),
        "nation": F.col("n_name"),
        "exposed": F.when(
            hash_uniform(F.col("row_id"), "x") < sigmoid(0.05 * (F.col("quantity") - 25)), "yes"
        ).otherwise("no"),
        "draw_y": hash_uniform(F.col("row_id"), "y"),
        "draw_s": hash_uniform(F.col("row_id"), "s"),
        "linear": _linear(),
        "outcome": (F.col("draw_y") < sigmoid(F.col("linear"))).cast("int"),
        "score": F.round(sigmoid(F.col("linear") + 2.0 * (F.col("draw_s") - 0.5)), 3),
        "predicted": (F.col("score") >= 0.5).cast("int"),
    }


NEEDS = {
    "linear": {"quantity", "return_flag", "segment"},
    "outcome": {"draw_y", "linear"},
    "exposed": {"row_id", "quantity"},
    "score": {"draw_s", "linear"},
    "draw_y": {"row_id"},
    "draw_s": {"row_id"},
    "predicted": {"score"},
}


def trade_cohort(spark: SparkSession, folder: str, columns: Iterable[str]) -> DataFrame:
    """The requested cohort columns, one row per order line."""
    columns = list(columns)
    needed, queue = set(), list(columns)
    while queue:
        name = queue.pop()
        if name not in needed:
            needed.add(name)
            queue += NEEDS.get(name, ())
    made = {name: c for name, c in _definitions().items() if name in needed}
    rows = spread(table(spark, folder, "lineitem"))
    for name in [n for n in made if n in LINE_COLUMNS]:
        rows = rows.withColumn(name, made.pop(name))
    if needed & ORDER_COLUMNS:
        rows = rows.select("l_orderkey", *sorted(needed & LINE_COLUMNS))
        orders = table(spark, folder, "orders")
        if needed & CUSTOMER_COLUMNS:
            customer = table(spark, folder, "customer")
            if "nation" in needed:
                nation = table(spark, folder, "nation")  # 25 rows at every scale
                customer = customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
            orders = with_customer(orders, customer)
        rows = rows.join(orders, rows.l_orderkey == orders.o_orderkey)
    for name, definition in made.items():
        rows = rows.withColumn(name, definition)
    return rows.select(*columns)


def with_customer(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders with their customer, joined before the lines: those are several times as many and shuffled once."""
    return orders.join(customer, orders.o_custkey == customer.c_custkey)


def raw_trade_text(spark: SparkSession, folder: str) -> DataFrame:
    """An all-text table with the usual defects: blanks, ``?``, bad numbers, repeats, suffixes."""
    lines, orders, customer = (table(spark, folder, n) for n in ("lineitem", "orders", "customer"))
    lines = spread(lines)
    bought = with_customer(orders, customer)
    rows = lines.join(bought, lines.l_orderkey == bought.o_orderkey)
    quantity = F.col("l_quantity").cast("int")
    text = rows.select(
        F.col("l_orderkey").cast("string").alias("order_key"),
        F.when(F.col("l_orderkey") % 17 == 0, F.lit(None))
        .when(F.col("l_partkey") % 31 == 0, F.lit("12 units"))
        .when(F.col("l_suppkey") % 29 == 0, (quantity * 10).cast("string"))
        .otherwise(F.concat(F.lit(" "), quantity.cast("string")))
        .alias("quantity"),
        F.col("l_discount").cast("string").alias("discount"),
        F.when(F.col("l_partkey") % 19 == 0, " ? ")
        .otherwise(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" ")))
        .alias("segment"),
        F.when(F.col("l_orderkey") % 13 == 0, "").otherwise(F.col("l_returnflag")).alias("return_flag"),
        F.when(F.col("l_partkey") % 97 == 0, F.lit("unknown"))
        .when(F.col("l_partkey") % 89 == 0, F.lit(None))
        .otherwise(
            F.concat(
                F.when(F.col("l_extendedprice") > 60000, ">60K").otherwise("<=60K"),
                F.when(F.col("l_suppkey") % 3 == 0, ".").otherwise(""),
            )
        )
        .alias("price_class"),
    )
    repeats = text.filter(F.col("order_key").cast("bigint") % 23 == 0)
    return text.unionByName(repeats)


def review_cohort(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents: a small cohort with sparse cells."""
    labels, documents = table(spark, folder, "labels"), table(spark, folder, "documents")
    return labels.join(documents, "doc_id").select(
        "doc_id",
        "quality",
        F.when(F.col("toxic") == 1, "toxic").otherwise("clean").alias("toxic"),
        F.col("n_chars").cast("double").alias("n_chars"),
        "lang",
        "source",
    )
