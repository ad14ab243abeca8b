"""Stratified splits and folds by hashed key (P2 and the folds of P6, X1, X4).

Membership depends on the key alone: the row order, the partitioning and reruns do not matter.
The exact class shares come from ``hash_cut_points``, so that applying a split is a row-wise
comparison without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.functions.columns import col
from cohortwise.operators.ordering import hash_cut_points


def digest(key: str, salt: str = "") -> Column:
    text = col(key).cast("string")
    return F.md5(F.concat(text, F.lit(salt)) if salt else text)


def _interval(df: DataFrame, target: str, key: str, salt: str, cuts: list[tuple[int, int]]) -> Column:
    """How many of the cut shares a row lies beyond, within its class."""
    rows = df.select(col(target).cast("int").alias("g"), digest(key, salt).alias("h"))
    points = hash_cut_points(rows, "g", "h", cuts)
    number = F.lit(None).cast("int")
    for g, keys in points.items():
        steps = F.lit(0)
        for k in keys:
            beyond = F.lit(1) if k is None else (digest(key, salt) > k).cast("int")
            steps = steps + beyond
        number = F.when(col(target).cast("int") == g, steps).otherwise(number)
    return number


def add_split(
    df: DataFrame, target: str, key: str, train: tuple[int, int] = (4, 5), out: str = "is_train"
) -> DataFrame:
    """Mark the first ``train`` share of each class, in hash order."""
    return df.withColumn(out, _interval(df, target, key, "", [train]) == 0)


def stratified_split(
    df: DataFrame, target: str, key: str, train: tuple[int, int] = (4, 5)
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows with the same class shares."""
    marked = add_split(df, target, key, train, "__train")
    return marked.filter("__train").drop("__train"), marked.filter(~F.col("__train")).drop("__train")


def add_folds(
    df: DataFrame, target: str, key: str, folds: int, out: str = "fold", salt: str = ""
) -> DataFrame:
    """Number the rows of each class into ``folds`` parts that differ by at most one row."""
    cuts = [(i, folds) for i in range(1, folds)]
    return df.withColumn(out, _interval(df, target, key, salt, cuts))
