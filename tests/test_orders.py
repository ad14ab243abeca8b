import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortwise.operators import binning, ordering, profiling, splits
from cohortwise.operators.quantiles import exact_quantiles
from cohortwise.spec import AnalysisError


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(3)
    return {
        "normal": rng.normal(size=3000),
        "hot": np.where(rng.random(3000) < 0.6, 7.0, rng.integers(0, 50, 3000).astype(float)),
        "same": np.full(3000, 4.0),
    }


@pytest.mark.parametrize("limits", [{}, {"direct_rows": 10, "inside_rows": 20, "accuracy": 50}])
def test_quantiles_match_linear_interpolation(spark, numbers, limits):
    df = spark.createDataFrame(list(zip(*[v.tolist() for v in numbers.values()])), ", ".join(f"{c} double" for c in numbers))
    probabilities = [0.0, 0.05, 0.25, 0.5, 0.9, 1.0]
    found = exact_quantiles(df.repartition(7), list(numbers), probabilities, **limits)
    for c, values in numbers.items():
        assert np.allclose(found[c], np.quantile(values, probabilities), rtol=0, atol=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None, 1.0)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [None], "b": [1.0]}


@pytest.mark.parametrize("per_range", [1000, 7])
def test_running_totals(spark, per_range):
    rng = np.random.default_rng(5)
    rows = [(g, float(k), int(rng.integers(0, 9))) for g in "ab" for k in rng.permutation(60)]
    df = spark.createDataFrame(rows, "g string, k double, n int")
    found = ordering.running_totals(df, "k", {"before": "n"}, ["g"], per_range)
    for r in found.collect():
        assert r.before == sum(n for g, k, n in rows if g == r.g and k < r.k)


def test_hash_positions_and_cuts(spark):
    rows = [(f"r{i}", int(i % 3 == 0)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id string, y int")
    digests = {r: hashlib.md5(r.encode()).hexdigest() for r, _ in rows}
    order = {
        y: sorted((r for r, v in rows if v == y), key=digests.get) for y in (0, 1)
    }
    train, test = splits.stratified_split(df, "y", "id")
    assert {r.id for r in train.collect()} == {r for y in (0, 1) for r in order[y][: len(order[y]) * 4 // 5]}
    assert train.count() + test.count() == 1000
    sizes = splits.add_folds(df, "y", "id", 7).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        counts = [r["count"] for r in sizes if r.y == y]
        assert len(counts) == 7 and max(counts) - min(counts) <= 1
    placed = ordering.hash_order_positions(df.withColumn("h", F.md5("id")), "h", "place", ["y"])
    for r in placed.collect():
        assert order[r.y][r.place] == r.id


def test_cut_search_descends_into_prefixes(spark, monkeypatch):
    monkeypatch.setattr(ordering, "WINDOW_ROWS", 1)
    df = spark.range(300).select(F.col("id").cast("string").alias("id"), F.lit(0).alias("y"))
    train, _ = splits.stratified_split(df, "y", "id", (1, 2))
    assert train.count() == 150


def test_folds_do_not_depend_on_partitioning(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("id"), (F.col("id") % 2).alias("y"))
    a = {r.id: r.fold for r in splits.add_folds(df.repartition(2), "y", "id", 5).collect()}
    b = {r.id: r.fold for r in splits.add_folds(df.repartition(9), "y", "id", 5).collect()}
    assert a == b


def test_bins_drop_repeated_edges_and_keep_the_lowest(spark):
    values = [0.0] * 60 + [1.0, 2.0, 3.0, 4.0] * 10
    df = spark.createDataFrame([(v, int(v > 1)) for v in values], "x double, y int")
    found = binning.binned_rates(df, "x", "y").collect()
    assert sum(r.n for r in found) == 100 and found[0].exposure_min == 0.0
    assert [r.exposure_mean for r in found] == sorted(r.exposure_mean for r in found)
    with pytest.raises(AnalysisError):
        binning.binned_rates(df.filter("x = 0"), "x", "y")


def test_profile_tables(spark):
    df = spark.createDataFrame(
        [(1.0, "a", 0), (1.0, "a", 0), (None, None, 1), (4.0, "b", None)], "x double, g string, y int"
    )
    missing = {r.column: r.missing_count for r in profiling.missing_values(df).collect()}
    assert missing == {"x": 1, "g": 1, "y": 1}
    assert profiling.duplicate_summary(df).first().duplicate_rows == 1
    numeric = {r.column: r for r in profiling.describe_numeric(df).collect()}
    assert numeric["x"].median == 1.0 and numeric["x"].missing_count == 1 and set(numeric) == {"x", "y"}
    levels = {r.category: (r["count"], r.proportion) for r in profiling.category_frequencies(df).collect()}
    assert levels == {"a": (2, 0.5), "b": (1, 0.25), "<NA>": (1, 0.25)}
    overview = profiling.profile_overview(df, "y").first()
    assert (overview.rows, overview.missing_cells, overview.duplicate_rows) == (4, 3, 1)
    assert abs(overview.high_rate - 1 / 3) < 1e-12
    with pytest.raises(AnalysisError):
        profiling.full_profile(df.filter("false"), "y")


@pytest.mark.parametrize("key", [[None, 1.0, 2.0, float("nan")], [float("-inf"), 0.5, 3.0, float("inf")]])
def test_running_totals_do_not_depend_on_the_size(spark, key):
    rows = [(g, k, i + 1) for g in (None, "a", "b") for i, k in enumerate(key + [float(j + 10) for j in range(20)])]
    df = spark.createDataFrame(rows, "g string, k double, n int")
    found = []
    for per_range in (1000, 4):
        totals = ordering.running_totals(df, "k", {"before": "n"}, ["g"], per_range)
        found.append(sorted((str(r.g), str(r.k), r.n, r.before) for r in totals.collect()))
    assert found[0] == found[1] and len(found[0]) == len(rows)


def test_auc_of_a_null_group_and_null_scores(spark, monkeypatch):
    from cohortwise.operators import metrics

    rows = [(None if i % 3 == 0 else "x", i % 2, None if i % 11 == 0 else float("nan") if i % 13 == 0 else i / 7) for i in range(90)]
    df = spark.createDataFrame(rows, "g string, y int, p double")
    found = []
    for per_range in (1000, 5):
        monkeypatch.setattr(ordering.running_totals, "__defaults__", ((), per_range))
        found.append(sorted((str(r.g), r.roc_auc) for r in metrics.roc_auc(df, "y", "p", ["g"]).collect()))
    assert found[0] == found[1] and len(found[0]) == 2


def test_hash_positions_keep_rows_without_a_digest(spark):
    rows = [(None if i % 4 == 0 else f"{i:032x}", None if i % 2 else "g") for i in range(40)]
    placed = ordering.hash_order_positions(spark.createDataFrame(rows, "h string, g string"), "h", "place", ["g"]).collect()
    assert len(placed) == 40
    for g in (None, "g"):
        own = sorted((r.place, r.h or "") for r in placed if r.g == g)
        assert [p for p, _ in own] == list(range(20)) and [h for _, h in own] == sorted(h for _, h in own)


@pytest.mark.parametrize("values", [[float("-inf")] * 3 + [1.0, 2.0, 4.0] + [float("inf")] * 3, [1.0, float("nan"), float("inf"), 5.0, None]])
def test_quantiles_of_infinities_do_not_depend_on_the_size(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    probabilities = [0.0, 0.2, 0.3, 0.5, 0.65, 0.8, 1.0]
    direct = exact_quantiles(df, ["x"], probabilities)["x"]
    narrow = exact_quantiles(df, ["x"], probabilities, direct_rows=1, inside_rows=2, accuracy=50)["x"]
    assert [str(v) for v in direct] == [str(v) for v in narrow]


def test_splits_refuse_keys_that_do_not_tell_rows_apart(spark):
    same = spark.createDataFrame([("k", 1)] * 40, "id string, y int")
    none = spark.createDataFrame([(None, 1), ("a", 1), ("b", 1)], "id string, y int")
    for df in (same, none):
        with pytest.raises(AnalysisError):
            splits.stratified_split(df, "y", "id")
    unknown = spark.createDataFrame([(f"r{i}", None if i == 3 else 1) for i in range(10)], "id string, y int")
    assert splits.add_folds(unknown, "y", "id", 2).filter("fold is null").count() == 1


def test_one_sketch_serves_all_ranks_of_a_bracket(spark, monkeypatch):
    """Twenty ranks of a column used to fill twenty equal sketches from every row."""
    from cohortwise.operators import quantiles

    made, sketch = [], F.percentile_approx
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda *args: made.append(args) or sketch(*args))
    df = spark.range(5000).select((F.col("id") * F.col("id") % 4999).cast("double").alias("a"), F.col("id").alias("b"))
    shares = [i / 10 for i in range(11)]
    found = quantiles.exact_quantiles(df, ["a", "b"], shares, direct_rows=10, inside_rows=4000, accuracy=100)
    rows = df.toPandas()
    for c in ("a", "b"):
        assert np.allclose(found[c], np.quantile(rows[c], shares))
    assert len(made) == 2
