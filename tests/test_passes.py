"""How often rows are read and what is shuffled by the shared steps of the queries."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortwise.catalogue import contracts, matching
from cohortwise.operators import cleaning, explain, frames, metrics, quantiles, unadjusted
from cohortwise.plans import association
from cohortwise.sources import tables
from cohortwise.spec import CONTINUOUS, AnalysisRequest, CohortSpec

SMALL = "/root/testdata/sf0.001"


def counted(df, tally):
    """The rows of ``df``, each added to ``tally`` whenever it is computed."""

    def work(batches):
        for batch in batches:
            tally.add(len(batch))
            yield batch

    return df.mapInPandas(work, df.schema)


@pytest.fixture
def scored(spark):
    rng = np.random.default_rng(2)
    rows = [(int(y), round(float(p), 2), int(p > 0.5)) for y, p in zip(rng.integers(0, 2, 400), rng.random(400))]
    return spark.createDataFrame([*rows, (None, 0.3, 0), (1, None, None)], "y_test int, y_proba double, y_pred int")


def _outermost_join(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return next(line for line in plan.splitlines() if "Join Inner" in line)


@pytest.mark.parametrize("columns", [["outcome", "score"], ["nation", "quantity"]])
def test_lines_are_joined_last(spark, columns):
    assert "l_orderkey" in _outermost_join(tables.trade_cohort(spark, SMALL, columns))
    assert "l_orderkey" in _outermost_join(tables.raw_trade_text(spark, SMALL))


def test_keys_are_hashed_before_the_join(spark):
    rows = cleaning.complete_cases(tables.trade_cohort(spark, SMALL, ["outcome", "segment", "quantity"]), ["outcome", "segment", "quantity"])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" in plan and "md5" not in plan[: plan.index("Join Inner")]


def test_matched_cohort_is_read_once(spark):
    """The score is a column of the rows that are matched, not of a second cohort joined by key."""
    rows = matching._scored_holes(spark, SMALL)
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey") == 1


def test_association_reads_rows_once(spark):
    rng = np.random.default_rng(5)
    rows = [(int(y), float(x), "unused") for y, x in zip(rng.integers(0, 2, 300), rng.integers(0, 9, 300))]
    df = spark.createDataFrame([*rows, (None, 1.0, ""), (1, None, "")], "y int, x double, text string")
    tally = spark.sparkContext.accumulator(0)
    spec = CohortSpec(variables={"x": CONTINUOUS}, target="y")
    result = association.analyze(counted(df, tally), AnalysisRequest("x"), spec)
    assert (result.input_rows, result.sample_size) == (302, 300)
    assert result.margins.count() and result.fit.design.rows == 300
    assert tally.value == 302


def test_evaluation_reads_rows_once(spark, scored):
    tally = spark.sparkContext.accumulator(0)
    row = metrics.evaluate(counted(scored, tally), "y_test", "y_proba").first()
    assert tally.value == 402
    kept = [(r.y_test, r.y_proba) for r in scored.collect()]
    both = [(y, p) for y, p in kept if y is not None and p is not None]
    known = [y for y, _ in kept if y is not None]
    assert row.test_rows == 402
    assert np.isclose(row.brier_score, np.mean([(p - y) ** 2 for y, p in both]))
    assert np.isclose(row.actual_positive_rate, np.mean(known))
    assert np.isclose(row.accuracy, np.mean([(p >= 0.5) == y for y, p in both]))


def test_consistency_reads_predictions_once(spark, scored):
    whole = scored.na.drop()
    stored = spark.createDataFrame([metrics.evaluate(whole, "y_test", "y_proba").first()])
    tally = spark.sparkContext.accumulator(0)
    found = metrics.artefact_consistency(stored, counted(whole, tally)).collect()
    assert tally.value == 400 and len(found) == 6


def test_levels_read_rows_once(spark):
    tally = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame([("b", "x"), ("a", None), ("b", "y")], "g string, h string")
    assert unadjusted.levels_of(counted(df, tally), ["g", "h"]) == {"g": ["a", "b"], "h": ["x", "y"]}
    assert tally.value == 3


def test_column_contract_makes_its_rows_once(spark, monkeypatch):
    tally = spark.sparkContext.accumulator(0)
    rows = tables.raw_trade_text(spark, SMALL).limit(50).persist()
    monkeypatch.setattr(contracts, "raw_trade_text", lambda *_: counted(rows, tally))
    accepted = {r.state: r.accepted for r in contracts.column_contract(spark, SMALL).collect()}
    assert tally.value == 50
    assert [s for s, ok in accepted.items() if ok] == ["as registered", "reordered"]


def test_top_impacts_inside_records(spark):
    rows = [(f"r{i}", *np.round(np.random.default_rng(i).normal(size=3), 1).tolist()) for i in range(30)]
    names = ("a", "b", "c")
    df = spark.createDataFrame([*rows, ("r30", 0.5, -0.5, 0.5), ("r31", 0.0, 0.0, 0.0)], "id string, a double, b double, c double")
    schema = {n: {"reference_value": 0.0} for n in names}

    def score(d):
        return d.withColumn("probability", (F.col("a") - 2 * F.col("b") + F.col("c")) / 10)

    long = frames.top_impacts(explain.local_impacts(df, "id", schema, score), "id", 2)
    whole = frames.top_record_impacts(explain.recorded_impacts(df, "id", schema, score), "id", 2)
    assert "Exchange" not in whole._jdf.queryExecution().executedPlan().toString()
    assert sorted(whole.collect()) == sorted(long.select(whole.columns).collect())


def test_quantiles_of_few_values_need_no_narrowing(spark, monkeypatch):
    def never(*_):
        raise AssertionError("a column of few values was narrowed")

    monkeypatch.setattr(quantiles, "_narrow", never)
    values = np.arange(3000) % 7
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    found = quantiles.exact_quantiles(df, ["x"], [0.05, 0.5, 0.95], direct_rows=2000, inside_rows=10)["x"]
    assert np.allclose(found, np.quantile(values, [0.05, 0.5, 0.95]))


def test_partners_are_sent_as_one_record_per_block():
    """A row's values were once a shuffled row of their own in each repeat."""
    numbers, texts = pa.array([float(i) for i in range(4100)]), pa.array([None if i % 9 == 0 else f"v{i % 7}" for i in range(4100)])
    own = pa.StructArray.from_arrays([numbers, texts], names=["a", "b"])
    sent = explain._packed(np.arange(4100), own, 4100, 3, 1000)
    assert sent.column("__block").to_pylist() == [0, 1, 2, 3, 4]
    for k, size in enumerate([1000] * 4 + [100]):
        where, values = explain._unpacked(pa.chunked_array([sent.column("__packed").slice(k, 1)]), 3, 1000)
        for r in range(3):
            senders = np.argsort(explain.permuted(4100, r))[k * 1000 : k * 1000 + size]
            for found, whole in zip(values, (numbers, texts)):
                assert found.take(pa.array(where[r * 1000 : r * 1000 + size])).to_pylist() == whole.take(pa.array(senders)).to_pylist()


@pytest.mark.parametrize("few", [True, False])
def test_importance_scores_patterns_not_rows(spark, few):
    """Each row was scored once per repeat and feature, however many rows were alike."""
    rng = np.random.default_rng(3)
    a = rng.integers(0, 4, 900).astype(float) if few else rng.random(900)
    rows = [(i, int(y), float(x), None if i % 11 == 0 else f"v{i % 3}") for i, (y, x) in enumerate(zip(rng.integers(0, 2, 900), a))]
    df = spark.createDataFrame(rows, "id int, y int, a double, b string").repartition(3)
    found = explain.permuted_patterns(df, "id", ["y"], ["a", "b"], 2, 300).collect()
    long = explain.shuffled_partners(df, "id", ["a", "b"], 2, 300).collect()
    for f in ("a", "b"):
        expected, counted = {}, {}
        for x in long:
            k = (x["repeat"], x.y, x["__partner"].a if f == "a" else x.a, x["__partner"].b if f == "b" else x.b)
            expected[k] = expected.get(k, 0) + 1
        for x in found:
            if x.feature == f:
                k = (x["repeat"], x.y, x.a, x.b)
                counted[k] = counted.get(k, 0) + x["__n"]
        assert counted == expected
    assert not few or len(found) <= 2 * 2 * 3 * 32  # two repeats and features, three blocks, 2 * 4 * 4 patterns
