import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortwise.operators import boosting, explain, fairness, frames, metrics
from cohortwise.operators.boosting import BoostingParams
from cohortwise.plans import experiments, training
from cohortwise.spec import AnalysisError, CohortSpec
from cohortwise.streaming.scoring import score_stream

SPEC = CohortSpec(
    variables={"age": "continuous", "sex": "binary", "job": "categorical"},
    target="rich", key="id", features=("age", "sex", "job"), group_columns=("sex", "job"),
)
QUICK = BoostingParams(max_iter=4, max_depth=2)


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(8)
    p = np.round(rng.random(500), 2)
    y = (rng.random(500) < p).astype(int)
    return p, y, spark.createDataFrame([(int(b), float(a)) for a, b in zip(p, y)], "y int, p double").persist()


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(600):
        age, sex, job = float(rng.integers(18, 80)), str(rng.choice(["F", "M"])), str(rng.choice(["a", "b", "c"]))
        rich = int(rng.random() < 1 / (1 + np.exp(-(age - 50) / 6)))
        rows.append((str(i), age if i % 50 else None, sex, job if i % 30 else None, rich))
    return spark.createDataFrame(rows, "id string, age double, sex string, job string, rich int").persist()


@pytest.fixture(scope="module")
def evaluation(people):
    return training.evaluate(people, SPEC, QUICK, importance_repeats=2)


def test_auc_matches_all_pairs(scores):
    p, y, df = scores
    gaps = p[y == 1][:, None] - p[y == 0][None, :]
    expected = np.mean((gaps > 0) + 0.5 * (gaps == 0))
    assert abs(metrics.roc_auc(df, "y", "p").first().roc_auc - expected) < 1e-12


def test_threshold_scan_matches_brute_force(scores):
    p, y, df = scores
    found = {r.threshold: r for r in metrics.threshold_scan(df, "y", "p").collect()}
    assert sorted(found) == list(metrics.THRESHOLDS)
    for t, r in found.items():
        hit = p >= t
        assert (r.tp, r.fp) == (int((hit & (y == 1)).sum()), int((hit & (y == 0)).sum()))
        assert (r.fn, r.tn) == (int((~hit & (y == 1)).sum()), int((~hit & (y == 0)).sum()))


def test_roc_ends_at_one(scores):
    points = sorted(metrics.roc_points(scores[2], "y", "p").collect(), key=lambda r: -r.threshold)
    assert (points[0].fpr, points[0].tpr) == (0.0, 0.0) and (points[-1].fpr, points[-1].tpr) == (1.0, 1.0)


def test_zero_division_gives_zero(spark):
    df = spark.createDataFrame([(0, 0.1), (1, 0.2)], "y int, p double")
    row = metrics.evaluate(df, "y", "p").first()
    assert (row.precision, row.recall, row.f1) == (0.0, 0.0, 0.0)


def test_fairness_states(spark):
    def groups(recalls):
        return spark.createDataFrame(
            [("g", str(i), 100, n, r, 1 - r, n >= 30) for i, (r, n) in enumerate(recalls)],
            "group_column string, group_value string, n int, n_actual_positive int, recall double, "
            "false_negative_rate double, reliable boolean",
        )

    assert fairness.fairness_status(groups([(0.60, 40), (0.69, 40)])).first().status == "pass"
    assert fairness.fairness_status(groups([(0.2, 5), (0.9, 8)])).first().status == "skipped"
    bad = groups([(0.59, 40), (0.9, 40)])
    assert fairness.fairness_status(bad).first().status == "fail"
    assert {r.type for r in fairness.fairness_violations(bad).collect()} == {"min_recall", "recall_gap"}


def test_model_learns_and_is_calibrated(evaluation):
    row = evaluation.metrics.first()
    assert row.roc_auc > 0.85 and abs(row.mean_probability_bias) < 0.1
    top = evaluation.importance.first()
    assert top.feature == "age" and top.importance_mean > 0.1
    assert set(evaluation.card["feature_types"]) == set(SPEC.features)


def test_only_declared_features_are_used(people, evaluation):
    leaky = people.withColumn("leak", F.col("rich") * 100)
    model, _, _ = training.train(leaky, SPEC, QUICK)
    assert list(model.schema) == list(SPEC.features)


def test_training_is_repeatable(people, evaluation):
    model, _, _ = training.train(people, SPEC, QUICK)
    a = {r.id: r.probability for r in model.score(people).collect()}
    b = {r.id: r.probability for r in evaluation.model.score(people).collect()}
    assert max(abs(a[k] - b[k]) for k in a) < 1e-9


def test_stored_model_scores_the_same_and_streams(spark, people, evaluation, tmp_path):
    folder = str(tmp_path / "bundle")
    with pytest.raises(AnalysisError, match="no data"):
        training.load_bundle(spark, folder)
    training.save_evaluation(evaluation, folder)
    bundle = training.load_bundle(spark, folder)
    records = people.na.drop().select("id", "age", "sex", "job")
    before = {r.id: r.probability for r in evaluation.model.score(records).collect()}
    after = {r.id: r for r in training.predict(records, bundle, "id").collect()}
    assert all(abs(before[k] - after[k].probability) < 1e-12 for k in before)
    assert all(r.predicted_class == int(r.probability >= 0.5) for r in after.values())
    metrics.require_consistency(*training.read_diagnostics(spark, folder))
    with pytest.raises(AnalysisError):
        training.predict(records.drop("age"), bundle, "id")
    with pytest.raises(AnalysisError):
        training.predict(records.withColumn("extra", F.lit(1)), bundle, "id")

    records.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(records.schema).parquet(str(tmp_path / "in"))
    query = (
        score_stream(stream, bundle.model).select("id", "probability")
        .writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination(120)
    streamed = {r.id: r.probability for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert streamed == {k: r.probability for k, r in after.items()}


def test_impacts_and_what_if_of_the_model(people, evaluation):
    records = people.na.drop().limit(20).select("id", *SPEC.features).persist()
    schema, score = evaluation.model.schema, evaluation.model.score
    rows = explain.local_impacts(records, "id", schema, score).collect()
    assert len(rows) == 20 * 3
    for r in rows:
        if r.current_value == r.reference_value:
            assert abs(r.impact_probability) < 1e-12
    kept = frames.top_impacts(explain.local_impacts(records, "id", schema, score), "id", 2)
    assert kept.groupBy("id").count().filter("count <> 2").count() == 0
    grid = explain.what_if(records, "id", "age", schema, score)
    assert grid.count() == 20 * explain.POINTS
    assert explain.what_if(records, "id", "job", schema, score).count() == 20 * 3


def test_what_if_values():
    schema = {"x": {"kind": "continuous", "minimum": 0.0, "maximum": 4.0, "q05": 1.0, "q95": 1.0}}
    assert explain.what_if_values("x", schema, 3) == [0.0, 2.0, 4.0]
    schema["x"]["maximum"] = 0.0
    assert explain.what_if_values("x", schema, 3) == [0.0]
    for bad in (lambda: explain.what_if_values("x", schema, 1), lambda: explain.what_if_values("q", schema),
                lambda: explain.what_if_values("x", schema, values=[])):
        with pytest.raises(AnalysisError):
            bad()


def test_sigmoid_calibration_is_monotone_and_isotonic_non_decreasing(spark):
    rng = np.random.default_rng(6)
    m = rng.normal(size=400)
    y = (rng.random(400) < 1 / (1 + np.exp(-2 * m))).astype(float)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(m, y)], "m double, y double").persist()
    curve = boosting.fit_sigmoid(df, "m", "y")
    assert 1.3 < curve.slope < 2.8
    stepped = boosting.fit_isotonic(df, "m", "y").apply(df, "m", "p").orderBy("m").collect()
    values = [r.p for r in stepped]
    assert all(b >= a for a, b in zip(values, values[1:])) and 0 <= values[0] <= values[-1] <= 1


def test_experiments(people):
    rows, schema = experiments.prepare(people, SPEC, 3)
    base = experiments.fold_scores(rows, schema, QUICK, 3)
    other = experiments.fold_scores(rows, schema, QUICK.with_(max_iter=2, max_depth=1), 3)
    r = experiments.compare_scores(base, other).first()
    assert r.folds == 3 and abs(r.mean_difference - (r.candidate_mean - r.baseline_mean)) < 1e-12
    assert experiments.score_summary(base).first().roc_auc_mean > 0.8
    assert experiments.sample_parameters(3) == experiments.sample_parameters(3)
    drawn = experiments.sample_parameters(40)
    assert all(0.03 <= p.learning_rate <= 0.25 and 100 <= p.max_iter <= 350 for p in drawn)
    found = experiments.out_of_fold(rows, schema, SPEC, QUICK, 3, 2)
    assert found.count() == 600 and found.select("row_id").distinct().count() == 600


def test_explanations_keep_repeated_records_and_shuffle_nothing(spark):
    from cohortwise.operators import explain

    schema = {"a": {"kind": "continuous", "reference_value": 0.0}, "b": {"kind": "categorical", "reference_value": "u"}}
    df = spark.createDataFrame([(1, 2.0, "v"), (1, 2.0, "v"), (1, 0.0, "u")], "id int, a double, b string")

    def score(rows):
        return rows.withColumn("probability", F.col("a") / 10 + F.when(F.col("b") == "v", 0.5).otherwise(0.0))

    found = explain.explained_predictions(df, "id", schema, score, 0.5, ("no", "yes"), "m", "-")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    rows = found.collect()
    assert len(rows) == 3 and sorted(len(r.impacts) for r in rows) == [2, 2, 2]
    assert [e.feature for e in rows[0].impacts] == ["b", "a"]
    assert explain.local_impacts(df, "id", schema, score).count() == 6


def test_search_refits_and_compares_the_best(spark, people, tmp_path):
    rows, schema = experiments.prepare(people, SPEC, 3)
    tried = [BoostingParams(max_iter=1, max_depth=1, l2=1.0), BoostingParams(max_iter=4, max_depth=None, max_leaf_nodes=7)]
    found = experiments.search(rows, schema, tried, QUICK, 3)
    ranking = {r["rank"]: r for r in found.ranking.collect()}
    assert tried[ranking[1].candidate] == found.best and ranking[1].mean_score >= ranking[2].mean_score
    folds = [r.roc_auc for r in found.best_folds.collect()]
    compared = found.comparison.first()
    assert compared.folds == 3 and abs(compared.candidate_mean - np.mean(folds)) < 1e-12
    experiments.write_search(found, str(tmp_path / "search"))
    stored = [spark.read.parquet(str(tmp_path / "search" / part)) for part in ("trees", "bins")]
    (again,) = training.models_from_frames(*stored)
    assert len(again.trees) == found.best.max_iter + 1
    margins = [r.m for r in boosting.with_margin(rows.rows, found.model, "m").orderBy("id").collect()]
    assert margins == [r.m for r in boosting.with_margin(rows.rows, again, "m").orderBy("id").collect()]
    assert spark.read.parquet(str(tmp_path / "search" / "ranking")).count() == 2


def test_permutations_are_bijections():
    for size in (0, 1, 2, 3, 5, 16, 17, 1000, 4097):
        found = [explain.permuted(size, r) for r in range(6)]
        assert all(sorted(f.tolist()) == list(range(size)) for f in found)
        if size >= 1000:
            assert len({tuple(f[:50]) for f in found}) == 6
            assert all((f == np.arange(size)).mean() < 0.01 for f in found)
            assert all(abs(np.corrcoef(f, np.arange(size))[0, 1]) < 0.1 for f in found)


def test_every_row_is_a_partner_once_in_each_repeat(spark):
    rows = [(i, float(i), None if i % 7 == 0 else f"v{i}", "x") for i in range(500)]
    df = spark.createDataFrame(rows, "id int, a double, b string, __row string").repartition(3)
    for per_block in (10_000, 60):
        found = explain.shuffled_partners(df, "id", ["a", "b"], 4, per_block).collect()
        assert len(found) == 2000
        for r in range(4):
            mine = [x for x in found if x["repeat"] == r]
            assert sorted(x.id for x in mine) == list(range(500))
            assert sorted(x["__partner"].a for x in mine) == [float(i) for i in range(500)]
            assert all(x["__partner"].b == rows[int(x["__partner"].a)][2] and x.a == x.id for x in mine)
    assert explain.shuffled_partners(df.limit(0), "id", ["a"], 2).count() == 0


def test_partners_come_from_the_whole_table(spark):
    """Blocks of neighbouring places once kept a row's partners among its own thousand."""
    rows = spark.range(6000).select(F.col("id"), F.col("id").cast("double").alias("a"))
    order = {r.id: i for i, r in enumerate(rows.orderBy(F.md5(F.col("id").cast("string"))).collect())}
    found = explain.shuffled_partners(rows, "id", ["a"], 2).collect()
    gaps = np.array([abs(order[r.id] - order[int(r["__partner"].a)]) for r in found])
    assert len(gaps) == 12_000 and 1800 < gaps.mean() < 2200  # a third of the rows, as of independent places
