"""The tree learner, isotonic ranges, the fit registry and published bundles."""

import json

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortwise.operators import boosting, isotonic, trees
from cohortwise.operators.boosting import BoostingParams
from cohortwise.operators.trees import FeatureBins, Grower, TreeModel, boosted
from cohortwise.plans import experiments, training
from cohortwise.sources import bundles
from cohortwise.spec import AnalysisError, CohortSpec

BINS = FeatureBins(("x", "kind"), {"x": (1.0, 2.0, 3.0)}, {"x": 2.0}, {"kind": ("a", "b", "c")})
SPEC = CohortSpec(variables={"age": "continuous", "job": "categorical"}, target="rich", key="id", features=("age", "job"), group_columns=("job",))


def sample(n, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.choice([0.5, 1.0, 1.5, 2.5, 3.5, np.nan], n)
    kind = rng.choice(["a", "b", "c", "new", None], n)
    columns = [pa.array(x, from_pandas=True), pa.array(kind, pa.string())]
    y = (rng.random(n) < np.where(kind == "b", 0.8, 0.2) * np.where(np.nan_to_num(x, nan=2.0) > 1.2, 1.0, 0.3)).astype(float)
    return columns, BINS.codes(columns), y


def test_codes():
    columns = [pa.array([0.0, 1.0, 1.5, 4.0, None, float("nan")]), pa.array(["a", "c", "b", "z", None, "a"])]
    assert BINS.codes(columns).tolist() == [[0, 4], [0, 6], [1, 5], [3, 7], [1, 7], [1, 4]]
    assert BINS.codes([pa.array([], pa.float64()), pa.array([], pa.string())]).shape == (0, 2)


def brute_split(codes, g, h, params):
    """The best split over all cuts of numbers and of levels in the order of their ratio."""
    best = (0.0, None, None)
    gain = lambda s: g[s].sum() ** 2 / (h[s].sum() + params.l2)
    for f, (start, stop) in enumerate(zip(BINS.offsets, BINS.offsets[1:])):
        present = list(range(start, stop))
        if f == 1:
            ratio = {c: g[codes[:, f] == c].sum() / (h[codes[:, f] == c].sum() + 10.0) for c in present}
            present.sort(key=lambda c: (ratio[c], c))
        for cut in range(1, len(present)):
            side = np.isin(codes[:, f], present[:cut])
            if min(side.sum(), (~side).sum()) < params.min_rows_per_leaf:
                continue
            found = gain(side) + gain(~side) - gain(np.ones(len(g), bool))
            if found > best[0] + 1e-12:
                best = (found, f, side)
    return best


def test_splits_are_the_best_ones():
    params = BoostingParams(max_depth=1, min_rows_per_leaf=15)
    for seed in range(12):
        _, codes, y = sample(200, seed)
        g, h = 0.4 - y, np.full(len(y), 0.24)
        tree, added = Grower(codes, BINS, params, lambda v: v).tree(g, h)
        found, feature, side = brute_split(codes, g, h, params)
        if feature is None:
            assert len(tree.features) == 1
            continue
        values = np.where(side, *(-params.learning_rate * g[s].sum() / (h[s].sum() + params.l2) for s in (side, ~side)))
        assert np.allclose(added, values)


def test_limits_of_a_tree():
    _, codes, y = sample(3000)
    for params in (BoostingParams(max_iter=3, max_depth=2), BoostingParams(max_iter=3, max_depth=None, max_leaf_nodes=5), BoostingParams(max_iter=3, max_depth=None, max_leaf_nodes=None, min_rows_per_leaf=100)):
        for tree in boosted(codes, y, np.ones(len(y)), BINS, params)[1:]:
            leaves = int((tree.features < 0).sum())
            assert leaves <= (params.max_leaf_nodes or 30)
            if params.max_depth == 2:
                assert leaves <= 4
    assert len(boosted(codes[:0], y[:0], y[:0], BINS, BoostingParams(max_iter=2))) == 3


def test_margins_follow_the_training_and_survive_storage():
    columns, codes, y = sample(2000)
    grown = boosted(codes, y, np.ones(len(y)), BINS, BoostingParams(max_iter=30))
    model = TreeModel(BINS, grown)
    margin = model.margins(columns)
    p = 1 / (1 + np.exp(-margin))
    loss = -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
    share = y.mean()
    assert loss < 0.9 * -(share * np.log(share) + (1 - share) * np.log(1 - share))
    from pyspark.sql import Row

    rows = [Row(**dict(zip(("tree", "features", "left", "right", "values", "goes_left"), r))) for r in model.rows()]
    again = TreeModel.from_rows(training.bins_from_text(json.dumps(
        {"names": BINS.names, "edges": BINS.edges, "stand_ins": BINS.stand_ins, "levels": BINS.levels})), rows[::-1])
    assert (again.margins(columns) == margin).all() and again.bins == BINS


@pytest.fixture(scope="module")
def people(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(900):
        age, job = float(rng.integers(18, 80)), str(rng.choice(["a", "b", "c"]))
        rows.append((str(i), age if i % 50 else None, job if i % 30 else None, int(rng.random() < 1 / (1 + np.exp(-(age - 50) / 6)))))
    return spark.createDataFrame(rows, "id string, age double, job string, rich int").persist()


def test_tasks_share_histograms(spark, people, monkeypatch):
    """Three barrier tasks grow the trees of one task, up to rounding."""
    params = BoostingParams(max_iter=6)
    one, schema = experiments.prepare(people, SPEC, 3)
    assert one.tasks == 1
    monkeypatch.setattr(boosting, "TASK_ROWS", 300)
    three, _ = experiments.prepare(people, SPEC, 3)
    assert three.tasks == 3 and three.fingerprint == one.fingerprint
    a, b = boosting.fit_tree(one, params), boosting.fit_tree(three, params)
    for s, t in zip(a.trees, b.trees):
        assert s.features.tolist() == t.features.tolist() and np.allclose(s.values, t.values, atol=1e-9)
    with pytest.raises(AnalysisError, match="no rows"):
        boosting.fit_tree(one.where(F.lit(False)), params)


def test_barrier_tasks_read_files_that_are_cut_in_more_parts(spark, people, monkeypatch):
    """A scan of more parts than tasks may not stand in a barrier stage."""
    monkeypatch.setattr(boosting, "TASK_ROWS", 500)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        table, _ = experiments.prepare(people, SPEC, 3)
        assert table.tasks == 2 and table.rows.rdd.getNumPartitions() > 2
        assert len(boosting.fit_tree(table, BoostingParams(max_iter=1)).trees) == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_default_fit_waits_for_no_barrier(people):
    """An all-gather takes a second; 154 trees of some 30 splits would wait over an hour."""
    assert -(-BoostingParams().fit_rows // boosting.TASK_ROWS) == 1


def test_a_bounded_sample_is_fitted_beyond_fit_rows(people):
    table = boosting.fit_table(people, {}, "rich", "id", params=BoostingParams(fit_rows=300))
    assert 200 < table.rows.count() < 400
    assert boosting.fit_table(people, {}, "rich", "id").rows.count() == 900


def test_queries_fit_all_rows_beyond_fit_rows(spark, people, monkeypatch):
    """Training and experiments take every labelled row, whatever the bound of a sample."""
    params, seen = BoostingParams(fit_rows=300, max_iter=1), []
    real = boosting.fit_calibrated
    monkeypatch.setattr(boosting, "fit_calibrated", lambda table, *args, **named: seen.append(table) or real(table, *args, **named))
    _, train_rows, _ = training.train(people, SPEC, params)
    assert seen[0].rows.count() == train_rows.count() > 700
    monkeypatch.setattr(boosting, "TASK_ROWS", 100)  # more parts than cores: tasks of one fit run at the same time
    table = boosting.whole_table(people, {}, "rich", "id", params=params)
    assert table.rows.count() == 900 and table.tasks == spark.sparkContext.defaultParallelism


def test_rows_with_equal_codes_are_one_record():
    _, codes, y = sample(1500)
    weights = np.where(y == 1, 2.0, 0.5)
    rows = trees.Patterns(BINS)
    for a in range(0, len(y), 100):
        rows.add(codes[a : a + 100], y[a : a + 100], weights[a : a + 100])
    found, total, positive, counts = rows.records()
    assert len(found) == len({tuple(c) for c in codes.tolist()}) and counts.sum() == len(y)
    for c, w, p, n in zip(found.tolist(), total, positive, counts):
        same = (codes == c).all(axis=1)
        assert n == same.sum() and np.isclose(w, weights[same].sum()) and np.isclose(p, (weights * y)[same].sum())


@pytest.mark.parametrize("params", [
    BoostingParams(max_iter=5), BoostingParams(max_iter=5, max_depth=None, max_leaf_nodes=6, min_rows_per_leaf=5),
    BoostingParams(max_iter=5, max_depth=4, max_leaf_nodes=None), BoostingParams(max_iter=5, max_depth=None, max_leaf_nodes=2),
])
def test_splits_counted_ahead_give_the_same_trees(params):
    """A level in one exchange: at most one for the sums, and one per level and tree, for trees bounded by depth."""
    _, codes, y = sample(3000)
    asked = []

    def grown(shared):
        rows = trees.Patterns(BINS)
        rows.add(codes, y, np.ones(len(y)))
        return trees.boosted_patterns(rows, BINS, params, lambda v: asked.append(shared) or v, shared)

    for s, t in zip(grown(False), grown(True), strict=True):
        assert s.features.tolist() == t.features.tolist() and np.allclose(s.values, t.values)
    if params.max_depth:
        assert sum(asked) <= 1 + params.max_iter * params.max_depth


def test_scores_by_tables_are_those_of_the_walk(monkeypatch):
    columns, codes, y = sample(3000)
    for leaves in (5, 40, 90):
        grown = boosted(codes, y, np.ones(len(y)), BINS, BoostingParams(max_iter=4))
        rng = np.random.default_rng(leaves)
        for t in grown[1:]:  # a chain of random splits, as deep as it has leaves
            n = 2 * leaves - 1
            t.features = np.array([int(rng.integers(2)) if i % 2 == 0 and i < n - 1 else -1 for i in range(n)])
            t.left = np.array([i + 1 if f >= 0 else -1 for i, f in enumerate(t.features)])
            t.right = np.array([i + 2 if f >= 0 else -1 for i, f in enumerate(t.features)])
            t.values = np.where(t.features < 0, rng.normal(size=n), 0.0)
            t.goes_left = [rng.random(BINS.sizes[f]) < 0.2 if f >= 0 else np.zeros(0, bool) for f in t.features]
        model = TreeModel(BINS, grown)
        local = BINS.codes(columns) - BINS.offsets[:-1].astype(np.int32)
        assert np.allclose(model.margins(columns), model._walked(local, np.zeros(len(y))))
    assert len(TreeModel(BINS, grown).margins([pa.array([], pa.float64()), pa.array([], pa.string())])) == 0


def brute_isotonic(x, y):
    order = sorted(set(x))
    blocks = [[y[x == v].sum(), float((x == v).sum()), [v]] for v in order]
    i = 0
    while i + 1 < len(blocks):
        if blocks[i][0] / blocks[i][1] >= blocks[i + 1][0] / blocks[i + 1][1]:
            total, weight, held = blocks.pop(i + 1)
            blocks[i] = [blocks[i][0] + total, blocks[i][1] + weight, blocks[i][2] + held]
            i = max(i - 1, 0)
        else:
            i += 1
    return {v: total / weight for total, weight, held in blocks for v in held}


@pytest.mark.parametrize("kind", ["noisy", "rising", "falling", "tied", "one"])
def test_isotonic_ranges_equal_one_pass(spark, kind, monkeypatch):
    monkeypatch.setattr(isotonic, "FAN", 2)
    rng = np.random.default_rng(3)
    n = 1 if kind == "one" else 400
    x = np.round(rng.normal(size=n), 1 if kind == "tied" else 4)
    y = {"rising": np.argsort(np.argsort(x)) * 1.0, "falling": -np.argsort(np.argsort(x)) * 1.0}.get(kind)
    y = (rng.random(n) < 1 / (1 + np.exp(-x))).astype(float) if y is None else y
    rows = [(float(a), float(b)) for a, b in zip(x, y)] + [(None, 1.0), (float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    expected = brute_isotonic(x, y)
    for size in (10**6, 60, 7):  # one range, a few, and more than tasks see scores
        curve = isotonic.isotonic_curve(df, "x", "y", size)
        assert (np.diff(curve.y) >= 0).all() and (np.diff(curve.x) > 0).all()
        found = df.filter("not isnan(x)").select("x", curve.values_at(F.col("x"), spark).alias("p")).collect()
        for r in found:
            assert r.x is None and r.p is None or abs(r.p - expected[r.x]) < 1e-9
    with pytest.raises(AnalysisError):
        isotonic.isotonic_curve(df.limit(0), "x", "y")


def test_registry_goes_on_where_it_was(spark, people, tmp_path, monkeypatch):
    table, schema = experiments.prepare(people, SPEC, 3)
    tried = [BoostingParams(max_iter=2, max_depth=1), BoostingParams(max_iter=3)]
    fits = []
    real = boosting.fit_tree

    def counted(part, params):
        if len(fits) == 4:
            raise KeyboardInterrupt
        fits.append(params)
        return real(part, params)

    registry = experiments.FitRegistry(str(tmp_path / "fits"))
    monkeypatch.setattr(boosting, "PARALLEL_FITS", 1)
    monkeypatch.setattr(boosting, "fit_tree", counted)
    with pytest.raises(KeyboardInterrupt):
        [registry.fit(table.where(F.col("fold") != k), p, f"fold-3-without-{k}") for p in tried for k in range(3)]
    assert len(fits) == 4
    monkeypatch.setattr(boosting, "fit_tree", lambda part, params: fits.append(params) or real(part, params))
    found = experiments.search(table, schema, tried, tried[0], 3, registry.fit)
    assert len(fits) == 4 + 2 + 1  # two folds were left, and the best one on all rows
    assert found.ranking.count() == 2 and found.comparison.first().folds == 3
    again = experiments.search(table, schema, tried, tried[0], 3, registry.fit)
    assert len(fits) == 7 and again.ranking.collect() == found.ranking.collect()
    other = boosting.fit_table(people.limit(500).withColumn("fold", F.lit(0)), schema, "rich", "id", ("fold",))
    assert registry.path(other, tried[0], "all") != registry.path(table, tried[0], "all")


def test_readers_see_whole_versions_only(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "bundle")

    def parts(n):
        return {name: (spark.createDataFrame([(n, name)], "n int, name string").coalesce(1), fmt) for name, fmt in (("a", "parquet"), ("b", "json"), ("c", "parquet"))}

    with pytest.raises(AnalysisError, match="no data"):
        bundles.current(spark, folder)
    bundles.publish(parts(1), folder)
    real = bundles.checksum
    for stop in range(3):  # the writer is lost after each part
        calls = []

        def lost(df):
            calls.append(1)
            if len(calls) > stop:
                raise RuntimeError("lost")
            return real(df)

        monkeypatch.setattr(bundles, "checksum", lost)
        with pytest.raises(RuntimeError):
            bundles.publish(parts(2), folder)
        monkeypatch.setattr(bundles, "checksum", real)
        seen = bundles.current(spark, folder)
        assert [seen.read(p).first().n for p in "abc"] == [1, 1, 1]
    second = bundles.publish(parts(3), folder)
    assert bundles.current(spark, folder).read("b", ["n"]).first().n == 3
    # a damaged part sends readers to the version before
    spark.createDataFrame([(9, "b")], "n int, name string").write.mode("overwrite").parquet(f"{folder}/versions/{second}/a")
    seen = bundles.current(spark, folder)
    assert [seen.read(p).first().n for p in "abc"] == [1, 1, 1]
    with pytest.raises(AnalysisError, match="no part"):
        seen.read("d")


def test_gathered_sums_keep_their_shape(monkeypatch):
    import pyspark

    class Context:
        @staticmethod
        def get():
            return Context()

        def allGather(self, message):  # noqa: N802
            return [message, message]

    monkeypatch.setattr(pyspark, "BarrierTaskContext", Context)
    assert trees.all_gathered(np.ones((3, 4))).tolist() == np.full((3, 4), 2.0).tolist()
