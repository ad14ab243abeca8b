import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortwise.operators import balance, matching
from cohortwise.plans.matching import propensity_matching
from cohortwise.spec import AnalysisError, CohortSpec

SPEC = CohortSpec(
    variables={"age": "continuous", "race": "categorical", "degree": "binary"}, target="rich", key="id"
)


def one_after_another(wanting, offered, radius):
    """The definition: hardest first, each takes the nearest reference that is left."""
    hardness = {x: np.min(np.abs(offered - x)) for x in set(wanting)}
    left, flows = sorted(offered.tolist()), collections.Counter()
    for x in sorted(wanting, key=lambda v: (-hardness[v], v)):
        if left:
            best = min(left, key=lambda c: (abs(c - x), c))
            if abs(best - x) <= radius:
                left.remove(best)
                flows[x, best] += 1
    return dict(flows)


CASES = {
    "ties": lambda rng: (rng.integers(0, 40, 200) / 8, rng.integers(0, 40, 150) / 8, 0.5, 25),
    "spread": lambda rng: (rng.normal(0.5, 1, 120), rng.normal(0, 1, 200), 0.3, 40),
    "one hot score": lambda rng: (
        np.concatenate([np.full(90, 1.0), rng.normal(1, 0.5, 60)]), rng.normal(1, 1, 110), 0.8, 10**6
    ),
    "scarce": lambda rng: (rng.integers(0, 400, 120) / 64, rng.integers(100, 300, 40) / 64, 0.4, 30),
}


@pytest.mark.parametrize("case", CASES)
def test_matching_equals_the_sequential_definition(spark, case):
    wanting, offered, radius, per_block = CASES[case](np.random.default_rng(7))
    rows = [(float(x), 1) for x in wanting] + [(float(x), 0) for x in offered]
    cells = matching.score_cells(spark.createDataFrame(rows, "x double, code int"), "code", "x").persist()
    expected = one_after_another(wanting, offered, radius)
    flows = matching.match_cells(cells, radius, per_block).groupBy("x", "reference").agg(F.sum("units").alias("u"))
    assert {(r.x, r.reference): r.u for r in flows.collect()} == expected


def test_successors_skip_full_references():
    rng = np.random.default_rng(3)
    scores = np.sort(rng.choice(1000, 300, replace=False)) / 8.0
    capacity = rng.integers(0, 4, 300)
    room, left = matching._Room(scores, capacity), capacity.tolist()
    for _ in range(2000):
        at = rng.integers(0, 1000) / 8.0
        below = [j for j in range(300) if scores[j] <= at and left[j]]
        above = [j for j in range(300) if scores[j] >= at and left[j]]
        assert room.last_below(at) == (below[-1] if below else None)
        assert room.first_above(at) == (above[0] if above else None)
        if above:
            wanted = int(rng.integers(1, 4))
            assert room.take(above[0], wanted) == min(wanted, left[above[0]])
            left[above[0]] -= min(wanted, left[above[0]])


@pytest.mark.parametrize("count,per_range", [(5, 10**6), (7, 7), (3, 20), (500, 10)])
def test_nearest_references_over_ranges(spark, count, per_range):
    rng = np.random.default_rng(9)
    rows = [(f"k{i}", int(rng.random() < 0.3), float(rng.integers(0, 30)) / 4) for i in range(160)]
    rows += [("low", 1, -50.0), ("high", 1, 90.0)]
    df = spark.createDataFrame(rows, "id string, code int, x double")
    found = matching.nearest_references(df, "code", "x", "id", count, per_range).collect()
    import hashlib

    offered = sorted((x, hashlib.md5(k.encode()).hexdigest(), k) for k, c, x in rows if not c)
    expected = {}
    for x in {x for _, c, x in rows if c}:
        below = sum(o[0] < x for o in offered)
        order = sorted(range(len(offered)), key=lambda p: (abs(offered[p][0] - x), offered[p][0] >= x, abs(p - below)))
        for rank, p in enumerate(order[:count], 1):
            expected[x, rank] = (offered[p][2], abs(offered[p][0] - x))
    assert {(r.x, r["rank"]): (r.reference_id, r.distance) for r in found} == expected and len(found) == len(expected)
    assert matching.nearest_references(df.filter("code = 1"), "code", "x", "id", count, per_range).count() == 0
    assert matching.nearest_references(df.filter("code = 0"), "code", "x", "id", count, per_range).count() == 0


def test_blocks_follow_the_cores():
    assert -(-20_000 // matching.cells_per_block(20_000, 8)) == 16
    assert matching.cells_per_block(100, 8) == matching.LEAST_CELLS
    assert matching.cells_per_block(10**9, 8) == matching.BLOCK_CELLS


@pytest.mark.parametrize("seed", range(4))
def test_crowded_blocks(spark, seed):
    """Many choosers per reference and blocks of a few cells, so that proposals move back and forth."""
    rng = np.random.default_rng(seed)
    wanting, offered = rng.integers(0, 60, 150) / 16, rng.integers(0, 60, 70) / 16
    rows = [(float(x), 1) for x in wanting] + [(float(x), 0) for x in offered]
    cells = matching.score_cells(spark.createDataFrame(rows, "x double, code int"), "code", "x").persist()
    for per_block in (3, 11):
        flows = matching.match_cells(cells, 1.0, per_block).groupBy("x", "reference").agg(F.sum("units").alias("u"))
        assert {(r.x, r.reference): r.u for r in flows.collect()} == one_after_another(wanting, offered, 1.0)


def test_pairs_use_each_row_once(spark):
    rng = np.random.default_rng(2)
    rows = [(f"k{i}", int(rng.random() < 0.4), float(rng.integers(0, 12)) / 4) for i in range(300)]
    df = spark.createDataFrame(rows, "id string, code int, x double").persist()
    pairs = matching.match_rows(df, "code", "x", "id", 0.5, per_block=5).collect()
    assert len({p.comparison.id for p in pairs}) == len({p.reference.id for p in pairs}) == len(pairs)
    assert all(p.comparison.code == 1 and p.reference.code == 0 for p in pairs)
    assert all(p.distance == abs(p.comparison.x - p.reference.x) <= 0.5 for p in pairs)
    expected = one_after_another(
        np.array([x for _, c, x in rows if c]), np.array([x for _, c, x in rows if not c]), 0.5
    )
    assert len(pairs) == sum(expected.values())


def test_large_flows_are_unrolled_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(matching, "UNIT_CHUNK", 10)
    flows = spark.createDataFrame([(0.0, 0.0, 37), (0.0, 1.0, 5), (1.0, 1.0, 4)], "x double, reference double, units bigint")
    units = matching.allot_units(flows.withColumn("distance", F.lit(0.0))).collect()
    assert sorted(u.x_place for u in units if u.x == 0.0) == list(range(42))
    assert sorted(u.reference_place for u in units if u.reference == 1.0) == list(range(9))


def test_full_matching_improves_balance(spark):
    rng = np.random.default_rng(42)
    rows = []
    for i in range(400):
        age = int(rng.integers(20, 60))
        degree = int(rng.random() < 1 / (1 + np.exp(-(age - 42) / 8)))
        rows.append((str(i), float(age), str(rng.choice(["W", "B", "A"])), "yes" if degree else "no",
                     int(rng.random() < 0.2 + 0.3 * degree)))
    df = spark.createDataFrame(rows, "id string, age double, race string, degree string, rich int")
    df = df.withColumn("age", F.when(F.col("id").cast("int") % 40 != 0, F.col("age")))
    found = propensity_matching(df, "degree", ["age", "race"], "rich", SPEC, "id")
    report = found.report.first()
    assert found.matched.count() == 2 * report.matched_pairs > 0
    table = {r.covariate: r for r in found.balance.collect()}
    assert "age__missing" in table and table["age"].smd_after <= table["age"].smd_before
    assert found.matched.agg(F.max("match_distance")).first()[0] <= report.caliper
    inside = found.matched.agg(F.min("propensity_score"), F.max("propensity_score")).first()
    assert inside[0] >= report.common_support_lower and inside[1] <= report.common_support_upper
    assert 0 <= found.mcnemar.first().mcnemar_p_value <= 1
    assert (found.reference_level, found.comparison_level) == ("no", "yes")


@pytest.mark.parametrize(
    "exposure,controls", [("degree", []), ("degree", ["age", "age"]), ("degree", ["degree"]), ("degree", ["rich"])]
)
def test_bad_matching_requests(spark, exposure, controls):
    df = spark.createDataFrame([("1", 1.0, "W", "yes", 1)], "id string, age double, race string, degree string, rich int")
    with pytest.raises(AnalysisError):
        propensity_matching(df, exposure, controls, "rich", SPEC, "id")


def test_disjoint_scores_have_no_support(spark):
    from cohortwise.operators import propensity

    with pytest.raises(AnalysisError):
        propensity.on_support(spark.range(1), 0.6, 0.4)


def test_smd_of_constant_columns(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0), (1, 1.0, 1.0), (0, 1.0, 2.0), (0, 1.0, 2.0)], "code int, a double, b double")
    columns = {"a": F.col("a"), "b": F.col("b")}
    found = {r.covariate: r.smd for r in balance.absolute_smd(df, "code", columns, "smd").collect()}
    assert found == {"a": 0.0, "b": float("inf")}
    table = spark.createDataFrame([("a", 0.3, 0.05), ("b", 0.05, float("inf"))], "covariate string, smd_before double, smd_after double")
    verdict = balance.balance_verdict(table).first()
    assert verdict.max_smd_after is None and not verdict.balanced_under_threshold
    assert (verdict.imbalanced_covariates_before, verdict.imbalanced_covariates_after) == (1, 1)


def test_balance_of_a_column_with_many_levels(spark):
    spec = CohortSpec(variables={"x": "continuous", "k": "categorical"}, target="y")
    rows = [(i % 2, float(i % 5), f"level{i // 2}") for i in range(24_004)] + [(1, None, None)]
    df = spark.createDataFrame(rows, "code int, x double, k string")
    found = balance.balance_table(df, df.filter("code = 0 or x < 3"), "code", ["x", "k"], spec)
    values = {r.covariate: (r.smd_before, r.smd_after) for r in found.collect()}
    assert len(values) == 12_002 + 1 + 2  # levels, the missing one, x and its gaps
    n0, n1 = 12_002, 12_003
    p0, p1 = 1 / n0, 1 / n1
    v0, v1 = (1 - 1 / n0) / (n0 - 1), (1 - 1 / n1) / (n1 - 1)
    assert values["k_level7"][0] == pytest.approx(abs(p1 - p0) / ((v0 + v1) / 2) ** 0.5)


def test_unrolled_units_are_never_broadcast(spark):
    """Their number shows in no estimate, so both joins that place them merge sorted sides."""
    rows = spark.range(60).selectExpr("cast(id as string) AS key", "cast(id % 5 as double) AS x", "cast(id % 2 as int) AS code")
    pairs = matching.match_rows(rows, "code", "x", "key", 4.0)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    placed = [line for line in plan.splitlines() if "Join [" in line and "_place" in line]
    assert len(placed) == 2 and all("SortMergeJoin" in line for line in placed), plan
    assert pairs.count() == 30


def test_matched_pairs_are_stored_once(spark, tmp_path):
    """A pair is written as one record of columns; nothing of the matched table is checkpointed as plain rows."""
    from cohortwise import session

    rows = spark.createDataFrame([(f"k{i}", i % 2, float(i)) for i in range(50)], "`row key` string, code int, score double")
    pairs = matching.match_rows(rows, "code", "score", "row key", 1.0)
    kept = session.stored(pairs)
    assert kept.dtypes == pairs.dtypes and sorted(map(str, kept.collect())) == sorted(map(str, pairs.collect()))
    assert matching.matched_table(kept, "row key").count() == 2 * kept.count() == 50
    assert kept.inputFiles() and "Scan parquet" in kept._jdf.queryExecution().toString()


def test_places_by_digests_in_bytes_are_those_in_text(spark):
    rows = spark.createDataFrame([(None if i == 7 else f"k{i}", i % 3) for i in range(400)], "id string, g int")
    from cohortwise.operators.ordering import hash_order_positions

    text = hash_order_positions(rows.withColumn("h", F.md5("id")), "h", "place", ["g"], 2)
    plain = hash_order_positions(rows.withColumn("h", F.unhex(F.md5("id"))), "h", "place", ["g"], 1)
    names = ("id", "g", "place")
    assert sorted(map(str, text.select(*names).collect())) == sorted(map(str, plain.select(*names).collect()))
