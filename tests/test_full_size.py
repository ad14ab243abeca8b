"""The registered model queries run with the default parameters, not with cut ones."""

import inspect

import pytest

from cohortwise.catalogue import prediction
from cohortwise.operators import explain
from cohortwise.operators.boosting import BoostingParams, FitTable
from cohortwise.operators.trees import FeatureBins
from cohortwise.plans import experiments


class Stop(Exception):
    pass


@pytest.fixture
def calls(spark, monkeypatch):
    """What the queries pass on, defaults included; nothing is fitted."""
    found = {}
    rows = spark.createDataFrame([(i, i % 5) for i in range(10)], "row_id int, fold int")
    table = FitTable(rows, FeatureBins((), {}, {}, {}), 1, "")

    def record(module, name, answer=None):
        signature = inspect.signature(getattr(module, name))

        def stub(*args, **named):
            bound = signature.bind(*args, **named)
            bound.apply_defaults()
            found[name] = bound.arguments
            if answer is None:
                raise Stop
            return answer

        monkeypatch.setattr(module, name, stub)

    monkeypatch.setattr(prediction, "_labelled", lambda spark, folder: rows)
    record(experiments, "prepare", (table, {}))
    for module, name in (
        (prediction.training, "evaluate"), (prediction.boosting, "fit_tree"), (experiments, "fold_scores"),
        (experiments, "search"), (experiments, "random_search"), (experiments, "out_of_fold"),
    ):
        record(module, name)
    prediction.forget()
    yield found
    prediction.forget()


def run(spark, name):
    with pytest.raises(Stop):
        prediction.QUERIES[name](spark, "nowhere")


def test_tree_model_learns_from_four_fifths(spark, calls):
    run(spark, "p5_boosted_trees")
    assert calls["fit_tree"]["params"] == BoostingParams()
    assert {r.fold for r in calls["fit_tree"]["table"].rows.collect()} == {1, 2, 3, 4}


@pytest.mark.parametrize("name", ["p6_calibrated_model", "p8_predictions", "p11_model_importance", "p12_model_card", "s7_bundle_round_trip"])
def test_trained_model_has_all_rounds_and_repeats(spark, calls, name):
    run(spark, name)
    assert calls["evaluate"]["params"] == BoostingParams()
    assert calls["evaluate"]["importance_repeats"] == explain.REPEATS == prediction.REPEATS


def test_experiments_have_all_rounds_and_folds(spark, calls):
    run(spark, "x1_cross_validation")
    assert calls["fold_scores"]["params"] == BoostingParams() and calls["fold_scores"]["folds"] == 5
    run(spark, "x4_out_of_fold")
    assert calls["out_of_fold"]["params"] == BoostingParams()
    assert (calls["out_of_fold"]["folds"], calls["out_of_fold"]["inner"]) == (5, 3)
    assert calls["prepare"]["folds"] == 5


@pytest.mark.parametrize("name", ["x2_random_search", "x2_best_folds", "x2_comparison", "x2_stored_search"])
def test_search_tries_all_candidates_in_the_whole_space(spark, calls, name):
    run(spark, name)
    assert calls["search"]["candidates"] == experiments.sample_parameters(40)
    assert calls["search"]["folds"] == 5 and calls["search"]["current"] == BoostingParams()
