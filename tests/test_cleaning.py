import pytest
from pyspark.sql import functions as F

from cohortwise.operators import cleaning
from cohortwise.sources import artefacts
from cohortwise.spec import AnalysisError, AnalysisRequest, CohortSpec, census_spec

SPEC = census_spec()
ROWS = [
    ("39", "Private", "77516", "Bachelors", "13", "Never-married", "Adm-clerical", "Not-in-family",
     "White", "Male", "2174", "0", "40", "United-States", " <=50K."),
    ("45", " ? ", "83311", "HS-grad", "9", "Married-civ-spouse", "Exec-managerial", "Husband",
     "White", "Male", "0", "0", "13", "United-States", ">50K"),
    ("130", "Private", "83311", "HS-grad", "9", "Divorced", "Sales", "Husband",
     "White", "Female", "0", "0", "13", "United-States", ">50K"),
    ("28", "Private", "1d", "HS-grad", "9", "Divorced", "Sales", "Husband",
     "White", "Female", "NaN", "0", "13", "", "who knows"),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in SPEC.raw_columns))


def test_clean_keeps_missing_drops_duplicates_and_invalid(spark):
    rows, audit = cleaning.clean_with_audit(frame(spark, ROWS + ROWS[:2]), SPEC)
    assert audit == {
        "initial_rows": 6, "rows_with_missing": 3, "duplicate_removed": 2, "invalid_removed": 2,
        "rows_after_cleaning": 2, "columns_after_cleaning": 16,
    }
    found = {r.age: r for r in rows.collect()}
    assert found[39.0].high_income == 0 and found[39.0].income == "<=50K"
    assert found[45.0].high_income == 1 and found[45.0].workclass is None


def test_numbers_that_only_java_would_parse_are_missing(spark):
    texts = ["1d", "0x1p3", " 12 ", "1e3", ".5", "5.", "-inf", "NaN", "twelve", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    found = [r.v for r in cleaning.coerce_numeric(df, ["v"]).collect()]
    assert found == [None, None, 12.0, 1000.0, 0.5, 5.0, float("-inf"), None, None, None]


def test_empty_input_is_an_error(spark):
    with pytest.raises(AnalysisError):
        cleaning.clean_with_audit(frame(spark, []), SPEC)


def test_csv_with_and_without_header_and_column_contract(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text(", ".join(SPEC.raw_columns) + "\n" + "\n".join(", ".join(r) for r in ROWS) + "\n")
    assert cleaning.clean(artefacts.read_raw_csv(spark, str(good), SPEC), SPEC).count() == 2
    bare = tmp_path / "bare.csv"
    bare.write_text("\n".join(", ".join(r) for r in ROWS) + "\n")
    assert artefacts.read_raw_csv(spark, str(bare), SPEC, header=False).count() == 4
    profiled = artefacts.load_before_cleaning(spark, str(good), SPEC)
    assert profiled.count() == 4 and "high_income" in profiled.columns
    bad = tmp_path / "bad.csv"
    for header in (SPEC.raw_columns[1:], (*SPEC.raw_columns, "extra"), ("age", *SPEC.raw_columns)):
        bad.write_text(",".join(header) + "\n")
        with pytest.raises(AnalysisError):
            artefacts.read_raw_csv(spark, str(bad), SPEC)
    with pytest.raises(AnalysisError, match="no data"):
        artefacts.read_raw_csv(spark, str(tmp_path / "absent.csv"), SPEC)


def test_complete_cases_keep_column_order_once(spark):
    df = spark.createDataFrame([(1.0, "a", 1), (None, "b", 0), (float("nan"), "c", 1)], "x double, g string, y int")
    found = cleaning.complete_cases(df, ["y", "x", "y"])
    assert found.columns == ["y", "x"] and found.count() == 1
    with pytest.raises(AnalysisError):
        cleaning.complete_cases(df, ["nope"])


def test_outcome_validation(spark):
    good = spark.createDataFrame([(0,), (1,), (None,)], "y int")
    assert cleaning.validate_binary_outcome(good, "y") == 2
    for values in ([(1,)], [(0,), (1,), (2,)]):
        with pytest.raises(AnalysisError):
            cleaning.validate_binary_outcome(spark.createDataFrame(values, "y int"), "y")


@pytest.mark.parametrize(
    "request_",
    [
        AnalysisRequest("fnlwgt"),
        AnalysisRequest("age", ("fnlwgt",)),
        AnalysisRequest("age", ("age",)),
        AnalysisRequest("age", ("sex", "sex")),
        AnalysisRequest("age", ("sex",), include_psm=True),
        AnalysisRequest("sex", (), include_psm=True),
    ],
)
def test_bad_requests(spark, request_):
    rows = cleaning.derive_target(frame(spark), SPEC)
    with pytest.raises(AnalysisError):
        cleaning.validate_request(rows, request_, SPEC)


def test_training_rows_need_enough_of_both_classes(spark):
    from dataclasses import replace

    spec = replace(SPEC, features=())
    for zeros, ones, fine in ((12, 12, True), (12, 3, False), (12, 0, False)):
        df = spark.createDataFrame([(0,)] * zeros + [(1,)] * ones + [(None,)], "high_income int")
        if fine:
            assert cleaning.select_training_rows(df, spec).count() == zeros + ones
        else:
            with pytest.raises(AnalysisError):
                cleaning.select_training_rows(df, spec)


def test_feature_coercion_strict_and_lenient(spark):
    schema = {"x": {"kind": "continuous"}, "g": {"kind": "categorical", "levels": ["a", "b"]}}
    df = spark.createDataFrame([("1", "a"), ("2", "z")], "x string, g string")
    with pytest.raises(AnalysisError, match="g='z'"):
        cleaning.coerce_features(df, schema, ["x", "g"])
    rows = cleaning.coerce_features(df, schema, ["x", "g"], allow_unknown=True).collect()
    assert [tuple(r) for r in rows] == [(1.0, "a"), (2.0, None)]
    with pytest.raises(AnalysisError, match="x='bad'"):
        cleaning.coerce_features(spark.createDataFrame([("bad", "a")], "x string, g string"), schema, ["x", "g"], True)
    with pytest.raises(AnalysisError):
        cleaning.prepare_prediction_rows(df.filter("false"), schema, ["x", "g"])


def test_prediction_table_checks(spark):
    ok = [(0, 0, 0.1), (1, 1, 0.9)]
    cleaning.validate_prediction_table(spark.createDataFrame(ok, "y_test int, y_pred int, y_proba double"))
    for bad in ([(0, 0, 0.1)], [*ok, (2, 0, 0.5)], [*ok, (1, 3, 0.5)], [*ok, (1, 1, 1.5)], [*ok, (1, 1, float("nan"))]):
        with pytest.raises(AnalysisError):
            cleaning.validate_prediction_table(
                spark.createDataFrame(bad, "y_test int, y_pred int, y_proba double")
            )


def test_serialisable_numbers(spark):
    df = spark.createDataFrame([(float("inf"),), (float("nan"),), (1.5,)], "v double")
    assert [r.v for r in artefacts.serialisable(df).collect()] == [None, None, 1.5]


def test_stored_out_of_fold_must_be_finite(spark, tmp_path):
    path = str(tmp_path / "oof")
    df = spark.createDataFrame([("a", 0, 0.1, 0.1, 0.1), ("b", 1, 0.9, float("nan"), 0.9)],
                               ", ".join(f"{c} {t}" for c, t in zip(artefacts.OOF_COLUMNS, ["string", "int", *["double"] * 3])))
    artefacts.write_out_of_fold(df, path)
    with pytest.raises(AnalysisError, match="not finite"):
        artefacts.read_out_of_fold(spark, path)
    assert artefacts.read_out_of_fold(spark, path, "isotonic_probability").agg(F.count("*")).first()[0] == 2


def test_csv_contract_of_part_files(spark, tmp_path):

    spec = CohortSpec(variables={"x": "continuous"}, target="t", raw_columns=("x", "y"), numeric_columns=("x",))
    (tmp_path / "quoted").mkdir()
    (tmp_path / "quoted" / "a.csv").write_text('"x","y"\n1,"p, q"\nNA,r\n')
    (tmp_path / "quoted" / "b.csv").write_text("x, y\n2,?\n")
    rows = {(r.x, r.y) for r in artefacts.read_raw_csv(spark, str(tmp_path / "quoted"), spec).collect()}
    assert rows == {("1", "p, q"), (None, "r"), ("2", "?")}
    (tmp_path / "mixed").mkdir()
    (tmp_path / "mixed" / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "mixed" / "b.csv").write_text("y,x\n20,10\n")
    with pytest.raises(Exception, match="(?i)header|schema|column"):
        artefacts.read_raw_csv(spark, str(tmp_path / "mixed"), spec).collect()
    (tmp_path / "none.csv").write_text("")
    with pytest.raises(AnalysisError):
        artefacts.read_raw_csv(spark, str(tmp_path / "none.csv"), spec)
    (tmp_path / "head.csv").write_text("x,y\n")
    with pytest.raises(AnalysisError):
        artefacts.load_and_clean(spark, str(tmp_path / "head.csv"), spec)
