import __spark_entry__ as entry


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_query_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["level", "n", "target_rate"] and df.count() == 5
