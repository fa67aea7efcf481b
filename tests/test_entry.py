import __spark_entry__ as spark_entry


def test_every_query_has_an_oracle():
    assert set(spark_entry._QUERIES) <= set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry_runs(spark):
    result = spark_entry.entry(spark)
    assert "bed_name" in result.columns and result.count() > 0
