import __spark_entry__ as E


def test_entry_flagship(spark):
    df = E.entry(spark)
    assert len(df.columns) == 22
    assert df.count() == 182


def test_every_query_has_a_builder_and_named_oracle_columns():
    qs, os_ = E.queries(), E.oracle_sql()
    assert set(os_) <= set(qs)
    assert len(qs) >= 50
