"""Driver contract: entry runs, every query has a callable, oracle keys are queries."""


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "sales_lag_7" in df.columns


def test_contract_keys():
    import __spark_entry__ as E
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60
