import __spark_entry__ as E


def test_contract_shapes():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 80


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "last_purchase_value" in df.columns
