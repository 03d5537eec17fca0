import __spark_entry__ as entry


def test_registry_consistent():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 70
    for name, fn in qs.items():
        assert fn.__doc__, name


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "zone_price_mean" in df.columns
