def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    schema = df.schema.simpleString()
    assert df.count() >= 0
    assert entry(spark).schema.simpleString() == schema
    assert "ews_pct" in df.columns and "risk_band" in df.columns


def test_every_sql_key_is_a_query():
    from __spark_entry__ import oracle_sql, queries
    assert set(oracle_sql()) <= set(queries())
