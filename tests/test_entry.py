import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["word", "n"] and 0 < len(rows) <= 15


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_oracle_sql_runs_on_duckdb():
    import duckdb
    from tessera.plans.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    for name, sql in E.oracle_sql().items():
        con.execute(sql).fetchall()
