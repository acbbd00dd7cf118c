import __spark_entry__


def test_registry():
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 30


def test_flagship(spark, sf_dir):
    out = __spark_entry__.entry(spark)
    assert out.count() > 0 and "error_code" in out.columns


def test_against_sql(spark, sf_dir):
    """A few queries against their SQL in another engine; the driver compares them all."""
    import duckdb

    con = duckdb.connect()
    for t in ("lineitem", "orders", "part", "documents", "labels", "embeddings", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    for name in ("label_errors_by_code", "error_counts", "nms", "exact_dedup"):
        want = sorted(map(tuple, con.sql(__spark_entry__.oracle_sql()[name]).fetchall()), key=str)
        df = __spark_entry__.queries()[name](spark, sf_dir)
        cols = con.sql(__spark_entry__.oracle_sql()[name]).columns
        got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)
        assert got == want, name
