"""The driver contract: every oracle key is a registered query and every
oracle SQL text binds in DuckDB against the given tables."""

import os

import duckdb

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def test_oracle_keys_are_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 50


def test_oracle_sql_binds():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    for name, sql in E.oracle_sql().items():
        con.execute("EXPLAIN " + sql)
