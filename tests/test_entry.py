"""Driver contract: entry() on sf0.001, and every query against its SQL
oracle (DuckDB) on sf0.001."""

import re

import duckdb
import pytest

from tests.conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
ROWS_ONLY = {"pipeline"}  # and training-data operators that have no SQL form


def test_entry(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["order_id"]
    assert df.count() > 0


def test_registry_has_oracles():
    from __spark_entry__ import oracle_sql, queries
    assert {n for n in set(queries()) - set(oracle_sql()) if not re.match(r"op\d+_", n)} <= ROWS_ONLY
    assert len(queries()) >= 70


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


def _norm(v):
    import datetime as dt
    import decimal
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return v


def _sorted(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


def test_all_queries_match_oracle(spark, duck):
    from __spark_entry__ import oracle_sql, queries
    sql = oracle_sql()
    bad = []
    for name, fn in queries().items():
        df = fn(spark, SF001)
        got = [tuple(r) for r in df.collect()]
        if name not in sql:
            continue
        res = duck.execute(sql[name])
        cols = [d[0] for d in res.description]
        want = res.fetchall()
        if sorted(cols) != sorted(df.columns) or _sorted(df.columns, got) != _sorted(cols, want):
            bad.append(name)
    assert bad == []
