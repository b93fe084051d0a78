"""Join operators: NULL-aware NOT IN, lookups, orphans, after-max."""

import datetime as dt

from vaultline.operators import joins
from tests.conftest import rows


def test_not_in_null_semantics_match_sql(spark):
    df = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id int, v int")
    df.createOrReplaceTempView("nin_df")
    cases = {
        "plain": spark.createDataFrame([(10,)], "x int"),
        "with_null": spark.createDataFrame([(10,), (None,)], "x int"),
        "empty": spark.createDataFrame([], "x int"),
    }
    for name, lst in cases.items():
        lst.createOrReplaceTempView("nin_list")
        want = rows(spark.sql("SELECT id FROM nin_df WHERE v NOT IN (SELECT x FROM nin_list)"))
        got = rows(joins.anti_not_in(df, "v", lst, "x"), "id")
        assert got == want, name
    assert rows(joins.anti_not_in(df, "v", cases["empty"], "x"), "id") == [(1,), (2,), (3,)]
    assert rows(joins.anti_not_in(df, "v", cases["with_null"], "x"), "id") == []


def test_lookup_dedupes_deterministically(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    lk = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c")], "lk int, name string")
    got = rows(joins.join_lookup(df, lk, [("k", "lk")], ["name"]), "k", "name")
    assert got == [(1, "a"), (2, "c"), (3, None)]        # no fan-out, smallest wins, misses kept


def test_orphans_skip_null_keys(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None)], "id int, fk int")
    parent = spark.createDataFrame([(10,)], "pk int")
    assert rows(joins.orphans(child, "fk", parent, "pk"), "id") == [(2,)]


def test_after_max_empty_existing_loads_all(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t), (2, t + dt.timedelta(1))], "id int, ts timestamp_ntz")
    empty = spark.createDataFrame([], "ts timestamp_ntz")
    assert joins.after_max(df, "ts", empty).count() == 2
    assert rows(joins.after_max(df, "ts", df.filter("id = 1")), "id") == [(2,)]
    assert joins.after_max(df, "ts", None).count() == 2


def test_inner_and_entities(spark):
    a = spark.createDataFrame([(1, 10)], "id int, b_id int")
    b = spark.createDataFrame([(10, 100)], "bid int, c_id int")
    c = spark.createDataFrame([(100, "x")], "cid int, name string")
    out = joins.join_entities(a, [(b, [("b_id", "bid")]), (c, [("c_id", "cid")])])
    assert rows(out, "id", "name") == [(1, "x")]
    assert joins.join_inner(a, b, "b_id = bid").count() == 1
