"""Skew-safe lag equals a plain window; changes and current rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vaultline.operators.ordered import changes, current_rows, ordered_lag, union_all_by_name, with_slice_groups
from tests.conftest import SF01, rows


@pytest.mark.parametrize("slices", [2, 7, 256])
def test_lag_equals_window_with_hot_and_null_keys(spark, slices):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    # 40% of rows on one key, 20% on a NULL key
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 5 < 2, F.lit(7))
                       .when(F.col("event_id") % 5 == 2, F.lit(None)).otherwise(F.col("user_id")))
    got = ordered_lag(ev, "user_id", ["ts", "event_id"], ["event_type", "ts"], slices=slices)
    want = ordered_lag(ev, "user_id", ["ts", "event_id"], ["event_type", "ts"], skew_safe=False)
    cols = ["event_id", "prev_event_type", "prev_ts"]
    assert rows(got, *cols) == rows(want, *cols)


def test_lag_with_ties_in_few_rows(spark):
    t = dt.datetime(2024, 1, 1)
    data = [(1, t, 1, "a"), (1, t, 2, "b"), (1, t + dt.timedelta(days=9), 3, "c"), (2, t, 4, "x")]
    df = spark.createDataFrame(data, "k int, ts timestamp_ntz, id int, v string")
    got = ordered_lag(df, "k", ["ts", "id"], ["v"], slices=3)
    assert rows(got, "id", "prev_v") == [(1, None), (2, "a"), (3, "b"), (4, None)]


def test_changes_keep_a_b_a(spark):
    t = dt.datetime(2024, 1, 1)
    data = [(1, t + dt.timedelta(hours=h), v) for h, v in enumerate(["A", "A", "B", "B", "A"])]
    df = spark.createDataFrame(data, "k int, ts timestamp_ntz, h string")
    got = changes(df, "k", "h", ["ts"])
    assert [r["h"] for r in got.orderBy("ts").collect()] == ["A", "B", "A"]


def test_current_rows_full_tie_break(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t, 1, "old"), (1, t, 2, "new"), (2, t, 3, "only")],
                               "k int, ts timestamp_ntz, id int, v string")
    assert rows(current_rows(df, "k", ["ts", "id"]), "k", "v") == [(1, "new"), (2, "only")]


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([(2,)], "a int")
    assert rows(union_all_by_name([a, b])) == [(1, "x"), (2, None)]


def test_hot_key_is_spread_over_many_groups(spark):
    """A key with 40% of all rows must not form one window group: the
    largest (key, slice) group stays a small fraction of the hot key."""
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    ev = ev.withColumn("user_id", F.when(F.col("event_id") % 5 < 2, F.lit(7)).otherwise(F.col("user_id")))
    hot = ev.filter(F.col("user_id") == 7).count()
    g = with_slice_groups(ev, ["user_id"], ["ts", "event_id"], 256)
    sizes = g.filter(F.col("user_id") == 7).groupBy("_grp").count()
    assert sizes.count() > 100
    assert sizes.agg(F.max("count")).first()[0] < hot / 50


@pytest.mark.parametrize("slices", [3, 1024])
def test_lag_with_null_order_values(spark, slices):
    t = dt.datetime(2024, 1, 1)
    data = [(1, None, 1), (1, t, 2), (1, None, 3), (1, t + dt.timedelta(days=5), 4), (2, None, 5),
            (2, t + dt.timedelta(days=9), 6)]
    df = spark.createDataFrame(data, "k int, ts timestamp_ntz, id int")
    got = ordered_lag(df, "k", ["ts", "id"], ["id"], slices=slices)
    want = ordered_lag(df, "k", ["ts", "id"], ["id"], skew_safe=False)
    assert rows(got, "id", "prev_id") == rows(want, "id", "prev_id")
    assert rows(got, "id", "prev_id") == [(1, None), (2, 3), (3, 1), (4, 2), (5, None), (6, 5)]


def test_double_order_with_nan(spark):
    df = spark.createDataFrame([(1, float("nan"), 1), (1, 1.0, 2), (1, float("inf"), 3), (1, -1.0, 4)],
                               "k int, x double, id int")
    got = ordered_lag(df, "k", ["x", "id"], ["id"], slices=8)
    want = ordered_lag(df, "k", ["x", "id"], ["id"], skew_safe=False)
    assert rows(got, "id", "prev_id") == rows(want, "id", "prev_id")


def test_tie_across_a_slice_edge(spark):
    """B and C tie, then B: whichever comes last in the tie is what B is compared
    with, the same in the window and in the stitched form."""
    t = dt.datetime(2024, 1, 1)
    data = [(1, t, "B"), (1, t, "C"), (1, t + dt.timedelta(days=1), "B"), (2, t, "B"), (2, t, "C"), (2, t + dt.timedelta(days=1), "C")]
    df = spark.createDataFrame(data, "k int, ts timestamp_ntz, v string")
    for slices in (2, 3, 6):
        got = ordered_lag(df, "k", ["ts"], ["v"], slices=slices)
        want = ordered_lag(df, "k", ["ts"], ["v"], skew_safe=False)
        assert rows(got) == rows(want)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string", "double"])
def test_outliers_and_bursts_stay_split(spark, kind):
    """A 9999 row and a 40 % burst of one key at one time: no group holds more
    than a small part of the hot key, for every order type."""
    ev = spark.read.parquet(f"{SF01}/events.parquet").select("event_id", "user_id", "ts", "event_type")
    burst = F.col("event_id") % 5 < 2
    ev = (ev.withColumn("user_id", F.when(burst, F.lit(7)).otherwise(F.col("user_id")))
          .withColumn("ts", F.when(burst, F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"))
                      .when(F.col("event_id") == 3, F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")).otherwise(F.col("ts"))))
    ev = ev.withColumn("ts", F.unix_micros(F.col("ts").cast("timestamp")).cast("double") if kind == "double" else F.col("ts").cast(kind))
    hot = ev.filter("user_id = 7").count()
    g = with_slice_groups(ev, ["user_id"], ["ts", "event_id"], 64)
    assert g.filter("user_id = 7").groupBy("_grp").count().agg(F.max("count")).first()[0] < hot / 8
    got = ordered_lag(ev, "user_id", ["ts"], ["event_id"], slices=64)
    want = ordered_lag(ev, "user_id", ["ts"], ["event_id"], skew_safe=False)
    assert rows(got, "event_id", "prev_event_id") == rows(want, "event_id", "prev_event_id")
