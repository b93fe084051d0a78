"""Watermark loads: filter, advance, never back, empty batch, full vs incremental."""

import datetime as dt

from vaultline.operators import incremental
from vaultline.session import scratch_path

T = dt.datetime(2024, 1, 1)


def frame(spark, days):
    return spark.createDataFrame([(i, T + dt.timedelta(days=d)) for i, d in enumerate(days)], "id int, ts timestamp_ntz")


def test_after_watermark_pushes_typed_literal(spark):
    df = frame(spark, [0, 1, 2])
    assert incremental.after_watermark(df, "ts", None).count() == 3
    assert incremental.after_watermark(df, "ts", "2024-01-02 00:00:00").count() == 1
    assert incremental.after_watermark(df, "ts", "2024-01-02 00:00:00", inclusive=True).count() == 2


def test_advance_never_moves_back_and_keeps_on_empty(spark):
    df = frame(spark, [0, 1])
    r = incremental.advance(df, "t", "ts", "2024-03-01 00:00:00").first()
    assert r["watermark"] == "2024-03-01 00:00:00" and r["loaded_rows"] == 2
    r = incremental.advance(df.limit(0), "t", "ts", "2024-01-05 00:00:00").first()
    assert r["watermark"] == "2024-01-05 00:00:00" and r["loaded_rows"] == 0
    r = incremental.advance(df, "t", "ts", None).first()
    assert r["watermark"] == "2024-01-02 00:00:00"


def test_incremental_load_twice(spark):
    target, state = scratch_path(spark, "t_inc"), scratch_path(spark, "t_state")
    src = frame(spark, [0, 1, 2])
    assert incremental.load(src, "incremental", target, state, "ts", "t", "b1").count() == 3
    assert incremental.load(src, "incremental", target, state, "ts", "t", "b2").count() == 0
    more = src.unionByName(frame(spark, [5]).selectExpr("10 AS id", "ts"))
    assert incremental.load(more, "incremental", target, state, "ts", "t", "b3").count() == 1
    assert spark.read.parquet(target).count() == 4
    assert str(incremental.read_watermark(spark, state, "t", src.schema["ts"].dataType)) == "2024-01-06 00:00:00"


def test_numeric_watermark_compares_as_number(spark):
    state = scratch_path(spark, "num_state")
    df = spark.createDataFrame([(9,), (10,)], "v int")
    incremental.advance_watermark(spark, state, "n", df.filter("v = 9"), "v")
    incremental.advance_watermark(spark, state, "n", df, "v")
    assert incremental.read_watermark(spark, state, "n", df.schema["v"].dataType) == 10


def test_full_load_overwrites(spark):
    target = scratch_path(spark, "t_full")
    incremental.load(frame(spark, [0, 1]), "full", target)
    incremental.load(frame(spark, [0]), "full", target)
    assert spark.read.parquet(target).count() == 1


def test_replay_without_state_row_does_not_duplicate(spark):
    """A crash after the data write but before the state row: the rerun
    starts from the same watermark and rewrites the same batch partition."""
    target = scratch_path(spark, "t_replay")
    src = frame(spark, [0, 1, 2])
    incremental.load(src, "incremental", target, scratch_path(spark, "st_a"), "ts", "t")
    incremental.load(src, "incremental", target, scratch_path(spark, "st_b"), "ts", "t")   # state lost
    back = spark.read.parquet(target)
    assert back.count() == 3
    assert [r[0] for r in back.select("load_batch").distinct().collect()] == ["initial"]


def test_late_rows_at_the_watermark_are_kept(spark):
    """Two rows share the stored maximum; one was loaded, one arrived later."""
    t = dt.datetime(2024, 1, 2)
    loaded = spark.createDataFrame([(1, t)], "id int, ts timestamp_ntz")
    source = spark.createDataFrame([(1, t), (2, t), (3, t + dt.timedelta(1)), (0, t - dt.timedelta(1))],
                                   "id int, ts timestamp_ntz")
    got = incremental.after_watermark_with_ties(source, "ts", "2024-01-02 00:00:00", loaded, "id")
    assert sorted(r["id"] for r in got.collect()) == [2, 3]
    assert sorted(r["id"] for r in incremental.after_watermark(source, "ts", "2024-01-02 00:00:00").collect()) == [3]


def ids(spark, target):
    return sorted(r[0] for r in spark.read.parquet(target).select("id").collect())


def test_rows_without_watermark_and_late_ties_arrive_once(spark):
    target, state = scratch_path(spark, "edge_t"), scratch_path(spark, "edge_s")
    day = lambda i, d: (i, None if d is None else T + dt.timedelta(days=d))

    def load(*rows):
        df = spark.createDataFrame(list(rows), "id int, ts timestamp_ntz")
        return incremental.load(df, "incremental", target, state, "ts", "t").count()
    first = [day(1, 0), day(2, 1), day(3, None)]
    assert load(*first) == 3 and ids(spark, target) == [1, 2, 3]
    late = [*first, day(4, 1), day(4, 1), day(5, None)]     # ties at the maximum, one row twice
    assert load(*late) == 3 and ids(spark, target) == [1, 2, 3, 4, 4, 5]
    assert load(*late) == 0
    assert load(*late, day(6, 1), day(7, 9)) == 2 and ids(spark, target) == [1, 2, 3, 4, 4, 5, 6, 7]
    assert load(day(8, 9)) == 1 and load(day(8, 9)) == 0 and ids(spark, target)[-1] == 8


def test_only_null_watermarks(spark):
    target, state = scratch_path(spark, "null_t"), scratch_path(spark, "null_s")
    df = spark.createDataFrame([(1, None)], "id int, ts timestamp_ntz")
    assert incremental.load(df, "incremental", target, state, "ts", "t").count() == 1
    assert incremental.load(df, "incremental", target, state, "ts", "t").count() == 0
    assert incremental.load(df.union(frame(spark, [3])), "incremental", target, state, "ts", "t").count() == 1
    assert spark.read.parquet(target).count() == 2


def test_full_then_incremental_then_lower_full(spark):
    target, state = scratch_path(spark, "fi_t"), scratch_path(spark, "fi_s")
    incremental.load(frame(spark, [0, 5]), "full", target, state, "ts", "t")
    more = frame(spark, [0, 5, 7])
    assert incremental.load(more, "incremental", target, state, "ts", "t").count() == 1
    assert ids(spark, target) == [0, 1, 2]
    incremental.load(frame(spark, [0, 1]), "full", target, state, "ts", "t")   # the watermark goes back with it
    assert ids(spark, target) == [0, 1]
    assert incremental.load(frame(spark, [0, 1, 2]), "incremental", target, state, "ts", "t").count() == 1


def test_unreadable_state_is_not_a_first_load(spark, tmp_path):
    import pytest
    bad = tmp_path / "state"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        incremental.read_watermark(spark, f"file://{bad}", "t")
    target = scratch_path(spark, "lost")
    incremental.load(frame(spark, [0]), "incremental", target, scratch_path(spark, "s1"), "ts", "t")
    state = scratch_path(spark, "s2")
    incremental.load(frame(spark, [0]), "incremental", target, state, "ts", "t")
    incremental.load(frame(spark, [0, 1]), "incremental", target, state, "ts", "t")
    with pytest.raises(ValueError):    # batches are there, their state is not
        incremental.load(frame(spark, [0]), "incremental", target, scratch_path(spark, "s3"), "ts", "t")
