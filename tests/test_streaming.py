"""Streaming loads equal their batch forms; replays are harmless."""

import pytest

from vaultline.operators import vault
from vaultline.plans.rules import parse_cell
from vaultline.session import scratch_path
from vaultline.streaming.loads import (run_available, stream_distinct, stream_distinct_keys, stream_dq_load, stream_split,
                                      stream_vault_load)
from tests.conftest import SF001, rows


def orders_stream(spark):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    return o, spark.readStream.schema(o.schema).option("pathGlobFilter", "orders.parquet").parquet(SF001)


def test_stream_hub_equals_batch_and_replay_is_idempotent(spark):
    o, stream = orders_stream(spark)
    target = scratch_path(spark, "shub")

    def build(b):
        return vault.hub(b, "o_custkey", "customer", "2024-01-01 00:00:00", "tpch")
    stream_vault_load(stream, build, target, "hub_customer_key", scratch_path(spark, "ck1"))
    batch = build(o)
    assert rows(spark.read.parquet(target).drop("batch_id")) == rows(batch)
    # a second stream over the same files with a fresh checkpoint replays batch 0
    stream_vault_load(orders_stream(spark)[1], build, target, "hub_customer_key", scratch_path(spark, "ck2"))
    assert spark.read.parquet(target).count() == batch.count()


def test_stream_split_and_refusal(spark):
    c = spark.read.parquet(f"{SF001}/customer.parquet")
    stream = spark.readStream.schema(c.schema).option("pathGlobFilter", "customer.parquet").parquet(SF001)
    rules = parse_cell("range(0, 5000)", "c_acctbal", handling="quarantine")
    s = stream_split(stream, rules)
    target = scratch_path(spark, "sclean")
    run_available(s.clean.drop("failed_rules"), target, scratch_path(spark, "ck3"))
    assert spark.read.parquet(target).count() == c.filter("c_acctbal BETWEEN 0 AND 5000").count()
    with pytest.raises(ValueError):
        stream_split(stream, parse_cell("unique", "c_custkey"))


def test_stream_distinct(spark):
    e = spark.read.parquet(f"{SF001}/events.parquet")
    stream = spark.readStream.schema(e.schema).option("pathGlobFilter", "events.parquet").parquet(SF001)
    target = scratch_path(spark, "sdist")
    run_available(stream_distinct(stream, ["user_id"], "ts", "60 days").select("user_id"), target,
                  scratch_path(spark, "ck4"))
    assert rows(spark.read.parquet(target)) == rows(e.select("user_id").distinct())


def test_stream_satellite_changes_equal_batch_and_replay(spark):
    e = spark.read.parquet(f"{SF001}/events.parquet")
    stream = spark.readStream.schema(e.schema).option("pathGlobFilter", "events.parquet").parquet(SF001)
    target = scratch_path(spark, "ssat")

    def build(b):
        return vault.satellite_history(b, "user_id", ["event_type"], "ts", "user", "tpch", tie_cols=["event_id"])
    stream_vault_load(stream, build, target, "hub_user_key", scratch_path(spark, "ck5"), kind="sat_changes")
    assert rows(spark.read.parquet(target).drop("batch_id")) == rows(build(e))
    again = spark.readStream.schema(e.schema).option("pathGlobFilter", "events.parquet").parquet(SF001)
    stream_vault_load(again, build, target, "hub_user_key", scratch_path(spark, "ck6"), kind="sat_changes")
    assert spark.read.parquet(target).count() == build(e).count()


def test_stream_dq_load_writes_both_sinks(spark):
    c = spark.read.parquet(f"{SF001}/customer.parquet")
    stream = spark.readStream.schema(c.schema).option("pathGlobFilter", "customer.parquet").parquet(SF001)
    rules = parse_cell("range(0, 5000)", "c_acctbal", handling="quarantine")
    clean, quar = scratch_path(spark, "sdq_clean"), scratch_path(spark, "sdq_q")
    stream_dq_load(stream, rules, "customer", clean, quar, scratch_path(spark, "ck7"), "2024-01-01 00:00:00")
    n_ok = c.filter("c_acctbal BETWEEN 0 AND 5000").count()
    assert spark.read.parquet(clean).count() == n_ok
    assert spark.read.parquet(quar).count() == c.count() - n_ok


def files_stream(spark, df, name, n=3):
    path = scratch_path(spark, name)
    df.repartition(n).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_fail_job_rows_stop_the_stream_before_any_write(spark):
    import os
    df = spark.createDataFrame([(1, 5), (2, None), (3, 7)], "id int, v int")
    clean, quar = scratch_path(spark, "f_clean"), scratch_path(spark, "f_q")
    rules = parse_cell("not null", "v", handling="fail_job")
    with pytest.raises(Exception, match="fail_job"):
        stream_dq_load(files_stream(spark, df, "f_src", 1), rules, "t", clean, quar, scratch_path(spark, "f_ck"),
                       "2024-01-01 00:00:00")
    assert not os.path.exists(clean.replace("file:", "")) and not os.path.exists(quar.replace("file:", ""))


def test_distinct_keys_over_batches_and_any_time(spark):
    """Keys whose events are years apart, in several micro-batches, come once."""
    df = spark.createDataFrame([(k, f"{y}-01-01") for y in (1990, 2005, 2024) for k in (1, 2, None)], "k int, day string")
    target = scratch_path(spark, "dk")
    stream_distinct_keys(files_stream(spark, df, "dk_src"), ["k"], target, scratch_path(spark, "dk_ck"))
    got = spark.read.parquet(target)
    assert rows(got, "k") == [(1,), (2,), (None,)]
    assert got.select("batch_id").distinct().count() >= 1


def test_hub_over_several_micro_batches(spark):
    o, _ = orders_stream(spark)
    target = scratch_path(spark, "mb")

    def build(b):
        return vault.hub(b, "o_custkey", "customer", "2024-01-01 00:00:00", "tpch")
    stream_vault_load(files_stream(spark, o, "mb_src"), build, target, "hub_customer_key", scratch_path(spark, "mb_ck"))
    got = spark.read.parquet(target)
    assert rows(got.drop("batch_id")) == rows(build(o)) and got.select("batch_id").distinct().count() > 1
