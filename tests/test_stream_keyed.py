"""Keyed rules on a stream against the batch rules."""

import random
import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tests.test_lineage_expressions import shuffle_bytes
from vaultline.operators import quality
from vaultline.plans.rules import Rule
from vaultline.session import scratch_path
from vaultline.sources.snapshots import Snapshots
from vaultline.sources.keyed import Bucketed
from vaultline.streaming import keyed_rules
from vaultline.streaming.loads import micro_batches, stream_distinct_bucketed

SCHEMA = "id long, k string, t long, v long"
RULES = [Rule("v", "range", ("0", "8"), handling="log"), Rule("id", "unique"),
         Rule(None, "unique_combination", ("k", "v"), handling="log"), Rule("k", "chronology", ("t", "id", "v"), handling="discard")]


def made_up(seed, n):
    rnd = random.Random(seed)
    pick = lambda xs, null: None if rnd.random() < null else rnd.choice(xs)
    # One key holds a third of all rows; ids repeat; keys, times and values may be NULL.
    return [(pick(range(n * 3), 0.05), "hot" if i % 3 == 0 else pick("abcdefgh", 0.1), pick(range(n // 6), 0.05), pick(range(12), 0.05))
            for i in range(n)]


def stream(spark, batches, rules, target, ckpt, **kw):
    files = scratch_path(spark, "files")
    for i, b in enumerate(batches):
        spark.createDataFrame(b, SCHEMA).coalesce(1).write.mode("append").parquet(f"{files}/{i}")
    df = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(files))
    return keyed_rules.stream_keyed_dq(df, rules, target, ckpt, buckets=4, **kw)


def test_equals_the_batch_rules(spark):
    data = made_up(1, 240)
    target = scratch_path(spark, "target")
    stream(spark, [data[:90], data[90:100], data[100:]], RULES, target, scratch_path(spark, "ckpt"))
    df = spark.createDataFrame(data, SCHEMA)
    split = keyed_rules.read_checked(spark, target, df.schema, RULES)
    want = quality.split(quality.mark_failures(df, RULES), RULES)
    key = lambda d: d.select("id", "k", "t", "v", F.array_join("failed_rules", ",").alias("f"), "dq_action")
    assert rows(key(split.marked)) == rows(key(want.marked))
    assert rows(split.clean.drop("failed_rules")) == rows(want.clean.drop("failed_rules"))
    assert keyed_rules.read_failures(spark, target).filter("late").count() > 0


def test_late_rows_and_replays(spark):
    target, one = scratch_path(spark, "target"), [Rule("k", "chronology", ("t", "id"))]
    feed = [[(5, "a", 1, 0)], [(3, "a", 1, 0), (9, "a", 1, 0)], [(1, "a", 0, 0)], [(4, "a", 1, 0)]]
    stream(spark, feed, one, target, scratch_path(spark, "ckpt"))
    got = rows(keyed_rules.read_failures(spark, target), "rule", "late", "batch_id")
    # Row 5 was first until row 3 came late; 9 and 4 come after it; another time is no tie.
    assert len(got) == 3 and sum(r[1] for r in got) == 1
    schema = spark.createDataFrame([], SCHEMA).schema
    assert rows(keyed_rules.read_checked(spark, target, schema, one).clean, "id") == [(1,), (3,)]
    # The same micro-batches once more, as after a lost checkpoint: nothing is counted twice.
    seq = Snapshots(spark, f"{target}/state").at().seq
    stream(spark, feed, one, target, scratch_path(spark, "ckpt"))
    assert Snapshots(spark, f"{target}/state").at().seq == seq
    assert rows(keyed_rules.read_failures(spark, target), "rule", "late", "batch_id") == got


def test_a_crash_before_the_commit_and_fail_job(spark, monkeypatch):
    target, ckpt, schema = scratch_path(spark, "target"), scratch_path(spark, "ckpt"), spark.createDataFrame([], SCHEMA).schema
    files = scratch_path(spark, "files")
    spark.createDataFrame([(1, "a", 1, 0), (2, "a", 2, 0)], SCHEMA).coalesce(1).write.parquet(files)
    source = lambda: spark.readStream.schema(SCHEMA).parquet(files)
    rules = [Rule("id", "unique")]
    with monkeypatch.context() as m:
        m.setattr(Snapshots, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(Exception):
            keyed_rules.stream_keyed_dq(source(), rules, target, ckpt, buckets=2)
    assert keyed_rules.read_checked(spark, target, schema, rules).marked.count() == 0
    keyed_rules.stream_keyed_dq(source(), rules, target, ckpt, buckets=2)
    assert keyed_rules.read_checked(spark, target, schema, rules).clean.count() == 2
    # A row of a later batch breaks a rule that fails the job: that batch is not committed.
    spark.createDataFrame([(2, "z", 9, 0)], SCHEMA).coalesce(1).write.mode("append").parquet(files)
    with pytest.raises(Exception, match="fail_job"):
        keyed_rules.stream_keyed_dq(source(), [Rule("id", "unique", handling="fail_job")], target, ckpt, buckets=2)
    assert keyed_rules.read_checked(spark, target, schema, rules).clean.count() == 2


def test_groups_are_appended_and_no_scratch_stays(spark):
    """Three micro-batches of new keys: each stores its own groups only and leaves no copies and no shuffles behind."""
    base = scratch_path(spark, "x").rpartition("/")[0]
    store, before, target = Snapshots(spark, base), shuffle_bytes(spark), scratch_path(spark, "target")
    there = set(store._list(base))
    feed = [[(i, f"k{i}", i, 0) for i in range(60 * b, 60 * b + 60)] for b in range(3)]
    stream(spark, feed, [Rule("id", "unique"), Rule("k", "chronology", ("t", "id"))], target, scratch_path(spark, "ckpt"))
    assert not [f for f in set(store._list(base)) - there if f.startswith("rule-groups")]
    until = time.time() + 20
    while shuffle_bytes(spark) > before and time.time() < until:
        time.sleep(0.2)
    assert shuffle_bytes(spark) <= before
    for table in ("groups_0", "groups_1"):
        files = spark.read.option("recursiveFileLookup", True).parquet(f"{target}/state/data/{table}")
        assert files.count() == 180  # 60 + 120 + 180 when all groups are written again each time


def test_buckets_become_one_folder_again_and_are_looked_at_in_runs(spark, monkeypatch):
    monkeypatch.setattr(keyed_rules, "RUN_BYTES", 1)
    data, target, rules = made_up(2, 160), scratch_path(spark, "target"), RULES[2:]
    stream(spark, [data[i:i + 40] for i in range(0, 160, 40)], rules, target, scratch_path(spark, "ckpt"), compact_at=3)
    df = spark.createDataFrame(data, SCHEMA)
    key = lambda d: d.select("id", "k", "t", "v", F.array_join("failed_rules", ",").alias("f"), "dq_action")
    want = quality.split(quality.mark_failures(df, rules), rules)
    assert rows(key(keyed_rules.read_checked(spark, target, df.schema, rules).marked)) == rows(key(want.marked))
    store = Snapshots(spark, f"{target}/state")
    for name, entry in store.at().tables.items():
        if name != keyed_rules.CURSOR:
            named = {p for paths in entry["buckets"].values() for p in paths}
            folders = store._list(f"{store.root}/data/{name}")
            there = {f"{store.root}/data/{name}/{f}/{b}" for f in folders for b in store._list(f"{store.root}/data/{name}/{f}") if "=" in b}
            assert there == named and max(map(len, entry["buckets"].values())) < 3


def test_failed_rows_are_not_broadcast_and_an_older_layout_is_refused(spark):
    target, one = scratch_path(spark, "target"), [Rule("id", "unique")]
    stream(spark, [[(1, "a", 1, 0), (1, "b", 1, 0), (2, "c", 1, 0)]], one, target, scratch_path(spark, "ckpt"))
    schema = spark.createDataFrame([], SCHEMA).schema
    marked = keyed_rules.read_checked(spark, target, schema, one).marked
    assert marked.filter("dq_action = 'quarantine'").count() == 2
    assert "Broadcast" not in marked._jdf.queryExecution().executedPlan().toString()
    store = Snapshots(spark, f"{target}/state")
    store.commit(store.at(), {keyed_rules.CURSOR: {"last": 0}})
    with pytest.raises(ValueError, match="older layout"):
        keyed_rules.read_failures(spark, target)


def test_micro_batches_are_read_in_parts_and_buckets_written_by_more_tasks(spark):
    """A batch is as many files as its rows were read in; rows come once."""
    files, seen = scratch_path(spark, "files"), []
    feed = micro_batches(spark.range(1200).repartition(4), files, 3)

    def look(batch, i):
        seen.append([r[0] for r in batch.collect()])
    feed.writeStream.foreachBatch(look).option("checkpointLocation", scratch_path(spark, "ckpt")).trigger(availableNow=True).start().awaitTermination()
    store = Snapshots(spark, scratch_path(spark, "store"))
    assert len([f for f in store._list(files) if f.endswith(".parquet")]) == 12
    assert len(seen) == 3 and sorted(x for ids in seen for x in ids) == list(range(1200))
    # A table of one bucket is not one task's work.
    kept = {key: spark.conf.get(key) for key in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        folder, written = Bucketed(store, "one", "id", 1)._write(spark.range(1000))
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    assert written == [0] and len([f for f in store._list(f"{folder}/_bucket=0") if f.endswith(".parquet")]) > 1
    assert sorted(r["id"] for r in spark.read.parquet(f"{folder}/_bucket=0").collect()) == list(range(1000))


def test_distinct_keys_in_buckets(spark):
    """Six micro-batches of new and old keys, replayed: every key once, folders per bucket level."""
    files, store = scratch_path(spark, "files"), Snapshots(spark, scratch_path(spark, "store"))
    for i in range(6):
        data = [(None if j % 7 == 0 else j, "x") for j in range(i * 5, i * 5 + 12)]
        spark.createDataFrame(data, "k long, s string").coalesce(1).write.mode("append").parquet(f"{files}/{i}")
    for _ in range(2):
        df = (spark.readStream.schema("k long, s string").option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", True).parquet(files))
        stream_distinct_bucketed(df, ["k", "s"], store, "seen", scratch_path(spark, "ckpt"), buckets=2, compact_at=3)
        assert rows(store.read("seen")) == sorted({(None if j % 7 == 0 else j, "x") for j in range(37)}, key=repr)
        assert max(Bucketed(store, "seen", ["k", "s"], 2).files_per_bucket().values()) < 3
