"""Stored loads: commits, Bloom-filtered keys, bucketed tables, batch labels."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vaultline.operators import bloom
from vaultline.plans.jobs import TargetSpec, run_job
from vaultline.plans.rules import parse_cell
from vaultline.session import scratch_path
from vaultline.sources import keyed, writers
from vaultline.sources.snapshots import CommitConflict, Snapshots


def kv(spark, data, schema="k string, v long"):
    return spark.createDataFrame(data, schema)


# ---------------------------------------------------------------- labels of batches

@pytest.mark.parametrize("labels", [("007", "7", "1.0", "b1"), ("2024-01-01", "null", "a/b=c %d", "é x"), ("1e3", "true", "NaN", "1000")])
def test_replayed_batches_lose_no_row(spark, labels):
    """A label may read as a number, a date or a null; it stays the text it is."""
    target = scratch_path(spark, "labels")
    batch = lambda i: kv(spark, [(f"key{j}", i) for j in range(i, i + 3)])
    for i in (0, 1, 0, 2, 3, 1, 2):
        writers.write_vault_increment(batch(i), target, "k", labels[i])
    got = rows(writers.read_batches(spark, target), "k", "batch_id")
    assert got == sorted([("key0", labels[0]), ("key1", labels[0]), ("key2", labels[0]), ("key3", labels[1]),
                          ("key4", labels[2]), ("key5", labels[3])])


def test_a_table_without_batches_is_refused(spark):
    target = scratch_path(spark, "plain")
    kv(spark, [("a", 1)]).write.parquet(target)
    with pytest.raises(ValueError):
        writers.write_vault_increment(kv(spark, [("b", 1)]), target, "k", "x")
    with pytest.raises(ValueError):
        writers.write_vault_increment(kv(spark, [("b", 1)]), target, "k", "")


# ---------------------------------------------------------------- commits

def test_commits_change_all_tables_or_none(spark):
    store = Snapshots(spark, scratch_path(spark, "store"))
    one, two = kv(spark, [("a", 1)]), kv(spark, [("b", 2), (None, None)])
    assert store.at().seq == 0 and store.publish({"x": one, "y": two}) == 1
    # A write that fails half way: its first table is staged, the second's rows raise.
    bad = one.select(F.raise_error(F.lit("no")).cast("string").alias("k"), "v")
    with pytest.raises(Exception, match="no"):
        store.publish({"x": kv(spark, [("c", 3)]), "y": bad})
    assert rows(store.read("x")) == [("a", 1)] and rows(store.read("y")) == rows(two) and store.at().seq == 1
    # A table may be replaced by rows that read it; older commits stay readable.
    store.publish({"x": store.read("x").withColumn("v", F.col("v") + 1)})
    assert rows(store.read("x")) == [("a", 2)] and rows(store.read("x", 1)) == [("a", 1)]
    assert rows(store.read("y")) == rows(two)
    store.commit(store.at(), {"y": None})
    with pytest.raises(ValueError):
        store.read("y")
    with pytest.raises(ValueError):
        store.read("x", 99)
    with pytest.raises(ValueError):
        store.stage("../x", one)


def test_a_second_writer_is_told(spark):
    store = Snapshots(spark, scratch_path(spark, "store"))
    seen = store.at()
    store.publish({"x": kv(spark, [("a", 1)])})
    with pytest.raises(CommitConflict):
        store.commit(seen, {"x": None})
    assert rows(store.read("x")) == [("a", 1)]


def test_vacuum_keeps_what_is_named(spark):
    store = Snapshots(spark, scratch_path(spark, "store"))
    for i in range(3):
        store.publish({"x": kv(spark, [("a", i)])})
    store.publish({"y": kv(spark, [("b", 9)], "k string, v long")})
    store.stage("x", kv(spark, [("lost", 1)]))
    assert len(store.vacuum(keep=2)) == 3  # two old versions of x and the staged one
    assert rows(store.read("x")) == [("a", 2)] and rows(store.read("y")) == [("b", 9)] and rows(store.read("x", 3)) == [("a", 2)]


def test_partitions_keep_their_types(spark):
    store = Snapshots(spark, scratch_path(spark, "store"))
    store.publish({"x": kv(spark, [("007", 1), ("1.0", 2), (None, 3)])}, {"x": ["k"]})
    assert rows(store.read("x").select("k", "v")) == sorted([("007", 1), ("1.0", 2), (None, 3)], key=repr)


def test_job_commits_all_targets_at_once(spark):
    """A job whose second target fails leaves the first as it was."""
    store = Snapshots(spark, scratch_path(spark, "store"))
    src = {"s": kv(spark, [("a", 1), ("b", 2)])}

    def specs(handling):
        return [TargetSpec(name="t1", source="s", columns={"k": "k", "v": "v"}),
                TargetSpec(name="t2", source="s", columns={"k": "k", "v": "v"},
                           rules=parse_cell("Range(0, 1)", "v", handling=handling))]
    reports = run_job(spark, specs("quarantine"), src, {}, scratch_path(spark, "q"), "2024-01-01 00:00:00", store=store)
    assert [r["clean_rows"] for r in reports] == [2, 1] and all("entry" not in r for r in reports)
    src = {"s": kv(spark, [("c", 1), ("d", 5)])}
    with pytest.raises(Exception):
        run_job(spark, specs("fail_job"), src, {}, scratch_path(spark, "q"), "2024-01-02 00:00:00", store=store)
    assert rows(store.read("t1")) == [("a", 1), ("b", 2)] and rows(store.read("t2")) == [("a", 1)]
    run_job(spark, specs("quarantine"), src, {}, scratch_path(spark, "q"), "2024-01-02 00:00:00", store=store)
    assert rows(store.read("t1")) == [("c", 1), ("d", 5)] and rows(store.read("t2")) == [("c", 1)]


# ---------------------------------------------------------------- Bloom filters

def test_filters_miss_no_key(spark):
    stored = spark.range(3000).select(F.concat(F.lit("key"), F.col("id")).alias("k"))
    blocks = bloom.blocks_for(3000)
    filters = bloom.build(stored, ["k"], blocks).select(F.lit("b").alias("batch"), F.lit(blocks).alias("blocks"), "block", "bits")
    probe = spark.range(9000).select(F.concat(F.lit("key"), F.col("id")).alias("k"))
    got = {r["k"] for r in bloom.possible(probe, ["k"], filters, [blocks]).collect()}
    assert {f"key{i}" for i in range(3000)} <= got and len(got) < 3000 + 6000 * 0.03
    assert bloom.blocks_for(0) == 1 and bloom.blocks_for(4) == 1 and bloom.blocks_for(17) == 8


def test_new_keys_open_only_what_they_may_repeat(spark):
    store = Snapshots(spark, scratch_path(spark, "hub"))
    part = lambda a, b, v: kv(spark, [(f"key{i}", v) for i in range(a, b)])
    load = lambda df, label: keyed.load_new_keys(store, "hub", df, "k", label)
    assert load(part(0, 500, 1), "007").rows.count() == 500
    # The stored keys of a batch are taken away: a batch of other keys must not need them.
    entry = store.at().tables["hub"]["batches"]["007"]
    p, fs = store._jvm(entry["data"])
    held, _ = store._jvm(entry["data"] + "-held")
    fs.rename(p, held)
    got = load(kv(spark, [("other", 2)]), "1.0")
    assert got.opened == [] and rows(got.rows) == [("other", 2)]
    fs.rename(held, p)
    got = load(part(490, 510, 3), "b1")
    assert "007" in got.opened and got.rows.count() == 10
    for label, df in (("007", part(0, 500, 1)), ("b1", part(490, 510, 3)), ("1.0", kv(spark, [("other", 2)])), ("none", part(0, 0, 1))):
        load(df, label)
    stored = keyed.read_batches(store, "hub")
    assert stored.count() == 511 and stored.select("k").distinct().count() == 511
    assert dict(rows(stored.groupBy("batch_id").count())) == {"007": 500, "1.0": 1, "b1": 10}
    with pytest.raises(ValueError):
        load(kv(spark, [("x", 1)], "k string, w long"), "b9")


# ---------------------------------------------------------------- buckets

def test_upsert_rewrites_touched_buckets_only(spark, monkeypatch):
    store = Snapshots(spark, scratch_path(spark, "up"))
    t = keyed.Bucketed(store, "t", "k", n=32)
    assert len(t.upsert(kv(spark, [(f"key{i}", i) for i in range(400)]), "b1")) == 32
    before = store.at().tables["t"]["buckets"]
    touched = t.upsert(kv(spark, [("key7", -7), ("brand new", 1), (None, 5)]), "b2")
    after = store.at().tables["t"]["buckets"]
    assert 1 <= len(touched) <= 3 and {int(b) for b in after if after[b] != before.get(b)} == set(touched)
    want = {**{f"key{i}": i for i in range(400)}, "key7": -7, "brand new": 1, None: 5}
    assert dict(rows(t.read())) == want
    assert t.upsert(kv(spark, [("key7", 99)]), "b2") == []  # a replay
    t.upsert(kv(spark, [(None, 6), ("key8", 1), ("key8", 2)]), "b3", order=["v"])
    assert dict(rows(t.read())) == {**want, None: 6, "key8": 2}

    def crash(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(store, "commit", crash)
        with pytest.raises(RuntimeError):
            t.upsert(kv(spark, [("key9", 0)]), "b4")
    assert dict(rows(t.read()))["key9"] == 9 and not t.loaded("b4")
    t.upsert(kv(spark, [("key9", 0)]), "b4")
    assert dict(rows(t.read()))["key9"] == 0
    with pytest.raises(ValueError):
        keyed.Bucketed(store, "t", "k", n=16).upsert(kv(spark, [("a", 1)]), "b5")


def test_counts_across_batches(spark):
    index = keyed.Bucketed(Snapshots(spark, scratch_path(spark, "ix")), "ix", ["k", "v"], n=8)
    b = [kv(spark, d) for d in ([("a", 1), ("a", 1), ("b", 1), (None, 2)], [("b", 1), ("c", 3)], [(None, 2), ("d", 4)])]
    assert rows(index.add_counts(b[0], "1")) == sorted([("a", 1, 2), ("b", 1, 1), (None, 2, 1)], key=repr)
    index.add_counts(b[1], "2")
    assert rows(index.add_counts(b[1], "2")) == [("b", 1, 2), ("c", 3, 1)]
    index.add_counts(b[2], "3")
    assert rows(index.read().filter("n > 1")) == sorted([("a", 1, 2), ("b", 1, 2), (None, 2, 2)], key=repr)


def test_distinct_keys_stay_in_few_files(spark):
    keys = keyed.Bucketed(Snapshots(spark, scratch_path(spark, "ks")), "ks", "k", n=4)
    seen = set()
    for i in range(9):
        batch = {f"key{j}" for j in range(i * 5, i * 5 + 12)}
        new = keys.add_keys(kv(spark, [(k, 0) for k in batch] * 2), f"m{i}", compact_at=3)
        assert {r["k"] for r in new.collect()} == batch - seen
        seen |= batch
        assert max(keys.files_per_bucket().values()) <= 3
    assert {r["k"] for r in keys.read().collect()} == seen and keys.read().count() == len(seen)
    assert keys.add_keys(kv(spark, [("zzz", 0)]), "m3", compact_at=3).count() == 0


def test_diff_without_a_watermark(spark):
    store = Snapshots(spark, scratch_path(spark, "df"))
    t = keyed.Bucketed(store, "t", "k", n=64)
    data = {f"key{i}": i for i in range(300)}
    assert t.diff(kv(spark, data.items()), "1").filter("change = 'insert'").count() == 300
    before = store.at()
    assert t.diff(kv(spark, data.items()), "2").count() == 0 and store.at() == before
    new = {**data, "key5": None, "fresh": 1, None: 3}
    del new["key9"]
    got = t.diff(kv(spark, new.items()), "3")
    assert rows(got) == sorted([("update", "key5", None), ("insert", "fresh", 1), ("insert", None, 3), ("delete", "key9", 9)], key=repr)
    after = store.at().tables["t"]["buckets"]
    assert sum(after[b] != before.tables["t"]["buckets"][b] for b in after) <= 4
    assert dict(rows(t.read())) == new
    assert t.diff(kv(spark, []), "4").filter("change = 'delete'").count() == len(new) and t.read().count() == 0


def test_tree_descends_to_unequal_leaves():
    a = {i: ["1", str(i)] for i in range(100)}
    b = {**a, 3: ["1", "x"], 99: ["2", "99"]}
    del b[50]
    assert keyed.unequal(a, b, 128) == [3, 50, 99] and keyed.unequal(a, dict(a), 128) == [] and keyed.unequal({}, a, 128) == list(range(100))


# ---------------------------------------------------------------- even files

def test_rebalanced_partitions(spark):
    df = spark.range(4000).repartition(16).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(
        F.concat(F.lit("p"), F.col("id") % 5)).alias("part"))
    path = scratch_path(spark, "reb")
    writers.write_partitioned(df, path, ["part"], rebalance=True)
    got = writers.read_partitioned(spark, path, df.schema)
    assert rows(got) == rows(df)
    files = rows(got.select(F.input_file_name().alias("f"), "part").distinct().groupBy("part").count())
    assert len(files) == 6 and all(n <= 2 for _, n in files)  # without it: 16 files a partition
