"""Vault loads: shapes, idempotence, batch-split invariance, changes."""

import datetime as dt

from pyspark.sql import functions as F

from vaultline.functions import checks
from vaultline.operators import vault
from tests.conftest import SF01, rows

TS1, TS2 = "2024-01-01 00:00:00", "2024-02-01 00:00:00"


def test_hub_shape_and_keys(spark):
    c = spark.read.parquet(f"{SF01}/customer.parquet")
    h = vault.hub(c, "c_custkey", "customer", TS1, "tpch")
    assert h.columns == ["hub_customer_key", "c_custkey", "load_datetime", "record_source"]
    assert h.count() == c.select("c_custkey").distinct().count()
    assert h.filter(checks.hash_key_format("hub_customer_key")).count() == 0


def test_hub_drops_null_keys_and_duplicates(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k int")
    assert rows(vault.hub(df, "k", "x", TS1, "s"), "k") == [(1,), (2,)]


def test_hub_load_twice_adds_nothing_and_split_invariance(spark):
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    full = vault.hub(o, "o_custkey", "customer", TS1, "tpch")
    again = vault.new_hub_rows(vault.hub(o, "o_custkey", "customer", TS2, "tpch"), full, "hub_customer_key")
    assert again.count() == 0
    # any batch split gives the same set of keys
    b1 = vault.hub(o.filter("o_orderkey % 3 = 0"), "o_custkey", "customer", TS1, "tpch")
    b2 = vault.new_hub_rows(vault.hub(o.filter("o_orderkey % 3 <> 0"), "o_custkey", "customer", TS2, "tpch"),
                            b1, "hub_customer_key")
    assert rows(b1.unionByName(b2), "hub_customer_key") == rows(full, "hub_customer_key")


def test_link_keys(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    hubs = {"order": ["l_orderkey"], "part": ["l_partkey"], "supplier": ["l_suppkey"]}
    lk = vault.link(li, hubs, "lineitem", TS1, "tpch")
    assert lk.columns == ["link_lineitem_key", "hub_order_key", "hub_part_key", "hub_supplier_key",
                          "load_datetime", "record_source"]
    # the link's hub keys equal the hubs' own keys
    ho = vault.hub(li, "l_orderkey", "order", TS1, "tpch")
    assert lk.join(ho, "hub_order_key", "left_anti").count() == 0


def test_satellite_and_history(spark):
    t = dt.datetime(2024, 1, 1)
    data = [(1, t, 1, "A"), (1, t + dt.timedelta(hours=1), 2, "A"), (1, t + dt.timedelta(hours=2), 3, "B"),
            (1, t + dt.timedelta(hours=3), 4, "A"), (2, t, 5, "X")]
    df = spark.createDataFrame(data, "k int, ts timestamp_ntz, id int, v string")
    hist = vault.satellite_history(df, "k", ["v"], "ts", "k", "src", tie_cols=["id"])
    by_key = {}
    for r in hist.orderBy("load_datetime").collect():
        by_key.setdefault(r["hub_k_key"], []).append(r["v"])
    assert sorted(by_key.values()) == [["A", "B", "A"], ["X"]]
    sat = vault.satellite(df, "k", ["v"], "k", TS1, "src")
    assert sat.count() == 3       # (1,A), (1,B), (2,X)


def test_incremental_satellite(spark):
    t = dt.datetime(2024, 1, 1)
    old = spark.createDataFrame([(1, t, 1, "A"), (2, t, 2, "X")], "k int, ts timestamp_ntz, id int, v string")
    existing = vault.satellite_history(old, "k", ["v"], "ts", "k", "src", tie_cols=["id"])
    new = spark.createDataFrame([(1, t + dt.timedelta(1), 3, "A"), (1, t + dt.timedelta(2), 4, "B"),
                                 (1, t + dt.timedelta(3), 5, "A"), (2, t + dt.timedelta(1), 6, "X"),
                                 (3, t + dt.timedelta(1), 7, "N")], "k int, ts timestamp_ntz, id int, v string")
    batch = vault.satellite_history(new, "k", ["v"], "ts", "k", "src", tie_cols=["id"])
    got = vault.changed_sat_rows(batch, existing, "hub_k_key")
    # key 1: A (same as current) dropped, then B, then A again; key 2 unchanged; key 3 new
    assert sorted(r["v"] for r in got.collect()) == ["A", "B", "N"]
    # loading the same batch again after it was applied adds nothing
    applied = existing.unionByName(got)
    assert vault.changed_sat_rows(batch, applied, "hub_k_key").count() == 0


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B", 1), (2, "BB", 2), (3, "c", 1)], "k int, v string, seq int")
    got = vault.upsert_by_key(new, old, "k", order=["seq"])
    assert rows(got, "k", "v") == [(1, "a"), (2, "BB"), (3, "c")]


def test_staging_casts_and_cleansing(spark):
    df = spark.createDataFrame([(1, " x ", "12.5"), (2, "  ", "oops")], "id int, s string, n string")
    st = vault.staging(df, {"cid": "id", "name": "s", "amount": "n"}, casts={"amount": "DECIMAL(10,2)"},
                       hash_keys={"hk": ["cid"]})
    got = {r["cid"]: (r["name"], r["amount"], r["cast_failures"]) for r in st.collect()}
    assert got[1][0] == "x" and str(got[1][1]) == "12.50" and got[1][2] == []
    assert got[2][0] is None and got[2][1] is None and got[2][2] == ["amount"]


def test_write_vault_increment_batches_and_replay(spark):
    from vaultline.session import scratch_path
    from vaultline.sources.writers import write_vault_increment
    o = spark.read.parquet(f"{SF01}/orders.parquet")
    target = scratch_path(spark, "hub_inc")
    early = o.filter(F.col("o_orderdate") < F.lit("1996-01-01 00:00:00").cast("timestamp_ntz"))
    write_vault_increment(vault.hub(early, "o_custkey", "customer", TS1, "tpch"), target, "hub_customer_key", "b1")
    write_vault_increment(vault.hub(o, "o_custkey", "customer", TS2, "tpch"), target, "hub_customer_key", "b2")
    write_vault_increment(vault.hub(o, "o_custkey", "customer", TS2, "tpch"), target, "hub_customer_key", "b2")
    stored = spark.read.parquet(target)
    full = vault.hub(o, "o_custkey", "customer", TS1, "tpch")
    assert stored.count() == full.count()                       # replay of b2 added nothing
    assert rows(stored, "hub_customer_key") == rows(full, "hub_customer_key")
    # first load time kept for keys of batch 1
    assert stored.filter("batch_id = 'b1'").select("load_datetime").distinct().count() == 1


def test_vault_from_metadata(spark):
    from vaultline.plans import template as tpl
    from vaultline.plans.vault_job import build_vault, vault_models_from_metadata
    models = {m.name: m for m in vault_models_from_metadata(tpl.SOURCE_COLUMN_ROWS, tpl.MAPPING_ROWS)}
    assert sorted(models) == ["hub_customer", "hub_orders", "link_orders_customer", "sat_customer", "sat_orders"]
    assert models["link_orders_customer"].keys == {"orders": ["o_orderkey"], "customer": ["o_custkey"]}
    assert models["sat_orders"].attrs == ["o_orderstatus", "o_totalprice", "o_orderdate"]   # fk left out
    built = build_vault(list(models.values()), tpl.sources(spark, SF01), TS1, "tpch")
    # the link's customer hub key equals the customer hub's key for the same customer
    link, hubc = built["link_orders_customer"], built["hub_customer"]
    assert link.join(hubc, "hub_customer_key", "left_anti").count() == 0
    # without primary-key flags the first key-looking column is the business key
    rows_nopk = [dict(r, primary_key=None) for r in tpl.SOURCE_COLUMN_ROWS]
    m2 = {m.name: m for m in vault_models_from_metadata(rows_nopk, tpl.MAPPING_ROWS)}
    assert m2["hub_customer"].keys == {"customer": ["c_custkey"]}


def test_late_and_same_time_satellite_versions_are_stored(spark):
    import pytest
    from vaultline.session import scratch_path
    from vaultline.sources.writers import write_vault_increment
    sat = "k string, hash_diff string, load_datetime timestamp_ntz"
    t = dt.datetime(2024, 1, 1)
    day = lambda k, h, d: (k, h, t + dt.timedelta(days=d))
    target = scratch_path(spark, "late_sat")

    def load(batch, *rows):
        out = write_vault_increment(spark.createDataFrame(list(rows), sat), target, "k", batch, "sat_changes")
        return sorted((r["hash_diff"], r["load_datetime"].day) for r in out.collect())
    assert load("1", day("a", "X", 9), day("a", "X", 10)) == [("X", 10)]
    late = [day("a", "W", 4), day("a", "Y", 9), day("b", "Q", 1)]
    assert load("2", *late) == [("Q", 2), ("W", 5), ("Y", 10)]
    assert load("2", *late) == [("Q", 2), ("W", 5), ("Y", 10)]     # the replay writes the same partition
    assert load("3", *late, day("a", "X", 9)) == []                # stored versions are not stored again
    assert spark.read.parquet(target).count() == 4
    plain = scratch_path(spark, "no_batch")
    spark.createDataFrame([day("a", "X", 1)], sat).write.parquet(plain)
    with pytest.raises(ValueError):
        write_vault_increment(spark.createDataFrame([day("a", "X", 1)], sat), plain, "k", "1")
