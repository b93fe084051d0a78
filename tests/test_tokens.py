"""Keyed masking and stored tokens."""

import hashlib
import hmac

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from vaultline.functions.protect import hmac_sha256
from vaultline.metadata import sheet
from vaultline.operators import protect
from vaultline.session import scratch_path
from vaultline.sources.snapshots import Snapshots
from vaultline.sources.tokens import TokenVault

ONE, TWO = b"0123456789abcdef", b"fedcba9876543210"
VALUES = ["", "alice", "bob", "é\U0001f600 x", "a" * 5000]


@pytest.mark.parametrize("key", [b"k", ONE, b"x" * 64, b"y" * 65])
def test_hmac_equals_the_library(spark, key):
    df = spark.createDataFrame([(v,) for v in VALUES], "v string")
    for v, h in df.select("v", hmac_sha256("v", key)).collect():
        assert h == hmac.new(key, v.encode(), hashlib.sha256).hexdigest()


def test_hmac_masking_needs_a_secret(spark):
    df = spark.createDataFrame([("alice", "x"), (None, None)], "name string, other string")
    prot = sheet(spark, "protection", [dict(table_name="t", column_name="name", pii=True, mask=True, encrypt=None)])
    with pytest.raises(ValueError):
        protect.protect(df, prot, "t", how="hmac")
    got = protect.protect(df, prot, "t", how="hmac", secret=ONE).collect()
    assert got[0]["name"] == hmac.new(ONE, b"alice", hashlib.sha256).hexdigest() and got[0]["other"] == "x"
    assert got[1]["name"] is None


def test_tokens_round_trip_rotation_and_withdrawal(spark):
    store = Snapshots(spark, scratch_path(spark, "tokens"))
    df = spark.createDataFrame([(i, v, v) for i, v in enumerate(VALUES + [None, "alice"])], "id int, a string, `b c` string")
    old = TokenVault(store, "person", {1: ONE}, n=4)
    t = old.tokenize(df, ["a", "b c"])
    got = t.collect()
    assert all(r["a"] == r["b c"] and (r["a"] is None or r["a"].startswith("v1_")) for r in got)
    assert got[1]["a"] == got[6]["a"] and len({r["a"] for r in got}) == 6
    assert rows(old.detokenize(t, ["b c", "a"])) == rows(df)
    # Another load of known values stores nothing, and a new one only itself.
    assert old.map.read().count() == 5
    old.tokenize(df.withColumn("a", F.concat("a", F.lit("!"))), ["a"])
    assert old.map.read().count() == 10
    new = TokenVault(store, "person", {1: ONE, 2: TWO}, n=4)
    moved = new.rotate(t, ["a"])
    assert all(r["a"] is None or r["a"].startswith("v2_") for r in moved.collect())
    assert rows(new.detokenize(moved, ["a", "b c"])) == rows(df)  # both versions read back
    # The same values, tokenized afresh, join with the rows that were carried over.
    assert rows(new.tokenize(df, ["a"]).select("a")) == rows(moved.select("a"))
    only = TokenVault(store, "person", {2: TWO}, n=4).detokenize(moved, ["a", "b c"])
    assert rows(only, "a") == rows(df, "a") and {r[0] for r in rows(only, "b c")} == {None}


def test_stored_rows_hold_no_value_and_domains_differ(spark):
    store = Snapshots(spark, scratch_path(spark, "tokens"))
    df = spark.createDataFrame([("alice",)], "v string")
    a, b = (TokenVault(store, d, {1: ONE}, n=2) for d in ("one", "two"))
    ta, tb = a.tokenize(df, ["v"]).first()[0], b.tokenize(df, ["v"]).first()[0]
    assert ta != tb and b.detokenize(a.tokenize(df, ["v"]), ["v"]).first()[0] is None
    text = str(a.map.read().collect())
    assert "alice" not in text and hashlib.sha256(b"alice").hexdigest() not in text
    empty = a.tokenize(df.limit(0), ["v"])
    assert empty.collect() == [] and a.map.read().count() == 1


def test_short_secrets_are_refused(spark):
    with pytest.raises(ValueError):
        TokenVault(None, "x", {1: b"short"})
