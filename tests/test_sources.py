"""Readers, writers and the checked write of E9."""

import pytest
from pyspark.sql import functions as F

from vaultline.operators import quality
from vaultline.plans.rules import parse_cell
from vaultline.session import scratch_path
from vaultline.sources import readers, writers
from tests.conftest import SF001, rows


def test_csv_round_trip_with_and_without_schema(spark):
    src = spark.read.parquet(f"{SF001}/customer.parquet")
    path = scratch_path(spark, "csv")
    src.write.option("header", "true").csv(path)
    typed = readers.scan_csv(spark, path, schema=src.schema)
    assert rows(typed) == rows(src)
    inferred = readers.scan_csv(spark, path)
    assert inferred.count() == src.count() and dict(inferred.dtypes)["c_acctbal"] == "double"


def test_glob_and_table(spark):
    assert readers.scan_glob(spark, SF001, "nat*.parquet").count() == 25
    assert readers.scan_table(spark, f"{SF001}/region.parquet").count() == 5
    v = readers.as_view(spark.read.parquet(f"{SF001}/region.parquet"), "region_v")
    assert spark.table("region_v").count() == v.count() == 5
    got = readers.register_sources(spark, {"region": ["r_name"]}, {"region": f"{SF001}/region.parquet"})
    assert got["region"].columns == ["r_name"]


def test_partitioned_write_dynamic_overwrite(spark):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    path = scratch_path(spark, "part")
    writers.write_partitioned(o, path, ["o_orderstatus"])
    writers.write_partitioned(o.filter("o_orderstatus = 'F'").limit(3), path, ["o_orderstatus"])
    back = spark.read.parquet(path)
    assert back.filter("o_orderstatus = 'F'").count() == 3           # replaced
    assert back.filter("o_orderstatus = 'O'").count() == o.filter("o_orderstatus = 'O'").count()  # kept


def test_store_failures_appends(spark):
    df = spark.createDataFrame([(1, None)], "id int, v string")
    path = scratch_path(spark, "fail")
    writers.store_failures(df, path, "r1", "not_null:v", "t")
    writers.store_failures(df, path, "r2", "not_null:v", "t")
    writers.store_failures(df, path, "r2", "not_null:v", "t")        # rerun of r2 replaces, not doubles
    assert rows(spark.read.parquet(path), "run_id", "row_json") == [("r1", '{"id":1}'), ("r2", '{"id":1}')]


def test_write_checked(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, v string")
    rules = parse_cell("not null", "v", handling="quarantine")
    target, q = scratch_path(spark, "tgt"), scratch_path(spark, "q")
    rep = writers.write_checked(quality.apply_rules(df, rules), target, q, "t", 1, "2024-01-01 00:00:00")
    assert rep == {"table": "t", "clean_rows": 2, "valid": True, "quarantined": 1, "logged": 0}
    assert spark.read.parquet(target).count() == 2 and spark.read.parquet(q).count() == 1
    # count not above the expectation: target untouched, quarantine still appended
    target2 = scratch_path(spark, "tgt2")
    rep = writers.write_checked(quality.apply_rules(df, rules), target2, q, "t", 5, "2024-01-02 00:00:00")
    assert rep["valid"] is False
    with pytest.raises(Exception):
        spark.read.parquet(target2).count()
    assert spark.read.parquet(q).count() == 2
    # rerun of the same batch: quarantine partition rewritten, not appended
    writers.write_checked(quality.apply_rules(df, rules), target2, q, "t", 5, "2024-01-02 00:00:00")
    assert spark.read.parquet(q).count() == 2
    # fail_job: nothing written at all
    target3 = scratch_path(spark, "tgt3")
    fail = parse_cell("not null", "v", handling="fail_job")
    with pytest.raises(quality.DataQualityError):
        writers.write_checked(quality.apply_rules(df, fail), target3, q, "t", 0, "2024-01-01 00:00:00")
    assert spark.read.parquet(q).count() == 2


def test_versioned_write(spark):
    base = scratch_path(spark, "ver")
    p1 = writers.write_versioned(spark.range(3), base)
    p2 = writers.write_versioned(spark.read.parquet(p1).filter(F.col("id") > 0), base)
    assert p1 != p2 and spark.read.parquet(p2).count() == 2
