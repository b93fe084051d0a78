"""A TPC-H metadata template: the sheets a user would fill in for the
customer/orders sample job, as rows and as canonical metadata DataFrames.

The registered queries run these sheets over the driver's tables.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.metadata import sheet

# Fixed parameters of the registered queries (repeatable time, cut-offs).
LOAD_TS = "2024-01-01 00:00:00"
LOAD_TS2 = "2024-02-01 00:00:00"
RECORD_SOURCE = "tpch"
ORDER_CUTOFF = "2000-01-01 00:00:00"        # sample job's date filter (data ends 2001-08)
JOB_CUTOFF = "2001-01-01 00:00:00"          # first batch of the incremental job
HUB_BATCH1_CUTOFF = "1996-01-01 00:00:00"
SAT_BATCH1_CUTOFF = "2024-01-15 00:00:00"


# The metadata sheets as rows (read on the driver; they are tiny).
TARGET_ROWS = [
    dict(system="warehouse", schema_name="tpch_stage", table_name="customer", column_name="customer_id",
         data_type="BIGINT", transformation="c_custkey", load_order=1, key_kind="business key",
         rule="not null; unique"),
    dict(system="warehouse", schema_name="tpch_stage", table_name="customer", column_name="customer_name",
         data_type="VARCHAR(50)", transformation="c_name", load_order=1, rule="not null; max_length(50)"),
    dict(system="warehouse", schema_name="tpch_stage", table_name="orders", column_name="order_id",
         data_type="BIGINT", transformation="o_orderkey", load_order=2, key_kind="business key",
         rule="not null; unique"),
]

MAPPING_ROWS = [
    dict(rule_id="0", target_table="customer", source_table="customer", expression="customer_id = c_custkey"),
    dict(rule_id="1", target_table="orders", source_table="orders", expression="order_id = o_orderkey",
         filter_condition=f"o_orderdate > '{ORDER_CUTOFF[:10]}'",
         join_condition="customer ON orders.o_custkey = customer.c_custkey"),
]

SOURCE_COLUMN_ROWS = [
    dict(system="tpch", table_name="customer", column_name="c_custkey", data_type="BIGINT", primary_key=True),
    dict(system="tpch", table_name="customer", column_name="c_name", data_type="VARCHAR(25)"),
    dict(system="tpch", table_name="customer", column_name="c_nationkey", data_type="INTEGER"),
    dict(system="tpch", table_name="customer", column_name="c_acctbal", data_type="DOUBLE"),
    dict(system="tpch", table_name="customer", column_name="c_mktsegment", data_type="VARCHAR(10)"),
    dict(system="tpch", table_name="orders", column_name="o_orderkey", data_type="BIGINT", primary_key=True),
    dict(system="tpch", table_name="orders", column_name="o_custkey", data_type="BIGINT"),
    dict(system="tpch", table_name="orders", column_name="o_orderstatus", data_type="VARCHAR(1)"),
    dict(system="tpch", table_name="orders", column_name="o_totalprice", data_type="DOUBLE"),
    dict(system="tpch", table_name="orders", column_name="o_orderdate", data_type="TIMESTAMP_NTZ"),
]

LOAD_ROWS = [
    dict(table_name="customer", frequency="daily", load_mode="full"),
    dict(table_name="orders", frequency="daily", load_mode="incremental", watermark_column="o_orderdate"),
]


def target_columns(spark: SparkSession) -> DataFrame:
    return sheet(spark, "target_columns", TARGET_ROWS)


def mappings(spark: SparkSession) -> DataFrame:
    return sheet(spark, "mappings", MAPPING_ROWS)


def loads(spark: SparkSession) -> DataFrame:
    return sheet(spark, "loads", LOAD_ROWS)


def protection(spark: SparkSession) -> DataFrame:
    return sheet(spark, "protection", [
        dict(table_name="customer", column_name="c_name", pii=True, mask=True, encrypt=False),
        dict(table_name="customer", column_name="c_acctbal", pii=True, mask=False, encrypt=True),
    ])


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class _Sources(Mapping):
    """Table name -> DataFrame, opened on first use (a job touching two
    tables lists and reads the footers of two files, not eight)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir, self._open = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise KeyError(name)
        if name not in self._open:
            self._open[name] = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        return self._open[name]

    def __iter__(self):
        return iter(TABLES)

    def __len__(self) -> int:
        return len(TABLES)


def sources(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    return _Sources(spark, sf_dir)


def customer_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer with one segment blanked to NULL (the data has no NULLs)."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return c.select("c_custkey", "c_name", "c_acctbal",
                    F.expr("nullif(c_mktsegment, 'BUILDING')").alias("segment"), "c_mktsegment")


CUSTOMER_STAGE_SQL = ("SELECT c_custkey, c_name, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS segment, "
                      "c_mktsegment FROM customer")

# Rules sheet for the customer DQ queries: (column, rule cell, reject handling, severity)
CUSTOMER_RULES = [
    ("segment", "Not Null", "quarantine", "error"),
    ("c_acctbal", "Range(0, 9000)", "discard", "error"),
    ("c_name", "Regex(^Customer#0000000[0-9]{2}$)", "log", "error"),
    ("c_mktsegment", "in('BUILDING', 'MACHINERY', 'HOUSEHOLD', 'AUTOMOBILE')", "quarantine", "warn"),
    ("c_name", "max_length(18)", "quarantine", "error"),
]

# The same rules as SQL failure conditions: (rule name, condition, effective handling)
CUSTOMER_RULES_SQL = [
    ("not_null:segment", "segment IS NULL", "quarantine"),
    ("range:c_acctbal", "NOT coalesce(c_acctbal >= 0 AND c_acctbal <= 9000, true)", "discard"),
    ("regex:c_name", "NOT coalesce(regexp_matches(c_name, '^Customer#0000000[0-9]{2}$'), true)", "log"),
    ("accepted_values:c_mktsegment",
     "NOT coalesce(c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD', 'AUTOMOBILE'), true)", "log"),
    ("max_length:c_name", "NOT coalesce(length(c_name) <= 18, true)", "quarantine"),
]


CUSTOMER_RULE_ROWS = [dict(table_name="customer", column_name=c, rule=r, reject_handling=h, severity=s)
                      for c, r, h, s in CUSTOMER_RULES]


def customer_rules(spark: SparkSession) -> DataFrame:
    return sheet(spark, "rules", CUSTOMER_RULE_ROWS)
