"""Metadata sheets as small DataFrames with fixed schemas.

Sheets arrive with human headers, in two spellings: the guide's
(``Source Table Name``) and the short one (``Table Name``). Both map to the
canonical names below; a sheet lacking a required column raises.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMAS = {
    "source_columns": "system string, table_name string, column_name string, data_type string, "
                      "nullable boolean, primary_key boolean, default_value string, comments string",
    "target_columns": "system string, schema_name string, table_name string, column_name string, "
                      "data_type string, transformation string, derived boolean, load_order int, "
                      "partition_key boolean, key_kind string, rule string",
    "mappings": "rule_id string, target_table string, source_table string, expression string, "
                "lookup_table string, filter_condition string, join_condition string, aggregation string",
    "loads": "table_name string, frequency string, load_mode string, watermark_column string, "
             "file_pattern string, error_handling string, dependencies string",
    "rules": "table_name string, column_name string, rule string, reject_handling string, "
             "severity string, record_count_expected bigint",
    "protection": "table_name string, column_name string, pii boolean, mask boolean, encrypt boolean",
}

REQUIRED = {
    "source_columns": ("table_name", "column_name"),
    "target_columns": ("table_name", "column_name"),
    "mappings": (),
    "loads": ("table_name",),
    "rules": ("column_name", "rule"),
    "protection": ("table_name", "column_name"),
}

# Header spellings of the metadata spreadsheet -> canonical names.
HEADER_ALIASES = {
    "source system name": "system", "target system": "system",
    "source table name": "table_name", "target table name": "table_name", "table name": "table_name",
    "source column name": "column_name", "target column name": "column_name", "column name": "column_name",
    "data type": "data_type", "target data type": "data_type",
    "nullable": "nullable", "primary key?": "primary_key", "default value": "default_value",
    "comments": "comments", "description": "comments",
    "target schema": "schema_name", "transformation logic": "transformation",
    "is derived?": "derived", "load order / priority": "load_order", "partition key?": "partition_key",
    "hash key or business key?": "key_kind",
    "mapping rule id": "rule_id", "source table": "source_table", "target table": "target_table", "business rule / expression": "expression",
    "lookup table used": "lookup_table", "filter conditions": "filter_condition",
    "join conditions": "join_condition", "aggregation rule": "aggregation",
    "load frequency": "frequency", "incremental or full load": "load_mode",
    "watermark column": "watermark_column", "source file pattern": "file_pattern",
    "error handling logic": "error_handling", "dependencies": "dependencies",
    "validations": "rule", "reject handling": "reject_handling",
    "record count expected": "record_count_expected", "severity": "severity",
    "pii/phi flag": "pii", "masking required": "mask", "encryption required": "encrypt",
}


def canonical_name(header: str) -> str:
    h = re.sub(r"\s+", " ", str(header).strip().lower())
    if h in HEADER_ALIASES:
        return HEADER_ALIASES[h]
    return re.sub(r"[^a-z0-9]+", "_", h).strip("_")


def normalize(df: DataFrame, kind: str) -> DataFrame:
    """Rename headers to canonical names, add missing optional columns as
    NULL, cast to the canonical schema; raise when a required one is absent."""
    renamed = df.withColumnsRenamed({c: canonical_name(c) for c in df.columns})
    target = df.sparkSession.createDataFrame([], SCHEMAS[kind]).schema
    missing = [c for c in REQUIRED[kind] if c not in renamed.columns]
    if missing:
        raise ValueError(f"{kind} sheet lacks {missing}; headers were {df.columns}")
    cols = []
    for f in target.fields:
        if f.name in renamed.columns:
            src = F.col(f.name)
            if f.dataType.simpleString() == "boolean":
                src = _yes(src)
            # A free-text cell that is not a number (e.g. load order "high")
            # reads as unspecified instead of failing the job.
            cols.append(src.try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return renamed.select(*cols)


def _yes(c):
    t = F.lower(F.trim(c.cast("string")))
    return F.when(t.isin("y", "yes", "true", "1", "x"), True).when(t.isin("n", "no", "false", "0", ""), False)


def sheet(spark: SparkSession, kind: str, rows: list[tuple | dict]) -> DataFrame:
    """Build a canonical sheet from Python rows (tests, templates)."""
    if rows and isinstance(rows[0], dict):
        names = [f.split()[0] for f in SCHEMAS[kind].split(", ")]
        rows = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(rows, SCHEMAS[kind])


def read_sheet(spark: SparkSession, path: str, kind: str, fmt: str = "csv", **options) -> DataFrame:
    """A metadata sheet exported as CSV (or any format Spark reads), with
    either header spelling, normalised to the canonical schema. Everything
    is read as text first, so cells like 'Y' or '10' are interpreted by
    ``normalize``, not by schema inference."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "false")
    return normalize(reader.options(**options).load(path), kind)
