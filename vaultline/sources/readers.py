"""Readers (A1-A5, A10)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, **options) -> DataFrame:
    """A1: CSV with a header. A declared schema avoids the extra pass that
    ``inferSchema`` costs; inference is only the fallback."""
    reader = spark.read.option("header", str(header).lower()).options(**options)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", "true").csv(path)


def scan_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """A2/A3: a catalog table by name, or files by path (prior output)."""
    if "/" in name_or_path or name_or_path.endswith(f".{fmt}"):
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def scan_glob(spark: SparkSession, root: str, pattern: str, fmt: str = "parquet",
              recursive: bool = True, schema: T.StructType | str | None = None) -> DataFrame:
    """A4: every file under ``root`` whose name matches ``pattern``
    (``Source File Pattern`` of the ETL sheet)."""
    reader = spark.read.format(fmt).option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(root)


def register_sources(spark: SparkSession, columns: Mapping[str, Sequence[str]] | None,
                     paths: Mapping[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """A5: logical source name -> DataFrame, projected to the columns the
    metadata lists (so the scan's ReadSchema holds only those)."""
    out = {}
    for name, path in paths.items():
        df = scan_table(spark, path, fmt)
        cols = (columns or {}).get(name)
        out[name] = df.select(*cols) if cols else df
    return out


def as_view(df: DataFrame, name: str) -> DataFrame:
    """A10: staging as a (non-cached) temp view."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
