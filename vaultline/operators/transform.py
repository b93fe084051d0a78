"""Projection, filter and scalar transforms.

All are lazy narrow transforms: they stay inside one whole-stage-codegen span
and let Catalyst push filters and column pruning into the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.plans.types import to_spark_type


def map_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """B1: ``{target: source}`` rename map; only mapped columns are kept, in
    the mapping's order. Sources may be SQL expressions."""
    return df.select(*[_expr(src).alias(tgt) for tgt, src in mapping.items()])


def direct_mapping(df: DataFrame, target: str, source: str) -> DataFrame:
    """B2: add (or replace) ``target`` as a copy of ``source``."""
    return df.withColumn(target, F.col(source))


def derive_column(df: DataFrame, target: str, expr_sql: str, rule_id: str | None = None) -> DataFrame:
    """Derived column from rule text (Spark SQL expression)."""
    try:
        return df.withColumn(target, F.expr(expr_sql))
    except Exception as exc:  # analysis errors name the rule that caused them
        raise ValueError(f"rule {rule_id or target!r}: cannot derive from {expr_sql!r}: {exc}") from exc


def cast_columns(df: DataFrame, types: Mapping[str, str], flag: str = "cast_failures") -> DataFrame:
    """``try_cast`` every listed column to its target type. A value that
    was not NULL before and is NULL after failed; the names of failed columns
    go to ``flag`` (array<string>, empty when all casts succeeded) so DQ can
    reject those rows."""
    casted, failed = {}, []
    for name, ddl in types.items():
        dt = to_spark_type(ddl)
        new = F.col(name).try_cast(dt)
        casted[name] = new
        failed.append(F.when(F.col(name).isNotNull() & new.isNull(), F.lit(name)))
    out = df.withColumns({**casted, flag: F.array_compact(F.array(*failed)) if failed
                          else F.array().cast("array<string>")})
    return out


def fill_default(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """``coalesce(col, default)``; defaults are literals of the column type."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                           for c, v in defaults.items()})


def filter_rows(df: DataFrame, condition_sql: str | Column | None, rule_id: str | None = None) -> DataFrame:
    """Metadata row filter. Comparisons against a column keep the column
    untouched, so the predicate reaches the parquet scan."""
    if condition_sql is None or (isinstance(condition_sql, str) and not condition_sql.strip()):
        return df
    try:
        return df.filter(condition_sql if isinstance(condition_sql, Column) else F.expr(condition_sql))
    except Exception as exc:
        raise ValueError(f"rule {rule_id!r}: bad filter {condition_sql!r}: {exc}") from exc


def require_keys(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop rows with a NULL business key."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def audit_columns(df: DataFrame, load_ts, record_source: str,
                  ts_col: str = "load_datetime", source_col: str = "record_source") -> DataFrame:
    """Constant audit columns. ``load_ts`` is a parameter (string,
    datetime or Column), never the wall clock, so a rerun is reproducible."""
    ts = load_ts if isinstance(load_ts, Column) else F.lit(load_ts).cast("timestamp_ntz")
    return df.withColumns({ts_col: ts, source_col: F.lit(record_source)})


def cleanse_strings(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Trim strings, blank -> NULL. Default: every string column."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.trim(F.col(c)), F.lit("")) for c in cols})


def _expr(src: str) -> Column:
    return F.col(src) if src.replace("_", "").isalnum() else F.expr(src)
