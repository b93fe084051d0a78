"""Aggregation.

Every aggregate here is decomposable (sum, max, count, min_by, ...), so Spark
plans a partial aggregation before the shuffle: a hot group is collapsed on
the map side and never lands whole in one task.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_GROUP_BY = re.compile(r"\bgroup\s+by\b", re.IGNORECASE)


def parse_aggregation(rule: str) -> tuple[list[str], dict[str, str]]:
    """Split an aggregation-rule cell such as
    ``SUM(o_totalprice) AS total, MAX(o_orderdate) AS last GROUP BY o_custkey``
    into group columns and ``{alias: expression}``. Expressions stay SQL text
    for Spark to analyse; an expression without alias is named by Spark."""
    parts = _GROUP_BY.split(rule, maxsplit=1)
    aggs_text = parts[0].strip().rstrip(",")
    groups = [g.strip() for g in _split_top(parts[1])] if len(parts) > 1 else []
    aggs: dict[str, str] = {}
    for item in _split_top(aggs_text):
        m = re.match(r"^(.*\S)\s+as\s+(\w+)\s*$", item, re.IGNORECASE)
        if m:
            aggs[m.group(2)] = m.group(1)
        elif item:
            aggs[item] = item
    return [g for g in groups if g], aggs


def _split_top(text: str) -> list[str]:
    """Split on commas outside parentheses and quotes."""
    out, depth, quote, cur = [], 0, None, []
    for ch in text:
        if quote:
            cur.append(ch)
            if ch == quote:
                quote = None
            continue
        if ch in "'\"":
            quote = ch
        elif ch == "(":
            depth += 1
        elif ch == ")":
            depth -= 1
        elif ch == "," and depth == 0:
            out.append("".join(cur).strip())
            cur = []
            continue
        cur.append(ch)
    if "".join(cur).strip():
        out.append("".join(cur).strip())
    return out


def aggregate_rule(df: DataFrame, group_cols: Sequence[str] | str,
                   aggs: Mapping[str, str] | None = None) -> DataFrame:
    """``groupBy(group_cols).agg(expr AS alias, ...)``. ``group_cols`` may
    also be a whole rule text (see ``parse_aggregation``)."""
    if isinstance(group_cols, str) and aggs is None:
        group_cols, aggs = parse_aggregation(group_cols)
    exprs = [F.expr(e).alias(a) for a, e in (aggs or {}).items()]
    if not exprs:
        return df.select(*group_cols).distinct()
    return df.groupBy(*group_cols).agg(*exprs)


def distinct_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct key tuples (hash aggregate with map-side combine)."""
    return df.select(*cols).distinct()


def max_of(df: DataFrame, col: str, alias: str | None = None) -> DataFrame:
    """D3: one-row global maximum (partial max per task, one final row)."""
    return df.agg(F.max(col).alias(alias or f"max_{col}"))


def record_count_check(df: DataFrame, table_name: str, expected: int | None) -> DataFrame:
    """D5 (lazy): one row ``table_name, record_count, expected, status``.
    Valid iff count > expected; a NULL expectation is 'skipped'."""
    cnt = F.count(F.lit(1))
    exp = F.lit(expected).cast("bigint")
    status = (F.when(exp.isNull(), F.lit("skipped"))
              .when(cnt > exp, F.lit("passed")).otherwise(F.lit("failed")))
    return df.agg(F.lit(table_name).alias("table_name"), cnt.alias("record_count"),
                  exp.alias("expected"), status.alias("status"))


def count_valid(df: DataFrame, expected: int | None) -> tuple[int, bool]:
    """D5 (action): (count, valid). ``expected=None`` skips the check."""
    n = df.count()
    return n, (True if expected is None else n > expected)
