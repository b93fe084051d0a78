"""Joins (C1-C6).

No join here forces a broadcast of data whose size is unknown: the planner's
size check (autoBroadcastJoinThreshold) and AQE's runtime statistics pick
broadcast or sort-merge, and AQE splits skewed partitions of sort-merge joins.
Lookups are reduced to one row per key first (partial aggregation), so a hot
key on the lookup side never multiplies rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cond(left: DataFrame, right: DataFrame, on) -> Column | list[str]:
    """``on`` may be a column name, a list of shared names, a list of
    (left_col, right_col) pairs, a Column or SQL text over both sides."""
    if isinstance(on, Column):
        return on
    if isinstance(on, str):
        if on in left.columns and on in right.columns:
            return [on]
        return F.expr(on)
    on = list(on)
    if all(isinstance(x, str) for x in on):
        return on
    cond = F.lit(True)
    for lc, rc in on:
        cond = cond & (left[lc] == right[rc])
    return cond


def join_inner(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Inner equi-join from a join condition."""
    return left.join(right, _cond(left, right, on), "inner")


def dedupe_lookup(lookup: DataFrame, keys: Sequence[str], take: Sequence[str]) -> DataFrame:
    """One row per lookup key; among duplicates the smallest ``take`` tuple
    wins (deterministic, unlike dropDuplicates). Partial + final aggregation."""
    if not take:
        return lookup.select(*keys).distinct()
    best = F.min(F.struct(*[F.col(c) for c in take])).alias("_v")
    return lookup.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in take])


def join_lookup(df: DataFrame, lookup: DataFrame, on: Sequence[tuple[str, str]] | Sequence[str],
                take: Sequence[str]) -> DataFrame:
    """Left lookup join. ``on`` = [(df_col, lookup_col)] or shared names;
    ``take`` = lookup columns to add. Rows without a match keep NULLs."""
    pairs = [(c, c) if isinstance(c, str) else tuple(c) for c in on]
    rkeys = [r for _, r in pairs]
    lk = dedupe_lookup(lookup, rkeys, take)
    renamed = lk.select(*[F.col(r).alias(f"_lk_{i}") for i, r in enumerate(rkeys)], *take)
    cond = F.lit(True)
    for i, (lcol, _) in enumerate(pairs):
        cond = cond & (df[lcol] == renamed[f"_lk_{i}"])
    out = df.join(renamed, cond, "left")
    return out.drop(*[f"_lk_{i}" for i in range(len(pairs))])


def anti_not_in(df: DataFrame, col: str, list_df: DataFrame, list_col: str) -> DataFrame:
    """Rows where ``col NOT IN (SELECT list_col FROM list_df)`` is TRUE,
    with SQL's null-aware meaning, built so no side has to be broadcast:

    - any NULL in the list  -> no row qualifies;
    - empty list            -> every row qualifies, NULL values included;
    - otherwise             -> non-NULL values absent from the list
                               (a shuffle anti-join, skew split by AQE).
    """
    values = list_df.select(F.col(list_col).alias("_v"))
    list_has_null = values.filter(F.col("_v").isNull()).exists()
    list_nonempty = values.exists()
    present = values.filter(F.col("_v").isNotNull())
    kept = df.join(present, df[col] == present["_v"], "left_anti")
    return kept.filter(~list_has_null & (F.col(col).isNotNull() | ~list_nonempty))


def orphans(child: DataFrame, fk: str | Sequence[str], parent: DataFrame,
            pk: str | Sequence[str]) -> DataFrame:
    """C4 / dbt ``relationships``: child rows whose non-NULL key has no parent."""
    fks = [fk] if isinstance(fk, str) else list(fk)
    pks = [pk] if isinstance(pk, str) else list(pk)
    keys = parent.select(*[F.col(p).alias(f"_pk_{i}") for i, p in enumerate(pks)])
    nonnull = F.lit(True)
    cond = F.lit(True)
    for i, f in enumerate(fks):
        nonnull = nonnull & F.col(f).isNotNull()
        cond = cond & (child[f] == keys[f"_pk_{i}"])
    return child.filter(nonnull).join(keys, cond, "left_anti")


def join_entities(base: DataFrame, others: Iterable[tuple[DataFrame, object]],
                  how: str = "inner") -> DataFrame:
    """Chain equi-joins (e.g. the entities a link connects)."""
    out = base
    for other, on in others:
        out = out.join(other, _cond(out, other, on), how)
    return out


def after_max(df: DataFrame, col: str, existing: DataFrame | None,
              existing_col: str | None = None, inclusive: bool = False) -> DataFrame:
    """Rows later than ``max(existing_col)`` of an existing table, as
    a scalar subquery evaluated once. An empty existing table (NULL max) or
    none at all means "load everything"."""
    if existing is None:
        return df
    mx = existing.select(F.max(existing_col or col)).scalar()
    later = (F.col(col) >= mx) if inclusive else (F.col(col) > mx)
    return df.filter(mx.isNull() | later)
