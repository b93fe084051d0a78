"""Order-dependent operators (W1-W3) and union.

``ordered_lag`` is the previous row within a key, built so that a key holding
a large share of all rows is NOT sent whole to one task, which a plain
``Window.partitionBy(key)`` would do:

1. rows are ordered by the order columns and then by a hash of the whole row, a
   total order but for equal rows. A bounded sample of order values gives slice
   bounds at its quantiles, so slices hold about as many rows each whatever the
   values: an outlier (9999-12-31) makes no slice empty, and a burst at one time
   is cut by the next order column or the hash. Bounds are literals, so the slice
   of a row is a pure function of the row (recomputing a lost task gives the
   same answer), and they decide the balance only, never the result;
2. ``lag`` runs inside (key, slice) - a hot key is spread over many groups;
3. the first row of every (key, slice) takes its predecessor from the last
   row of the key's previous non-empty slice: a ``max_by`` aggregate per
   (key, slice) by the same total order (map-side partial, so skew-safe), then
   ``lag`` over the slices of a key (at most ``slices`` rows per key), joined back
   on the (key, slice) struct - the same column the window was partitioned by, so
   the data side is not shuffled again.

NULL order values come first, as in a plain ascending window. Any type that
Spark can order works.

``current_rows`` (latest row per key) is a ``max_by`` aggregate with a map-side
partial step: a hot key is collapsed before the shuffle. Spark plans it as a sort
aggregate where the kept row has variable-length fields (the sort is inside a
task); the alternative, a hash aggregate of the largest order value joined back,
reads and shuffles the rows a second time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Slices by default: one per this many rows, within the bounds.
ROWS_PER_SLICE, LEAST_SLICES, MOST_SLICES = 500_000, 8, 1024
SAMPLE_PER_SLICE = 50   # the sample of order values has about slices times this many rows


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _order_key(df: DataFrame, col: str) -> Column:
    """The column, in a form whose text reads back in the same order: a session-zone
    timestamp's text repeats itself in the hour the clocks go back."""
    return F.unix_micros(F.col(col)) if isinstance(df.schema[col].dataType, T.TimestampType) else F.col(col)


def _sample_bounds(df: DataFrame, order: Sequence[str], slices: int | None) -> list[Column]:
    """Up to ``slices - 1`` ascending order tuples at quantiles of a sample."""
    n = df.count()
    slices = slices or max(LEAST_SLICES, min(MOST_SLICES, n // ROWS_PER_SLICE))
    share = min(1.0, slices * SAMPLE_PER_SLICE / max(n, 1))
    sample = df.select(*[_order_key(df, c).alias(f"o{i}") for i, c in enumerate(order)])
    types = [f.dataType for f in sample.schema.fields]
    if share < 1.0:
        sample = sample.sample(share, seed=7)
    values = sample.orderBy(*sample.columns).select(*[F.col(c).cast("string") for c in sample.columns]).collect()  # about slices * 50
    picked: list[tuple] = []
    for i in range(1, slices):
        row = tuple(values[i * len(values) // slices]) if values else None
        if row is not None and (not picked or picked[-1] != row):
            picked.append(row)
    return [F.struct(*[F.lit(v).cast(t) if v is not None else F.lit(None).cast(t) for v, t in zip(row, types)])
            for row in picked]


def _slice_of(at: Column, bounds: list[Column], low: int = 0) -> Column:
    """Number of bounds at or before ``at``: a binary decision tree."""
    if not bounds:
        return F.lit(low)
    m = len(bounds) // 2
    return (F.when(at >= bounds[m], _slice_of(at, bounds[m + 1:], low + m + 1))
            .otherwise(_slice_of(at, bounds[:m], low)))


def with_slice_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], slices: int | None = None) -> DataFrame:
    """Add ``_grp = struct(keys..., s)``, ``s`` the slice of the order tuple."""
    # Field names do not matter to a comparison; positions do.
    at = F.struct(*[_order_key(df, c) for c in order])
    sl = _slice_of(at, _sample_bounds(df, order, slices))
    return df.withColumn("_grp", F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], sl.cast("long").alias("s")))


def ordered_lag(df: DataFrame, keys, order, values, prefix: str = "prev_",
                skew_safe: bool = True, slices: int | None = None) -> DataFrame:
    """Add ``prefix + v`` = value of ``v`` on the previous row of the same
    key in ``order`` (NULL on a key's first row). Rows that tie in ``order`` are
    ordered by a hash of the row, the same in every run and plan."""
    keys, order, values = _names(keys), _names(order), _names(values)
    base = df.withColumn("_tie", F.xxhash64(*[F.col(c) for c in df.columns]))
    order = [*order, "_tie"]
    if not skew_safe or slices == 1:
        w = Window.partitionBy(*keys).orderBy(*order)
        return base.withColumns({f"{prefix}{v}": F.lag(v).over(w) for v in values}).drop("_tie")

    base = with_slice_groups(base, keys, order, slices)
    w = Window.partitionBy("_grp").orderBy(*order)
    lagged = base.withColumns({
        **{f"{prefix}{v}": F.lag(v).over(w) for v in values},
        "_run_first": F.lag(F.lit(1)).over(w).isNull(),
    })
    # Last row of every (key, slice), aggregated on top of the window's own
    # shuffle (already clustered by _grp, so no new exchange). Naming a
    # window output keeps the window in this branch, so both branches have the
    # same subtree below that shuffle and Spark reuses it instead of computing
    # the input again (results do not depend on the reuse: slices are
    # deterministic). Equal rows tie, and are equal.
    last = lagged.groupBy("_grp").agg(
        F.max_by(F.struct(*[F.col(v).alias(f"v{i}") for i, v in enumerate(values)]),
                 F.struct(*order, ~F.col("_run_first")))
        .alias("_last"))
    keys_of = [F.col(f"_grp.k{i}") for i in range(len(keys))]
    prev = last.select("_grp", F.lag("_last").over(
        Window.partitionBy(*keys_of).orderBy(F.col("_grp.s"))).alias("_pl"))
    joined = lagged.join(prev, "_grp", "left")
    fixed = {f"{prefix}{v}": F.when(F.col("_run_first"), F.col(f"_pl.v{i}")).otherwise(F.col(f"{prefix}{v}"))
             for i, v in enumerate(values)}
    return joined.withColumns(fixed).drop("_grp", "_run_first", "_pl", "_tie")


def changes(df: DataFrame, keys, hash_col: str, order, skew_safe: bool = True) -> DataFrame:
    """Rows whose ``hash_col`` differs from the previous row of the same
    key (the first row of a key always counts). A->B->A keeps all three."""
    lagged = ordered_lag(df, keys, order, [hash_col], prefix="_prev_", skew_safe=skew_safe)
    return lagged.filter(~F.col(hash_col).eqNullSafe(F.col(f"_prev_{hash_col}"))).drop(f"_prev_{hash_col}")


def current_rows(df: DataFrame, keys, order) -> DataFrame:
    """The latest row per key by ``order`` (a full tie-break makes it
    deterministic). ``max_by`` aggregate: partial per task, no sort."""
    keys, order = _names(keys), _names(order)
    others = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*others), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in others])


def union_all_by_name(dfs: Sequence[DataFrame], allow_missing: bool = True) -> DataFrame:
    """UNION ALL by column name; missing columns become NULL."""
    dfs = list(dfs)
    if not dfs:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


