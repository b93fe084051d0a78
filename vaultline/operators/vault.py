"""Data Vault 2.0 loads (F1-F5) and their incremental forms.

Shapes:
  hub       = hub_<name>_key, <business key cols>, load_datetime, record_source
  link      = link_<name>_key, hub_<a>_key, hub_<b>_key, ..., load_datetime, record_source
  satellite = hub_<name>_key, hash_diff, <attributes>, load_datetime, record_source

Scale notes: hub/link/satellite de-duplication is a hash aggregate with a
map-side partial step, so a business key holding a third of all rows is
collapsed before the shuffle. Hashes are computed after de-duplication
(fewer MD5 calls). Incremental loads anti-join on the hash key, whose values
are uniformly spread, and compare a batch only with the *current* satellite
row per key (``max_by`` aggregate), never with all history.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.functions.hashing import hash_diff, surrogate_key
from vaultline.operators.ordered import current_rows, ordered_lag
from vaultline.operators.transform import audit_columns, cast_columns, cleanse_strings, require_keys

# Column names of the vault row shapes.
TS, SRC, HD = "load_datetime", "record_source", "hash_diff"


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def hub_key_name(name: str) -> str:
    return f"hub_{name.lower()}_key"


def staging(source: DataFrame, columns: Mapping[str, str] | Sequence[str],
            casts: Mapping[str, str] | None = None, cleanse: bool = True,
            hash_keys: Mapping[str, Sequence[str]] | None = None,
            hash_diffs: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """select (and rename) source columns early so later hashes and
    shuffles carry only what the vault needs; cast to declared types; trim
    strings with blank -> NULL; optionally add hash keys / hash diffs.
    Failed casts are listed in ``cast_failures`` when ``casts`` is given."""
    if isinstance(columns, Mapping):
        out = source.select(*[(F.col(src) if src in source.columns else F.expr(src)).alias(tgt)
                              for tgt, src in columns.items()])
    else:
        out = source.select(*columns)
    if cleanse:
        out = cleanse_strings(out)
    if casts:
        out = cast_columns(out, casts)
    for name, cols in (hash_keys or {}).items():
        out = out.withColumn(name, surrogate_key(cols, out.schema))
    for name, cols in (hash_diffs or {}).items():
        out = out.withColumn(name, hash_diff(cols, out.schema))
    return out


def hub(stg: DataFrame, key_cols, name: str, load_ts, record_source: str,
        key_col: str | None = None, framed: bool = False) -> DataFrame:
    """distinct non-NULL business keys + hash key + audit columns. ``framed``
    keys cannot collide across the columns of a composite key; the default is
    the public convention, which other tools reproduce. Use one form per vault."""
    keys = _names(key_cols)
    hk = key_col or hub_key_name(name)
    distinct = require_keys(stg.select(*keys), keys).distinct()
    hashed = distinct.select(surrogate_key(keys, distinct.schema, framed).alias(hk), *keys)
    return audit_columns(hashed, load_ts, record_source)


def link(stg: DataFrame, hubs: Mapping[str, Sequence[str]], name: str, load_ts, record_source: str,
         key_col: str | None = None, framed: bool = False) -> DataFrame:
    """one row per distinct combination of the hubs' business keys (rows
    with any NULL key dropped); a hash key per hub and one over all keys."""
    all_cols: list[str] = []
    for cols in hubs.values():
        all_cols += [c for c in _names(cols) if c not in all_cols]
    distinct = require_keys(stg.select(*all_cols), all_cols).distinct()
    lk = key_col or f"link_{name.lower()}_key"
    hub_keys = [surrogate_key(_names(cols), distinct.schema, framed).alias(hub_key_name(h)) for h, cols in hubs.items()]
    hashed = distinct.select(surrogate_key(all_cols, distinct.schema, framed).alias(lk), *hub_keys)
    return audit_columns(hashed, load_ts, record_source)


def satellite(stg: DataFrame, key_cols, attrs: Sequence[str], name: str, load_ts, record_source: str,
              key_col: str | None = None, framed: bool = False) -> DataFrame:
    """hub key + hash_diff over ``attrs`` (fixed order) + attributes,
    one row per distinct (key, attribute values)."""
    keys, attrs = _names(key_cols), list(attrs)
    hk = key_col or hub_key_name(name)
    distinct = require_keys(stg.select(*keys, *attrs), keys).distinct()
    out = distinct.select(surrogate_key(keys, distinct.schema, framed).alias(hk),
                          hash_diff(attrs, distinct.schema).alias(HD), *attrs)
    return audit_columns(out, load_ts, record_source)


def satellite_history(df: DataFrame, key_cols, attrs: Sequence[str], ts_col: str, name: str,
                      record_source: str, tie_cols: Sequence[str] = (), key_col: str | None = None,
                      skew_safe: bool = True) -> DataFrame:
    """Satellite rows from time-stamped source rows: a row is kept
    when its hash_diff differs from the previous row of the same key ordered
    by (``ts_col``, ``tie_cols``); load_datetime = the row's own time."""
    keys, attrs = _names(key_cols), list(attrs)
    hk = key_col or hub_key_name(name)
    base = require_keys(df.select(*keys, *attrs, ts_col, *[t for t in tie_cols if t not in keys + attrs]), keys)
    base = base.withColumn(HD, hash_diff(attrs, base.schema))
    # Ordered by the business key itself; the hub key is hashed only for
    # the rows that survive (changes), not for every source row.
    lagged = ordered_lag(base, keys, [ts_col, *tie_cols], [HD], prefix="_prev_", skew_safe=skew_safe)
    changed = lagged.filter(~F.col(HD).eqNullSafe(F.col(f"_prev_{HD}")))
    return changed.select(surrogate_key(keys, base.schema).alias(hk), HD, *attrs, F.col(ts_col).alias(TS),
                          F.lit(record_source).alias(SRC))


# ------------------------------------------------------------ incremental

def touched(existing: DataFrame, batch: DataFrame, key_col: str) -> DataFrame:
    """Rows of the (large) stored table whose key occurs in the (usually
    small) batch: a semi-join with the batch's distinct keys on the build
    side, which the planner may broadcast when it is small - so the stored
    table is scanned (key column first) but not shuffled. A large batch
    falls back to a sort-merge join."""
    keys = batch.select(key_col).distinct()
    return existing.join(keys, key_col, "left_semi")


def new_hub_rows(batch: DataFrame, existing: DataFrame | None, key_col: str) -> DataFrame:
    """Hub rows whose hash key is not yet in the hub (insert-only, so a
    key's first load time is never overwritten). Idempotent: loading the same
    batch twice adds nothing the second time. One anti-join on the key column
    alone; with a hub bucketed by its key, its side needs no exchange."""
    if existing is None:
        return batch
    return batch.join(existing.select(key_col), key_col, "left_anti")


def new_link_rows(batch: DataFrame, existing: DataFrame | None, key_col: str) -> DataFrame:
    """As I1, on the link hash key."""
    return new_hub_rows(batch, existing, key_col)


def changed_sat_rows(batch: DataFrame, existing: DataFrame | None, key_col: str,
                     order: Sequence[str] = (TS,), skew_safe: bool = True) -> DataFrame:
    """Satellite rows to insert: those that differ from the version before
    them in the key's history (stored and batch rows together, by ``order``, then
    hash_diff, stored rows first). Late and same-time versions take their place
    in the history; consecutive equal versions collapse to the first, so
    intermediate changes and A->B->A survive; a version that is already stored
    follows itself and is not inserted again, so replaying a batch adds nothing."""
    order = list(order)
    rows = batch.withColumn("_stored", F.lit(1))
    if existing is not None:
        # Only the history of the keys the batch touches, and only what orders and tells versions apart.
        history = touched(existing.select(key_col, HD, *order), batch, key_col).withColumn("_stored", F.lit(0))
        rows = rows.unionByName(history, allowMissingColumns=True)
    lagged = ordered_lag(rows, [key_col], [*order, HD, "_stored"], [HD], prefix="_prev_", skew_safe=skew_safe)
    keep = (F.col("_stored") == 1) & ~F.col(HD).eqNullSafe(F.col(f"_prev_{HD}"))
    return lagged.filter(keep).select(*batch.columns)


def upsert_by_key(batch: DataFrame, existing: DataFrame | None, keys, order: Sequence[str] | None = None) -> DataFrame:
    """I4: new table = latest batch row per key  UNION ALL  existing rows
    whose key is not in the batch. Write it to a new location (never over
    its own input)."""
    keys = _names(keys)
    latest = current_rows(batch, keys, list(order)) if order else batch
    if existing is None:
        return latest
    kept = existing.join(latest.select(*keys), keys, "left_anti")
    return kept.unionByName(latest.select(*existing.columns))
