"""Hash keys and hash diffs (H1, H2) as plain Column expressions.

Keys are upper-case MD5 hex (32 chars) so they pass the vault's own
hash-key-format rule. Text rendering per type is fixed so the same key comes
out of any engine that renders the same text (see ``as_text``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The surrogate-key convention of the public dbt-utils package
# (generate_surrogate_key), which the generated vault models delegate to.
# Columns are rendered as text, NULL replaced by the sentinel, joined by "-".
NULL_SENTINEL = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"

# Scale used to render floating point values when the caller gives none;
# doubles print differently across engines, decimals do not.
DEFAULT_FLOAT_DECIMAL = "decimal(38,9)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c, data_type: T.DataType | None = None) -> Column:
    """Stable text for hashing.

    - float/double -> decimal first (engines disagree on double text)
    - timestamp (session zone) -> UTC wall time, then text
    - timestamp_ntz, date, decimal, integral, string -> plain cast
    - boolean -> 'true' / 'false'
    """
    col = _col(c)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        # NaN and values a decimal cannot hold (infinities, > 1e29) keep their
        # own double text, so nothing raises under ANSI mode and none of them
        # collides with NULL.
        dec = col.try_cast(DEFAULT_FLOAT_DECIMAL)
        return (F.when(col.isNull(), F.lit(None).cast("string"))
                .when(F.isnan(col) | dec.isNull(), col.cast("string"))
                .otherwise(dec.cast("string")))
    if isinstance(data_type, T.TimestampType):
        return F.to_utc_timestamp(col, F.current_timezone()).cast("timestamp_ntz").cast("string")
    return col.cast("string")


def _rendered(cols: Iterable, schema: T.StructType | None) -> list[Column]:
    types: Mapping[str, T.DataType] = {f.name: f.dataType for f in schema.fields} if schema else {}
    out = []
    for c in cols:
        dt = types.get(c) if isinstance(c, str) else None
        out.append(as_text(c, dt))
    return out


def surrogate_key(cols: Iterable, schema: T.StructType | None = None,
                  framed: bool = False) -> Column:
    """H1: upper(md5(concat_ws('-', coalesce(text(c), sentinel), ...))).

    ``framed=True`` prefixes every part with its length, so ('a-b','c') and
    ('a','b-c') no longer collide and NULL differs from any text.
    """
    parts = _rendered(cols, schema)
    if framed:
        pieces = [F.when(p.isNull(), F.lit("~")).otherwise(F.concat(F.length(p).cast("string"), F.lit(":"), p))
                  for p in parts]
        return F.upper(F.md5(F.concat_ws("|", *pieces)))
    return F.upper(F.md5(F.concat_ws(SEPARATOR, *[F.coalesce(p, F.lit(NULL_SENTINEL)) for p in parts])))


def hash_diff(attrs: Iterable, schema: T.StructType | None = None, framed: bool = True) -> Column:
    """H2: a hash over descriptive attributes, in the given fixed order. Framed by
    default: free text often holds the separator, and a change must not vanish."""
    return surrogate_key(list(attrs), schema, framed)
