"""Row-level data-quality predicates (Q1, Q3-Q9, Q11-Q14 row parts).

Every builder returns a Column that is TRUE when the row FAILS the rule.
Three-valued logic: a predicate that evaluates to NULL passes, except for the
rules that are about NULL (not_null, hash-key format, blank checks).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: hash keys are 32 upper-case hex characters (upper MD5).
HASH_KEY_PATTERN = "^[A-F0-9]+$"
HASH_KEY_LENGTH = 32


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fails(pred: Column) -> Column:
    """Fail only when the predicate is definitely false."""
    return ~F.coalesce(pred, F.lit(True))


def not_null(c) -> Column:
    return _col(c).isNull()


def in_range(c, lo, hi) -> Column:
    """range(lo, hi), both ends inclusive; either bound may be None (open)."""
    col = _col(c)
    pred = F.lit(True)
    if lo is not None:
        pred = pred & (col >= F.lit(lo))
    if hi is not None:
        pred = pred & (col <= F.lit(hi))
    return _fails(pred)


def accepted(c, values: Iterable) -> Column:
    return _fails(_col(c).isin(list(values)))


def matches(c, pattern: str) -> Column:
    """regex / pattern: a search (find anywhere), as rlike does."""
    return _fails(_col(c).cast("string").rlike(pattern))


def max_length(c, n: int) -> Column:
    return _fails(F.length(_col(c)) <= F.lit(int(n)))


def min_length(c, n: int) -> Column:
    return _fails(F.length(_col(c)) >= F.lit(int(n)))


def length_between(c, lo: int, hi: int) -> Column:
    return _fails(F.length(_col(c)).between(int(lo), int(hi)))


def is_true(expr_sql: str) -> Column:
    """expression_is_true: the SQL text must hold (NULL passes)."""
    return _fails(F.expr(expr_sql))


def blank(c) -> Column:
    """NULL or only whitespace, after rendering as text (hub integrity)."""
    col = _col(c).cast("string")
    return col.isNull() | (F.trim(col) == F.lit(""))


def hash_key_format(c) -> Column:
    """Q11: NULL, length other than 32, or not upper-case hex."""
    col = _col(c)
    return col.isNull() | (F.length(col) != HASH_KEY_LENGTH) | ~col.rlike(HASH_KEY_PATTERN)


def any_null(cols: Iterable) -> Column:
    """Q13: any of the given columns is NULL."""
    out = F.lit(False)
    for c in cols:
        out = out | _col(c).isNull()
    return out
