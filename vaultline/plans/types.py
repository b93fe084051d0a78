"""Free-text metadata types -> Spark types.

Metadata sheets carry types as free text: ``INTEGER``, ``VARCHAR(50)``,
``DECIMAL(10,2)``, ``DATE``, ``int``/``string``/``float`` ... Strings keep
their declared length so a length rule can be derived from it.
"""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Spellings seen in metadata sheets and the Spark type each means.
_SIMPLE = {
    "int": T.IntegerType(), "integer": T.IntegerType(), "smallint": T.ShortType(),
    "tinyint": T.ByteType(), "bigint": T.LongType(), "long": T.LongType(),
    "number": T.DecimalType(38, 0), "numeric": T.DecimalType(38, 0),
    "float": T.FloatType(), "real": T.FloatType(), "double": T.DoubleType(),
    "double precision": T.DoubleType(),
    "string": T.StringType(), "text": T.StringType(), "varchar": T.StringType(),
    "char": T.StringType(), "nvarchar": T.StringType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
    "datetime": T.TimestampNTZType(), "boolean": T.BooleanType(), "bool": T.BooleanType(),
    "binary": T.BinaryType(),
}

_PARAM = re.compile(r"^\s*([a-z_ ]+?)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)\s*$")


def to_spark_type(text: str) -> T.DataType:
    """Parse a metadata type; unknown spellings go through Spark's DDL parser
    and raise if Spark does not know them either."""
    t = (text or "").strip().lower()
    if t in _SIMPLE:
        return _SIMPLE[t]
    m = _PARAM.match(t)
    if m:
        base, p, s = m.group(1), int(m.group(2)), m.group(3)
        if base in ("decimal", "numeric", "number", "dec"):
            return T.DecimalType(p, int(s) if s is not None else 0)
        if base in ("varchar", "char", "nvarchar", "string"):
            return T.StringType()
    try:
        return T._parse_datatype_string(t)
    except Exception as exc:
        raise ValueError(f"unknown data type {text!r}") from exc


def declared_length(text: str) -> int | None:
    """``VARCHAR(50)`` -> 50; anything else -> None."""
    m = _PARAM.match((text or "").strip().lower())
    if m and m.group(1) in ("varchar", "char", "nvarchar", "string") and m.group(3) is None:
        return int(m.group(2))
    return None


def is_string_type(text: str) -> bool:
    t = (text or "").strip().lower()
    return t.startswith(("varchar", "char", "nvarchar", "string", "text"))
