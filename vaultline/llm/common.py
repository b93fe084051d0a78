"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.session import scratch_path

# Word separators of the contracts: space, \t, \n, \v, \f, \r.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared folder and read it back: cuts the
    lineage, survives lost executors, and gives the planner the true size."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_of(text: Column) -> Column:
    """Non-blank runs of ``text``, in order."""
    return F.filter(F.split(text, BLANK_RUN), lambda w: w != "")


def count_chars(text: Column, chars: str) -> Column:
    """How many of the single-byte ``chars`` are in ``text``: bytes that go
    when each is removed."""
    total = F.lit(0).cast("long")
    for c in chars:
        total = total + (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit(""))))
    return total


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Helper column names that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out
