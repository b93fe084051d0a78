"""Writers (A6-A9, A11, E9).

Plain parquet tables; a Delta/Iceberg format works through ``fmt`` where the
connector is on the classpath. Writing over the path a DataFrame reads from
fails part-way in Spark, so ``write_versioned`` writes to a fresh version
folder and returns it for the caller to switch to.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.operators import vault
from vaultline.operators.aggregate import count_valid
from vaultline.operators.incremental import path_exists
from vaultline.operators.quality import FAILED, Split, enforce_fail_rules, split_marked, to_quarantine_rows
from vaultline.session import scratch_path
from vaultline.sources.snapshots import Snapshots


def write_overwrite(df: DataFrame, target: str, fmt: str = "parquet") -> str:
    """A6/A8."""
    df.write.mode("overwrite").format(fmt).save(target)
    return target


def write_append(df: DataFrame, target: str, fmt: str = "parquet") -> str:
    """Append (quarantine, failures, state). Read back with
    ``mergeSchema`` when appended batches differ in columns."""
    df.write.mode("append").format(fmt).save(target)
    return target


def write_partitioned(df: DataFrame, target: str, partition_cols: Sequence[str], mode: str = "overwrite",
                      fmt: str = "parquet", replace_all: bool = False, rebalance: bool = False) -> str:
    """Partitioned by the metadata's partition keys. Overwrite is
    dynamic (only the partitions present in ``df`` are replaced) unless
    ``replace_all``: then partitions that ``df`` no longer has go too.

    ``rebalance`` gathers the rows of a partition first, so a partition has few
    files instead of one per task; adaptive execution splits one that is larger
    than its target size (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) and
    joins small ones, so a partition with half of all rows is no single task."""
    if rebalance:
        df = df.hint("rebalance", *partition_cols)
    (df.write.mode(mode).format(fmt).option("partitionOverwriteMode", "static" if replace_all else "dynamic")
     .partitionBy(*partition_cols).save(target))
    return target


def read_partitioned(spark: SparkSession, target: str, schema, fmt: str = "parquet") -> DataFrame:
    """A9 read back with the declared types: a partition value '007' stays
    text instead of being guessed to be the number 7."""
    return spark.read.format(fmt).schema(schema).load(target)


def write_versioned(df: DataFrame, base: str, fmt: str = "parquet") -> str:
    """Write to ``base/v=<new id>`` and return that path (safe replacement for
    overwriting a table that ``df`` itself reads)."""
    path = f"{base.rstrip('/')}/v={uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").format(fmt).save(path)
    return path


def store_failures(failures: DataFrame, target: str, run_id: str, rule: str, table_name: str,
                   fmt: str = "parquet") -> str:
    """Append failing rows with ``rule, table_name, run_id`` (rows as
    JSON text so tables with different schemas share one store)."""
    data_cols = failures.columns
    rows = failures.select(F.lit(table_name).alias("table_name"), F.lit(rule).alias("rule"),
                           F.lit(run_id).alias("run_id"),
                           F.to_json(F.struct(*data_cols)).alias("row_json"))
    # One partition per (run, table, rule), dynamically overwritten: a rerun
    # of the same run replaces its rows instead of appending them twice.
    return write_partitioned(rows, target, ["run_id", "table_name", "rule"], "overwrite", fmt)


def write_checked(s: Split, target: str, quarantine_target: str | None, table: str,
                  expected: int | None, load_ts, fmt: str = "parquet", mode: str = "overwrite",
                  partition_cols: Sequence[str] = (), batch: str | None = None, replace_all: bool = True,
                  load_batch: str | None = None, store: Snapshots | None = None) -> dict:
    """E9 (action): fail_job rules first (nothing written if one failed);
    then the clean rows are written, with their declared columns only, if their
    count is valid (count > expected). The quarantine's ``table_name/load_batch``
    partition (``batch``, default the load time) is replaced by this run's
    rejects, also by none. ``load_batch`` names the target partition of an
    incremental batch; without ``replace_all`` other partitions stay. With a
    ``store`` the clean rows are staged there as a new version of the table
    ``target`` and the report's ``entry`` is what to commit: readers keep the old
    rows until then, whatever happens in between.

    The marked rows are written once to the shared scratch folder and every
    view reads them from there: the source is computed once, and a lost
    executor loses nothing."""
    spark = s.marked.sparkSession
    path = scratch_path(spark, "marked")
    s.marked.write.mode("overwrite").parquet(path)
    s = split_marked(spark.read.schema(s.marked.schema).parquet(path))
    enforce_fail_rules(s, table)
    clean = s.clean.drop(FAILED)
    if load_batch is not None:
        clean, partition_cols = clean.withColumn("load_batch", F.lit(load_batch)), [*partition_cols, "load_batch"]
    n, valid = count_valid(clean, expected)
    logged = s.clean.filter(F.size(FAILED) > 0).count()
    entry = None
    if valid:
        if store is not None:
            entry = store.stage(target, clean, partition_cols)
        elif partition_cols:
            write_partitioned(clean, target, partition_cols, mode, fmt, replace_all)
        else:
            clean.write.mode(mode).format(fmt).save(target)
    q = s.quarantine.count()
    if quarantine_target is not None:
        label = batch if batch is not None else "".join(ch if ch.isalnum() else "_" for ch in str(load_ts))
        (to_quarantine_rows(s.quarantine, table, load_ts).drop("table_name").write.mode("overwrite").format(fmt)
         .save(f"{quarantine_target.rstrip('/')}/table_name={table}/load_batch={label}"))
    report = {"table": table, "clean_rows": n, "valid": valid, "quarantined": q, "logged": logged}
    return report if store is None else {**report, "entry": entry}


def _folder_value(label: str) -> str:
    """A label as a partition folder spells it (Spark reads it back unescaped)."""
    return "".join(c if c.isalnum() or c in "-_." or not c.isascii() else f"%{ord(c):02X}" for c in label)


def read_batches(spark: SparkSession, target: str, batch_col: str = "batch_id", fmt: str = "parquet") -> DataFrame:
    """A table written batch by batch, with the labels as they were given: '007'
    and '1.0' stay text instead of being guessed to be numbers."""
    found = spark.read.format(fmt).load(target)
    if batch_col not in found.columns:
        raise ValueError(f"{target} has no column {batch_col!r}: it was not written batch by batch")
    fields = [f for f in found.schema.fields if f.name != batch_col] + [T.StructField(batch_col, T.StringType())]
    return spark.read.format(fmt).schema(T.StructType(fields)).load(target)


def write_vault_increment(new_rows: DataFrame, target: str, key_col: str, batch, kind: str = "insert_new",
                          batch_col: str = "batch_id", fmt: str = "parquet") -> DataFrame:
    """I1-I3 as a table load (what an incremental vault model run does):
    compare ``new_rows`` (a built hub/link/satellite batch) with the stored
    target *without* this batch's own partition, keep what is new
    (``insert_new``: hash key not present; ``sat_changes``: differs from the
    version before it in the key's history), and write it to
    ``<batch_col>=<batch>`` with dynamic overwrite. Replaying the same batch
    rewrites the same partition, so a crash anywhere leaves no duplicates. Only
    an absent target is an empty one: any other trouble raises. Returns the rows
    that were written."""
    spark, label = new_rows.sparkSession, str(batch)
    if not label:
        raise ValueError("a batch needs a label")
    existing = None
    if path_exists(spark, target):
        existing = read_batches(spark, target, batch_col, fmt)
        existing = existing.filter(F.col(batch_col) != F.lit(label))
    if kind == "sat_changes":
        rows = vault.changed_sat_rows(new_rows, existing, key_col)
    elif kind == "insert_new":
        rows = vault.new_hub_rows(new_rows, existing, key_col)
    else:
        raise ValueError(f"unknown increment kind {kind!r}")
    part = f"{target.rstrip('/')}/{batch_col}={_folder_value(label)}"
    # This batch's own partition alone is replaced, also by no rows.
    rows.write.mode("overwrite").format(fmt).save(part)
    return spark.read.format(fmt).schema(rows.schema).load(part)
