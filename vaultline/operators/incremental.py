"""High-watermark incremental loads (M1-M3).

State is a small table: one row per table and load, in order (``seq``). A load
fixes its upper bound first, writes its data to a ``load_batch=`` partition
named after the state it started from, then the hashes of the rows on the bound,
then its state row. A crash in between replays into the same partitions.

Rows that share the stored maximum but arrive later, and rows whose watermark
is NULL, cannot be told from loaded ones by the watermark. Their row hashes are
kept with counts (``<state>_edges``), so each such row is loaded exactly once.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE_SCHEMA = ("table_name string, watermark_column string, watermark string, "
                "batch_id string, loaded_rows bigint, load_mode string, seq bigint")
EDGE_SCHEMA = "row_hash string, watermark string, n bigint, seq bigint, table_name string, load_batch string"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there; any other trouble (rights, network) raises."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _typed_literal(df: DataFrame, col: str, value):
    """The watermark as a literal of the column's own type, so the filter
    compares the raw column and is pushed into the scan."""
    return F.lit(value).cast(df.schema[col].dataType)


def after_watermark(df: DataFrame, col: str, wm, inclusive: bool = False) -> DataFrame:
    """M1: rows past the stored watermark; ``wm=None`` (first load) -> all.
    ``inclusive=True`` uses ``>=``; pair it with a key anti-join to pick up
    rows that share the maximum but arrived later."""
    if wm is None:
        return df
    lit = _typed_literal(df, col, wm)
    return df.filter(F.col(col) >= lit if inclusive else F.col(col) > lit)


def after_watermark_with_ties(df: DataFrame, col: str, wm, loaded: DataFrame | None, keys) -> DataFrame:
    """M1 without losing late ties: rows with ``col >= wm`` except those
    whose key was already loaded AT the watermark value. Only the boundary
    rows of ``loaded`` (``col == wm``) take part in the anti-join, so that
    side stays small however large the loaded table is."""
    if wm is None:
        return df
    keys = [keys] if isinstance(keys, str) else list(keys)
    lit = _typed_literal(df, col, wm)
    candidates = df.filter(F.col(col) >= lit)
    if loaded is None:
        return candidates
    boundary = loaded.filter(F.col(col) == _typed_literal(loaded, col, wm)).select(*keys).distinct()
    return candidates.join(boundary, keys, "left_anti")


def advance(batch: DataFrame, table: str, col: str, previous, batch_id: str | None = None) -> DataFrame:
    """M2 (lazy): one state row. The new watermark is the batch maximum, but
    never lower than ``previous``; an empty batch keeps ``previous``."""
    prev = F.lit(previous).cast(batch.schema[col].dataType) if previous is not None else None
    mx = F.max(col)
    new = F.greatest(mx, prev) if prev is not None else mx
    if prev is not None:
        new = F.coalesce(new, prev)
    return batch.agg(F.lit(table).alias("table_name"), F.lit(col).alias("watermark_column"),
                     new.cast("string").alias("watermark"),
                     F.lit(batch_id).cast("string").alias("batch_id"),
                     F.count(F.lit(1)).alias("loaded_rows"))


def read_state(spark: SparkSession, state_path: str, table: str, data_type=None):
    """(watermark, next sequence number, sequence number of the last full load)
    of ``table``. The watermark is compared in the column's own type when
    ``data_type`` is given (text order would put '9' after '10') and counts from
    the last full load on. Only an absent state table means a first load."""
    if not path_exists(spark, state_path):
        return None, 0, 0
    state = spark.read.schema(STATE_SCHEMA).parquet(state_path).filter(F.col("table_name") == table)
    seq = F.coalesce("seq", F.lit(0))
    n, full = state.agg(F.count(F.lit(1)), F.coalesce(F.max(F.when(F.col("load_mode") == "full", seq)), F.lit(0))).first()
    w = F.col("watermark").cast(data_type) if data_type is not None else F.col("watermark")
    return state.filter(seq >= full).agg(F.max(w)).first()[0], n, full


def read_watermark(spark: SparkSession, state_path: str, table: str, data_type=None):
    """Latest watermark of ``table`` from the state table, None when absent."""
    return read_state(spark, state_path, table, data_type)[0]


def advance_watermark(spark: SparkSession, state_path: str, table: str, batch: DataFrame, col: str,
                      batch_id: str | None = None) -> str | None:
    """M2 (action): append the new state row after the data write succeeded."""
    dt = batch.schema[col].dataType
    prev, seq, _ = read_state(spark, state_path, table, dt)
    row = (advance(batch, table, col, prev, batch_id)
           .withColumn("load_mode", F.lit("incremental")).withColumn("seq", F.lit(seq).cast("bigint")))
    row.write.mode("append").parquet(state_path)
    return read_watermark(spark, state_path, table, dt)


LOAD_BATCH = "load_batch"


def batch_label(previous_watermark, seq: int = 0) -> str:
    """Partition value of a batch: the state it started from. A replay after a
    crash starts from the same state and rewrites the same partition; the next
    batch starts from another one, even when the watermark has not moved."""
    if previous_watermark is None and not seq:
        return "initial"
    return f"{seq:06d}_" + "".join(ch if ch.isalnum() else "_" for ch in str(previous_watermark))


class Batch(NamedTuple):
    rows: DataFrame            # what this load takes, lazy
    upper: str | None          # its bound, as Spark writes it; None: only NULL watermarks
    count: int
    nulls: int                 # rows without a watermark among them
    label: str
    seq: int
    first: bool                # no state yet: the load stands for the whole source
    hashes: DataFrame          # (row_hash, watermark, n) of the rows on the bound or without one


def _row_hash(df: DataFrame):
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}), 256)


def _unseen(rows: DataFrame, seen: DataFrame) -> DataFrame:
    """``rows`` less those in ``seen`` (row_hash, n), as multisets: equal rows
    are counted before they move, so a hot row is one row in the join."""
    counted = (rows.groupBy(_row_hash(rows).alias("_hash"))
               .agg(F.first(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("_row"), F.count(F.lit(1)).alias("_n")))
    known = seen.groupBy(F.col("row_hash").alias("_hash")).agg(F.sum("n").alias("_known"))
    left = (counted.join(known, "_hash", "left").withColumn("_new", (F.col("_n") - F.coalesce("_known", F.lit(0))).cast("int"))
            .filter("_new > 0").select(F.explode(F.sequence(F.lit(1), F.col("_new"))), "_row"))
    return left.select("_row.*")


def plan_batch(df: DataFrame, col: str, state_path: str, table: str) -> Batch | None:
    """The next load of ``df``: rows past the watermark up to a bound fixed now,
    plus late rows at the watermark and rows without one. None: nothing new."""
    spark = df.sparkSession
    dt = df.schema[col].dataType
    wm, seq, full = read_state(spark, state_path, table, dt)
    pending = df
    if seq:
        at = F.col(col).isNull() if wm is None else F.col(col).isNull() | (F.col(col) == _typed_literal(df, col, wm))
        edges_path = state_path.rstrip("/") + "_edges"
        seen = (spark.read.schema(EDGE_SCHEMA).parquet(edges_path) if path_exists(spark, edges_path)
                else spark.createDataFrame([], EDGE_SCHEMA))
        # Only hashes of committed loads since the last full one count.
        seen = seen.filter((F.col("table_name") == table) & (F.col("seq") >= full) & (F.col("seq") < seq))
        past = df.filter(F.col(col).isNotNull()) if wm is None else after_watermark(df, col, wm)
        pending = past.unionByName(_unseen(df.filter(at), seen.filter(
            F.col("watermark").isNull() if wm is None else
            F.col("watermark").isNull() | (F.col("watermark").cast(dt) == _typed_literal(df, col, wm)))))
    upper, count, nulls = pending.agg(F.max(col).cast("string"), F.count(F.lit(1)), F.count_if(F.col(col).isNull())).first()
    if not count:
        return None
    inside = F.col(col).isNull() if upper is None else F.col(col).isNull() | (F.col(col) <= F.lit(upper).cast(dt))
    rows = pending.filter(inside)
    edge = F.col(col).isNull() if upper is None else F.col(col).isNull() | (F.col(col) == F.lit(upper).cast(dt))
    hashes = (rows.filter(edge).select(_row_hash(rows).alias("row_hash"), F.col(col).cast("string").alias("watermark"))
              .groupBy("row_hash", "watermark").agg(F.count(F.lit(1)).alias("n")))
    return Batch(rows, upper, count, nulls, batch_label(wm, seq), seq, not seq, hashes)


def write_hashes(batch: Batch, state_path: str, table: str) -> None:
    """The bound's row hashes, before the data (their source rows are read the
    same way); they count only once the state row is there."""
    (batch.hashes.withColumn("seq", F.lit(batch.seq).cast("bigint")).withColumn("table_name", F.lit(table))
     .withColumn(LOAD_BATCH, F.lit(batch.label)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("table_name", LOAD_BATCH).parquet(state_path.rstrip("/") + "_edges"))


def commit(spark: SparkSession, state_path: str, table: str, col: str, upper: str | None, seq: int, rows: int,
           batch_id: str | None, mode: str = "incremental") -> None:
    state = spark.createDataFrame([(table, col, upper, batch_id, rows, mode, seq)], STATE_SCHEMA)
    state.coalesce(1).write.mode("append").parquet(state_path)


def check_first(spark: SparkSession, target: str, fmt: str = "parquet") -> None:
    """A load without state replaces the target; refuse when the target holds
    batches of loads whose state is missing."""
    if not path_exists(spark, target):
        return
    found = spark.read.format(fmt).load(target)
    if LOAD_BATCH in found.columns and found.filter(~F.col(LOAD_BATCH).cast("string").isin("initial", "full")).take(1):
        raise ValueError(f"{target} holds incremental batches but their state is missing")


def load(df: DataFrame, mode: str, target: str, state_path: str | None = None,
         watermark_column: str | None = None, table: str | None = None,
         batch_id: str | None = None, fmt: str = "parquet") -> DataFrame:
    """M3 (action): ``full`` replaces the target (one ``load_batch=full``
    partition, the layout of incremental loads) and, given a state table, records
    its watermark; ``incremental`` loads what :func:`plan_batch` finds. Returns
    the rows written."""
    mode = (mode or "full").strip().lower()
    spark = df.sparkSession
    tracked = state_path and watermark_column and table
    if mode.startswith("full"):
        label, seq, upper = "full", 0, None
        if tracked:
            _, seq, _ = read_state(spark, state_path, table)
            upper = df.agg(F.max(watermark_column).cast("string")).first()[0]
            if upper is not None:  # later rows of a growing source belong to the next load
                df = df.filter(F.col(watermark_column).isNull()
                               | (F.col(watermark_column) <= F.lit(upper).cast(df.schema[watermark_column].dataType)))
            on = F.col(watermark_column).cast("string")
            hashes = (df.filter(on.isNull() | (on == F.lit(upper))).select(_row_hash(df).alias("row_hash"), on.alias("watermark"))
                      .groupBy("row_hash", "watermark").agg(F.count(F.lit(1)).alias("n")))
            label = f"full_{seq:06d}"
            write_hashes(Batch(df, upper, 0, 0, label, seq, True, hashes), state_path, table)
        _write_batch(df, target, "full", fmt, replace=True)
        if tracked:
            commit(spark, state_path, table, watermark_column, upper, seq, None, batch_id, "full")
        return spark.read.format(fmt).load(target).drop(LOAD_BATCH)
    if not tracked:
        raise ValueError("incremental load needs state_path, watermark_column and table")
    batch = plan_batch(df, watermark_column, state_path, table)
    if batch is None:               # nothing new: state unchanged
        return df.limit(0)
    if batch.first:
        check_first(spark, target, fmt)
    write_hashes(batch, state_path, table)
    _write_batch(batch.rows, target, batch.label, fmt, replace=batch.first)
    commit(spark, state_path, table, watermark_column, batch.upper, batch.seq, batch.count, batch_id)
    return spark.read.format(fmt).load(target).filter(F.col(LOAD_BATCH) == batch.label).drop(LOAD_BATCH)


def _write_batch(rows: DataFrame, target: str, label: str, fmt: str, replace: bool) -> None:
    (rows.withColumn(LOAD_BATCH, F.lit(label)).write.mode("overwrite")
     .option("partitionOverwriteMode", "static" if replace else "dynamic").partitionBy(LOAD_BATCH).format(fmt).save(target))
