"""Structured Streaming forms of the loads.

S1: a file stream feeds the vault load through ``foreachBatch``; the stream
checkpoint replaces the stored watermark variable. Each micro-batch writes
only its own ``batch_id=<n>`` partition (dynamic overwrite) and compares
against the target *without* that partition, so a batch replayed after a
crash rewrites exactly the same rows: the load is idempotent.

S2: row rules on a streaming DataFrame are plain projections and filters.
Keyed rules (unique, chronology, ...) need state and are refused here:
``keyed_rules.stream_keyed_dq`` keeps it in bucketed tables.

S3: distinct keys. ``stream_distinct_bucketed`` keeps them in hash buckets and
reads only those a micro-batch touches. ``stream_distinct_keys`` compares every micro-batch with the
whole stored key table (S1's path). Both are complete however long the stream runs.
``stream_distinct`` keeps bounded state instead and says what that costs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.functions.hashing import surrogate_key
from vaultline.operators import quality
from vaultline.plans.rules import Rule
from vaultline.session import scratch_path, shuffles_dropped
from vaultline.sources.keyed import Bucketed
from vaultline.sources.snapshots import Snapshots
from vaultline.sources.writers import write_vault_increment


def micro_batches(df: DataFrame, path: str, n: int) -> DataFrame:
    """``df`` as a file stream of ``n`` micro-batches, in no order of keys. A batch has as
    many files as ``df`` is read in parts, so that it is read (and each step on it run) by as many tasks."""
    files = max(1, df.rdd.getNumPartitions())
    with shuffles_dropped(df.sparkSession):
        df.repartition(n * files).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def stream_vault_load(stream_df: DataFrame, build: Callable[[DataFrame], DataFrame], target: str,
                      key_col: str, checkpoint: str, kind: str = "insert_new",
                      available_now: bool = True, processing_time: str | None = None):
    """S1 (action): run ``build`` (e.g. ``vault.hub``) on every micro-batch and
    add the rows the target lacks through ``write_vault_increment`` (the same
    code path as a batch load). ``kind``: ``insert_new`` (hubs, links:
    anti-join on the hash key) or ``sat_changes`` (satellites: changed
    hash_diff against the current row). Returns the finished query when
    ``available_now``, else the running query."""

    def per_batch(batch_df: DataFrame, batch_id: int) -> None:
        write_vault_increment(build(batch_df), target, key_col, batch_id, kind)

    writer = stream_df.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if available_now:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.trigger(processingTime=processing_time or "1 minute").start()


def stream_split(stream_df: DataFrame, rules: Sequence[Rule]) -> quality.Split:
    """E1 + split on a stream; only row rules are allowed."""
    keyed = [r.name for r in rules if r.is_keyed]
    if keyed:
        raise ValueError(f"keyed rules need state: {keyed}; run stream_keyed_dq")
    return quality.split(quality.mark_failures(stream_df, rules), rules)


def stream_dq_load(stream_df: DataFrame, rules: Sequence[Rule], table: str, clean_target: str,
                   quarantine_target: str, checkpoint: str, load_ts, available_now: bool = True,
                   processing_time: str | None = None):
    """S2 with sinks: every micro-batch is marked and written once to scratch,
    and from there to both the clean target and the quarantine store (the
    streaming form of the checked write). A fail_job rule that a row breaks
    raises before either is written. Both writes replace the batch's own
    ``batch_id=`` partition, so a replayed batch replaces its rows. Keyed rules
    are refused as in ``stream_split``; rules that cannot run are refused when
    they were to fail the job."""
    keyed = [r.name for r in rules if r.is_keyed]
    if keyed:
        raise ValueError(f"keyed rules need state: {keyed}; run stream_keyed_dq")

    quality.enforce_runnable(rules, table)

    def per_batch(batch_df: DataFrame, batch_id: int) -> None:
        marked = quality.split(quality.mark_failures(batch_df, rules), rules).marked
        path = scratch_path(batch_df.sparkSession, "stream-marked")
        marked.write.parquet(path)
        s = quality.split_marked(batch_df.sparkSession.read.schema(marked.schema).parquet(path))
        quality.enforce_fail_rules(s, table)
        s.clean.drop(quality.FAILED).write.mode("overwrite").parquet(f"{clean_target.rstrip('/')}/batch_id={batch_id}")
        (quality.to_quarantine_rows(s.quarantine, table, load_ts).drop("table_name").write.mode("overwrite")
         .parquet(f"{quarantine_target.rstrip('/')}/table_name={table}/batch_id={batch_id}"))

    writer = stream_df.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if available_now:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.trigger(processingTime=processing_time or "1 minute").start()


def stream_distinct_keys(stream_df: DataFrame, keys: Sequence[str], target: str, checkpoint: str,
                         available_now: bool = True, processing_time: str | None = None):
    """S3 (action): every distinct key tuple of the stream once, whatever its
    events' times: each micro-batch adds the keys that the stored table lacks.
    NULL is a value. The target has the keys, their hash ``_key`` and ``batch_id``."""
    def build(batch: DataFrame) -> DataFrame:
        found = batch.select(*keys).distinct()
        return found.withColumn("_key", surrogate_key(keys, found.schema, framed=True))
    return stream_vault_load(stream_df, build, target, "_key", checkpoint, "insert_new", available_now, processing_time)


def stream_distinct_bucketed(stream_df: DataFrame, keys: Sequence[str], store: Snapshots, table: str, checkpoint: str,
                             buckets: int = 64, compact_at: int = 8, available_now: bool = True,
                             processing_time: str | None = None):
    """S3 (action): every distinct key tuple of the stream once, in table
    ``table`` of ``store``. A micro-batch looks its keys up in their buckets and appends the new
    ones; a bucket of ``compact_at`` folders becomes one again, so the folders read per bucket
    stay level. A replay finds all its keys there and adds none. NULL is a value."""
    def per_batch(batch_df: DataFrame, batch_id: int) -> None:
        Bucketed(store, table, keys, buckets).insert(batch_df.select(*keys).distinct(), compact_at=compact_at)

    writer = stream_df.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if available_now:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.trigger(processingTime=processing_time or "1 minute").start()


def stream_distinct(stream_df: DataFrame, keys: Sequence[str], ts_col: str, delay: str) -> DataFrame:
    """One row per key among events at most ``delay`` apart, in bounded state: a
    key comes again once its events are further apart, and events later than
    ``delay`` are dropped. For complete distinct keys use
    ``stream_distinct_keys``. ``withWatermark`` needs a session-zone TIMESTAMP,
    so a TIMESTAMP_NTZ column is cast first."""
    wm_col = f"_{ts_col}_wm"
    return (stream_df.withColumn(wm_col, F.col(ts_col).cast("timestamp"))
            .withWatermark(wm_col, delay)
            .dropDuplicatesWithinWatermark(list(keys))
            .drop(wm_col))


def run_available(df: DataFrame, target: str, checkpoint: str, fmt: str = "parquet"):
    """Drain everything available into a file sink (append) and stop."""
    q = (df.writeStream.format(fmt).option("path", target).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q
