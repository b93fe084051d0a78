"""Keyed rules on a stream (S2): ``unique``, ``unique_combination`` and
``chronology`` over all micro-batches, equal to the batch rules over all rows.

Rows are compared in groups: equal keys for the unique rules, equal key and load
time for chronology (a row fails that rule when the row before it has its time).
Per group a bucketed table keeps how many rows came and which is first; rows
themselves are not kept and earlier ones never read again. A micro-batch reads
only the buckets that its groups fall into and appends its groups to them: a
group's entries are summed up when they are read, and a bucket of ``compact_at``
folders becomes one again. Buckets are looked at a run of ``RUN_BYTES`` at a time,
so what is shuffled does not grow with the stored groups.

What a later batch can change is defined: a row that passed may come to fail (its
key comes again, or a row of the same time that sorts before it comes late), and
a row that failed never passes. Such a row is reported by the batch that made it
fail, as ``late``. Rows of any event time are taken; nothing is dropped.

Under ``target``: ``rows`` and ``failures``, a folder per micro-batch, and
``state``, whose commit carries the group tables of all rules and the number of
the last micro-batch. Readers see batches up to that number, so a batch that
died on the way is not seen, and its replay writes the same folders again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.operators import quality
from vaultline.plans.rules import Rule, named
from vaultline.session import scratch_path, shuffles_dropped
from vaultline.sources.keyed import BUCKET, Bucketed
from vaultline.sources.snapshots import Snapshots

ROW, CURSOR = "_row", "cursor"
GROUPED = ("unique", "unique_combination", "chronology")
# A row's id is the number of its micro-batch and its number there; ``read_failures`` gives it as text.
FAILURES = "of long, at long, rule string, late boolean"
LAYOUT = 2  # of what lies under ``target``: 1 had ids as text, and whole groups in each commit
RUN_BYTES = 256 << 20


def _grouping(rule: Rule, columns: Sequence[str]) -> tuple[list[str], list[Column]]:
    """(columns that rows are grouped by, order of the rows in a group)."""
    if rule.kind == "chronology":
        # Tie columns, then a hash of the row. Where rows differ that the tie columns do not order, the batch rule may
        # pick another one of them (its hash covers its helper columns); as many fail.
        return [rule.column, rule.args[0]], [*[F.col(c) for c in rule.args[1:]], F.xxhash64(*[F.col(f"`{c}`") for c in columns])]
    return ([rule.column] if rule.kind == "unique" else list(rule.args)), []


def _written(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    df.write.mode(mode).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _runs(store: Snapshots, paths: Mapping[int, Sequence[str]]) -> list[list[int]]:
    """The buckets in runs of at most ``RUN_BYTES`` stored (or of one bucket)."""
    runs, room = [], 0
    for b in sorted(paths):
        held = store.size(paths[b])
        if not runs or held > room:
            runs.append([])
            room = RUN_BYTES
        runs[-1].append(b)
        room -= held
    return runs


def _summed(entries: DataFrame, keys: Sequence[str], ordered: bool, now: Column | None = None) -> DataFrame:
    """One row a group of ``entries``: how many rows came, which is first. With ``now`` (is the entry of this
    micro-batch?) also whether any is, and the same of the earlier ones."""
    def total(which: Column | None) -> list[Column]:
        of = lambda c: F.col(c) if which is None else F.when(which, F.col(c))
        # Without an order the first row counts only while it is alone: its two numbers need not be kept together.
        first = F.min(of("first")) if ordered else F.struct(*[F.min(of(f"first.{c}")).alias(c) for c in ("of", "at")])
        return [F.sum(of("n")), first]
    found = [c.alias(name) for c, name in zip(total(None), ("n", "first"))]
    if now is not None:
        found += [c.alias(name) for c, name in zip(total(~now), ("old_n", "old_first"))] + [F.max(now).alias("now")]
    return entries.groupBy(*keys).agg(*found)


def _repeated(new: DataFrame, old: DataFrame | None, keys: Sequence[str], ordered: bool) -> DataFrame:
    """The groups in ``new`` that have several rows: the first row, how many came earlier and the first of these."""
    if old is None:
        groups = new.withColumns({"old_n": F.lit(0).cast("long"), "old_first": F.lit(None).cast(new.schema["first"].dataType)})
    else:
        both = new.withColumn("now", F.lit(True)).unionByName(old.withColumn("now", F.lit(False)))
        groups = _summed(both, keys, ordered, F.col("now")).filter("now")
    return groups.filter("n > 1").select(*keys, "first.of", "first.at", F.coalesce("old_n", F.lit(0)).alias("old_n"),
                                         F.col("old_first.of").alias("old_of"), F.col("old_first.at").alias("old_at"))


def _new_failures(table: Bucketed, rule: Rule, rows: DataFrame, columns: Sequence[str], batch_id: int, compact_at: int):
    """(failures that ``rows`` bring about or None, the scratch folder they are read from, the group table's entry
    after them, its folders that are read no more)."""
    store, spark = table.store, rows.sparkSession
    cols, order = _grouping(rule, columns)
    taken = rows
    for c in cols if rule.kind == "unique" else cols[1:] if rule.kind == "chronology" else []:
        taken = taken.filter(F.col(f"`{c}`").isNotNull())
    keys = {c: f"g{i}" for i, c in enumerate(cols)}
    placed = taken.select(*[F.col(f"`{c}`").alias(g) for c, g in keys.items()],
                          *[o.alias(f"o{i}") for i, o in enumerate(order)], F.lit(batch_id).cast("long").alias("of"), F.col(ROW).alias("at"))
    # Summed up before the shuffle: a key with a third of all rows is one row a task. Without an order any row of a
    # group may be its first (it counts only while it is alone), and numbers need no sort to be summed up.
    place = [f"o{i}" for i in range(len(order))] + ["of", "at"]
    first = F.min(F.struct(*place)) if order else F.struct(F.min("of").alias("of"), F.min("at").alias("at"))
    delta = placed.groupBy(*table.keys).agg(F.count(F.lit(1)).alias("n"), first.alias("first"))
    _, entry = table._entry(delta.schema)
    schema = T.StructType.fromJson(entry["schema"])
    folder, touched = table._write(delta.select(*schema.names), packed=True)
    new = {b: [f"{folder}/{BUCKET}={b}"] for b in touched}
    after = {b: [*entry["buckets"].get(str(b), []), *new[b]] for b in touched}
    many = scratch_path(spark, "rule-groups")
    for run in _runs(store, after):
        earlier = [p for b in run for p in after[b] if p not in new[b]]
        groups = _repeated(store.read_paths([p for b in run for p in new[b]], schema),
                           store.read_paths(earlier, schema) if earlier else None, table.keys, bool(order))
        # Written as ever: by its size it is seen whether the groups can be sent to all tasks.
        groups.write.mode("append").parquet(many)
    full = {b: after[b] for b in touched if len(after[b]) >= compact_at}
    for run in _runs(store, full):
        again, _ = table._write(_summed(store.read_paths([p for b in run for p in full[b]], schema), table.keys, bool(order)), packed=True)
        after |= {b: [f"{again}/{BUCKET}={b}"] for b in run}
    gone = [p for paths in full.values() for p in paths]
    changed = table._after(entry, after, None, labels=[str(batch_id)])
    if not touched:
        return None, many, changed, gone
    groups = spark.read.schema(groups.schema).parquet(many)
    mine = placed.join(groups, [placed[g].eqNullSafe(groups[g]) for g in table.keys])
    before = groups.filter("old_n = 1")
    if rule.kind == "chronology":
        mine = mine.filter((placed["of"] != groups["of"]) | (placed["at"] != groups["at"]))
        before = groups.filter("old_n > 0 AND (old_of != of OR old_at != at)")
    name = F.lit(rule.name).alias("rule")
    found = mine.select(placed["of"], placed["at"], name, F.lit(False).alias("late")).unionByName(
        before.select(F.col("old_of").alias("of"), F.col("old_at").alias("at"), name, F.lit(True).alias("late")))
    return found, many, changed, gone


def stream_keyed_dq(stream_df: DataFrame, rules: Sequence[Rule], target: str, checkpoint: str,
                    parents: Mapping[str, DataFrame] | None = None, buckets: int = 64, table: str = "",
                    available_now: bool = True, processing_time: str | None = None, compact_at: int = 8):
    """S2 (action): row rules, relationships (against ``parents``) and keyed
    rules on every micro-batch. A ``fail_job`` rule that a row breaks, also one of an earlier batch,
    stops the stream before the batch is committed."""
    rules = named(rules)
    quality.enforce_runnable(rules, table)
    plain = [r for r in rules if r.kind not in GROUPED]
    grouped = [(i, r) for i, r in enumerate(rules) if r.is_keyed and r.kind in GROUPED]
    strict = [r.name for r in rules if r.effective_handling == "fail_job"]

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        with shuffles_dropped(batch.sparkSession):
            checked(batch, batch_id)

    def checked(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = Snapshots(spark, f"{target.rstrip('/')}/state")
        seen = store.at()
        if (last := _last(seen.tables, target)) is not None and batch_id <= last:
            return  # committed, but the stream's checkpoint was not
        marked = quality.mark_failures(batch.withColumn(ROW, F.monotonically_increasing_id()), plain, parents)
        rows = _written(marked, f"{target.rstrip('/')}/rows/batch_id={batch_id}")
        path, changes, gone, mode = f"{target.rstrip('/')}/failures/batch_id={batch_id}", {}, [], "overwrite"
        for i, r in grouped:
            cols, _ = _grouping(r, batch.columns)
            groups = Bucketed(store, f"groups_{i}", [f"g{j}" for j in range(len(cols))], buckets)
            found, scratch, changes[groups.table], replaced = _new_failures(groups, r, rows, batch.columns, batch_id, compact_at)
            if found is not None:
                _written(found, path, mode)
                mode = "append"
            store.drop([scratch])
            gone += replaced
        if mode == "overwrite":
            _written(spark.createDataFrame([], FAILURES), path)
        failures = spark.read.schema(FAILURES).parquet(path)
        if strict and (failures.filter(F.col("rule").isin(strict)).take(1)
                       or rows.filter(F.arrays_overlap(quality.FAILED, F.array(*[F.lit(n) for n in strict]))).take(1)):
            raise quality.DataQualityError(f"table {table!r}: a fail_job rule failed in batch {batch_id}; not committed")
        store.commit(seen, {**changes, CURSOR: {"last": batch_id, "layout": LAYOUT}})
        store.drop(gone)  # readers of rows and failures never open them

    writer = stream_df.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if available_now:
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    return writer.trigger(processingTime=processing_time or "1 minute").start()


def _last(tables: Mapping[str, dict], target: str) -> int | None:
    """The last committed micro-batch."""
    if CURSOR not in tables:
        return None
    if tables[CURSOR].get("layout") != LAYOUT:
        raise ValueError(f"{target} was written in an older layout; check the stream anew into another target")
    return tables[CURSOR]["last"]


def read_failures(spark: SparkSession, target: str) -> DataFrame:
    """(row, rule, late, batch_id) of the committed batches."""
    return _failures(spark, target).select(F.concat_ws(":", "of", "at").alias("row"), "rule", "late", "batch_id")


def _failures(spark: SparkSession, target: str) -> DataFrame:
    return _committed(spark, target, "failures", T.StructType.fromDDL(FAILURES))


def _committed(spark: SparkSession, target: str, name: str, schema: T.StructType) -> DataFrame:
    last = _last(Snapshots(spark, f"{target.rstrip('/')}/state").at().tables, target)
    schema = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    if last is None:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).parquet(f"{target.rstrip('/')}/{name}")
            .filter(F.col("batch_id") <= last))


def read_checked(spark: SparkSession, target: str, schema: T.StructType, rules: Sequence[Rule]) -> quality.Split:
    """The rows of all committed batches, split by their state now. ``schema``
    is the stream's."""
    rules, flag = named(rules), quality.FAILED
    stored = T.StructType([*schema.fields, T.StructField(ROW, T.LongType()),
                           T.StructField(flag, T.ArrayType(T.StringType()))])
    rows = _committed(spark, target, "rows", stored)
    # One flag per rule: flags are summed up in place, sets of names would be sorted.
    marks = {r.name: f"_keyed_{i}" for i, r in enumerate(rules) if r.is_keyed and r.kind in GROUPED}
    # A failed row takes a byte or two in its files and some fifty in memory: their size must not have them broadcast.
    late = _failures(spark, target).groupBy(F.col("at").alias("_at"), F.col("of").alias("_of")).agg(
        F.lit(True).alias("_keyed"), *[F.max(F.col("rule") == n).alias(m) for n, m in marks.items()])
    mark = lambda n: F.coalesce(F.col(marks[n]), F.lit(False)) if n in marks else F.lit(False)
    failed = [F.when(F.array_contains(flag, r.name) | mark(r.name), F.lit(r.name)) for r in rules]
    every = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    marked = (rows.join(late.hint("merge"), (rows[ROW] == late["_at"]) & (rows["batch_id"] == late["_of"]), "left")
              .withColumn(flag, every).drop(*marks.values(), "_keyed", "_at", "_of", ROW, "batch_id"))
    return quality.split(marked, rules)
