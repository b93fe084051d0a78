"""Stored tables by key: insert-only loads behind Bloom filters (I1/I2), and
tables in hash buckets of which a batch rewrites or extends only those it
touches: upserts (I4), key counts (Q2/Q15), distinct keys (S3) and change
detection without a watermark (M3). All commit through ``snapshots``.

A batch has a label. The labels a table has seen are part of its commit, so a
replay is known whatever its label looks like ("007", "1.0", a date, "null").
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vaultline.operators import bloom
from vaultline.operators.ordered import current_rows
from vaultline.session import scratch_path
from vaultline.sources.snapshots import Snapshots

FILTER = "batch string, blocks int, block int, bits long"
BUCKET = "_bucket"


def _scratch(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys, NULL equal to NULL."""
    out = F.lit(True)
    for k in keys:
        out = out & left[f"`{k}`"].eqNullSafe(right[f"`{k}`"])
    return out


# ------------------------------------------------------------------ I1, I2

class NewKeys(NamedTuple):
    rows: DataFrame          # what the batch added
    opened: list[str]        # batches whose key files were read


def load_new_keys(store: Snapshots, table: str, rows: DataFrame, key_col: str, label: str) -> NewKeys:
    """I1/I2 (action): add the rows of ``rows`` (one per key) whose key no other
    batch has. Every stored batch has a filter; only keys a filter may hold are
    looked up, and only in the batches they may be in, so a batch of new keys opens
    no stored key file. A batch that is loaded again replaces itself: the same rows give the same result."""
    seen = store.at()
    entry = seen.tables.get(table, {"batches": {}, "schema": rows.schema.jsonValue()})
    if T.StructType.fromJson(entry["schema"]).names != rows.columns:
        raise ValueError(f"{table} has the columns {T.StructType.fromJson(entry['schema']).names}, not {rows.columns}")
    schema = T.StructType.fromJson(entry["schema"])
    others = {k: v for k, v in entry["batches"].items() if k != label and v["rows"]}
    batch, opened = _scratch(rows, "new-keys"), []
    new = batch
    if others:
        filters = store.read_paths([f for v in others.values() for f in v["side"]], FILTER)
        maybe = _scratch(bloom.possible(batch, [key_col], filters, sorted({v["blocks"] for v in others.values()})), "maybe-known")
        opened = sorted(r[0] for r in maybe.select("batch").distinct().collect())  # at most the number of batches
        if opened:
            known = None
            for name in opened:
                keys = store.read_paths([others[name]["data"]], schema).select(key_col)
                mine = maybe.filter(F.col("batch") == name).select(key_col)
                found = keys.join(mine, key_col, "left_semi")
                known = found if known is None else known.unionByName(found)
            new = batch.join(known.distinct(), key_col, "left_anti")
    folder, side = store.new_folder(table), store.new_folder(table)
    new.write.mode("errorifexists").parquet(folder)
    added = store.read_paths([folder], schema)
    n = added.count()
    blocks = bloom.blocks_for(n)
    (bloom.build(added, [key_col], blocks).select(F.lit(label).alias("batch"), F.lit(blocks).alias("blocks"), "block", "bits")
     .write.mode("errorifexists").parquet(side))
    batches = {**entry["batches"], label: {"data": folder, "side": [side], "blocks": blocks, "rows": n}}
    store.commit(seen, {table: {**entry, "batches": batches}})
    return NewKeys(added, opened)


def read_batches(store: Snapshots, table: str, batch_col: str = "batch_id") -> DataFrame:
    """All rows with the label of their batch, as text."""
    entry = store.at().tables[table]
    schema, out = T.StructType.fromJson(entry["schema"]), None
    for label, b in entry["batches"].items():
        part = store.read_paths([b["data"]], schema).withColumn(batch_col, F.lit(label))
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------------ hash buckets

class Bucketed:
    """A table in ``n`` hash buckets of its keys; a bucket is a list of folders."""

    def __init__(self, store: Snapshots, table: str, keys: Sequence[str], n: int = 64):
        self.store, self.table, self.keys, self.n = store, table, [keys] if isinstance(keys, str) else list(keys), n

    def _entry(self, schema: T.StructType):
        seen = self.store.at()
        entry = seen.tables.get(self.table)
        if entry is None:
            entry = {"buckets": {}, "labels": [], "keys": self.keys, "n": self.n, "schema": schema.jsonValue()}
        if entry["keys"] != self.keys or entry["n"] != self.n:
            raise ValueError(f"{self.table} is bucketed by {entry['keys']} into {entry['n']}")
        return seen, entry

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]), F.lit(self.n)).cast("int")

    def read(self) -> DataFrame:
        return self.store.read(self.table)

    def loaded(self, label: str) -> bool:
        return label in self.store.at().tables.get(self.table, {}).get("labels", ())

    def _stored(self, entry: dict, touched: Sequence[int]) -> DataFrame:
        paths = [p for b in touched for p in entry["buckets"].get(str(b), ())]
        return self.store.read_paths(paths, T.StructType.fromJson(entry["schema"]))

    def _write(self, rows: DataFrame, packed: bool = False) -> tuple[str, list[int]]:
        """Rows to one folder per bucket. Few buckets are split by further bits of
        the keys' hash, so that tasks do not grow in size while most cores wait.
        ``packed``: in the order of the keys and by zstd, which takes less room."""
        folder = self.store.new_folder(self.table)
        placed = rows.withColumn(BUCKET, self.bucket())
        split = max(1, int(self.store.spark.conf.get("spark.sql.shuffle.partitions")) // self.n)
        further = F.pmod(F.xxhash64(F.lit("split"), *[F.col(f"`{k}`") for k in self.keys]), F.lit(split))
        dealt = placed.repartition(F.col(BUCKET), further)
        if packed:
            dealt = dealt.sortWithinPartitions(BUCKET, *[F.col(f"`{k}`") for k in self.keys])
        writer = dealt.write.option("compression", "zstd") if packed else dealt.write
        writer.mode("errorifexists").partitionBy(BUCKET).parquet(folder)
        return folder, [int(f.split("=")[1]) for f in self.store._list(folder) if f.startswith(f"{BUCKET}=")]

    def _after(self, entry: dict, changed: dict[int, list[str]], label: str | None, **extra) -> dict:
        """The table's entry with the changed buckets in place."""
        buckets = {**entry["buckets"], **{str(b): p for b, p in changed.items()}}
        labels = [*entry["labels"], label] if label is not None else entry["labels"]
        return {**entry, "buckets": buckets, "labels": labels, **extra}

    def _commit(self, seen, entry: dict, changed: dict[int, list[str]], label: str | None, **extra) -> None:
        self.store.commit(seen, {self.table: self._after(entry, changed, label, **extra)})

    def upsert(self, batch: DataFrame, label: str, order: Sequence[str] | None = None) -> list[int]:
        """I4 (action): the batch's rows (the last by ``order`` of each key) replace
        the stored rows of their keys. Returns the buckets that were rewritten."""
        seen, entry = self._entry(batch.schema)
        if label in entry["labels"]:
            return []
        latest = _scratch(current_rows(batch, self.keys, list(order)) if order else batch, "upsert")
        touched = [r[0] for r in latest.select(self.bucket()).distinct().collect()]  # at most n
        old = self._stored(entry, touched)
        kept = old.join(latest, _same(old, latest, self.keys), "left_anti")
        folder, written = self._write(kept.unionByName(latest.select(*old.columns)))
        self._commit(seen, entry, {b: [f"{folder}/{BUCKET}={b}"] for b in written}, label)
        return written

    def add_counts(self, batch: DataFrame, label: str, count_col: str = "n") -> DataFrame:
        """Q2/Q15 (action): add the batch's rows per key to the stored counts and
        return the counts of the batch's keys. Stored rows are not read: a batch is
        counted once, and only the buckets of its keys are rewritten."""
        delta = _scratch(batch.groupBy(*self.keys).agg(F.count(F.lit(1)).alias(count_col)), "key-counts")
        seen, entry = self._entry(delta.schema)
        touched = [r[0] for r in delta.select(self.bucket()).distinct().collect()]  # at most n
        old = self._stored(entry, touched)
        if label not in entry["labels"]:
            both = old.unionByName(delta).groupBy(*self.keys).agg(F.sum(count_col).alias(count_col))
            folder, written = self._write(both)
            changed = {b: [f"{folder}/{BUCKET}={b}"] for b in written}
            self._commit(seen, entry, changed, label)
            old = self.store.read_paths([p for ps in changed.values() for p in ps], delta.schema)
        return old.join(delta.select(*self.keys), _same(old, delta, self.keys), "left_semi")

    def insert(self, batch: DataFrame, label: str | None = None, compact_at: int = 8) -> DataFrame:
        """Action: store the batch's rows (one per key) whose keys are not there
        yet and return them. Reads only the buckets the batch touches and writes only new
        rows, one file a bucket; a bucket of ``compact_at`` files becomes one again. Without a
        label a replay is looked up like any batch, and finds nothing new."""
        rows = _scratch(batch, "keys")
        seen, entry = self._entry(rows.schema)
        if label is not None and label in entry["labels"]:
            return rows.limit(0)
        touched = [r[0] for r in rows.select(self.bucket()).distinct().collect()]  # at most n
        old = self._stored(entry, touched)
        folder, written = self._write(rows.join(old, _same(rows, old, self.keys), "left_anti"))
        changed = {b: entry["buckets"].get(str(b), []) + [f"{folder}/{BUCKET}={b}"] for b in written}
        full = [b for b in changed if len(changed[b]) >= compact_at]
        if full:
            again, _ = self._write(self.store.read_paths([p for b in full for p in changed[b]], rows.schema))
            changed |= {b: [f"{again}/{BUCKET}={b}"] for b in full}
        self._commit(seen, entry, changed, label)
        return self.store.read_paths([f"{folder}/{BUCKET}={b}" for b in written], rows.schema)

    def add_keys(self, batch: DataFrame, label: str, compact_at: int = 8) -> DataFrame:
        """S3 (action): store the batch's keys that are not there yet and return
        them, as ``insert`` does."""
        return self.insert(batch.select(*self.keys).distinct(), label, compact_at)

    def files_per_bucket(self) -> dict[int, int]:
        return {int(b): len(p) for b, p in self.store.at().tables[self.table]["buckets"].items()}

    # -------------------------------------------------------- M3 without a watermark
    def digests(self, rows: DataFrame) -> dict[int, list[str]]:
        """{bucket: [rows, digest]}: sums of row hashes, so order is no matter."""
        h = [F.xxhash64(F.lit(s), *[F.col(f"`{c}`") for c in rows.columns]).cast("decimal(38,0)") for s in ("a", "b")]
        found = rows.groupBy(self.bucket().alias(BUCKET)).agg(F.count(F.lit(1)), F.sum(h[0]), F.sum(h[1])).collect()  # at most n
        return {r[0]: [str(r[1]), f"{r[2]}:{r[3]}"] for r in found}

    def diff(self, rows: DataFrame, label: str) -> DataFrame:
        """M3 (action): make the table equal to ``rows`` (one per key) and return
        the changes: ``change`` (insert, update, delete) and the row's columns, the
        stored ones for a delete. Digests of the stored buckets are
        kept as the leaves of a tree; one pass over ``rows`` gives theirs, the trees
        are walked down where they differ, and only those buckets are read."""
        seen, entry = self._entry(rows.schema)
        names = T.StructType.fromJson(entry["schema"]).names
        rows = rows.select(*names)
        now = self.digests(rows)
        before = {int(b): d for b, d in entry.get("digests", {}).items()}
        differ = unequal(before, now, self.n)
        new = rows.filter(self.bucket().isin(differ)) if differ else rows.limit(0)
        new = _scratch(new, "changed-buckets")
        old = self._stored(entry, differ)
        cells = lambda df: F.struct(*[df[f"`{c}`"].alias(c) for c in names])
        both = old.select(cells(old).alias("was"), F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]).alias("h")).join(
            new.select(cells(new).alias("now"), F.xxhash64(*[F.col(f"`{k}`") for k in self.keys]).alias("g")),
            (F.col("h") == F.col("g")) & F.expr(" AND ".join(f"was.`{k}` <=> now.`{k}`" for k in self.keys)), "full_outer")
        change = (F.when(F.col("was").isNull(), "insert").when(F.col("now").isNull(), "delete")
                  .when(~F.col("was").eqNullSafe(F.col("now")), "update"))
        changes = _scratch(both.select(change.alias("change"), F.coalesce("now", "was").alias("row"))
                           .filter("change IS NOT NULL").select("change", "row.*"), "changes")
        if not differ:
            return changes
        folder, written = self._write(new)
        changed = {b: [f"{folder}/{BUCKET}={b}"] for b in written} | {b: [] for b in differ if b not in written}
        self._commit(seen, entry, changed, label, digests={str(b): d for b, d in now.items()})
        return changes


def unequal(left: dict, right: dict, n: int, fanout: int = 16) -> list[int]:
    """Buckets whose digests differ, found from the roots of two digest trees
    down: below equal nodes nothing is looked at. A tree has at most ``n`` leaves."""
    import hashlib

    def tree(leaves: dict) -> list[list[str]]:
        levels = [[":".join(leaves.get(b, ["0", ""])) for b in range(n)]]
        while len(levels[-1]) > 1:
            row = levels[-1]
            levels.append([hashlib.sha256("|".join(row[i:i + fanout]).encode()).hexdigest() for i in range(0, len(row), fanout)])
        return levels

    a, b = tree(left), tree(right)
    open_ = [0] if a[-1][0] != b[-1][0] else []
    for level in range(len(a) - 2, -1, -1):
        open_ = [c for node in open_ for c in range(node * fanout, min((node + 1) * fanout, len(a[level])))
                 if a[level][c] != b[level][c]]
    return open_
