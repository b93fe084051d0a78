"""Repeated substrings through a logarithmic family of sampled suffix arrays.

A string of ``need`` bytes counts as repeated if it starts at two places. A
suffix enters the index only where its first ``CORE`` bytes have the smallest
hash among all that start inside some window of ``need`` bytes (the leftmost of
equals). That place depends on the window's bytes alone, so equal windows hold an
equal sampled suffix at the same offset, and about one suffix in
``(need - CORE) / 2`` is kept. An entry is the suffix's key (name of its first
``CORE`` bytes) and the name of its block: all windows that chose it. Names are
64-bit hashes and stand for the bytes when suffixes are ordered: equal prefixes
are neighbours in either order, which is all a scan for long matches needs, and
no merge has to fetch texts.

The index is a family of levels. A new batch gets its array of entries, is merge
scanned against all existing levels (a key seen on both sides is a long match)
and becomes a level of size 1; equal-sized levels merge into one of double size,
in the same pass. So an entry is rewritten log2(batches) times. Every batch is
committed by a numbered manifest written last: a replayed batch adds nothing,
and a crash leaves the family as it was.

Which windows of a matched suffix repeat is then decided exactly. Where all blocks of a
key are equal, all their windows repeat. Otherwise one block of each name is
fetched from its text and told apart in two steps: runs of ``STEP`` windows by
the bytes they span together (equal: all repeat) and have in common (unique:
none does), and window by window where that leaves it open. Pairs are never
made: everything is grouped by a name, with a partial sum before the shuffle.

Texts are known by two 64-bit hashes of their bytes. Defined results: a null text is empty;
texts under ``need`` bytes lose nothing; a repeated row is another document, so
texts that occur twice go wholly if they have ``need`` bytes; a null or repeated
doc_id is carried, rows are told by their texts; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultline.llm.common import materialize, text_or_empty
from vaultline.operators.incremental import path_exists

NEED, CORE, STEP = 400, 128, 16
BATCHES, BUCKET_BITS = 4, 20
CHUNK, AT_BITS = 1 << 20, 24
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
OCCURRENCES = "d1 long, d2 long, place long, key long, name long"
LEVEL = "key long, low long, high long, n int, repeated boolean, contested boolean"
MANIFEST = "kind string, label string, path string, batches int, need int, core int"


# ------------------------------------------------------------------ suffixes of one text

_POWERS: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if n not in _POWERS:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        both = []
        for x in (BASE, inverse):
            p = np.full(n, x, dtype=np.uint64)
            p[0] = 1
            both.append(np.cumprod(p))
        _POWERS[n] = tuple(both)
    return _POWERS[n]


def _chosen(raw: np.ndarray, need: int, core: int) -> np.ndarray:
    """For each window of ``need`` bytes the place of its sampled suffix."""
    power, inverse = _powers(CHUNK + need)
    n, width = len(raw), need - core + 1
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
    h = (total[core:] - total[:-core]) * inverse[:n - core + 1]
    h ^= h >> np.uint64(29)
    h *= MIX
    # The hash's upper bits with the place below them: the least is the leftmost of the smallest.
    low = np.uint64((1 << AT_BITS) - 1)
    h &= ~low
    h |= np.arange(len(h), dtype=np.uint64)
    windows = len(h) - width + 1
    blocks = np.full(-(-len(h) // width) * width, ~np.uint64(0))
    blocks[:len(h)] = h
    blocks = blocks.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(after[:windows], before[width - 1:width - 1 + windows])
    return (least & low).astype(np.int64)


def sampled(raw: np.ndarray, need: int = NEED, core: int = CORE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, first window, last window) of the sampled suffixes of a text's bytes."""
    parts = []
    for start in range(0, max(len(raw) - need + 1, 0), CHUNK):
        at = _chosen(raw[start:start + CHUNK + need - 1], need, core)
        cut = np.flatnonzero(np.diff(at)) + 1
        first = np.concatenate([[0], cut])
        parts.append((at[first] + start, first + start, np.concatenate([cut, [len(at)]]) - 1 + start))
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none
    at, first, last = (np.concatenate(x) for x in zip(*parts))
    one = np.concatenate([[True], at[1:] != at[:-1]])  # a run may go on in the next chunk
    return at[one], first[one], last[np.concatenate([one[1:], [True]])]


def _pack(at: int, left: int, right: int) -> int:
    """A sampled suffix's place and the offsets (largest, smallest) that its windows have it at."""
    return at << 20 | left << 10 | right


def _at(place: Column) -> Column:
    return F.shiftright(place, 20)


def _left(place: Column) -> Column:
    return F.shiftright(place, 10).bitwiseAND(F.lit(1023))


def _right(place: Column) -> Column:
    return place.bitwiseAND(F.lit(1023))


def digest(text: Column) -> list[Column]:
    """Two independent 64-bit hashes of the text's bytes."""
    return [F.xxhash64(text), F.xxhash64(F.lit("second"), text)]


def _signed(values: list[int]):
    import pyarrow as pa
    return pa.array(np.array(values, dtype=np.uint64).view(np.int64))


def suffix_array(docs: DataFrame, text: str = "text", need: int = NEED, core: int = CORE) -> DataFrame:
    """(d1, d2, place, key, name): the sampled suffixes of every row's text."""
    body = text_or_empty(text)
    long = docs.filter(F.octet_length(body) >= need).select(*digest(body), body.cast("binary")).toDF("d1", "d2", "body")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from xxhash import xxh3_64_intdigest as name_of
        for b in batches:
            row, place, key, name = [], [], [], []
            for i, value in enumerate(b.column(2)):
                raw = value.as_py()
                at, first, last = (x.tolist() for x in sampled(np.frombuffer(raw, np.uint8), need, core))
                for a, lo, hi in zip(at, first, last):
                    key.append(name_of(raw[a:a + core]))
                    name.append(name_of(raw[lo:hi + need], (a - lo) << 10 | (a - hi)))
                    place.append(_pack(a, a - lo, a - hi))
                row += [i] * len(at)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), pa.array(place, pa.int64()),
                                              _signed(key), _signed(name)], names=["d1", "d2", "place", "key", "name"])

    return long.mapInArrow(run, OCCURRENCES)


# ------------------------------------------------------------------ the family

class Entry(NamedTuple):
    kind: str       # batch (its suffixes) or level
    label: str
    path: str
    batches: int
    need: int
    core: int


class SuffixFamily:
    """Sampled suffix arrays of the batches added so far, under ``path``."""

    def __init__(self, spark: SparkSession, path: str, need: int = NEED, core: int = CORE):
        if not 0 < need - core < 1024:
            raise ValueError("need must be over core, by less than 1,024 bytes")
        self.spark, self.path, self.need, self.core = spark, path.rstrip("/"), need, core

    def _read(self) -> tuple[int, list[Entry]]:
        """Number and entries of the last complete manifest."""
        base = f"{self.path}/manifest"
        if not path_exists(self.spark, base):
            return 0, []
        jvm_path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
        fs = jvm_path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        numbers = [int(s.getPath().getName()) for s in fs.listStatus(jvm_path)]
        done = [n for n in numbers if path_exists(self.spark, f"{base}/{n:06d}/_SUCCESS")]
        if not done:
            return 0, []
        rows = self.spark.read.schema(MANIFEST).parquet(f"{base}/{max(done):06d}").collect()  # a row per batch and level
        entries = [Entry(*r) for r in rows]
        if any((e.need, e.core) != (self.need, self.core) for e in entries):
            raise ValueError(f"{self.path} was built for other lengths")
        return max(done), entries

    def levels(self) -> list[Entry]:
        return sorted((e for e in self._read()[1] if e.kind == "level"), key=lambda e: -e.batches)

    def add(self, docs: DataFrame, label: str, text: str = "text") -> None:
        """Add the batch ``label``; one that is already there is left alone."""
        seq, entries = self._read()
        if any(e.kind == "batch" and e.label == label for e in entries):
            return
        seq += 1
        own, level = f"{self.path}/batch/{seq:06d}", f"{self.path}/level/{seq:06d}"
        suffix_array(docs, text, self.need, self.core).write.mode("overwrite").parquet(own)
        old = sorted((e for e in entries if e.kind == "level"), key=lambda e: e.batches)
        merged, size = [], 1
        for e in old:
            if e.batches != size:
                break
            merged.append(e)
            size *= 2
        self._scan(self.spark.read.schema(OCCURRENCES).parquet(own), old, merged).write.mode("overwrite").parquet(level)
        entries = [e for e in entries if e not in merged]
        entries += [Entry("batch", label, own, 1, self.need, self.core), Entry("level", label, level, size, self.need, self.core)]
        self.spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/{seq:06d}")
        for e in merged:  # the manifest does not name them any more
            gone = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(e.path)
            gone.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(gone, True)

    def _scan(self, batch: DataFrame, old: list[Entry], merged: list[Entry]) -> DataFrame:
        """The batch's array merged with the levels of ``merged``; keys that the batch
        has in common with itself or with any level are marked."""
        rows = batch.select("key", F.col("name").alias("low"), F.col("name").alias("high"), F.lit(1).alias("n"),
                            F.lit(False).alias("repeated"), F.lit(False).alias("contested"),
                            F.lit(True).alias("fresh"), F.lit(True).alias("inside"))
        for e in old:
            level = self.spark.read.schema(LEVEL).parquet(e.path)
            rows = rows.unionByName(level.select("key", "low", F.coalesce("high", "low").alias("high"), "n", "repeated", "contested",
                                                 F.lit(False).alias("fresh"), F.lit(e in merged).alias("inside")))
        met = rows.groupBy("key").agg(
            F.min(F.when(F.col("inside"), F.col("low"))).alias("low_in"), F.max(F.when(F.col("inside"), F.col("high"))).alias("high_in"),
            F.sum(F.when(F.col("inside"), F.col("n"))).alias("n_in"), F.min("low").alias("low"), F.max("high").alias("high"),
            F.sum("n").alias("n"), F.max("fresh").alias("fresh"), F.max(F.col("inside") & F.col("repeated")).alias("repeated"),
            F.max(F.col("inside") & F.col("contested")).alias("contested"))
        return met.filter("low_in IS NOT NULL").select(
            "key", F.col("low_in").alias("low"), F.when(F.col("high_in") != F.col("low_in"), F.col("high_in")).alias("high"),
            F.least("n_in", F.lit(2)).cast("int").alias("n"),
            (F.col("repeated") | (F.col("fresh") & (F.col("n") > 1))).alias("repeated"),
            (F.col("contested") | (F.col("fresh") & (F.col("low") != F.col("high")))).alias("contested")).sortWithinPartitions("key")

    def matches(self) -> DataFrame:
        """(d1, d2, place, key, name, contested) of all suffixes whose key repeats."""
        entries = self._read()[1]
        if not entries:
            return self.spark.createDataFrame([], OCCURRENCES + ", contested boolean")
        found = None
        for e in entries:
            if e.kind == "level":
                level = self.spark.read.schema(LEVEL).parquet(e.path).filter("repeated").select("key", "contested")
                found = level if found is None else found.unionByName(level)
        # Written, so that both sides of the join are plain shuffles: a hot key's side can then be split.
        found = materialize(found.groupBy("key").agg(F.max("contested").alias("contested")), "suffix-keys")
        own = self.spark.read.schema(OCCURRENCES).parquet(*[e.path for e in entries if e.kind == "batch"])
        return own.join(found, "key")


# ------------------------------------------------------------------ which windows repeat

def _low_bits(c: Column) -> Column:
    return c.bitwiseAND(F.lit(2 ** BUCKET_BITS - 1))


def _buckets(digests: DataFrame) -> DataFrame:
    """Low bits of the texts to look at: at most 2 ** BUCKET_BITS rows, so that
    most other texts are passed over without a shuffle."""
    return F.broadcast(digests.select(_low_bits(F.col("d1")).alias("bucket")).distinct())


def _blocks(names: DataFrame, docs: DataFrame, text: str, need: int) -> DataFrame:
    """(key, name, n, place, from, body): one block of each name, as wide as its
    windows and the rest of their runs, cut from its text; ``from``: its place."""
    wanted = names.groupBy("d1", "d2").agg(F.collect_list(F.struct("key", "name", "n", "place")).alias("wanted"))  # of one text
    body = text_or_empty(text)
    rows = docs.select(body.alias("body"), *[c.alias(n) for c, n in zip(digest(body), ("d1", "d2"))])
    rows = rows.join(_buckets(names), _low_bits(F.col("d1")) == F.col("bucket"), "left_semi")
    one = rows.groupBy("d1", "d2").agg(F.first("body").alias("body"))  # copies are one text
    both = one.join(wanted, ["d1", "d2"]).select(F.col("body").cast("binary").alias("body"), "wanted")
    schema = "key long, name long, n long, place long, `from` long, body binary"

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            for value, wants in zip(b.column(0), b.column(1)):
                raw = value.as_py()
                for w in wants.as_py():
                    at, left, right = w["place"] >> 20, w["place"] >> 10 & 1023, w["place"] & 1023
                    start = max(at - (left // STEP * STEP + STEP - 1), 0)
                    row = (w["key"], w["name"], w["n"], w["place"], start, raw[start:at - right // STEP * STEP + need])
                    for c, v in zip(cols, row):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:5]), pa.array(cols[5], pa.binary())],
                                             names=["key", "name", "n", "place", "from", "body"])

    return both.mapInArrow(run, schema)


def _runs(blocks: DataFrame, need: int) -> DataFrame:
    """(key, name, n, s, whole, common): for each run s of STEP offsets the names of
    the bytes its windows span (null at a text's end) and have in common."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from xxhash import xxh3_64_intdigest as name_of
        for b in batches:
            row, step, whole, common = [], [], [], []
            for i, (place, start, value) in enumerate(zip(*(b.column(c).to_pylist() for c in (3, 4, 5)))):
                at, left, right = (place >> 20) - start, place >> 10 & 1023, place & 1023
                for s in range(right // STEP, left // STEP + 1):
                    lo, hi = at - s * STEP - (STEP - 1), at - s * STEP + need
                    row.append(i), step.append(s)
                    whole.append(name_of(value[lo:hi]) if lo >= 0 and hi <= len(value) else None)
                    common.append(name_of(value[lo + STEP - 1:hi - (STEP - 1)]))
            take = pa.array(row, pa.int64())
            signed = [None if w is None else w - (1 << 64) if w >> 63 else w for w in whole]
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(take) for c in range(3)), pa.array(step, pa.int32()),
                                              pa.array(signed, pa.int64()), _signed(common)],
                                             names=["key", "name", "n", "s", "whole", "common"])

    return blocks.mapInArrow(run, "key long, name long, n long, s int, whole long, common long")


def _windows(blocks: DataFrame, need: int) -> DataFrame:
    """(key, name, n, o, h) of each window in the runs that ``blocks.runs`` lists."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from xxhash import xxh3_64_intdigest as name_of
        for b in batches:
            row, offset, h = [], [], []
            for i, (place, start, value, runs) in enumerate(zip(*(b.column(c).to_pylist() for c in (3, 4, 5, 6)))):
                at, left, right = (place >> 20) - start, place >> 10 & 1023, place & 1023
                for s in runs:
                    for o in range(max(s * STEP, right), min(s * STEP + STEP - 1, left) + 1):
                        row.append(i), offset.append(o), h.append(name_of(value[at - o:at - o + need]))
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(take) for c in range(3)), pa.array(offset, pa.int32()), _signed(h)],
                                             names=["key", "name", "n", "o", "h"])

    return blocks.mapInArrow(run, "key long, name long, n long, o int, h long")


def _repeated(rows: DataFrame, by: list[str]) -> DataFrame:
    """Groups that more than one name is in; written, so that joins with them can split a hot group."""
    return materialize(rows.groupBy(*by).agg(F.min("name").alias("a"), F.max("name").alias("b")).filter("a != b").select(*by),
                       "suffix-groups")


def spans(family: SuffixFamily, docs: DataFrame, text: str = "text") -> DataFrame:
    """(d1, d2, spans): the byte ranges of each text that repeated strings cover;
    ranges may overlap. ``docs``: all documents of the family."""
    need = family.need
    found = materialize(family.matches(), "suffix-matches")
    range_of = [(_at(F.col("place")) - _left(F.col("place"))).alias("start"),
                (_at(F.col("place")) - _right(F.col("place")) + need).alias("end")]
    sure = found.filter("NOT contested").select("d1", "d2", *range_of)
    open_ = found.filter("contested")
    names = materialize(open_.groupBy("key", "name").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("d1", "d2", "place")).alias("one"))
                        .select("key", "name", "n", "one.*"), "suffix-names")
    twice = open_.join(names.filter("n > 1").select("key", "name"), ["key", "name"]).select("d1", "d2", *range_of)
    blocks = materialize(_blocks(names, docs, text, need), "suffix-blocks")
    runs = materialize(_runs(blocks, need), "suffix-runs")
    # Runs that repeat as a whole, and those of which at least the common bytes repeat.
    both = F.expr("stack(2, true, whole, false, common) AS (full, h)")
    told = runs.select("key", "name", "n", "s", both).filter("h IS NOT NULL")
    marks = materialize(told.filter("n = 1").join(_repeated(told, ["key", "s", "full", "h"]), ["key", "s", "full", "h"])
                        .groupBy("key", "name", "s").agg(F.max("full").alias("full")), "suffix-marks")
    known = marks.groupBy("key", "name").agg(F.max(F.when(F.col("full"), F.col("s"))).alias("last"),
                                             F.min(F.when(F.col("full"), F.col("s"))).alias("first"))
    # Only what may reach beyond the whole runs is looked at window by window, with all that may equal it.
    unsure = (marks.filter("NOT full").join(known, ["key", "name"]).filter("last IS NULL OR s > last OR s < first")
              .select("key", "name", "s"))
    cores = unsure.join(runs.select("key", "name", "s", "common"), ["key", "name", "s"]).select("key", "s", "common").distinct()
    look = (runs.join(cores, ["key", "s", "common"]).groupBy("key", "name").agg(F.collect_list("s").alias("runs")))  # of one block
    windows = materialize(_windows(blocks.join(look, ["key", "name"]), need), "suffix-windows")
    hits = (windows.filter("n = 1").join(_repeated(windows, ["key", "o", "h"]), ["key", "o", "h"])
            .select("key", "name", F.col("o").alias("top"), F.col("o").alias("bottom")))
    whole = known.filter("last IS NOT NULL").select("key", "name", (F.col("last") * STEP + STEP - 1).alias("top"),
                                                    (F.col("first") * STEP).alias("bottom"))
    # All windows of a suffix hold its first bytes, so what they cover is one range.
    reach = hits.unionByName(whole).groupBy("key", "name").agg(F.max("top").alias("top"), F.min("bottom").alias("bottom"))
    single = names.join(reach, ["key", "name"]).select(
        "d1", "d2", (_at(F.col("place")) - F.col("top")).alias("start"), (_at(F.col("place")) - F.col("bottom") + need).alias("end"))
    return (sure.unionByName(twice).unionByName(single).groupBy("d1", "d2")
            .agg(F.collect_set(F.struct("start", "end")).alias("spans")))  # of one text


def cut(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) and, with ``keep``, the
    remaining bytes ``kept`` (a cut may fall inside a character)."""
    body = text_or_empty(text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), body.alias("body"), *[c.alias(n) for c, n in zip(digest(body), ("d1", "d2"))])
    hit = _low_bits(F.col("d1")) == F.col("bucket")
    buckets = _buckets(found)
    raw = F.col("body").cast("binary")
    clean = rows.join(buckets, hit, "left_anti").select(
        "doc_id", F.octet_length("body").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(raw, 256).alias("kept_sha256"), *([raw.alias("kept")] if keep else []))
    names = clean.columns
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            cols: list[list] = [[] for _ in range(5 if keep else 4)]
            for value, ranges in zip(b.column(1), b.column(2)):
                raw, at, removed, runs, kept = value.as_py(), 0, 0, 0, []
                for start, end in sorted((r["start"], r["end"]) for r in ranges.as_py() or ()):
                    if start > at or not runs:
                        kept.append(raw[at:start])
                        runs, at = runs + 1, start
                    if end > at:
                        removed, at = removed + end - at, end
                kept.append(raw[at:])
                left = b"".join(kept)
                for c, v in zip(cols, (len(raw), removed, runs, hashlib.sha256(left).hexdigest(), left)):
                    c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=names)

    suspects = (rows.join(buckets, hit, "left_semi").join(found, ["d1", "d2"], "left")
                .select("doc_id", F.col("body").cast("binary").alias("body"), "spans"))
    return clean.unionByName(suspects.mapInArrow(run, f"doc_id {kind}, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in clean.schema.fields[1:])))


def remove_repeats(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", batches: int = BATCHES,
                   need: int = NEED, core: int = CORE, keep: bool = True) -> DataFrame:
    """Cut every byte that a repeated string of ``need`` bytes covers. The rows
    enter the family at ``path`` in ``batches`` batches, told by their text."""
    family = SuffixFamily(docs.sparkSession, path, need, core)
    part = F.pmod(F.xxhash64(F.lit("batch"), text_or_empty(text)), F.lit(batches))
    for i in range(batches):
        family.add(docs.filter(part == i), f"part-{i}-of-{batches}", text)
    found = materialize(spans(family, docs, text), "suffix-spans")
    return cut(docs, found, doc_id, text, keep)
