"""SimHash near-duplicates through a Gray-order hierarchical index.

Every text gets a 64-bit fingerprint over its word shingles. Distinct
fingerprints are sorted by Gray rank, where neighbours share many bits, and cut
into ranges. Over each range stands a tree: a node keeps the bits on which all
fingerprints below it agree (its masked pattern), less those its ancestors
already have. A search goes down from the top, adds up the differing bits of
the masked patterns, and drops a whole subtree once the sum passes the limit.
The same kind of tree over the ranges tells which ranges a fingerprint must
visit, so a fingerprint travels to the few ranges that can hold a neighbour
(about C(log2 ranges, <= 2)) instead of meeting all others.

Scale: copies collapse to one fingerprint before anything else; ranges are
made from a histogram over the first ``PREFIX`` bits of the rank (at most
2 ** PREFIX rows reach the driver, never fingerprints); a fingerprint has at
most C(64, 1) + C(64, 2) = 2,080 neighbours at two bits, so the pairs a range
meets are linear in its size, and only a spanning forest of them leaves it.
Components come from alternating star contraction, each round written out.

Defined results: a null or wordless text has fingerprint zero and links like
any other; a text with fewer words than a shingle is one shingle; repeated
rows share their component; a component's id is its smallest doc_id, null
when all of its ids are null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultline.llm.common import fresh, materialize

SHINGLE, MAX_BITS, SEED = 3, 2, 42
PREFIX, RANGE_SIZE, FANOUT, CHUNK, BUCKET_BITS = 16, 1024, 8, 2048, 20
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint: bit i is 1 if more than half of the shingle hashes
    have it. Only A-Z are lower-cased; words are non-blank runs."""
    import xxhash
    words = (text or "").encode("utf-8").lower().split()  # of bytes: ASCII only, for both
    if not words:
        return 0
    if len(words) < shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(p, SEED) for p in parts], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(h), 255):  # 255 rows of bits fit a byte's sum
        ones += np.add.reduce(np.unpackbits(h[i:i + 255].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"),
                              axis=0, dtype=np.uint8)
    bits = np.packbits(ones * 2 > len(h), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                 content: bool = False) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long. With ``content`` also c1
    and c2, hashes of the text."""
    more = [h.alias(f"c{n}") for n, h in enumerate(_content(F.col(text)), 1)] if content else []
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), *more)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64)), *b.columns[2:]],
                                             names=["doc_id", "fp", *b.schema.names[2:]])

    return rows.mapInArrow(run, f"doc_id {kind}, fp long" + (", c1 long, c2 long" if content else ""))


def gray_rank(fp: Column) -> Column:
    """Place of a fingerprint in Gray order (the inverse Gray code), as a long
    to be read as unsigned."""
    r = fp
    for s in (1, 2, 4, 8, 16, 32):
        r = r.bitwiseXOR(F.shiftrightunsigned(r, s))
    return r


def _gray_rank(v: np.ndarray) -> np.ndarray:
    r = v.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


class GrayTree:
    """Masked patterns over rows in Gray order. Rows may be fingerprints (all
    bits fixed) or groups of them (``mask`` says which bits are)."""

    def __init__(self, value: np.ndarray, mask: np.ndarray | None = None):
        mask = np.full(len(value), ALL) if mask is None else mask
        self.levels = [(value & mask, mask)]  # from the rows up
        low, high = value & mask, value | ~mask  # bits set in all, bits set in any
        while len(low) > FANOUT:
            cut = np.arange(0, len(low), FANOUT)
            low, high = np.bitwise_and.reduceat(low, cut), np.bitwise_or.reduceat(high, cut)
            fixed = ~(low ^ high)
            self.levels.append((low & fixed, fixed))

    def within(self, queries: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """(query index, row index) of all rows whose fixed bits differ from the
        query's in at most ``limit`` places."""
        value, mask = self.levels[-1]
        q = np.repeat(np.arange(len(queries)), len(value))
        node = np.tile(np.arange(len(value)), len(queries))
        spent = np.bitwise_count((queries[q] ^ value[node]) & mask[node])
        keep = spent <= limit
        q, node, spent = q[keep], node[keep], spent[keep]
        for level in range(len(self.levels) - 2, -1, -1):
            above = self.levels[level + 1][1]
            value, mask = self.levels[level]
            child = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            parent, q, spent = np.repeat(node, FANOUT), np.repeat(q, FANOUT), np.repeat(spent, FANOUT)
            real = child < len(value)
            child, parent, q, spent = child[real], parent[real], q[real], spent[real]
            spent = spent + np.bitwise_count((queries[q] ^ value[child]) & mask[child] & ~above[parent])
            keep = spent <= limit
            node, q, spent = child[keep], q[keep], spent[keep]
        return q, node


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each of n nodes' component under the edges a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        if (root == before).all():
            break
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]
    return root


def _ranges(fps: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of about ``size`` fingerprints: (first prefix, value, mask) of
    each, from a histogram of at most 2 ** PREFIX rows."""
    prefix = F.shiftrightunsigned(gray_rank(F.col("fp")), 64 - PREFIX).cast("int")
    hist = sorted(tuple(r) for r in fps.groupBy(prefix.alias("p")).agg(
        F.count(F.lit(1)), F.bit_and("fp"), F.bit_or("fp")).collect())
    first, low, high, room = [], [], [], 0
    for p, n, a, o in hist:
        a, o = np.int64(a).astype(np.uint64), np.int64(o).astype(np.uint64)
        if room <= 0:
            first.append(p), low.append(a), high.append(o)
            room = size
        else:
            low[-1] &= a
            high[-1] |= o
        room -= n
    low, high = np.array(low, dtype=np.uint64), np.array(high, dtype=np.uint64)
    fixed = ~(low ^ high)
    return np.array(first, dtype=np.int64), low & fixed, fixed


def links(fps: DataFrame, max_bits: int = MAX_BITS, size: int = RANGE_SIZE) -> DataFrame:
    """Spanning edges (a, b) of the graph that joins distinct fingerprints at
    most ``max_bits`` apart. ``fps`` has distinct values in ``fp``."""
    first, value, mask = _ranges(fps, size)
    if not len(first):
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).filter(F.lit(False))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top = GrayTree(value, mask)
        for batch in batches:
            v = batch["fp"].to_numpy().astype(np.int64).view(np.uint64)
            for i in range(0, len(v), CHUNK):
                part = v[i:i + CHUNK]
                own = np.searchsorted(first, (_gray_rank(part) >> np.uint64(64 - PREFIX)).astype(np.int64), "right") - 1
                q, to = top.within(part, max_bits)
                later = to > own[q]  # each pair meets in the later of its two ranges
                yield pd.DataFrame({
                    "range": np.concatenate([own, to[later]]).astype(np.int32),
                    "fp": np.concatenate([part, part[q[later]]]).view(np.int64),
                    "visitor": np.concatenate([np.zeros(len(part), bool), np.ones(int(later.sum()), bool)])})

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        v = group["fp"].to_numpy().view(np.uint64)
        visitor = group["visitor"].to_numpy()
        members = v[~visitor]
        members = members[np.argsort(_gray_rank(members), kind="stable")]
        tree = GrayTree(members)
        nodes = np.concatenate([members, v[visitor]])
        left, right = [], []
        for i in range(0, len(nodes), CHUNK):
            q, m = tree.within(nodes[i:i + CHUNK], max_bits)
            q = q + i
            once = q > m  # a member meets itself and each partner twice
            left.append(q[once]), right.append(m[once])
        root = _forest(len(nodes), np.concatenate(left), np.concatenate(right))
        joined = root != np.arange(len(nodes))
        return pd.DataFrame({"a": nodes[joined].view(np.int64), "b": nodes[root[joined]].view(np.int64)})

    return (fps.select("fp").mapInPandas(route, "range int, fp long, visitor boolean")
            .groupBy("range").applyInPandas(meet, "a long, b long"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): rows (a, b) with b the smallest
    node of a's component, for every node but the smallest. Alternating large
    and small stars; every round is written, so a lost executor costs a round
    at most."""
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .filter("a != b").distinct(), "simhash-edges")
    for _ in range(rounds):
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = materialize(both.join(low, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
                            .filter("a != b").distinct(), "simhash-large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        after = materialize(small.select("a", F.col("m").alias("b"))
                            .union(small.filter("b != m").select("b", "m")).distinct(), "simhash-small")
        same = _state(after) == _state(edges)
        edges = after
        if same:
            return edges
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def classes(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root, component_id) of every fingerprint of ``rows`` (doc_id, fp):
    root is the component's smallest fingerprint, component_id its smallest document."""
    distinct = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    star = components(links(distinct, max_bits))
    rooted = (distinct.join(star, distinct["fp"] == star["a"], "left")
              .select("fp", "first", F.coalesce("b", "fp").alias("root")))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rooted.join(lowest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row."""
    rows = materialize(fingerprints(docs, doc_id, text, shingle), "simhash-fingerprints")
    found = classes(rows, max_bits).select("fp", "component_id")
    return rows.join(found, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _content(text: Column) -> list[Column]:
    """128 bits of a text: tells rows of one id apart."""
    return [F.xxhash64(F.coalesce(text, F.lit("")), F.lit(n)) for n in (1, 2)]


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component: the one with the smallest id (a null id
    comes last), and of several texts under that id the one with the smallest
    hash. Rows are told apart by id and text, so other texts of a repeated id
    stand for themselves; repeated rows of the same id and text become one."""
    rows = materialize(fingerprints(docs, doc_id, text, shingle, content=True), "simhash-fingerprints")
    root = classes(rows.select("doc_id", "fp"), max_bits).select("fp", "root")
    i, c1, c2, b, act = fresh(docs, "_k_id", "_k_c1", "_k_c2", "_k_bucket", "_k_act")
    entries = materialize(rows.groupBy("fp", "doc_id", "c1", "c2").agg(F.count(F.lit(1)).alias("n"))
                          .join(root, "fp").select("root", "doc_id", "c1", "c2", "n"), "simhash-entries")
    at = F.struct(F.col("doc_id").isNull(), "doc_id", "c1", "c2")
    first = entries.groupBy("root").agg(F.min(at).alias("first"))  # summed up before the shuffle
    # Entries that go, and those that stay as one row of several. Documents whose id and text fall into no such entry's
    # bucket stay at once; only the others are compared (and shuffled, when many go). At most 2 ** BUCKET_BITS buckets
    # are broadcast.
    told = entries.join(first, "root").withColumn(act, F.when(~at.eqNullSafe(F.col("first")), "go").when(F.col("n") > 1, "one"))
    told = materialize(told.filter(F.col(act).isNotNull()).select(
        F.col("doc_id").alias(i), F.col("c1").alias(c1), F.col("c2").alias(c2), act), "simhash-told")
    one, two = _content(docs[text])
    low = lambda h, k: F.xxhash64(h, k).bitwiseAND(F.lit(2 ** BUCKET_BITS - 1))
    buckets = F.broadcast(told.select(low(F.col(c1), F.col(i)).alias(b)).distinct())
    suspect = low(one, docs[doc_id]) == F.col(b)
    named = (docs.join(buckets, suspect, "left_semi")
             .join(told, docs[doc_id].eqNullSafe(told[i]) & (one == told[c1]) & (two == told[c2]), "left")
             .filter(F.col(act).isNull() | (F.col(act) == "one")))
    out = docs.join(buckets, suspect, "left_anti").unionByName(named.filter(F.col(act).isNull()).select(*docs.columns))
    if told.filter(F.col(act) == "one").take(1):
        again = named.filter(F.col(act) == "one").dropDuplicates([doc_id, c1, c2])
        out = out.unionByName(again.select(*docs.columns))
    return out
