"""Shards through fixed virtual slots.

A record's virtual slot is a hash of its key modulo ``N_SLOTS``; that never
changes. Bytes and rows are summed per slot, and a versioned slot-to-shard map
says where each slot lives. Version 1 starts from equal ranges of slots; each
run edits the latest stored version (moves and swaps of whole slots from the
fullest to the emptiest shard) and stores the result as the next one where it differs, so most
slots stay where they are. With more shards than before, ``grow_only`` lets slots go to the new ones
and nowhere else; with fewer, the slots of those that are gone are dealt out first. The map has ``N_SLOTS`` rows whatever the input, which
bounds what the driver edits and what joins broadcast.

Law: ``bytes``, the shards' sizes are near equal.

Defined results: a null text has size 16 and the CRC of the empty text; a null
key is hashed by its text; repeated rows are rows of their own (ties in a slot
are ordered by key, CRC and size); an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vaultline.llm.common import materialize, text_or_empty
from vaultline.operators.incremental import path_exists
from vaultline.session import scratch_path

N_SLOTS = 8192
OVERHEAD = 16  # bytes a record takes beside its text
MAP_SCHEMA = "virtual_slot int, shard int, version int"


def virtual_slots(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_slots: int = N_SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot) of every row."""
    body = text_or_empty(text)
    key = F.when(F.col(doc_id).isNull(), F.xxhash64(body)).otherwise(F.xxhash64(F.col(doc_id)))
    return docs.select(
        F.col(doc_id).alias("doc_id"), (F.octet_length(body) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.encode(body, "UTF-8")).alias("text_crc32"),
        F.pmod(key, F.lit(n_slots)).cast("int").alias("virtual_slot"))


def slot_totals(slots: DataFrame) -> DataFrame:
    """Bytes and rows per virtual slot: at most ``n_slots`` rows."""
    return slots.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def initial_map(n_shards: int, n_slots: int = N_SLOTS) -> list[int]:
    return [s * n_shards // n_slots for s in range(n_slots)]


def edit_map(shard_of: list[int], weight: list[int], n_shards: int) -> list[int]:
    """The map after rebalancing. The fullest shard gives the emptiest one the
    slot, or swaps the pair of slots, whose difference is nearest to half the
    gap. A shard that no step can ease (one slot is its load) is left as it is
    and the next fullest goes on. Empty slots stay."""
    shard_of = list(shard_of)
    load = [0] * n_shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    for slot, w in enumerate(weight):
        load[shard_of[slot]] += w
        if w:
            held[shard_of[slot]].append((w, slot))
    for h in held:
        h.sort()

    def move(item: tuple[int, int], a: int, b: int) -> None:
        held[a].remove(item)
        insort(held[b], item)
        load[a] -= item[0]
        load[b] += item[0]
        shard_of[item[1]] = b

    def nearest(items: list[tuple[int, int]], w: int) -> list[tuple[int, int]]:
        i = bisect_left(items, (w, -1))
        return items[max(0, i - 1):i + 1]

    full = set(range(n_shards))
    for _ in range(20 * len(weight)):
        low = min(range(n_shards), key=load.__getitem__)
        high = max(full, key=load.__getitem__, default=low)
        if high == low:
            break
        gap = load[high] - load[low]
        # (distance to the ideal, item given, item taken back)
        steps = [(abs(2 * x[0] - gap), x, None) for x in nearest(held[high], gap // 2) if 0 < x[0] < gap]
        if not steps or steps[0][0] > gap // 8:
            steps += [(abs(2 * (x[0] - y[0]) - gap), x, y) for y in held[low]
                      for x in nearest(held[high], y[0] + gap // 2) if 0 < x[0] - y[0] < gap]
        if not steps:
            full.discard(high)
            continue
        _, give, take = min(steps, key=lambda step: step[0])
        move(give, high, low)
        if take:
            move(take, low, high)
    return shard_of


def grow_map(shard_of: list[int], weight: list[int], n_shards: int) -> list[int]:
    """The map with the shards above its last one filled up to an even share:
    each takes, from the fullest of the others, the largest slot that still fits."""
    shard_of, old = list(shard_of), max(shard_of) + 1
    load = [0] * n_shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(n_shards)]
    for slot, w in sorted(enumerate(weight), key=lambda x: (x[1], x[0])):
        load[shard_of[slot]] += w
        if w:
            held[shard_of[slot]].append((w, slot))
    share = sum(load) // n_shards
    for new in range(old, n_shards):
        givers = set(range(old))
        while givers:
            high = max(givers, key=load.__getitem__)
            i = bisect_left(held[high], (share - load[new] + 1, -1)) - 1
            if i < 0:
                givers.discard(high)
                continue
            w, slot = held[high].pop(i)
            load[high], load[new], shard_of[slot] = load[high] - w, load[new] + w, new
    return shard_of


def _without(shard_of: list[int], weight: list[int], n_shards: int) -> list[int]:
    """Slots of shards that are gone go to the emptiest of the others, the heaviest first."""
    shard_of, load = list(shard_of), [0] * n_shards
    for slot, sh in enumerate(shard_of):
        if sh < n_shards:
            load[sh] += weight[slot]
    for slot in sorted((s for s, sh in enumerate(shard_of) if sh >= n_shards), key=lambda s: (-weight[s], s)):
        low = min(range(n_shards), key=load.__getitem__)
        shard_of[slot], load[low] = low, load[low] + weight[slot]
    return shard_of


def latest_version(spark: SparkSession, path: str) -> int:
    """The highest whole version under ``path``, 0 if there is none. A version is
    one file, so one that was cut off in writing has no rows."""
    if not path_exists(spark, path):
        return 0
    maps = spark.read.schema(MAP_SCHEMA).parquet(path)
    return maps.agg(F.max("version")).first()[0] or 0


def next_map(spark: SparkSession, path: str, weight: list[int], n_shards: int, grow_only: bool = False) -> tuple[list[int], int]:
    """(map, version) for these weights: the latest stored map, edited, and stored as
    the next version where that changes anything."""
    version = latest_version(spark, path)
    before = read_map(spark, path, version) if version else initial_map(n_shards, len(weight))
    if len(before) != len(weight):
        raise ValueError(f"the map under {path} has {len(before)} slots, not {len(weight)}")
    if grow_only and version:
        after = grow_map(before, weight, n_shards) if max(before) < n_shards - 1 else before
    else:
        after = edit_map(_without(before, weight, n_shards), weight, n_shards)
    if version and after == before:
        return before, version
    write_map(spark, path, after, version + 1)
    return after, version + 1


def write_map(spark: SparkSession, path: str, shard_of: list[int], version: int) -> None:
    (spark.createDataFrame([(i, s, version) for i, s in enumerate(shard_of)], MAP_SCHEMA)
     .coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={version}"))


def read_map(spark: SparkSession, path: str, version: int) -> list[int]:
    rows = spark.read.parquet(f"{path.rstrip('/')}/version={version}").select("virtual_slot", "shard").collect()
    out = [0] * len(rows)
    for slot, shard in rows:
        out[slot] = shard
    return out


def shard(docs: DataFrame, n_shards: int, doc_id: str = "doc_id", text: str = "text",
          n_slots: int = N_SLOTS, map_path: str | None = None, grow_only: bool = False) -> DataFrame:
    """(doc_id, size, text_crc32, virtual_slot, shard, slot, map_version): slot
    is the row's place in its shard, gapless from 0. The latest version of the map under
    ``map_path`` is taken on (without a path: a map of this run's own); one writer at a time."""
    spark = docs.sparkSession
    map_path = map_path or scratch_path(spark, "slot-map")
    rows = materialize(virtual_slots(docs, doc_id, text, n_slots), "virtual-slots")
    totals = {r[0]: (r[1], r[2]) for r in slot_totals(rows).collect()}  # at most n_slots rows
    weight = [totals.get(s, (0, 0))[0] for s in range(n_slots)]
    shard_of, version = next_map(spark, map_path, weight, n_shards, grow_only)
    # The first place of each slot in its shard: running row counts over the map.
    places, at = [], [0] * max(n_shards, max(shard_of) + 1)
    for slot, sh in enumerate(shard_of):
        places.append((slot, sh, at[sh]))
        at[sh] += totals.get(slot, (0, 0))[1]
    where = F.broadcast(spark.createDataFrame(places, "virtual_slot int, shard int, first long"))  # n_slots rows
    order = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("place", F.row_number().over(order) - 1).join(where, "virtual_slot")
            .select("doc_id", "size", "text_crc32", "virtual_slot", "shard",
                    (F.col("first") + F.col("place")).alias("slot"), F.lit(version).alias("map_version")))
