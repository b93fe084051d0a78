"""Bloom filters as tables: (block, bits), one row per 64-bit block.

A key sets ``BITS`` bits of one block. Building is a ``bit_or`` per block with a
partial step on the map side; probing is an equi-join on the block, which the
planner broadcasts or shuffles by the filter's size. So a filter may be as
large as its keys need, and nothing passes the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, KEYS_PER_BLOCK = 4, 4  # 16 bits a key: about one key in 300 is a false positive


def blocks_for(n_keys: int) -> int:
    """A power of two, so that filters of like size share a layout."""
    return 1 << max(0, -(-n_keys // KEYS_PER_BLOCK) - 1).bit_length()


def _hash(cols: Sequence[str], seed: str) -> Column:
    return F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in cols])


def place(cols: Sequence[str], blocks: int | Column) -> Column:
    blocks = blocks if isinstance(blocks, Column) else F.lit(blocks)
    return F.pmod(_hash(cols, "block"), blocks.cast("long")).cast("int")


def mask(cols: Sequence[str]) -> Column:
    """The bits of a key in its block."""
    h, one = _hash(cols, "bits"), F.lit(1).cast("long")
    bits = [F.call_function("shiftleft", one, F.shiftright(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def build(rows: DataFrame, cols: Sequence[str], blocks: int) -> DataFrame:
    """(block, bits) of the keys of ``rows``; NULL keys are keys like others."""
    return rows.select(place(cols, blocks).alias("block"), mask(cols).alias("m")).groupBy("block").agg(F.bit_or("m").alias("bits"))


def possible(rows: DataFrame, cols: Sequence[str], filters: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """(``cols``, batch) for every key of ``rows`` that may be in a batch.
    ``filters``: (batch, blocks, block, bits); ``sizes``: the values of blocks."""
    keys = rows.select(*[F.col(f"`{c}`") for c in cols]).distinct()
    probes = (keys.withColumn("_blocks", F.explode(F.array(*[F.lit(s) for s in sizes])))
              .withColumn("_block", place(cols, F.col("_blocks"))).withColumn("_mask", mask(cols)))
    meets = ((probes["_blocks"] == filters["blocks"]) & (probes["_block"] == filters["block"])
             & (filters["bits"].bitwiseAND(probes["_mask"]) == probes["_mask"]))
    return probes.join(filters, meets).select(*[probes[f"`{c}`"] for c in cols], filters["batch"].alias("batch"))
