"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows fall into ``BLOCKS`` blocks by a hash of the row's key. How many rows of
each block go to each shard is drawn exactly, from the multivariate
hypergeometric law that a uniform shuffle of all rows implies. Within a block a
random permutation tells which rows those are; after the exchange a second
random permutation orders each shard. Shard counts differ by one at most (law
``rows``). Only the matrix, of ``BLOCKS`` x shards integers whatever the
input, is made outside the plan, from the blocks' counts.

Both permutations rank rows by hashes within (block) and within (shard, slot
range); ranges are uniform in size, so no task gets a whole shard.

A row's key is its id, its text's hash and a number among the rows that share
both. These are numbered in parts, by where the part's rows begin, so that a
text that a third of the rows repeat goes through many tasks. The rows' keys
are written once, so all steps and retries see the same. Equal rows are
interchangeable: the result does not depend on how the input is partitioned.

Defined cases: a null text counts as no bytes, and its CRC-32 as that of no
bytes; a null id is an id like others; no rows give no rows. Other columns are
not read. Groups of equal texts are spread, as the law ``rows`` requires.
"""

from __future__ import annotations

import math
import random
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import written

#: Blocks, and slot ranges of all shards together.
BLOCKS = 4096
#: Parts in which rows of one key are numbered.
PARTS = 64


def hypergeometric(rng: random.Random, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` items taken from good + bad are good: exact inversion outward from the mode."""
    low, high = max(0, drawn - bad), min(good, drawn)
    if low == high:
        return low
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (good + bad + 2)))
    choose = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    at_mode = math.exp(choose(good, mode) + choose(bad, drawn - mode) - choose(good + bad, drawn))
    left = rng.random() - at_mode
    down = up = mode
    p_down = p_up = at_mode
    while left > 0 and (down > low or up < high):
        if up < high:
            p_up *= (good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1))
            up += 1
            if (left := left - p_up) <= 0:
                return up
        if down > low:
            p_down *= down * (bad - drawn + down) / ((good - down + 1) * (drawn - down + 1))
            down -= 1
            if (left := left - p_down) <= 0:
                return down
        if p_up < 1e-300 and p_down < 1e-300:
            break
    return mode


def matrix(block_counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows by block and shard, drawn as a uniform shuffle would deal them; sums are exact both ways."""
    rng = random.Random(seed)
    left = list(sizes)
    out = []
    for count in block_counts:
        row, rest, total = [], count, sum(left)
        for room in left:
            total -= room
            row.append(hypergeometric(rng, room, total, rest))
            rest -= row[-1]
        left = [a - b for a, b in zip(left, row, strict=True)]
        out.append(row)
    return out


def _hash(seed: str, *keys: Column) -> Column:
    return F.xxhash64(F.lit(seed), *keys)


def numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with _copy, numbers from 0 among the rows that agree in ``keys``."""
    parted = written(rows.withColumn("_part", F.pmod(F.monotonically_increasing_id(), F.lit(PARTS))))
    sizes = parted.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).filter("_before > 0")
    sizes = sizes.select(*[F.col(c).alias(f"_of_{c}") for c in [*keys, "_part"]], "_before")
    same = F.lit(True)
    for c in [*keys, "_part"]:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    at = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(F.lit(0)))
    copy = F.coalesce("_before", F.lit(0)) + at - 1
    return parted.join(sizes, same, "left").withColumn("_copy", copy).select(*rows.columns, "_copy")


def shuffle_into_shards(rows: DataFrame, keys: list[str], shards: int, seed: int = 42) -> DataFrame:
    """``rows`` with shard (int) and slot (long, gapless from 0 in each shard); ``keys`` tell rows that differ apart."""
    spark = rows.sparkSession
    names = rows.columns
    key = [*keys, "_copy"]
    keyed = lambda part: _hash(f"{part}/{seed}", *[F.col(c) for c in key])
    block = F.pmod(keyed("block"), F.lit(BLOCKS)).cast("int")
    rows = written(numbered(rows, keys).withColumn("_block", block))
    counts = sorted((r["_block"], r["n"]) for r in rows.groupBy("_block").agg(F.count(F.lit(1)).alias("n")).collect())  # BLOCKS at most
    total = sum(n for _, n in counts)
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    dealt = matrix([n for _, n in counts], sizes, seed)
    ends = spark.createDataFrame(
        [(b, list(accumulate(row))) for (b, _), row in zip(counts, dealt, strict=True)], "_block int, _ends array<bigint>"
    )
    order = Window.partitionBy("_block").orderBy(keyed("first"), *key)
    taken = rows.withColumn("_rank", F.row_number().over(order)).join(F.broadcast(ends), "_block")
    taken = taken.withColumn("shard", F.size(F.filter("_ends", lambda end: end < F.col("_rank"))).cast("int"))

    ranges = max(1, BLOCKS // shards)
    taken = taken.withColumn("_range", F.pmod(keyed("second"), F.lit(ranges)).cast("int"))
    taken = written(taken.select(*names, "_copy", "shard", "_range"))
    per_range = sorted(
        (r["shard"], r["_range"], r["n"]) for r in taken.groupBy("shard", "_range").agg(F.count(F.lit(1)).alias("n")).collect()
    )  # at most BLOCKS rows, or one a shard
    starts, last, at = [], None, 0
    for shard, part, n in per_range:
        at = at if shard == last else 0
        starts.append((shard, part, at))
        last, at = shard, at + n
    starts = spark.createDataFrame(starts, "shard int, _range int, _start bigint")
    order = Window.partitionBy("shard", "_range").orderBy(keyed("third"), *key)
    placed = taken.withColumn("_at", F.row_number().over(order)).join(F.broadcast(starts), ["shard", "_range"])
    return placed.select(*names, "shard", (F.col("_start") + F.col("_at") - 1).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 16, seed: int = 42) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return shuffle_into_shards(rows, ["doc_id", "text_hash", "size", "text_crc32"], shards, seed).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
