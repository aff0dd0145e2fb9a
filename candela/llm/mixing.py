"""Mixing sources to target weights, by Poisson replication.

A source with weight w, of W in all, should give w/W of the characters of the
mix. Its rate is that share over the share it has now. A document is repeated
k times, where k inverts the Poisson distribution of that rate at a uniform
number hashed from the seed and the document; so the mix is the same in any
run, and a document's count does not depend on other documents except through
its source's rate. The copies are dealt out by a second hash, which also
orders each output partition: a uniform global shuffle without a range sample.

Sources are joined as a broadcast table while there are at most
``BROADCAST_SOURCES`` of them, otherwise by a shuffle on (source, salt) with
the small side repeated for each salt, so that a hot source is spread.

The thresholds of a rate are made in log space for the counts within 12
standard deviations, and 30 more, of the rate; so any rate has its own law.

Defined cases: a null source is a source of its own; null and empty texts
count as one character, so that a source of them has a finite rate; rows equal
in id and text get equal counts, rows that share only the id (or have none) are
drawn apart; an empty table gives no rows; other columns are kept, and a clash
with an added name replaces the old one.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.llm.common import unit, unused, written

BROADCAST_SOURCES = 100_000
SALTS = 64
#: Tails of the Poisson distribution below this are cut; uniform numbers have 52 bits.
TAIL = 1e-16


def log_factorial(k: Column) -> Column:
    """ln k!, of a table for small k, else by Stirling's series to 1e-15."""
    small = F.array(*[F.lit(math.lgamma(i + 1)) for i in range(32)])
    x = k.cast("double")
    series = 1 / (12 * x) - 1 / (360 * F.pow(x, 3)) + 1 / (1260 * F.pow(x, 5)) - 1 / (1680 * F.pow(x, 7))
    return F.when(k < 32, F.get(small, k.cast("int"))).otherwise(x * F.log(x) - x + F.log(2 * math.pi * x) / 2 + series)


def with_thresholds(rates: DataFrame, lowest: str, at_most: str) -> DataFrame:
    """rates (_source, rate) with P(X <= k) for k from ``lowest`` until the rest is below TAIL, as an array.

    A count is ``lowest`` and how many of them are <= u.
    """
    rate, k = F.col("rate"), F.col("k")
    spread = 12 * F.sqrt(rate) + 30
    low, high = F.greatest(F.lit(0), F.floor(rate - spread)).cast("bigint"), F.floor(rate + spread).cast("bigint")
    each = rates.select("_source", "rate", low.alias(lowest), F.explode(F.sequence(low, high)).alias("k"))
    p = F.when(rate > 0, F.exp(k * F.log(rate) - rate - log_factorial(k))).otherwise((k == 0).cast("double"))
    up_to = Window.partitionBy("_source", "rate", lowest).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("_source", "rate", lowest)
    summed = each.withColumn("p", p).withColumn("t", F.sum("p").over(up_to) / F.sum("p").over(whole))
    pairs = F.collect_list(F.when((F.col("t") < 1 - TAIL), F.struct("k", "t")))
    lists = summed.groupBy("_source", "rate", lowest).agg(F.array_sort(pairs).alias("pairs"))
    return lists.select("_source", "rate", lowest, F.transform("pairs", lambda x: x["t"]).alias(at_most))


def source_rates(docs: DataFrame, alpha: float, size: float, weights: Mapping[str, float] | None = None) -> DataFrame:
    """source, chars, rate: by given weights, or by chars ** alpha where none are given."""
    chars = F.greatest(F.coalesce(F.length("text"), F.lit(0)), F.lit(1)).cast("bigint")
    per = docs.groupBy(F.col("source").alias("_source")).agg(F.sum(chars).alias("_chars"))
    if weights is None:
        weight = F.pow(F.col("_chars").cast("double"), F.lit(alpha))
    else:
        given = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
        weight = F.coalesce(F.try_element_at(given, F.col("_source")), F.lit(0.0))
    per = written(per.withColumn("_weight", weight))
    everything, weights_sum = per.agg(F.sum("_chars"), F.sum("_weight")).first()  # two numbers
    if not weights_sum:
        return per.select("_source", "_chars", F.lit(0.0).alias("rate"))
    return per.select(
        "_source", "_chars", (size * F.col("_weight") / F.lit(weights_sum) * F.lit(everything) / F.col("_chars")).alias("rate")
    )


def mix(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    alpha: float = 0.7,
    size: float = 1.0,
    seed: int = 42,
    partitions: int | None = None,
) -> DataFrame:
    """The mixed documents with rate, n_copies, copy (0-based) and shuffle_key, in random order.

    ``size`` is the mix's expected length relative to the input's.
    """
    added = ("rate", "n_copies", "copy", "shuffle_key")
    docs = docs.select(*[c for c in docs.columns if c not in added])
    names = docs.columns
    lowest, at_most, salt, text_hash, from_ = unused([*names, *added], "lowest", "at_most", "salt", "text_hash", "from")
    rates = written(with_thresholds(source_rates(docs, alpha, size, weights), lowest, at_most))
    rates = rates.withColumnRenamed("_source", from_)
    hashed = docs.withColumn(text_hash, F.md5("text"))
    if rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        joined = hashed.join(F.broadcast(rates), F.col("source").eqNullSafe(F.col(from_)))
    else:
        salted = hashed.withColumn(salt, F.pmod(F.xxhash64(text_hash, "doc_id"), F.lit(SALTS)))
        other = f"{salt}_"
        repeated = rates.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = salted.join(repeated, F.col("source").eqNullSafe(F.col(from_)) & (F.col(salt) == F.col(other)))
    u = unit(f"{seed}/count", F.col("doc_id"), F.col(text_hash))
    n_copies = (F.col(lowest) + F.size(F.filter(at_most, lambda t: t <= u))).cast("int")
    counted = joined.select(*names, "rate", n_copies.alias("n_copies"), text_hash).filter("n_copies > 0")
    copies = counted.select("*", F.explode(F.sequence(F.lit(0), F.col("n_copies") - 1)).alias("copy"))
    copies = copies.withColumn("shuffle_key", unit(f"{seed}/order", F.col("doc_id"), F.col(text_hash), F.col("copy"))).drop(text_hash)
    key = F.col("shuffle_key")
    dealt = copies.repartition(partitions, key) if partitions else copies.repartition(key)
    return dealt.sortWithinPartitions("shuffle_key", "doc_id", "copy")
