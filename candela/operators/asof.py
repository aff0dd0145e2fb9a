"""As-of lookup: for each row the other side's latest row strictly before it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_before(left: DataFrame, right: DataFrame, on: str, at: str, time: str, take: Mapping[str, str]) -> DataFrame:
    """``left`` with values of the last ``right`` row of the same key whose ``time`` is before ``at``.

    Both sides become one timeline, so there is one exchange on the key and no
    range join; the frame ends one day before the row. Where several rows share
    the latest day, the largest by the taken values counts. ``right`` rows with
    a NULL first taken value do not count, nor do those without a key.
    """
    names = left.columns
    first = next(iter(take))
    values = F.struct(F.col(time).alias("_t"), *[F.col(c).alias(c) for c in take])
    facts = right.filter(F.col(on).isNotNull() & F.col(first).isNotNull() & F.col(time).isNotNull()).groupBy(on, time).agg(F.max(values).alias("_seen"))
    facts = facts.select(on, F.datediff(F.col(time), F.lit("1970-01-01").cast("date")).alias("_day"), "_seen")
    wanted = left.select("*", F.datediff(F.col(at), F.lit("1970-01-01").cast("date")).alias("_day"), F.lit(True).alias("_ask"))
    line = wanted.unionByName(facts, allowMissingColumns=True)
    before = Window.partitionBy(on).orderBy("_day").rangeBetween(Window.unboundedPreceding, -1)
    seen = line.withColumn("_last", F.last("_seen", ignorenulls=True).over(before)).filter("_ask")
    return seen.select(*names, *[F.col("_last")[c].alias(out) for c, out in take.items()])


def prior_row(rows: DataFrame, keys: list[str], time: str, most_days: int, take: Mapping[str, str]) -> DataFrame:
    """``rows`` with values of the key's previous row, if it is at most ``most_days`` older."""
    by = Window.partitionBy(*keys).orderBy(time)
    near = F.datediff(F.col(time), F.lag(time).over(by)) <= most_days
    taken = [F.when(near, F.lag(c).over(by)).alias(out) for c, out in take.items()]
    return rows.select("*", *taken)
