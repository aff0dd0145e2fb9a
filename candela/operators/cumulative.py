"""Reverse cumulative products: what later events do to earlier bars."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def strictly_after(bars: DataFrame, events: DataFrame, key: str, day: str, event_day: str, factors: Mapping[str, str]) -> DataFrame:
    """``bars`` with, for each (factor, name), the product of the key's factors whose event day is after the bar's.

    NULL factors and those not above 0 are left out; without events the product
    is 1. All products come from one window over one timeline: events are
    multiplied by day first, then added to the bars' rows.
    """
    usable = lambda c: F.when(F.col(c) > 0, F.col(c))
    daily = events.groupBy(key, F.col(event_day).alias(day)).agg(*[F.product(usable(c)).alias(f"_{c}") for c in factors])
    line = bars.withColumn("_bar", F.lit(True)).unionByName(daily, allowMissingColumns=True)
    line = line.withColumn("_day", F.datediff(F.col(day), F.lit("1970-01-01").cast("date")))
    after = Window.partitionBy(key).orderBy(F.col("_day").desc()).rangeBetween(Window.unboundedPreceding, -1)
    products = [F.coalesce(F.product(f"_{c}").over(after), F.lit(1.0)).alias(name) for c, name in factors.items()]
    return line.select(*bars.columns, "_bar", *products).filter("_bar").drop("_bar")


def within_edge(events: DataFrame, bars: DataFrame, key: str, event_day: str, day: str) -> DataFrame:
    """Events on or before the key's last bar: later ones have nothing to adjust against yet."""
    edge = bars.groupBy(key).agg(F.max(day).alias("_edge"))
    return events.join(edge, key).filter(F.col(event_day) <= F.col("_edge")).drop("_edge")
