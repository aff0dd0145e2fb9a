"""The security master: what is listed and what was seen trading."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.schemas import STALE_DAYS


def security_master(listed: DataFrame, bars: DataFrame, key: str, last_day: date | None) -> DataFrame:
    """``key``, the listing's columns, first_seen, last_seen, status, delisting_date.

    What is listed is active; else a key unseen for more than ninety days is
    delisted, one seen on the last day is active, others are suspended.
    """
    seen = bars.groupBy(key).agg(F.min("trade_date").alias("first_seen"), F.max("trade_date").alias("last_seen"))
    joined = listed.withColumn("_listed", F.lit(True)).join(seen, key, "full_outer")
    edge = F.lit(last_day).cast("date")
    status = (
        F.when(F.col("_listed"), "active")
        .when(F.datediff(edge, "last_seen") > STALE_DAYS, "delisted")
        .when(F.col("last_seen") == edge, "active")
        .otherwise("suspended")
    )
    out = joined.withColumn("status", status).drop("_listed")
    return out.withColumn("delisting_date", F.when(F.col("status") == "delisted", F.col("last_seen")))


def symbol_history(bars: DataFrame, key: str, symbol: str) -> DataFrame:
    """``key`` and its symbols with the days that each was seen, as an ordered array."""
    each = bars.groupBy(key, symbol).agg(F.min("trade_date").alias("from_day"), F.max("trade_date").alias("to_day"))
    ordered = F.sort_array(F.collect_list(F.struct("from_day", symbol, "to_day")))
    return each.groupBy(key).agg(ordered.alias("history"))
