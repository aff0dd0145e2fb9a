"""Identifier chains: one security under several identifiers over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candela.functions.scalars import security_type, stem
from candela.operators.storage import materialised
from candela.schemas import CONTINUITY_TOLERANCE, MAX_CHAIN, PRIOR_DAYS, STEM_DAYS


def one_per_day(bars: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each key: the main series first, then volume, then series."""
    best = Window.partitionBy(*keys).orderBy((F.col("series") == "EQ").desc(), F.col("volume").desc_nulls_last(), "series")
    return bars.withColumn("_n", F.row_number().over(best)).filter("_n = 1").drop("_n")


def switches(bars: DataFrame) -> DataFrame:
    """symbol, old_isin, new_isin, switch_date, prior_date, prior_close, prev_close, close: changes between near days."""
    daily = one_per_day(bars.filter(security_type(F.col("isin")) == "01"), ["symbol", "trade_date"])
    by = Window.partitionBy("symbol").orderBy("trade_date")
    before = {f"_{c}": F.lag(c).over(by) for c in ("isin", "c", "trade_date")}
    moved = daily.withColumns(before).filter("_isin <> isin")
    return moved.filter(F.datediff("trade_date", "_trade_date") <= PRIOR_DAYS).select(
        "symbol",
        F.col("_isin").alias("old_isin"),
        F.col("isin").alias("new_isin"),
        F.col("trade_date").alias("switch_date"),
        F.col("_trade_date").alias("prior_date"),
        F.col("_c").alias("prior_close"),
        "prev_close",
        F.col("c").alias("close"),
    )


def judged(found: DataFrame) -> DataFrame:
    """Switches with gap and status: accepted where the reported previous close continues the old identifier's."""
    gap = F.abs(F.try_divide(F.col("prev_close") - F.col("prior_close"), F.col("prior_close")))
    status = F.when(gap <= CONTINUITY_TOLERANCE, "accepted").otherwise("rejected_gap")
    return found.withColumns({"gap": gap, "status": status})


def edges(found: DataFrame) -> DataFrame:
    """old_isin, new_isin of accepted switches; of several for one identifier the last by symbol and date counts."""
    return (
        found.filter("status = 'accepted'")
        .groupBy("old_isin")
        .agg(F.max_by("new_isin", F.struct("symbol", "switch_date")).alias("new_isin"))
    )


def terminal(links: DataFrame, most: int = MAX_CHAIN) -> DataFrame:
    """isin, canonical_isin, depth: where following the links ends.

    Pointers are doubled, so a chain of twenty takes five joins, each over the
    written table of the one before; a walk that comes back to its start stops
    before it does.
    """
    walk = materialised(links.select(
        F.col("old_isin").alias("isin"),
        F.col("new_isin").alias("canonical_isin"),
        F.lit(1).alias("depth"),
    ).filter("isin <> canonical_isin"))
    hops = 1
    while hops < most:
        following = walk.select(
            F.col("isin").alias("_at"), F.col("canonical_isin").alias("_next"), F.col("depth").alias("_more")
        )
        joined = walk.join(following, walk["canonical_isin"] == following["_at"], "left")
        onward = F.col("_next").isNotNull() & (F.col("_next") != F.col("isin"))
        walk = materialised(joined.select(
            "isin",
            F.when(onward, F.col("_next")).otherwise(F.col("canonical_isin")).alias("canonical_isin"),
            (F.col("depth") + F.when(onward, F.col("_more")).otherwise(0)).alias("depth"),
        ))
        hops *= 2
    return walk


def spans(bars: DataFrame) -> DataFrame:
    """isin, symbol, first_seen, last_seen, bars."""
    return bars.groupBy("isin", "symbol").agg(
        F.min("trade_date").alias("first_seen"), F.max("trade_date").alias("last_seen"), F.count(F.lit(1)).alias("bars")
    )


def stem_pairs(seen: DataFrame, linked: DataFrame, most_days: int = STEM_DAYS) -> DataFrame:
    """old_isin, new_isin, gap_days: same symbol and stem, the new one begins soon after the old one ends."""
    old = seen.select("symbol", stem(F.col("isin")).alias("_stem"), F.col("isin").alias("old_isin"), "last_seen")
    new = seen.select("symbol", stem(F.col("isin")).alias("_stem"), F.col("isin").alias("new_isin"), "first_seen")
    gap = F.datediff("first_seen", "last_seen")
    pairs = old.join(new, ["symbol", "_stem"]).filter((F.col("old_isin") != F.col("new_isin")) & (gap > 0) & (gap <= most_days))
    pairs = pairs.select("symbol", "old_isin", "new_isin", gap.alias("gap_days"))
    return pairs.join(linked.select("old_isin").distinct(), "old_isin", "left_anti")


def unexplained(found: DataFrame, events: DataFrame) -> DataFrame:
    """Switches without a corporate action on their date, with the price ratio that they imply."""
    acted = events.select("symbol", F.col("ex_date").alias("switch_date")).distinct()
    left = found.join(acted, ["symbol", "switch_date"], "left_anti")
    return left.withColumn("implied_price_ratio", F.try_divide("close", "prior_close"))


def resolve_events(events: DataFrame, seen: DataFrame, before_days: int = 10, after_days: int = 400) -> DataFrame:
    """event_id, isin, candidates: the most traded identifier of the symbol whose span holds the event's date."""
    inside = F.col("ex_date").between(F.date_sub("first_seen", before_days), F.date_add("last_seen", after_days))
    found = events.join(seen, "symbol").filter(inside)
    by = Window.partitionBy("event_id")
    ranked = found.withColumns(
        {
            "_n": F.row_number().over(by.orderBy(F.col("bars").desc(), "first_seen", "isin")),
            "candidates": F.count(F.lit(1)).over(by),
        }
    )
    return ranked.filter("_n = 1").select("event_id", "isin", "candidates")


def histories(seen: DataFrame) -> DataFrame:
    """symbol, chain, history: identifiers of a symbol in order, as text and as JSON."""
    ordered = F.sort_array(F.collect_list(F.struct("first_seen", "isin", "last_seen")))
    grouped = seen.groupBy("symbol").agg(ordered.alias("_all"))
    return grouped.select(
        "symbol",
        F.array_join(F.transform("_all", lambda x: x["isin"]), " -> ").alias("chain"),
        F.to_json("_all").alias("history"),
    )
