"""Human review: listing, locating the event, recounts, and what a resolution may do."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.schemas import FACTOR_HIGH, FACTOR_LOW


def listing(queue: DataFrame, universe: DataFrame, volumes: DataFrame, key: str, n: int = 50) -> DataFrame:
    """Open items: those in the universe first, then by severity, volume and age."""
    inside = universe.select(key).distinct().withColumn("_in", F.lit(True))
    top = volumes.groupBy(key).agg(F.max("adv").alias("max_adv"))
    joined = queue.filter("status = 'open'").join(inside, key, "left").join(top, key, "left")
    rank = F.when(F.col("severity") == "high", 0).when(F.col("severity") == "medium", 1).otherwise(2)
    joined = joined.withColumn("in_universe", F.coalesce("_in", F.lit(False))).drop("_in")
    return joined.orderBy(F.col("in_universe").desc(), rank, F.col("max_adv").desc_nulls_last(), "review_id").limit(n)


def located(queue: DataFrame, events: DataFrame) -> DataFrame:
    """review_id, event_id, n_live: by the id in the text, else by the announcement if it has one live event."""
    stated = F.regexp_extract("raw_purpose", r"event_id=(\d+)", 1).try_cast("bigint")
    live = events.groupBy("ca_raw_id").agg(F.count(F.lit(1)).alias("n_live"), F.max("event_id").alias("_only"))
    joined = queue.withColumn("_stated", stated).join(live, "ca_raw_id", "left")
    found = F.coalesce("_stated", F.when(F.col("n_live") == 1, F.col("_only")))
    return joined.select("review_id", found.alias("event_id"), F.coalesce("n_live", F.lit(0)).alias("n_live"))


def factor_from_text(text: str) -> float:
    """A person's factor; ValueError where it is no number or outside the envelope."""
    if not re.fullmatch(r"\s*\d+(\.\d+)?([eE]-?\d+)?\s*", text or ""):
        raise ValueError(f"not a factor: {text!r}")
    value = float(text)
    if not FACTOR_LOW <= value <= FACTOR_HIGH:
        raise ValueError(f"factor {value} is outside [{FACTOR_LOW}, {FACTOR_HIGH}]")
    return value


@dataclass(frozen=True)
class Counts:
    breaks: int
    moves: int
    orphans: int


def cleared(before: Counts, after: Counts) -> bool:
    """Whether a resolution may close its item: nothing is left, or it helped and harmed nothing."""
    if after.orphans:
        return False
    return after.breaks == after.moves == 0 or after.breaks <= before.breaks and after.moves < before.moves


@dataclass
class Resolution:
    """A request to resolve a review item; ``refusals`` tells why it may not run."""

    action: str  # factor, reanchor, accept or ignore
    reason: str
    factor: str | None = None
    source: str | None = None
    confirmed: bool = False
    n_live: int = 1
    target_bars: int | None = None

    def refusals(self) -> list[str]:
        out = []
        if self.action not in ("factor", "reanchor", "accept", "ignore"):
            out.append(f"unknown action {self.action}")
        if self.action in ("factor", "reanchor"):
            if self.n_live > 1:
                out.append("several live events; name one")
            if not self.confirmed:
                out.append("changes prices; confirm it")
        if self.action == "factor":
            try:
                factor_from_text(self.factor or "")
            except ValueError as error:
                out.append(str(error))
            if self.reason == "needs_external_price" and not self.source:
                out.append("name the source of the price")
        if self.action == "reanchor" and not self.target_bars:
            out.append("the target has no bars before the date")
        return out
