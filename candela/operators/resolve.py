"""Resolving a review item: a person's decision is written, the scope rebuilt and counted again, and the item closed."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.functions.scalars import relative_gap
from candela.operators.asof import prior_row
from candela.operators.checks import zero_multipliers
from candela.operators.links import one_per_day
from candela.operators.panel import canonical, materialise
from candela.operators.review import Counts, Resolution, cleared, factor_from_text
from candela.schemas import ADJACENT_DAYS, JUMP, JUMP_FLOOR, PREV_CLOSE_TOLERANCE

CLOSED = {"accept": "reviewed_accepted", "ignore": "ignored"}


@dataclass(frozen=True)
class Tables:
    """bars, links (isin, canonical_isin), events (event_id, isin, symbol, ex_date, type, factors, state, learned_at), reviews."""

    bars: DataFrame
    links: DataFrame
    events: DataFrame
    reviews: DataFrame


@dataclass(frozen=True)
class Outcome:
    """The tables after the decision, the scope's gold rows (None without a rebuild), counts, and how the item stands."""

    tables: Tables
    gold: DataFrame | None
    status: str
    before: Counts | None = None
    after: Counts | None = None
    refusals: tuple[str, ...] = ()


def counts(tables: Tables, ids: DataFrame) -> tuple[Counts, DataFrame]:
    """Breaks, unexplained moves and orphaned factors of some canonical ids, and their gold rows."""
    named = lambda df: canonical(df, tables.links).drop("isin").withColumnRenamed("canonical_isin", "isin")
    bars, events = (named(df).join(ids, "isin", "left_semi") for df in (tables.bars, tables.events))
    daily = one_per_day(bars, ["isin", "trade_date"])
    near = prior_row(daily, ["isin"], "trade_date", ADJACENT_DAYS, {"c": "last_c"})
    breaks = near.filter(relative_gap(F.col("prev_close"), F.col("last_c")) > PREV_CLOSE_TOLERANCE).count()
    gold = materialise(tables.bars, tables.links, tables.events, ids)
    sound = gold.filter(F.col("in_universe") & (F.col("c_adj") > JUMP_FLOOR))
    moved = prior_row(sound, ["isin", "series"], "trade_date", ADJACENT_DAYS, {"c_adj": "pc", "trade_date": "pd"})
    moved = moved.filter((F.col("pc") > 0) & (F.abs(F.col("c_adj") / F.col("pc") - 1) > JUMP))
    acts = events.select(F.col("isin").alias("_isin"), "ex_date")
    explained = (F.col("isin") == F.col("_isin")) & F.col("ex_date").between(F.date_sub("pd", 3), F.date_add("trade_date", 3))
    moves = moved.join(acts, explained, "left_anti").count()
    settled = events.filter("state = 'computed'")
    orphans = zero_multipliers(settled, bars, "isin", "symbol").filter("kind = 'ORPHANED'").count()
    return Counts(breaks, moves, orphans), gold


def resolve(tables: Tables, review_id: int, request: Resolution, event_id: int | None = None, to_isin: str | None = None, by: str = "manual") -> Outcome:
    """Applies a decision to the tables, which stay as they are if it is refused.

    ``accept`` and ``ignore`` close the item. ``factor`` overrides the event's
    factor, ``reanchor`` files it under another identifier; both rebuild the ids
    concerned and count again. The decision stands; the item is closed only if
    the counts are cleared, otherwise it stays open.
    """
    if tables.reviews.filter(F.col("review_id") == review_id).isEmpty():
        return Outcome(tables, None, "unknown", refusals=("no such item",))
    event = tables.events.filter(F.col("event_id") == event_id).limit(1).collect() if event_id is not None else []
    if request.action == "reanchor" and event and to_isin:
        early = canonical(tables.bars, tables.links).filter((F.col("canonical_isin") == to_isin) & (F.col("trade_date") < F.lit(event[0]["ex_date"])))
        request = replace(request, target_bars=early.count())
    refusals = list(request.refusals())
    if request.action in ("factor", "reanchor") and not event:
        refusals.append("no event")
    elif request.action in ("factor", "reanchor") and event[0]["ex_date"] is None:
        refusals.append("the event has no date")
    if refusals:
        return Outcome(tables, None, "refused", refusals=tuple(refusals))
    if request.action in CLOSED:
        return Outcome(replace(tables, reviews=marked(tables.reviews, review_id, CLOSED[request.action], by)), None, CLOSED[request.action])
    this = F.col("event_id") == event_id
    if request.action == "factor":
        value = factor_from_text(request.factor or "")
        changes = {"factor_price": F.lit(value), "state": F.lit("computed")}
    else:
        changes = {"isin": F.lit(to_isin)}
    events = tables.events.withColumns({c: F.when(this, v).otherwise(F.col(c)) for c, v in changes.items()})
    after = replace(tables, events=events)
    touched = tables.events.unionByName(events).filter(this).select("isin", "event_id")
    ids = canonical(touched, tables.links).select(F.col("canonical_isin").alias("isin")).distinct()
    was, _ = counts(tables, ids)
    now, gold = counts(after, ids)
    status = "resolved" if cleared(was, now) else "open"
    return Outcome(replace(after, reviews=marked(tables.reviews, review_id, status, by)), gold, status, was, now)


def marked(reviews: DataFrame, review_id: int, status: str, by: str) -> DataFrame:
    this = F.col("review_id") == review_id
    out = reviews.withColumn("status", F.when(this, status).otherwise(F.col("status")))
    if "resolved_by" in reviews.columns:
        out = out.withColumn("resolved_by", F.when(this, by).otherwise(F.col("resolved_by")))
    return out
