"""The adjusted panel: canonical bars, factors, flags, as-of replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candela.functions.factors import reinvested
from candela.functions.scalars import classify_isin, classify_series
from candela.operators.cumulative import strictly_after, within_edge
from candela.schemas import ADV_WINDOW, MULTIPLYING_STATES, PANEL_SERIES, UNIVERSE_SERIES

CUMULATIVE = {"factor_price": "cum_factor", "factor_vol": "cum_factor_vol", "factor_tr": "cum_factor_tr"}


def multiplying(events: DataFrame) -> DataFrame:
    """Events whose factor is settled, with the total-return factor."""
    settled = events.filter(F.col("state").isin(*MULTIPLYING_STATES))
    return settled.withColumn("factor_tr", reinvested(F.col("type"), F.col("factor_price"), F.col("div_amount"), F.col("anchor")))


def known_at(events: DataFrame, as_of: Column) -> DataFrame:
    """Events that had been learned by a point in time."""
    return events.filter(F.col("learned_at") <= as_of)


def adjusted(bars: DataFrame, events: DataFrame, key: str = "user_id") -> DataFrame:
    """Bars with cumulative factors and adjusted prices, volume and total-return close.

    Events after the key's last bar are left out: their exchange, that of the
    events' days, and that of the timeline are on the key.
    """
    events = within_edge(multiplying(events), bars, key, "ex_date", "trade_date")
    out = strictly_after(bars, events, key, "trade_date", "ex_date", CUMULATIVE)
    prices = {f"{c}_adj": F.col(c) * F.col("cum_factor") for c in ("o", "h", "l", "c") if c in bars.columns}
    return out.withColumns(
        {**prices, "v_adj": F.col("volume") * F.col("cum_factor_vol"), "c_tr": F.col("c") * F.col("cum_factor_tr")}
    )


def average_volume(rows: Column, keys: list[str], ties: tuple[str, ...] = ()) -> Column:
    """Rolling mean of the last twenty rows of a key; ``ties`` order the rows of a day."""
    by = Window.partitionBy(*keys).orderBy(F.col("trade_date").asc_nulls_last(), *ties).rowsBetween(-(ADV_WINDOW - 1), 0)
    return F.avg(rows).over(by)


def universe_flags(bars: DataFrame, keys: list[str], floor: float = 0.0, delisting: Column | None = None) -> DataFrame:
    """Bars with series_flag, adv, is_tradeable and in_universe.

    Where a key has several rows of a day, they are taken by traded identifier and symbol, so that a rerun gives the same.
    """
    flag = classify_series(F.col("series"))
    tradeable = F.col("series_flag").isin(*UNIVERSE_SERIES) & (classify_isin(F.col("isin")) == "EQUITY")
    listed = F.lit(True) if delisting is None else F.coalesce(F.col("trade_date") <= delisting, F.lit(True))
    ties = tuple(c for c in ("isin_traded", "symbol") if c in bars.columns and c not in keys)
    flagged = bars.withColumns({"series_flag": flag, "adv": average_volume(F.col("turnover"), keys, ties)})
    flagged = flagged.withColumn("is_tradeable", tradeable)
    inside = F.col("is_tradeable") & listed & (F.coalesce(F.col("adv"), F.lit(0.0)) >= floor)
    return flagged.withColumn("in_universe", inside)


def panel_series(bars: DataFrame) -> DataFrame:
    return bars.filter(classify_series(F.col("series")).isin(*PANEL_SERIES))


def canonical(bars: DataFrame, links: DataFrame) -> DataFrame:
    """Bars under their canonical identifier, with the traded one kept; links is (isin, canonical_isin)."""
    joined = bars.join(links.select("isin", "canonical_isin"), "isin", "left")
    return joined.withColumn("canonical_isin", F.coalesce("canonical_isin", "isin"))


def affected(traded: DataFrame, changed: DataFrame, key: str) -> DataFrame:
    """Keys to rebuild: traded today, or with a changed event."""
    return traded.select(key).union(changed.select(key)).distinct()


def materialise(
    bars: DataFrame,
    links: DataFrame,
    events: DataFrame,
    ids: DataFrame | None = None,
    as_of: Column | None = None,
    floor: float = 0.0,
    delisted: DataFrame | None = None,
) -> DataFrame:
    """Gold rows of all securities, or of the canonical ids in ``ids``: one row for each (isin, trade_date, series).

    Bars go under their canonical identifier (``links`` has isin and
    canonical_isin), debt series are left out, and then the last bar of a
    security is its edge. Events (isin, ex_date, factors, state, learned_at)
    that were known at ``as_of`` and are not after the edge give the cumulative
    factors. ``delisted`` has isin and delisting_date. Bars and events meet in
    one timeline, so that edge, products and volumes share an exchange; the
    events are multiplied in the order of their day, time and ``event_id``.
    """
    named = lambda df: canonical(df, links).withColumnRenamed("isin", "isin_traded").withColumnRenamed("canonical_isin", "isin")
    rows, known = named(panel_series(bars)), named(events if as_of is None else known_at(events, as_of))
    if ids is not None:
        wanted = ids.select("isin").distinct()
        rows, known = rows.join(wanted, "isin", "left_semi"), known.join(wanted, "isin", "left_semi")
    usable = lambda c: F.when(F.col(c) > 0, F.col(c)).alias(f"_{c}")
    number = F.col("event_id") if "event_id" in known.columns else F.lit(None)
    acts = multiplying(known).select(
        "isin", F.col("ex_date").alias("trade_date"), F.col("learned_at").alias("_learned"), number.alias("_number"), *[usable(c) for c in CUMULATIVE]
    )
    line = rows.withColumn("_bar", F.lit(True)).unionByName(acts, allowMissingColumns=True)
    whole = Window.partitionBy("isin")
    line = line.withColumns({"_edge": F.max(F.when(F.col("_bar"), F.col("trade_date"))).over(whole), "factor_asof": F.max("_learned").over(whole)})
    # from the last day back, the bars of a day before its events; the events one by one in a fixed order, as a product depends on it in its last digit
    order = ["trade_date", "_bar", "_learned", "_number", *[f"_{c}" for c in CUMULATIVE]]
    after = Window.partitionBy("isin").orderBy(*[F.col(c).desc_nulls_last() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    inside = F.col("trade_date") <= F.col("_edge")
    dated = F.col("trade_date").isNotNull()  # a bar without a day is before no event
    later = lambda c: F.when(dated, F.product(F.when(inside, F.col(f"_{c}"))).over(after))
    products = {name: F.coalesce(later(c), F.lit(1.0)) for c, name in CUMULATIVE.items()}
    gold = line.withColumns(products).filter("_bar")
    prices = [c for c in ("o", "h", "l", "c", "vwap") if c in bars.columns]
    gold = gold.withColumns({f"{c}_adj": F.col(c) * F.col("cum_factor") for c in prices})
    gold = gold.withColumns({f"{c}_tr": F.col(c) * F.col("cum_factor_tr") for c in prices if c != "vwap"})
    gold = gold.withColumn("v_adj", F.col("volume") * F.col("cum_factor_vol"))
    day = None
    if delisted is not None:
        gold = gold.join(delisted.select("isin", "delisting_date"), "isin", "left")
        day = F.col("delisting_date")
    flagged = universe_flags(gold, ["isin", "series"], floor, day)
    return flagged.drop("_bar", "_edge", "_learned", "_number", *[f"_{c}" for c in CUMULATIVE])
