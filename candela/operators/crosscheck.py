"""Comparison with another provider's series: raw levels, price returns, total returns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bars that both must have; tolerances of levels and returns; how many misses are still minor.
SHARED, LEVEL, RETURN = 30, 0.0025, 0.005
MINOR = {"level": (2, 0.02), "price": (2, 0.02), "total": (3, 0.03)}


def compared(gold: DataFrame, theirs: DataFrame, key: str, shared: int = SHARED) -> DataFrame:
    """key, bars, misses and medians of levels, price returns and total returns, status.

    ``gold`` has trade_date, c, c_adj, c_tr, cum_factor, cum_factor_tr; ``theirs``
    has close (adjusted for splits) and adjclose (dividends reinvested too).
    Levels are compared only where neither splits nor dividends lie ahead.
    """
    both = gold.join(theirs.select(key, "trade_date", "close", "adjclose"), [key, "trade_date"])
    by = Window.partitionBy(key).orderBy("trade_date")
    change = lambda c: F.try_divide(F.col(c), F.lag(c).over(by)) - 1
    plain = (F.abs(F.col("cum_factor") - 1) < 1e-9) & (F.abs(F.coalesce("cum_factor_tr", F.lit(1.0)) - 1) < 1e-9) & (F.col("close") > 0)
    gaps = both.select(
        key,
        F.when(plain, F.abs(F.col("c") - F.col("close")) / F.col("close")).alias("level"),
        F.abs(change("c_adj") - change("close")).alias("price"),
        F.abs(change("c_tr") - change("adjclose")).alias("total"),
    )
    limits = {"level": LEVEL, "price": RETURN, "total": RETURN}
    counted = [F.count(c).alias(f"{c}_n") for c in limits] + [F.median(c).alias(f"{c}_median") for c in limits]
    counted += [F.count_if(F.col(c) > most).alias(f"{c}_bad") for c, most in limits.items()]
    out = gaps.groupBy(key).agg(F.count(F.lit(1)).alias("bars"), *counted)
    return out.withColumn("status", _status(shared))


def _status(shared: int) -> Column:
    def grave(c: str) -> Column:
        few, part = MINOR[c]
        return F.col(f"{c}_bad") > F.greatest(F.lit(float(few)), part * F.greatest(F.col(f"{c}_n"), F.lit(1)))

    some = (F.col("level_bad") > 0) | (F.col("price_bad") > 0) | (F.col("total_bad") > 0)
    return (
        F.when(F.col("bars") < shared, "skip")
        .when(grave("level"), "RAW_MISMATCH")
        .when(grave("price"), "ADJ_MISMATCH")
        .when(grave("total"), "TR_MISMATCH")
        .when(some, "minor")
        .otherwise("ok")
    )
