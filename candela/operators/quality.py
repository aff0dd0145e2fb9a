"""The quality gate: verified securities, the tradeable universe, quarantine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def statuses(ids: DataFrame, key: str, reviews: DataFrame, orphans: DataFrame, breaks: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """key, n_open, n_orphans, n_breaks, status, note; a blocked key stays blocked."""
    counted = ids.select(key).distinct()
    for rows, name in ((reviews, "n_open"), (orphans, "n_orphans"), (breaks, "n_breaks")):
        counted = counted.join(rows.groupBy(key).agg(F.count(F.lit(1)).alias(name)), key, "left")
    names = ("n_open", "n_orphans", "n_breaks")
    counted = counted.na.fill(0, list(names))
    clear = (F.col("n_open") == 0) & (F.col("n_orphans") == 0) & (F.col("n_breaks") == 0)
    status = F.when(clear, "verified").otherwise("review_open")
    if before is not None:
        held = before.filter("status = 'blocked'").select(key, F.lit(True).alias("_held")).distinct()
        counted = counted.join(held, key, "left")
        status = F.when(F.col("_held"), "blocked").otherwise(status)
    parts = [F.when(F.col(n) > 0, F.concat(F.col(n).cast("string"), F.lit(f" {n[2:]}"))) for n in names]
    return counted.select(key, *names, status.alias("status"), F.concat_ws(", ", *parts).alias("note"))


def universe(flagged: DataFrame, quality: DataFrame, key: str) -> DataFrame:
    """In-universe rows of verified keys, one for each key and day."""
    verified = quality.filter("status = 'verified'").select(key)
    return flagged.filter("in_universe").join(verified, key, "left_semi").dropDuplicates([key, "trade_date"])


def quarantine(quality: DataFrame, key: str, bad: DataFrame) -> DataFrame:
    """Quality after ejecting some keys: open, unless blocked."""
    marked = quality.join(bad.select(key).distinct().withColumn("_bad", F.lit(True)), key, "left")
    status = F.when(F.col("_bad") & (F.col("status") != "blocked"), "review_open").otherwise(F.col("status"))
    return marked.withColumn("status", status).drop("_bad")


def identities(bars: DataFrame, orphans: DataFrame, symbol: str, key: str) -> DataFrame:
    """All keys that any bar of an orphan's symbol belongs to."""
    return bars.join(orphans.select(symbol).distinct(), symbol, "left_semi").select(key).distinct()


def blockers(quality: DataFrame, volumes: DataFrame, key: str, n: int = 20) -> DataFrame:
    """The unverified keys with the largest volume."""
    top = volumes.groupBy(key).agg(F.max("adv").alias("max_adv"))
    joined = quality.filter("status <> 'verified'").join(top, key, "left")
    return joined.orderBy(F.col("max_adv").desc_nulls_last(), key).limit(n).select(key, "status", "max_adv")
