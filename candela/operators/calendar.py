"""The trading calendar: sources with authority, derivation from what was observed, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A source with a higher rank wins; what was observed always does.
AUTHORITY = {"weekend_rule": 0, "weekday_rule": 0, "holiday_master": 1, "observed": 2}


def days(spark: SparkSession, start: str, end: str) -> DataFrame:
    """cal_date: every day from start to end."""
    span = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(span).alias("cal_date"))


def by_weekday(calendar: DataFrame) -> DataFrame:
    """cal_date, is_trading, source by the weekday alone."""
    weekend = F.weekday("cal_date") >= 5
    return calendar.select(
        "cal_date", (~weekend).alias("is_trading"), F.when(weekend, "weekend_rule").otherwise("weekday_rule").alias("source")
    )


def authoritative(entries: DataFrame) -> DataFrame:
    """Of all entries for a day the one whose source has the most authority; on a tie trading days win."""
    rank = F.element_at(F.create_map(*[F.lit(x) for pair in AUTHORITY.items() for x in pair]), F.col("source"))
    best = Window.partitionBy("cal_date").orderBy(rank.desc(), F.col("is_trading").desc(), "source")
    return entries.withColumn("_n", F.row_number().over(best)).filter("_n = 1").drop("_n")


def observed(traded: DataFrame, attempted: DataFrame) -> DataFrame:
    """What loading showed: days with bars trade; weekdays tried on a later day without bars do not."""
    open_days = traded.select("cal_date").distinct()
    shut = attempted.filter((F.weekday("cal_date") < 5) & (F.col("attempted_on") > F.col("cal_date"))).select("cal_date").distinct()
    shut = shut.join(open_days, "cal_date", "left_anti")
    mark = lambda df, on: df.select("cal_date", F.lit(on).alias("is_trading"), F.lit("observed").alias("source"))
    return mark(open_days, True).unionByName(mark(shut, False))


def verdicts(calendar: DataFrame, entries: DataFrame) -> DataFrame:
    """cal_date, trades: unknown days and mere weekends may trade, masters and observations decide."""
    joined = calendar.join(entries, "cal_date", "left")
    decided = F.col("source").isin("holiday_master", "observed")
    return joined.select("cal_date", F.when(decided, F.col("is_trading")).otherwise(True).alias("trades"))


def windows(spark: SparkSession, start: str, end: str, most_days: int = 60) -> DataFrame:
    """from_date, to_date: stretches of at most so many days that cover start to end without overlap."""
    begins = F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr(f"interval {most_days} days")))
    each = spark.range(1).select(begins.alias("from_date"))
    return each.withColumn("to_date", F.least(F.date_add("from_date", most_days - 1), F.lit(end).cast("date")))


def pending(calendar: DataFrame, done: DataFrame, traded_weekends: DataFrame) -> DataFrame:
    """Days still to load: weekdays, and weekends known to trade, that are not done."""
    weekend = F.weekday("cal_date") >= 5
    special = calendar.filter(weekend).join(traded_weekends.select("cal_date"), "cal_date", "left_semi")
    return calendar.filter(~weekend).unionByName(special).join(done.select("cal_date"), "cal_date", "left_anti")
