"""Validation checks, the zero-multiplier guard and audits: each gives findings as rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candela.functions.scalars import relative_gap
from candela.operators.asof import prior_row
from candela.schemas import (
    CONTINUITY_TOLERANCE,
    FINDING_SCHEMA,
    JUMP,
    JUMP_FLOOR,
    PREV_CLOSE_TOLERANCE,
    PRIOR_DAYS,
    ROWCOUNT_FLOOR,
    ROWCOUNT_SIGMA,
)

SEVERITIES = ("info", "warning", "critical")


def finding(name: str, severity: Column | str, isin: Column, symbol: Column, detail: Column, metrics: Column | None = None) -> list[Column]:
    """Columns of a finding."""
    level = severity if isinstance(severity, Column) else F.lit(severity)
    empty = F.lit(None).cast("string")
    return [
        F.lit(name).alias("check_name"),
        level.alias("severity"),
        isin.alias("isin"),
        symbol.alias("symbol"),
        detail.alias("detail"),
        (empty if metrics is None else F.to_json(metrics)).alias("metrics"),
    ]


def prev_close(bars: DataFrame, keys: list[str], gap: Callable[[Column, Column], Column] = relative_gap) -> DataFrame:
    """Bars whose reported previous close is off the last one by more than 0.5 %; ``gap`` decides on a last close of 0."""
    near = prior_row(bars, keys, "trade_date", PRIOR_DAYS, {"c": "prior_c"})
    off = near.withColumn("rel", gap(F.col("prev_close"), F.col("prior_c")))
    return off.filter(F.col("rel") > PREV_CLOSE_TOLERANCE)


def jumps(gold: DataFrame, events: DataFrame, keys: list[str], key: str) -> DataFrame:
    """Large overnight moves of adjusted prices: info where an action is near, else warning."""
    near = prior_row(gold, keys, "trade_date", PRIOR_DAYS, {"c_adj": "prior_adj"})
    moved = near.filter((F.col("prior_adj") > JUMP_FLOOR) & (F.abs(F.col("c_adj") / F.col("prior_adj") - 1) > JUMP))
    acts = events.select(F.col(key).alias("_key"), F.col("ex_date").alias("_ex")).distinct()
    explained = (F.col(key) == F.col("_key")) & F.col("_ex").between(F.date_sub("trade_date", 3), F.date_add("trade_date", 1))
    with_event = moved.join(acts, explained, "left_semi").withColumn("severity", F.lit("info"))
    without = moved.join(acts, explained, "left_anti").withColumn("severity", F.lit("warning"))
    return with_event.unionByName(without)


def row_count(counts: DataFrame, day: str) -> DataFrame:
    """The finding on one day's row count, if any; counts has trade_date and n."""
    before = counts.filter(F.col("trade_date") < F.lit(day).cast("date")).orderBy(F.col("trade_date").desc()).limit(20)
    mean, spread, days = before.agg(F.avg("n"), F.stddev_samp("n"), F.count(F.lit(1))).first()  # three numbers
    today = counts.filter(F.col("trade_date") == F.lit(day).cast("date")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    z = F.try_divide(F.col("n") - F.lit(mean), F.lit(spread).cast("double"))
    reason = (
        F.when(F.col("n") == 0, "no rows")
        .when(F.col("n") < ROWCOUNT_FLOOR, "few rows")
        .when((F.lit(days) >= 5) & (F.abs(z) > ROWCOUNT_SIGMA), "odd count")
    )
    return today.select("n", F.round(z, 6).alias("z"), reason.alias("reason")).filter("reason is not null")


def chain_bars_before(factored: DataFrame, bars: DataFrame, chain: str, symbol: str) -> DataFrame:
    """Events with the number of earlier bars of their chain and of their symbol.

    Earlier bars are counted by a running count over one timeline per key, not
    by a range join. Bars without a day are before no event.
    """
    out, bars = factored, bars.filter("trade_date is not null")
    for key, name in ((chain, "chain_bars"), (symbol, "symbol_bars")):
        day = F.datediff(F.col("_d"), F.lit("1970-01-01").cast("date"))
        facts = bars.groupBy(key, F.col("trade_date").alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
        line = out.withColumns({"_d": F.col("ex_date"), "_ask": F.lit(True)}).unionByName(facts, allowMissingColumns=True)
        before = Window.partitionBy(key).orderBy(day).rangeBetween(Window.unboundedPreceding, -1)
        line = line.withColumn(name, F.coalesce(F.sum("_n").over(before), F.lit(0)))
        out = line.filter("_ask").drop("_d", "_ask", "_n")
    return out


def zero_multipliers(factored: DataFrame, bars: DataFrame, chain: str, symbol: str) -> DataFrame:
    """Factors that multiply no bar: ORPHANED if the symbol has earlier bars, else PRE_HISTORY."""
    counted = chain_bars_before(factored.filter("factor_price <> 1"), bars, chain, symbol)
    kind = F.when(F.col("symbol_bars") > 0, "ORPHANED").otherwise("PRE_HISTORY")
    return counted.filter("chain_bars = 0").withColumn("kind", kind)


def orphan_reviews(found: DataFrame, isin: str) -> DataFrame:
    """Review rows whose text is the same on every run, so that they are queued once."""
    text = F.format_string("[zero multiplier] event_id=%s %s %s", F.col("event_id"), F.col("type"), F.col("kind"))
    return found.select(
        F.col(isin).alias("isin"),
        "symbol",
        text.alias("raw_purpose"),
        F.when(F.col("kind") == "ORPHANED", "high").otherwise("low").alias("severity"),
        F.to_json(F.struct("event_id", "symbol_bars")).alias("suggested_json"),
    )


def worst(findings: DataFrame) -> DataFrame:
    """One row: the worst severity and the exit code, 0 to 2."""
    rank = F.max(F.when(F.col("severity") == "critical", 2).when(F.col("severity") == "warning", 1).otherwise(0))
    code = F.coalesce(rank, F.lit(0))
    return findings.agg(code.alias("exit_code")).withColumn(
        "worst", F.element_at(F.array(*[F.lit(s) for s in SEVERITIES]), F.col("exit_code") + 1)
    )


def run_all(spark: SparkSession, checks: dict[str, Callable[[], DataFrame]]) -> list:
    """Findings of all checks; a check that fails is itself a critical finding.

    Findings are a report, so they come to the driver.
    """
    out = []
    for name, check in checks.items():
        try:
            out += check().select("check_name", "severity", "isin", "symbol", "detail", "metrics").collect()
        except Exception as error:  # noqa: BLE001  a broken check must not hide the others
            row = (name, "critical", None, None, f"constraint_violation: {str(error)[:150]}", None)
            out += spark.createDataFrame([row], FINDING_SCHEMA).collect()
    return out


def right_edges(gold: DataFrame, key: str) -> DataFrame:
    """Keys whose latest bar has a factor other than 1."""
    latest = gold.groupBy(key).agg(F.max_by("cum_factor", "trade_date").alias("cum_factor"))
    return latest.filter(F.abs(F.col("cum_factor") - 1) > 1e-9)


def continuous(gap: Column) -> Column:
    return gap <= CONTINUITY_TOLERANCE
