"""Loading announcements: events, reviews, and what a new parse changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.functions import purpose
from candela.functions.scalars import event_uid
from candela.operators.storage import first_of

#: Fields in which a fresh parse may differ from a live event.
COMPARED = ("type", "ratio_num", "ratio_den", "sub_price", "div_amount", "parsed_ok")


def events_and_reviews(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One event for each component, and the review rows.

    ``raw`` has ca_raw_id, isin, ex_date, purpose and face_value. Rows without
    an identifier or date make no event but a review of high severity. Two
    equal components of one announcement make one review.
    """
    parsed = purpose.parse(raw)
    placed = F.col("isin").isNotNull() & F.col("ex_date").isNotNull()
    uid = event_uid(F.col("isin"), F.col("ex_date"), F.col("type"), F.col("component_ix"), F.col("raw_text"))
    events = parsed.filter(placed).withColumn("event_uid", uid)
    missing = F.when(F.col("isin").isNull(), "ambiguous_ratio").when(F.col("ex_date").isNull(), "unparsed_pattern")
    reviews = parsed.filter(~F.col("parsed_ok") | ~placed).select(
        "ca_raw_id",
        "isin",
        "ex_date",
        F.col("raw_text").alias("raw_purpose"),
        F.coalesce(missing, F.col("review_reason")).alias("reason"),
        F.when(~placed, "high").otherwise(F.col("severity")).alias("severity"),
        F.lit("open").alias("status"),
        F.to_json(F.struct("type", "ratio_num", "ratio_den", "div_amount")).alias("suggested_json"),
        "component_ix",
    )
    return events, unique_reviews(reviews, "component_ix").drop("component_ix")


def unique_reviews(queue: DataFrame, order: str) -> DataFrame:
    """One row for each announcement and text; announcements without a number count as one."""
    return first_of(queue, [F.coalesce("ca_raw_id", F.lit(-1)), F.col("raw_purpose")], [F.col(order)])


def reparse_diff(live: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """keys and change: newly_parsed, superseded, changed or same."""
    fields = lambda df, name: df.select(*keys, F.struct(*COMPARED).alias(name))
    joined = fields(live, "_was").join(fields(fresh, "_is"), keys, "full_outer")
    change = (
        F.when(F.col("_was").isNull(), "newly_parsed")
        .when(F.col("_is").isNull(), "superseded")
        .when(F.col("_was") == F.col("_is"), "same")
        .otherwise("changed")
    )
    return joined.select(*keys, F.when(F.col("_was").eqNullSafe(F.col("_is")), "same").otherwise(change).alias("change"))
