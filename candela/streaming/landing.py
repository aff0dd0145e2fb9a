"""Landed bar files as a stream: each run takes what is new, and later versions of a row win by hash."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from candela.operators.storage import first_of, hash_gate, merged, recovered, swap_in, with_row_hash

ARRIVED = "arrived"
KEYS = ["trade_date", "isin", "series"]
FLOATS = ["o", "h", "l", "c", "last_price", "prev_close", "turnover"]
OTHERS = ["volume", "trades"]


def landed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stream over the CSV files of a landing directory, all columns as the schema says, and when each file arrived."""
    stream = spark.readStream.schema(schema).option("header", True).csv(path)
    return stream.select("*", F.struct("_metadata.file_modification_time", "_metadata.file_path").alias(ARRIVED))


def upsert_into(path: str) -> Callable[[DataFrame, int], None]:
    """A batch function that merges bars into a Parquet table: a restated row replaces the old one.

    Of rows with one key in a batch the one that arrived last counts, if the batch
    still says when; else, or in a tie, the one with the greatest hash. A batch that
    is delivered twice changes nothing the second time.
    """

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        hashed = with_row_hash(batch, FLOATS, OTHERS)
        latest = [F.col(c).desc() for c in (ARRIVED, "row_hash") if c in hashed.columns]
        new = first_of(hashed, [F.col(k) for k in KEYS], latest).drop(ARRIVED)
        if recovered(spark, path):
            swap_in(merged(spark.read.parquet(path), new, KEYS, hash_gate()), path)
        else:
            swap_in(new, path)

    return merge


def load_available(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], table: str, checkpoint: str
) -> StreamingQuery:
    """Processes all files that have landed since the last run, then stops."""
    merge = upsert_into(table)
    writer = stream.writeStream.foreachBatch(lambda batch, n: merge(transform(batch), n))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
