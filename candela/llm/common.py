"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from candela.operators.storage import materialised, spread

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Texts are handed to numpy code in slices of about this many characters.
SLICE_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same, dealt out to all cores if it has fewer partitions: for work that costs far more than a shuffle."""
    return spread(table(spark, sf_dir, name))


def written(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once, written as Parquet to the shared folder and read again.

    This cuts the lineage: executors that are lost later do not matter. The
    files go when the session's JVM ends.
    """
    return materialised(df)


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, with underscores in front until none is among the columns, in either case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of doc_id as text, modulo n; a null id counts as remainder 0."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n)), F.lit(0))


def unit(seed: object, *keys: Column) -> Column:
    """A number in [0, 1) with 52 bits, from md5 of the seed and the keys."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(k.cast("string"), F.lit("\\N")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def map_batches(
    df: DataFrame, schema: StructType | str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None]
) -> DataFrame:
    """mapInArrow for work on one batch; batches are cut by text size first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                if (out := work(part)) is not None:
                    yield out

    return arrow(df, run, schema)


def arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """mapInArrow whose workers, which Spark keeps for later tasks, give free memory back when a task ends."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(whole, schema)


def give_back() -> None:
    """Hands memory that this process has freed back to the operating system, where the C library can."""
    import ctypes

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, most: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Consecutive slices whose string and binary columns hold about ``most`` bytes (one row at least)."""
    import numpy as np

    if not batch.num_rows:
        return
    total = np.zeros(batch.num_rows, "int64")
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type) or pa.types.is_large_string(column.type):
            import pyarrow.compute as pc

            total += np.asarray(pc.fill_null(pc.binary_length(column), 0))
    ends = np.cumsum(total)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop
