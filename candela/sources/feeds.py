"""Announcement feed, index files, holiday lists, zipped files, and the landing directory."""

from __future__ import annotations

import csv
import io
import zipfile
from datetime import date
from pathlib import PurePosixPath

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.functions.scalars import api_date, index_number, normalise_key, payload_hash, to_float
from candela.sources.bars import FormatError

# Fields of the announcement feed; the columns of an index file.
FEED_FIELDS = (
    "symbol", "isin", "comp", "series", "faceVal", "exDate", "recDate", "bcStartDate", "bcEndDate", "ndStartDate", "ndEndDate",
    "caBroadcastDate", "subject",
)
FEED_SCHEMA = ", ".join(f"{f} string" for f in FEED_FIELDS)
INDEX_COLUMNS = (
    "index_name", "index_date", "open", "high", "low", "close", "points_change", "pct_chg", "volume", "turnover", "pe", "pb", "div_yield",
)
#: Attempts of a fetch at most; answers that are final.
ATTEMPTS = 5
FINAL = (200, 304, 404)


def unzipped(content: bytes) -> str:
    """The text of a file that may be a zip of one CSV."""
    if not content.startswith(b"PK"):
        return content.decode("utf-8", "replace")
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for name in archive.namelist():
            if name.lower().endswith(".csv"):
                return archive.read(name).decode("utf-8", "replace")
    raise FormatError("no CSV in the zip")


def landed_texts(spark: SparkSession, path: str) -> DataFrame:
    """path, text of every file under a landing directory, zipped or not."""

    def texts(batches):
        for batch in batches:
            yield pd.DataFrame({"path": batch["path"], "text": [unzipped(bytes(c)) for c in batch["content"]]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(texts, "path string, text string")


def feed(spark: SparkSession, path: str) -> DataFrame:
    """Raw feed rows from landed JSON, each payload once."""
    raw = spark.read.schema(FEED_SCHEMA).json(path, multiLine=True, mode="FAILFAST")
    return once(raw)


def once(raw: DataFrame) -> DataFrame:
    hashed = payload_hash(F.col("isin"), F.col("exDate"), F.col("subject"), F.col("recDate"))
    return raw.withColumn("payload_hash", hashed).dropDuplicates(["payload_hash"])


def mapped(raw: DataFrame) -> DataFrame:
    """Typed announcements; rows without a subject are left out."""
    face = to_float(F.replace(F.col("faceVal"), F.lit(","), F.lit("")))
    name = lambda c: F.upper(F.nullif(F.nullif(F.trim(c), F.lit("")), F.lit("-")))
    return raw.filter(F.coalesce(F.trim("subject"), F.lit("")) != "").select(
        "payload_hash",
        name("symbol").alias("symbol"),
        name("isin").alias("isin"),
        F.trim("series").alias("series"),
        F.when(face > 0, face).alias("face_value"),
        api_date(F.col("exDate")).alias("ex_date"),
        api_date(F.col("recDate")).alias("record_date"),
        F.trim("subject").alias("purpose"),
    )


def index_rows(spark: SparkSession, text: str) -> DataFrame:
    """The rows of an index file as text, with a hash of their cells; short and nameless rows are left out."""
    lines = list(csv.reader(text.strip().splitlines(), skipinitialspace=True))
    if [c.strip().lower() for c in lines[0][:2]] != ["index name", "index date"]:
        raise FormatError(f"not an index file: {','.join(lines[0])[:80]!r}")
    width = len(INDEX_COLUMNS)
    cells = [[c.strip() for c in line] for line in lines[1:] if len(line) >= 6 and line[0].strip()]
    padded = [tuple((row + [""] * width)[:width]) for row in cells]
    rows = spark.createDataFrame(padded, ", ".join(f"{c} string" for c in INDEX_COLUMNS))
    hashed = F.substring(F.sha2(F.concat_ws("|", *INDEX_COLUMNS), 256), 1, 32)
    return rows.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in INDEX_COLUMNS], hashed.alias("row_hash"))


def reconciled(index_date: Column, requested: date) -> Column:
    """The row's date: day-first or month-first, whichever is the requested day; blank means the requested day."""
    day = F.lit(requested)
    text = F.initcap(F.trim(index_date))
    forms = [F.try_to_date(text, f) == day for f in ("d-MM-yyyy", "d-MMM-yyyy", "d/MM/yyyy", "M-dd-yyyy", "M/dd/yyyy")]
    blank = F.coalesce(F.trim(index_date), F.lit("")) == ""
    return F.when(blank | F.greatest(*[F.coalesce(f, F.lit(False)) for f in forms]), day)


def index_silver(rows: DataFrame, requested: date) -> DataFrame:
    """Typed index rows; a row of another date is an error."""
    out = rows.withColumn("trade_date", reconciled(F.col("index_date"), requested))
    if not out.filter("trade_date is null").isEmpty():
        raise FormatError(f"rows of another day than {requested}")
    numbers = [index_number(F.col(c)).alias(c) for c in INDEX_COLUMNS[2:] if c != "volume"]
    volume = index_number(F.col("volume")).try_cast("bigint").alias("volume")
    return out.select("trade_date", normalise_key(F.col("index_name")).alias("index_key"), *numbers, volume, "row_hash")


def holidays(spark: SparkSession, master: dict[str, list[dict]], segment: str) -> DataFrame:
    """cal_date, is_trading, source from a holiday list by segment."""
    rows = [(entry["tradingDate"], entry.get("description")) for entry in master.get(segment, [])]
    raw = spark.createDataFrame(rows, "day string, description string")
    return raw.select(
        api_date(F.col("day")).alias("cal_date"), F.lit(False).alias("is_trading"), F.lit("holiday_master").alias("source")
    ).filter("cal_date is not null")


def should_retry(status: int | None, attempt: int) -> bool:
    """Whether to ask again: not after a final answer, a missing file among them, nor after the last attempt."""
    return attempt < ATTEMPTS and status not in FINAL


def landing_path(root: str, kind: str, day: date) -> str:
    """Where a day's raw file of a kind is kept."""
    return str(PurePosixPath(root) / kind / f"{day:%Y/%m}" / f"{kind}_{day:%Y%m%d}.csv")
