"""Bar files of two formats, and their side files, as canonical frames."""

from __future__ import annotations

import csv
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from candela.functions.scalars import circuit_flag, flexible_dmy, to_float, to_int, vwap
from candela.schemas import BAR_SCHEMA

# Column names of the two bar formats, by canonical name.
MODERN = {
    "trade_date": "TradDt",
    "isin": "ISIN",
    "symbol": "TckrSymb",
    "series": "SctySrs",
    "o": "OpnPric",
    "h": "HghPric",
    "l": "LwPric",
    "c": "ClsPric",
    "last_price": "LastPric",
    "prev_close": "PrvsClsgPric",
    "volume": "TtlTradgVol",
    "turnover": "TtlTrfVal",
    "trades": "TtlNbOfTxsExctd",
}
LEGACY = {
    "trade_date": "TIMESTAMP",
    "isin": "ISIN",
    "symbol": "SYMBOL",
    "series": "SERIES",
    "o": "OPEN",
    "h": "HIGH",
    "l": "LOW",
    "c": "CLOSE",
    "last_price": "LAST",
    "prev_close": "PREVCLOSE",
    "volume": "TOTTRDQTY",
    "turnover": "TOTTRDVAL",
    "trades": "TOTALTRADES",
}
# Columns that tell a format; four of its five must be there.
MODERN_MARKS = ("TradDt", "TckrSymb", "SctySrs", "ClsPric", "TtlTradgVol")
LEGACY_MARKS = ("SYMBOL", "SERIES", "PREVCLOSE", "TOTTRDQTY", "TOTALTRADES")
#: From this day on the modern format is looked for first.
MODERN_SINCE = date(2024, 1, 1)


class FormatError(ValueError):
    """A file that is not what it should be."""


def detect(header: str) -> str:
    """'modern' or 'legacy', from a file's first line."""
    names = [n.strip().strip('"').strip() for n in header.lstrip("﻿").rstrip("\r\n").split(",")]
    if sum(mark in names for mark in MODERN_MARKS) >= 4:
        return "modern"
    upper = {n.upper() for n in names}
    if sum(mark in upper for mark in LEGACY_MARKS) >= 4:
        return "legacy"
    raise FormatError(f"unknown bar format: {header[:120]!r}")


def format_order(day: date) -> tuple[str, str]:
    """Which format to look for first; the other is always tried too."""
    return ("modern", "legacy") if day >= MODERN_SINCE else ("legacy", "modern")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; names stripped, unnamed ones left out."""
    raw = spark.read.csv(path, header=True, inferSchema=False, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return stripped(raw)


def csv_rows(spark: SparkSession, text: str) -> DataFrame:
    """The same from text that is at hand."""
    rows = [[cell.strip() for cell in line] for line in csv.reader(text.strip().splitlines(), skipinitialspace=True)]
    names, width = rows[0], len(rows[0])
    schema = ", ".join(f"`{n or f'_c{k}'}` string" for k, n in enumerate(names))
    cells = [tuple((row + [None] * width)[:width]) for row in rows[1:]]
    return stripped(spark.createDataFrame(cells, schema))


def stripped(raw: DataFrame) -> DataFrame:
    names = [c.strip().strip("﻿") for c in raw.columns]
    kept = [(c, n) for c, n in zip(raw.columns, names, strict=True) if n and not n.startswith("_c")]
    return raw.select(*[F.col(f"`{c}`").alias(n) for c, n in kept])


def required(df: DataFrame, names: list[str]) -> None:
    if missing := [n for n in names if n not in df.columns]:
        raise FormatError(f"columns missing: {', '.join(missing)}")


def first_by_order(df: DataFrame, keys: list[str]) -> DataFrame:
    """The first row of each key in file order."""
    order = Window.partitionBy(*keys).orderBy("_order")
    return df.withColumn("_n", F.row_number().over(order)).filter("_n = 1").drop("_n", "_order")


def _canonical(raw: DataFrame, names: dict[str, str], day: Column) -> DataFrame:
    col = {k: F.col(f"`{v}`") for k, v in names.items()}
    numbers = {k: to_float(col[k]) for k in ("o", "h", "l", "c", "last_price", "prev_close", "turnover")}
    wholes = {k: to_int(col[k]) for k in ("volume", "trades")}
    ids = {k: F.upper(F.trim(col[k])) for k in ("isin", "symbol", "series")}
    columns = {"trade_date": day, **ids, **numbers, **wholes, "instrument_type": F.lit("STK")}
    order = [c.split()[0] for c in BAR_SCHEMA.split(", ")]
    place = [F.monotonically_increasing_id()]
    if arrived := next((c for c in raw.columns if c.lower() == "arrived"), None):  # of several files the latest counts
        place = [-F.unix_micros(F.col(arrived)["file_modification_time"]), F.col(arrived)["file_path"], *place]
    return raw.select(*[columns[c].alias(c) for c in order], F.struct(*place).alias("_order"))


def finalised(bars: DataFrame) -> DataFrame:
    """Rows with identifier, date and close; the first of each (day, isin, series), in canonical order."""
    sound = bars.filter((F.coalesce("isin", F.lit("")) != "") & F.col("trade_date").isNotNull() & F.col("c").isNotNull())
    return first_by_order(sound, ["trade_date", "isin", "series"]).orderBy("isin", "series")


def modern_bars(raw: DataFrame) -> DataFrame:
    required(raw, list(MODERN.values()))
    if "FinInstrmTp" in raw.columns:
        raw = raw.filter(F.trim("FinInstrmTp") == "STK")
    return finalised(_canonical(raw, MODERN, F.try_to_date(F.trim(MODERN["trade_date"]), "yyyy-MM-dd")))


def legacy_bars(raw: DataFrame) -> DataFrame:
    raw = raw.toDF(*[c.upper() for c in raw.columns])
    required(raw, list(LEGACY.values()))
    return finalised(_canonical(raw, LEGACY, flexible_dmy(F.col(LEGACY["trade_date"]))))


def parse_bars(raw: DataFrame, expected: date) -> DataFrame:
    """Canonical bars of either format; no rows, or rows of another day, are an error."""
    bars = modern_bars(raw) if detect(",".join(raw.columns)) == "modern" else legacy_bars(raw)
    days = [r[0] for r in bars.select("trade_date").distinct().limit(3).collect()]
    if days != [expected]:
        raise FormatError(f"rows of {days or 'no day'} in the file of {expected}")
    return bars


def delivery(raw: DataFrame) -> DataFrame:
    """trade_date, symbol, series, vwap, deliv_qty, deliv_pct."""
    required(raw, ["SYMBOL", "SERIES", "DATE1", "AVG_PRICE", "DELIV_QTY", "DELIV_PER"])
    out = raw.select(
        flexible_dmy(F.col("DATE1")).alias("trade_date"),
        F.upper(F.trim("SYMBOL")).alias("symbol"),
        F.upper(F.trim("SERIES")).alias("series"),
        to_float(F.col("AVG_PRICE")).alias("vwap"),
        to_int(F.col("DELIV_QTY")).alias("deliv_qty"),
        to_float(F.col("DELIV_PER")).alias("deliv_pct"),
        F.monotonically_increasing_id().alias("_order"),
    )
    return first_by_order(out, ["trade_date", "symbol", "series"])


def bands(raw: DataFrame) -> DataFrame:
    """symbol, series, price_band, band_remarks; series and remarks may be absent."""
    names = {c.upper(): c for c in raw.columns}
    if "SYMBOL" not in names or "BAND" not in names:
        raise FormatError("columns missing: Symbol or Band")
    series = F.upper(F.trim(names["SERIES"])) if "SERIES" in names else F.lit("EQ")
    remarks = F.trim(names["REMARKS"]) if "REMARKS" in names else F.lit(None).cast("string")
    out = raw.select(
        F.upper(F.trim(names["SYMBOL"])).alias("symbol"),
        series.alias("series"),
        F.trim(names["BAND"]).alias("price_band"),
        remarks.alias("band_remarks"),
        F.monotonically_increasing_id().alias("_order"),
    )
    return first_by_order(out, ["symbol", "series"])


def listing(raw: DataFrame) -> DataFrame:
    """isin, symbol, name, series, listing_date, face_value of listed securities."""
    wanted = ["SYMBOL", "NAME OF COMPANY", "SERIES", "DATE OF LISTING", "ISIN NUMBER", "FACE VALUE"]
    required(raw, wanted)
    out = raw.select(
        F.upper(F.trim("ISIN NUMBER")).alias("isin"),
        F.upper(F.trim("SYMBOL")).alias("symbol"),
        F.trim("NAME OF COMPANY").alias("name"),
        F.upper(F.trim("SERIES")).alias("series"),
        flexible_dmy(F.col("DATE OF LISTING")).alias("listing_date"),
        to_float(F.col("FACE VALUE")).alias("face_value"),
        F.monotonically_increasing_id().alias("_order"),
    )
    return first_by_order(out.filter("isin is not null and isin <> ''"), ["isin"])


def assembled(bars: DataFrame, deliveries: DataFrame | None, price_bands: DataFrame | None) -> DataFrame:
    """Bars with delivery and band columns, NULL where a side file is absent, and the circuit flag."""
    spark = bars.sparkSession
    side = "trade_date date, symbol string, series string, vwap double, deliv_qty bigint, deliv_pct double"
    band = "symbol string, series string, price_band string, band_remarks string"
    deliveries = spark.createDataFrame([], side) if deliveries is None else deliveries
    price_bands = spark.createDataFrame([], band) if price_bands is None else price_bands
    out = bars.join(deliveries, ["trade_date", "symbol", "series"], "left").join(price_bands, ["symbol", "series"], "left")
    flag = circuit_flag(*[F.col(c) for c in ("o", "h", "l", "c", "prev_close", "price_band")])
    return out.withColumns({"vwap": vwap(F.col("vwap"), F.col("turnover"), F.col("volume")), "circuit_flag": flag})
