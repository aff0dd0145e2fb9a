"""File parsers, feeds, operations and the landing stream."""

from __future__ import annotations

import datetime as dt
import io
import json
import zipfile

import pytest

from candela.operators import calendar, operations
from candela.schemas import BAR_SCHEMA
from candela.sources import bars, feeds
from candela.streaming import landing

MODERN = """TradDt,FinInstrmTp,ISIN,TckrSymb,SctySrs,OpnPric,HghPric,LwPric,ClsPric,LastPric,PrvsClsgPric,TtlTradgVol,TtlTrfVal,TtlNbOfTxsExctd
2026-08-28,STK,ine144j01027,20MICRONS,EQ,217.34,224.87,217.00,222.00,220.30,-,241206,53281611.76,5911
2026-08-28,STK,INE144J01027,20MICRONS,EQ,1,1,1,1,1,1,1,1,1
2026-08-28,FUT,INE000000001,X,EQ,1,1,1,1,1,1,1,1,1
2026-08-28,STK,INE000000002,Y,EQ,1,1,1,-,1,1,1,1,1"""
LEGACY = """SYMBOL,SERIES,OPEN,HIGH,LOW,CLOSE,LAST,PREVCLOSE,TOTTRDQTY,TOTTRDVAL,TIMESTAMP,TOTALTRADES,ISIN,
20MICRONS,EQ,217.34,224.87,217.00,222.00,220.30,-,241206,53281611.76,28-AUG-2026,5911,INE144J01027,"""


def test_both_formats_agree(spark):
    a = bars.parse_bars(bars.csv_rows(spark, MODERN), dt.date(2026, 8, 28))
    b = bars.parse_bars(bars.csv_rows(spark, LEGACY), dt.date(2026, 8, 28))
    assert a.collect() == b.collect() and a.count() == 1
    row = a.first()
    assert (row.o, row.c, row.last_price, row.prev_close, row.volume, row.trades) == (217.34, 222.0, 220.3, None, 241206, 5911)
    assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in a.schema) == BAR_SCHEMA


def test_wrong_files_are_refused(spark):
    with pytest.raises(bars.FormatError):
        bars.detect("a,b,c")
    with pytest.raises(bars.FormatError):
        bars.parse_bars(bars.csv_rows(spark, MODERN), dt.date(2026, 8, 27))
    with pytest.raises(bars.FormatError):
        bars.delivery(bars.csv_rows(spark, "A,B\n1,2"))
    assert bars.detect('﻿"TradDt", TckrSymb,SctySrs,ClsPric') == "modern"
    assert bars.format_order(dt.date(2023, 12, 31))[0] == "legacy" and bars.format_order(dt.date(2024, 1, 1))[0] == "modern"


def test_csv_from_disk_and_side_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text(MODERN)
    day = bars.modern_bars(bars.read_csv(spark, str(tmp_path / "a.csv")))
    delivery = bars.delivery(bars.csv_rows(spark, "SYMBOL, SERIES, DATE1, AVG_PRICE, DELIV_QTY, DELIV_PER\n20MICRONS, EQ, 28-Aug-2026, 220.90, 109988, 45.60"))
    band = bars.bands(bars.csv_rows(spark, "Symbol,Series,Security Name,Band,Remarks\n20MICRONS,EQ,x,2,-"))
    row = bars.assembled(day, delivery, band).first()
    assert (row.vwap, row.deliv_qty, row.deliv_pct, row.price_band, row.circuit_flag) == (220.9, 109988, 45.6, "2", False)
    bare = bars.assembled(day, None, None).first()
    assert bare.deliv_qty is None and bare.vwap == pytest.approx(53281611.76 / 241206) and bare.circuit_flag is False
    header = "SYMBOL,NAME OF COMPANY, SERIES, DATE OF LISTING, PAID UP VALUE, MARKET LOT, ISIN NUMBER, FACE VALUE"
    listed = bars.listing(bars.csv_rows(spark, f"{header}\nAB,Ab Ltd,EQ,06-OCT-2008,5,1,INE1,5")).first()
    assert (listed.isin, listed.listing_date, listed.face_value) == ("INE1", dt.date(2008, 10, 6), 5.0)


def test_zip_or_plain(spark, tmp_path):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        archive.writestr("readme.txt", "x")
        archive.writestr("a.CSV", "h\n1")
    assert feeds.unzipped(packed.getvalue()) == "h\n1" and feeds.unzipped(b"h\n\xff") == "h\n�"
    empty = io.BytesIO()
    with zipfile.ZipFile(empty, "w") as archive:
        archive.writestr("readme.txt", "x")
    with pytest.raises(bars.FormatError):
        feeds.unzipped(empty.getvalue())
    (tmp_path / "a.zip").write_bytes(packed.getvalue())
    (tmp_path / "b.csv").write_text("h\n2")
    assert sorted(r.text for r in feeds.landed_texts(spark, str(tmp_path)).collect()) == ["h\n1", "h\n2"]


def test_index_file(spark):
    header = "Index Name,Index Date,Open,High,Low,Close,Points,Pct,Volume,Turnover,PE,PB,DY"
    text = f"{header}\nIndia VIX,01-09-2026,11.19,12.1225,9.2475,11.49,0.3,2.7,-,-,-,-,-\n,,,\nx,y,1\nNifty  50,01-09-2026,1,2,3,abc,-24.6,-.1,334207690,1"
    rows = feeds.index_rows(spark, text)
    out = {r.index_key: r for r in feeds.index_silver(rows, dt.date(2026, 9, 1)).collect()}
    assert set(out) == {"INDIA VIX", "NIFTY 50"} and out["INDIA VIX"].volume is None and out["INDIA VIX"].close == 11.49
    assert out["NIFTY 50"].close is None and out["NIFTY 50"].pct_chg == -0.1 and out["NIFTY 50"].volume == 334207690
    with pytest.raises(bars.FormatError):
        feeds.index_silver(rows, dt.date(2026, 8, 28))
    assert feeds.index_silver(rows, dt.date(2026, 1, 9)).count() == 2  # month first
    with pytest.raises(bars.FormatError):
        feeds.index_rows(spark, "a,b\n1,2")


def test_feed(spark, tmp_path):
    row = dict.fromkeys(feeds.FEED_FIELDS, "-") | {"isin": "ine1", "symbol": "ab", "subject": "Bonus 1:1", "exDate": "01-Jan-2026", "faceVal": "0"}
    (tmp_path / "a.json").write_text(json.dumps([row, row | {"isin": "INE1"}, row | {"subject": ""}]))
    typed = feeds.mapped(feeds.feed(spark, str(tmp_path))).collect()
    assert len(typed) == 1 and typed[0].ex_date == dt.date(2026, 1, 1) and typed[0].face_value is None and typed[0].record_date is None


def test_fetch_rules():
    assert not feeds.should_retry(404, 1) and feeds.should_retry(500, 1) and feeds.should_retry(None, 4) and not feeds.should_retry(500, 5)
    assert feeds.landing_path("/raw", "bars", dt.date(2026, 8, 28)) == "/raw/bars/2026/08/bars_20260828.csv"


def test_calendar(spark):
    days = calendar.days(spark, "2024-01-05", "2024-01-08")
    master = feeds.holidays(spark, {"CM": [{"tradingDate": "06-Jan-2024"}, {"tradingDate": "08-Jan-2024"}]}, "CM")
    both = calendar.authoritative(calendar.by_weekday(days).unionByName(master))
    assert {r.cal_date.day: r.trades for r in calendar.verdicts(days, both).collect()} == {5: True, 6: False, 7: True, 8: False}
    windows = calendar.windows(spark, "2024-01-01", "2024-03-31", 30).orderBy("from_date").collect()
    assert windows[0].from_date == dt.date(2024, 1, 1) and windows[-1].to_date == dt.date(2024, 3, 31)
    assert all((b.from_date - a.to_date).days == 1 for a, b in zip(windows, windows[1:], strict=False))


def test_operations(tmp_path):
    now = dt.datetime(2024, 1, 10)
    assert operations.is_stale(None, now) and operations.is_stale(now - dt.timedelta(hours=72), now)
    assert not operations.is_stale(now - dt.timedelta(hours=12), now)
    path = tmp_path / "beat.json"
    operations.heartbeat(str(path), {"b": 1, "at": now})
    assert json.loads(path.read_text())["b"] == 1 and len(list(tmp_path.iterdir())) == 1
    findings = [{"severity": "warning", "check_name": "w", "detail": "x" * 500}] * 9 + [{"severity": "critical", "check_name": "c", "detail": None}] * 5
    lines = operations.alert(findings).splitlines()
    assert lines[0].startswith("critical") and len(lines) == 13 and lines[-1] == "...and 2 more" and max(map(len, lines)) <= 150
    assert operations.RunSummary().add(events=2).add(events=1).as_row()["events"] == 3
    with pytest.raises(KeyError):
        operations.RunSummary().add(typo=1)


def test_landing_stream(spark, tmp_path):
    source, table, state = (str(tmp_path / x) for x in ("in", "table", "state"))
    (tmp_path / "in").mkdir()
    schema = ", ".join(f"`{n.strip()}` string" for n in MODERN.splitlines()[0].split(","))

    def run():
        stream = landing.landed(spark, source, schema)
        landing.load_available(stream, lambda df: bars.modern_bars(bars.stripped(df)), table, state).awaitTermination(120)
        return {r.isin: r.c for r in spark.read.parquet(table).collect()}

    (tmp_path / "in" / "a.csv").write_text(MODERN)
    assert run() == {"INE144J01027": 222.0}
    restated = MODERN.splitlines()[0] + "\n" + MODERN.splitlines()[1].replace("222.00", "223.00")
    (tmp_path / "in" / "b.csv").write_text(restated)
    assert run() == {"INE144J01027": 223.0} == run()


def test_the_later_of_two_files_of_a_batch_counts(spark, tmp_path):
    import os

    source, target, state = (str(tmp_path / n) for n in ("in", "table", "state"))
    os.makedirs(source)
    names = list(bars.MODERN.values())
    for k, (name, close) in enumerate((("b", "11"), ("a", "12"), ("c", "13"))):
        row = {"trade_date": "2026-01-02", "isin": "INE1", "symbol": "S", "series": "EQ"}
        cells = [row.get(key, close) for key in bars.MODERN]
        with open(f"{source}/{name}.csv", "w") as f:
            f.write(",".join(names) + "\n" + ",".join(cells) + "\n")
        os.utime(f"{source}/{name}.csv", (1_700_000_000 + k * 60,) * 2 if name != "a" else (1_700_009_000,) * 2)
    stream = landing.landed(spark, source, ", ".join(f"`{n}` string" for n in names))
    landing.load_available(stream, lambda df: bars.modern_bars(bars.stripped(df)), target, state).awaitTermination(120)
    assert [r.c for r in spark.read.parquet(target).collect()] == [12.0]
