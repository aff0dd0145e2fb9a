"""The daily run and resolving review items, on tables of a few rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candela.operators import daily, resolve
from candela.operators.review import Resolution
from candela.operators.storage import with_row_hash

BARS = "trade_date date, isin string, symbol string, series string, o double, h double, l double, c double, prev_close double, volume bigint, turnover double"
EVENTS = "event_id bigint, isin string, symbol string, ex_date date, type string, factor_price double, factor_vol double, div_amount double, anchor double, state string, learned_at timestamp"
A, B = "INE0000A01010", "INE0000B01010"


def day(n):
    return dt.date(2024, 1, n)


def bar(n, isin, c, before):
    return (day(n), isin, isin[7], "EQ", c, c, c, c, before, 100, 100 * c)


def event(number, isin, n, factor, state="computed", type_="SPLIT"):
    return (number, isin, isin[7], day(n), type_, factor, 1 / factor, None, None, state, dt.datetime(2024, 1, 1))


@pytest.fixture
def history(spark):
    rows = [bar(1, A, 100.0, None), bar(2, A, 102.0, 100.0), bar(1, B, 50.0, None), bar(2, B, 51.0, 50.0)]
    return with_row_hash(spark.createDataFrame(rows, BARS), daily.FLOATS, ["volume"]).cache()


def test_a_day_is_loaded_once_and_adjusted(spark, history):
    none = spark.createDataFrame([], EVENTS)
    state = daily.State(history, none)
    new = spark.createDataFrame([bar(3, A, 51.0, 102.0), bar(3, B, 51.5, 51.0)], BARS)
    split = spark.createDataFrame([event(1, A, 3, 0.5)], EVENTS)
    now = dt.datetime(2024, 1, 3, 20)
    done = daily.run(state, "2024-01-03", new, split, now)
    assert (done.status, done.exit_code, done.findings) == ("success", 0, [])
    assert done.summary["rows_written"] == 2 and done.summary["events"] == 1
    closes = {(r.isin, r.trade_date.day): r.c_adj for r in state.gold.collect()}
    assert closes == {(A, 1): 50.0, (A, 2): 51.0, (A, 3): 51.0, (B, 1): 50.0, (B, 2): 51.0, (B, 3): 51.5}
    assert {r.status for r in state.quality.collect()} == {"verified"}
    again = daily.run(state, "2024-01-03", new, split, now)
    assert again.notes and again.summary["rows_written"] == 0
    restated = spark.createDataFrame([bar(3, A, 51.0, 102.0), bar(3, B, 52.5, 51.0)], BARS)
    later = daily.run(state, "2024-01-03", restated, none, now)
    assert later.summary["rows_restated"] == 1 and {(r.isin, r.trade_date.day): r.c_adj for r in state.gold.collect()}[(B, 3)] == 52.5


def test_an_orphaned_factor_ejects_its_security(spark, history):
    state = daily.State(history, spark.createDataFrame([], EVENTS))
    new = spark.createDataFrame([bar(3, A, 51.0, 102.0), bar(3, B, 51.5, 51.0)], BARS)
    lost = spark.createDataFrame([event(1, "INE0000X01010", 3, 0.5)[:2] + ("A",) + event(1, A, 3, 0.5)[3:]], EVENTS)
    done = daily.run(state, "2024-01-03", new, lost, dt.datetime(2024, 1, 3))
    assert done.exit_code == 2 and done.status == "failed" and "orphaned_factor" in done.alert
    assert {r.isin: r.status for r in state.quality.collect()} == {A: "review_open", B: "verified"}


def test_a_day_without_bars_and_a_broken_step(spark, history):
    state = daily.State(history, spark.createDataFrame([], EVENTS))
    none = spark.createDataFrame([], BARS)
    assert daily.run(state, "2024-01-03", none, spark.createDataFrame([], EVENTS), dt.datetime(2024, 1, 3)).exit_code == 1
    broken = daily.run(state, "2024-01-04", none, spark.createDataFrame([], "event_id bigint"), dt.datetime(2024, 1, 4), force=True)
    assert broken.exit_code == 2 and any("constraint_violation" in f["detail"] for f in broken.findings)


@pytest.fixture
def tables(spark, history):
    more = spark.createDataFrame([bar(3, A, 51.0, 102.0), bar(4, A, 52.0, 51.0)], BARS)
    links = spark.createDataFrame([], "isin string, canonical_isin string")
    events = spark.createDataFrame([event(7, A, 3, 1.0, "unresolved"), event(8, "INE0000Y01010", 3, 0.5)], EVENTS)
    reviews = spark.createDataFrame([(1, A, "open", None), (2, A, "open", None)], "review_id bigint, isin string, status string, resolved_by string")
    return resolve.Tables(history.drop("row_hash").unionByName(more), links, events, reviews)


def statuses(out):
    return {r.review_id: r.status for r in out.tables.reviews.collect()}


def test_a_factor_is_written_rebuilt_and_verified(tables):
    asked = Resolution("factor", "unparsed_pattern", factor="0.5", confirmed=True)
    out = resolve.resolve(tables, 1, asked, event_id=7)
    assert (out.status, out.after.moves, statuses(out)) == ("resolved", 0, {1: "resolved", 2: "open"})
    assert {r.trade_date.day: r.c_adj for r in out.gold.collect()} == {1: 50.0, 2: 51.0, 3: 51.0, 4: 52.0}
    assert out.tables.events.filter("event_id = 7").first().factor_price == 0.5


def test_refusals_change_nothing(tables):
    for asked, number in ((Resolution("factor", "x", factor="0.5"), 7), (Resolution("factor", "x", factor="abc", confirmed=True), 7),
                          (Resolution("factor", "x", factor="0.5", confirmed=True), 99), (Resolution("factor", "needs_external_price", factor="0.5", confirmed=True), 7)):
        out = resolve.resolve(tables, 1, asked, event_id=number)
        assert out.status == "refused" and out.refusals and out.tables is tables and out.gold is None
    assert resolve.resolve(tables, 9, Resolution("accept", "x")).status == "unknown"


def test_accept_closes_and_reanchor_moves_the_event(tables):
    assert statuses(resolve.resolve(tables, 2, Resolution("accept", "x"))) == {1: "open", 2: "reviewed_accepted"}
    moved = resolve.resolve(tables, 1, Resolution("reanchor", "x", confirmed=True), event_id=8, to_isin=A)
    assert moved.before.orphans == 0 and moved.after.orphans == 0 and moved.status == "resolved"
    assert moved.tables.events.filter(F.col("event_id") == 8).first().isin == A
    assert {r.trade_date.day: r.c_adj for r in moved.gold.filter(F.col("isin") == A).collect()}[1] == 50.0
    nowhere = resolve.resolve(tables, 1, Resolution("reanchor", "x", confirmed=True), event_id=8, to_isin="INE0000Z01010")
    assert nowhere.status == "refused"
