"""Queries against their SQL on closes of 0, and on users whose identifiers coincide."""

from __future__ import annotations

import datetime as dt

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from candela.functions.scalars import rounded_as_sql
from candela.operators.panel import materialise
from candela.plans.catalogue import ORACLES, QUERIES


@pytest.fixture(scope="module")
def odd_dir(tmp_path_factory):
    """Three weeks of closes of some users: 0 on one day, or on two in a row, or 0.0049 off, or never."""
    path = str(tmp_path_factory.mktemp("odd"))
    rows = []
    for user in (17, 31, 34, 51, 68, *range(101, 109)):
        for day in range(1, 22):
            zero = user in (31, 101, 106, 107) and day in (10, 15, 18) or user in (17, 102) and day in (14, 15)
            value = 0.0 if zero else 10.0 + (7 * user + 3 * day) % 11
            rows.append((7 * len(rows), dt.datetime(2024, 1, day, 9), user, "view", value, "{}"))
    return written(path, rows)


@pytest.fixture(scope="module")
def shared_dir(tmp_path_factory):
    """Users of up to six digits, whose identifiers in the SQL are those of others."""
    users = (12, 1234, 12342, 12343, 123422, 123456)
    days = [(user, dt.datetime(2024, 1, day, 9)) for user in users for day in range(1, 29)]
    rows = [(7 * k, at, user, "view", 10.0 + (user + 3 * at.day) % 11, "{}") for k, (user, at) in enumerate(days)]
    return written(str(tmp_path_factory.mktemp("shared")), rows)


@pytest.fixture(scope="module")
def null_dir(tmp_path_factory):
    """Users whose last event of some days has no value."""
    rows = []
    for user in (17, 31, 34, 51, 68, *range(101, 109)):
        for day in range(1, 22):
            rows.append((7 * len(rows), dt.datetime(2024, 1, day, 9), user, "view", 10.0 + (7 * user + 3 * day) % 11, "{}"))
            if day in (10, 14) and user % 2:
                rows.append((7 * len(rows), dt.datetime(2024, 1, day, 15), user, "click", None, "{}"))
    return written(str(tmp_path_factory.mktemp("null")), rows)


@pytest.fixture(scope="module")
def below_dir(tmp_path_factory):
    """Users some of whose days have negative values, infinities, NaN or zeros of both signs, or of two only negative ones; one user is not named."""
    odd = (-3.5, -4000.0, float("-inf"), float("inf"), float("nan"), -0.0, 0.0, 1e-300)
    rows = []
    for user in (None, -17, 0, 17, 31, 34, 51, *range(101, 119), 201, 202):
        for day in range(1, 29):
            value = odd[(user + day // 5) % 8] if user and user % 3 and day % 5 == 0 else 10.0 + (7 * (user or 3) + 3 * day) % 11
            value = -3.5 * day if user in (201, 202) else value
            rows.append((7 * len(rows), dt.datetime(2024, 1, day, 9), user, "view", value, "{}"))
    return written(str(tmp_path_factory.mktemp("below")), rows)


@pytest.fixture(scope="module")
def timeless_dir(tmp_path_factory):
    """Users some of whose bars and actions have no time; the bonus of some users with such bars comes before all others."""
    rows = []
    for user in range(101, 107):
        days = [dt.datetime(2024, 1, day, 9) for day in range(5, 25)]
        rows += [(7 * (len(rows) + k), at, user, "view", 10.0 + k % 7, "{}") for k, at in enumerate(days)]
        rows.append((1, None, user, "view", 9.0, "{}"))
        rows.append((21 * user + 3, None if user % 2 else dt.datetime(2024, 1, 2), user, "signup", 5.0, "{}"))  # 3 more than a multiple of 7 and 3
    return written(str(tmp_path_factory.mktemp("timeless")), rows)


@pytest.fixture(scope="module")
def valueless_dir(tmp_path_factory):
    """Users none of whose events, or none before the tenth, have a value."""
    rows = []
    for user in range(101, 111):
        for day in range(1, 22):
            value = None if user < 106 or day < 10 else 10.0 + (7 * user + 3 * day) % 11
            rows.append((7 * len(rows), dt.datetime(2024, 1, day, 9), user, "view", value, "{}"))
    return written(str(tmp_path_factory.mktemp("valueless")), rows)


@pytest.fixture(scope="module")
def digits_dir(tmp_path_factory):
    """Users of one bar each, whose turnovers lie at the edge between two numbers of six places."""
    values = (0.24 * 0.99390625, 1.0000005, 2.5e-6, 1e300, *[k / 8 * 1.1e-6 for k in range(-40, 400)])
    rows = [(7 * k, dt.datetime(2024, 1, 5, 9), 101 + k, "view", v, "{}") for k, v in enumerate(values)]
    return written(str(tmp_path_factory.mktemp("digits")), rows)


@pytest.fixture(scope="module")
def nameless_dir(tmp_path_factory):
    """Bars and actions without a user, which have an identifier in the SQL but no anchor."""
    rows = []
    for user in (None, 31, 34):
        for day in range(1, 29):
            rows.append((7 * len(rows), dt.datetime(2024, 1, day, 9), user, "view", 10.0 + 3 * day % 11, "{}"))
            if day % 4 == 0:
                rows.append((7 * len(rows) + 3, dt.datetime(2024, 1, day, 12), user, "purchase" if day % 8 else "signup", 5.0, "{}"))
    return written(str(tmp_path_factory.mktemp("nameless")), rows)


@pytest.fixture(scope="module")
def tie_dir(tmp_path_factory):
    """Closes whose gaps end in a five at the ninth place, and zeros of both signs."""
    rows = []
    for user in range(100, 220):
        for day in range(1, 29):
            cents = (512, 1024, 2560, 7680)[(user + day) % 4] if day % 3 else (user * 977 + day * 3571) % 9000
            value = -0.0 if user < 104 and day in (8, 16) else cents / 100
            rows.append((7 * len(rows), dt.datetime(2024, 1, day, 9), user, "view", value, "{}"))
    return written(str(tmp_path_factory.mktemp("tie")), rows)


@pytest.fixture(scope="module")
def same_time_dir(tmp_path_factory):
    """Users whose first and last time of a day several events have, of values above, at and below zero or none."""
    values = (12.5, 0.0, -3.5, None, 7.25, -0.0, float("inf"))
    rows = []
    for user in (17, 31, 34, 51, 68, 85, *range(101, 109)):
        for day in range(1, 22):
            for k in range(8):
                value = values[(user * 5 + day * 3 + k * (1 + day % 6)) % 7]
                rows.append((7 * ((len(rows) * 7919) % 100_003), dt.datetime(2024, 1, day, 9 + k % 2), user, "view", value, "{}"))
    return written(str(tmp_path_factory.mktemp("same_time")), rows)


def written(path, rows):
    kinds = [pa.int64(), pa.timestamp("us"), pa.int64(), pa.string(), pa.float64(), pa.string()]
    names = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    pq.write_table(pa.table(columns, names=names), f"{path}/events.parquet")
    return path


def same(name, spark, path, sql=None):
    rows = QUERIES[name](spark, path)
    names = sorted(rows.columns)
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{path}/events.parquet'")
    cursor = con.execute(sql or ORACLES[name])
    at = [[d[0] for d in cursor.description].index(n) for n in names]
    expected = sorted((tuple(r[k] for k in at) for r in cursor.fetchall()), key=repr)
    assert expected
    assert repr(sorted((tuple(r) for r in rows.select(*names).collect()), key=repr)) == repr(expected)  # NaN as text


@pytest.mark.parametrize("name", ["agg_median", "win_returns", "xck_returns", "aud_chain", "chk_prev_close", "link_unexplained", "qlt_quarantine", "qlt_status", "qlt_universe", "rsv_breaks", "snk_findings", "win_break_per_id", "win_break_per_series"])
def test_closes_of_zero(name, spark, odd_dir):
    same(name, spark, odd_dir)


@pytest.mark.parametrize("name", ["qlt_quarantine", "qlt_status", "qlt_universe", "rsv_breaks", "win_break_per_id", "win_break_per_series"])
def test_days_that_end_without_a_value(name, spark, null_dir):
    same(name, spark, null_dir)


@pytest.mark.parametrize("name", ["qlt_status", "qlt_universe", "rsv_breaks", "win_break_per_id"])
def test_values_below_zero_and_beyond_all_numbers(name, spark, below_dir):
    same(name, spark, below_dir)


@pytest.mark.parametrize("name", ["qlt_status", "rsv_breaks", "win_break_per_id", "win_break_per_series"])
def test_of_events_at_one_time_the_first_of_the_file_counts(name, spark, same_time_dir):
    same(name, spark, same_time_dir)


def test_bars_without_a_day_are_before_no_action(spark, timeless_dir):
    same("qlt_status", spark, timeless_dir)


def test_gaps_are_rounded_and_signed_as_the_sql_has_them(spark, tie_dir):
    same("win_break_per_series", spark, tie_dir)


@pytest.mark.parametrize("name", ["src_modern_bars", "src_legacy_bars"])
def test_shared_identifiers(name, spark, shared_dir):
    same(name, spark, shared_dir)


def ordered_sql(name):
    """The SQL with the rows of a day in the order of their traded identifiers and symbols, which it leaves open."""
    sql = ORACLES[name]
    tied = sql.replace(", series ORDER BY trade_date ROWS", ", series ORDER BY trade_date, isin, symbol ROWS")
    tied = tied.replace(", series ORDER BY trade_date\nROWS", ", series ORDER BY trade_date, isin, symbol\nROWS")
    assert tied != sql
    return tied


@pytest.mark.parametrize("name", ["gold_universe_flags", "gold_materialize"])
def test_rows_of_a_day_have_an_order(name, spark, shared_dir):
    same(name, spark, shared_dir, ordered_sql(name))


@pytest.mark.parametrize("rows", ["below_dir", "timeless_dir", "valueless_dir", "nameless_dir", "digits_dir"])
@pytest.mark.parametrize("name", ["gold_universe_flags", "gold_materialize"])
def test_users_days_and_values_that_are_missing_or_fine(name, rows, spark, request):
    same(name, spark, request.getfixturevalue(rows))


def test_events_are_multiplied_one_by_one_from_the_last(spark):
    day, at = dt.date, dt.datetime
    bars = spark.createDataFrame([("A", day(2024, 1, d), "EQ", 1.0, 1, 1.0) for d in (1, 20)], "isin string, trade_date date, series string, c double, volume bigint, turnover double")
    factors = [(10 / 11, 5, 3), (3 / 7, 5, 2), (0.9, 5, 1), (7 / 13, 6, 4), (10 / 12, 4, 5)]
    rows = [(n, "A", day(2024, 1, d), at(2024, 1, d, 9), "BONUS", "computed", f, 1 / f, None, None) for f, d, n in factors]
    kinds = "event_id int, isin string, ex_date date, learned_at timestamp_ntz, type string, state string, factor_price double, factor_vol double, div_amount double, anchor double"
    expected = 1.0
    for f, _, _ in sorted(factors, key=lambda x: (-x[1], -x[2])):
        expected *= f
    links = spark.createDataFrame([], "isin string, canonical_isin string")
    for some in (rows, rows[::-1], rows[2:] + rows[:2]):
        gold = materialise(bars, links, spark.createDataFrame(some, kinds)).filter("trade_date = date'2024-01-01'")
        assert [r[0] for r in gold.select("cum_factor").collect()] == [expected]


def test_doubles_are_rounded_as_the_sql_rounds_them(spark):
    values = [0.24 * 0.99390625, 1.0000005, 2.5e-6, -0.24 * 0.99390625, 0.0, 1e300, *[k / 8 * 1.1e-6 for k in range(-40, 400)]]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(rounded_as_sql(F.col("v"), 6)).collect()
    assert [r[0] for r in rows] == [duckdb.execute("SELECT round(?::DOUBLE, 6)", [v]).fetchall()[0][0] for v in values]
