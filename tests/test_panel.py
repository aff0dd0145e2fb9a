"""Hand-checked values of factors, cumulative products, parser, links and checks."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from candela.functions import factors, purpose, scalars
from candela.operators import checks, ingest, links, panel, quality, review, storage
from candela.operators.asof import asof_before
from candela.operators.cumulative import strictly_after, within_edge
from candela.schemas import FINDING_SCHEMA


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("name", "given", "price", "volume", "state"),
    [
        ("bonus", (1, 1), 0.5, 2, "computed"),
        ("bonus", (13, 10), 10 / 23, 2.3, "computed"),
        ("bonus", (1, 3), 0.75, 4 / 3, "computed"),
        ("bonus", (0, 1), None, None, "unresolved"),
        ("bonus", (2, -1), None, None, "unresolved"),
        ("split", (10, 2), 0.2, 5, "computed"),
        ("split", (1, 10), 10, 0.1, "computed"),
        ("split", (10**7, 1), None, None, "unresolved"),
        ("cash", (100, 10), 0.9, 1, "computed"),
        ("cash", (250, 7.5), 0.97, 1, "computed"),
        ("cash", (100, 0), 1, 1, "computed"),
        ("cash", (100, 100), None, None, "unresolved"),
        ("rights", (1, 1, 50, 100), 0.75, 1, "computed"),
        ("rights", (1, 5, 50, 100), 1.1 / 1.2, 1, "computed"),
        ("rights", (1, 1, 16.25, 25), 0.825, 1, "computed"),
        ("rights", (1, 1, 150, 100), 1, 1, "skipped_s_gt_p"),
        ("rights", (1, 1, 100, 100), 1, 1, "computed"),
        ("spinoff", (100, 20, 0.5), 0.9, 1, "computed"),
        ("abnormal_cash", (100, 2, 10), 88 / 98, 1, "computed"),
        ("total_return", (100, 4), 0.96, 1, "computed"),
    ],
)
def test_factors(spark, name, given, price, volume, state):
    row = value(spark, getattr(factors, name)(*given))
    close = lambda a, b: a == b or a == pytest.approx(b, rel=1e-12)
    assert close(row.factor_price, price) and close(row.factor_vol, volume) and row.state == state


def test_multi_spinoff_and_dispatch(spark):
    legs = F.array(*[F.struct(F.lit(p).alias("child_price"), F.lit(n).alias("per_share")) for p, n in ((0.0999999, 1.0), (0.4625, 1.0))])
    assert value(spark, factors.multi_spinoff(10, legs)).factor_price == pytest.approx(0.94375001)
    call = lambda t, anchor: value(
        spark, factors.dispatch(F.lit(t), F.lit(1), F.lit(1), F.lit(50.0), F.lit(4.0), F.lit(anchor).cast("double"))
    )
    assert call("DIVIDEND", 100.0).state == "not_applicable"
    assert call("RIGHTS", None).state == "needs_anchor"
    assert call("DEMERGER", 100.0)[:] == (1.0, 1.0, "unresolved")
    assert call("BONUS_PREFERENCE", 100.0).state == "not_applicable"


def day(n):
    return dt.date(2024, 1, n)


@pytest.mark.parametrize(
    ("events", "expected"),
    [
        ([(3, 0.5)], [0.5, 0.5, 1, 1]),
        ([(2, 0.5), (4, 0.2)], [0.1, 0.2, 0.2, 1]),
        ([(3, 0.5), (3, 0.9)], [0.45, 0.45, 1, 1]),
        ([(1, 0.5)], [1, 1, 1, 1]),
        ([(3, None), (3, 0.0), (3, -1.0)], [1, 1, 1, 1]),
        ([(20, 0.5)], [0.5] * 4),
    ],
)
def test_strictly_after(spark, events, expected):
    bars = spark.createDataFrame([("k", day(n)) for n in (1, 2, 3, 4)], "id string, d date")
    acts = spark.createDataFrame([("k", day(n), f) for n, f in events], "id string, ex date, f double")
    rows = strictly_after(bars, acts, "id", "d", "ex", {"f": "cum"}).orderBy("d").collect()
    assert [r.cum for r in rows] == pytest.approx(expected)
    kept = within_edge(acts, bars, "id", "ex", "d").count()
    assert kept == sum(n <= 4 for n, _ in events)


def test_asof_is_strict_and_skips_nulls(spark):
    left = spark.createDataFrame([(1, day(3)), (1, day(1)), (2, day(3)), (1, day(9))], "k int, ex date")
    right = spark.createDataFrame([(1, day(1), 10.0), (1, day(2), None), (1, day(3), 30.0), (1, day(5), 50.0)], "k int, d date, c double")
    rows = asof_before(left, right, "k", "ex", "d", {"c": "anchor", "d": "seen"}).collect()
    assert {(r.k, r.ex): (r.anchor, r.seen) for r in rows} == {
        (1, day(3)): (10.0, day(1)), (1, day(1)): (None, None), (2, day(3)): (None, None), (1, day(9)): (50.0, day(5)),
    }


def test_total_return_is_below_price_return(spark, sf_dir):
    from candela.plans import analogs

    out = panel.adjusted(analogs.bars(spark, sf_dir), analogs.priced_actions(spark, sf_dir))
    assert out.filter("c_tr > c_adj * 1.0000001").count() == 0
    assert out.filter("c_tr <> c_adj").count() > 0


PURPOSES = [
    ("Bonus 13:10", None, [("BONUS", 13, 10, None, True)]),
    ("Bonus Issue", None, [("BONUS", None, None, None, False)]),
    ("Bonus Ncrps 4:1", None, [("BONUS_PREFERENCE", 4, 1, None, True)]),
    ("Scheme Of Arrangement - Bonus Ncrps 1:10", None, [("BONUS_PREFERENCE", 1, 10, None, True)]),
    ("Face Value Split (Sub-Division) - From Rs 10/- Per Share To Re 1/- Per Share", None, [("SPLIT", 10, 1, None, True)]),
    ("FACE VALUE SPLIT (SUB-DIVISION) - FROM RS 10/- PER SHARE TO RE 1/- PER SHARE", None, [("SPLIT", 10, 1, None, True)]),
    ("Rights 1:1 @ Premium Rs 11.25/-", 5, [("RIGHTS", 1, 1, 16.25, True)]),
    ("Rights 1:1 @ Premium Rs 0/-", 5, [("RIGHTS", 1, 1, 5, True)]),
    ("Rights 1:11.10 @ Premium Rs 0/-", 100, [("RIGHTS", 1, 11.1, 100, True)]),
    ("Rights 10:63", 10, [("RIGHTS", 10, 63, None, False)]),
    ("Rights Issue 30:37@ Premium Rs 53/-", 10, [("RIGHTS", 30, 37, 63, True)]),
    ("Rights 1:50 @ Premium Rs 690/- With 17 Warrants For 50 Equity Shares", 2, [("RIGHTS", 1, 50, None, False)]),
    ("Rights 9:77 Partly Paid @ Premium Rs 100/-", 10, [("RIGHTS", 9, 77, None, False)]),
    ("Bonus- 1:2", None, [("BONUS", 1, 2, None, True)]),
    ("Dividend - Re 0.40 Per Share", None, [("DIVIDEND", None, None, 0.4, True)]),
    ("Special Dividend - Rs 7.50 Per Share", None, [("SPECIAL_DIVIDEND", None, None, 7.5, True)]),
    ("Int Div-Rs 0.5 Per Sh", None, [("DIVIDEND", None, None, 0.5, True)]),
    ("Interim Dividned - Rs 135 Per Share", None, [("INTERIM_DIVIDEND", None, None, 135, True)]),
    ("Annual General Meetingdividend - Rs 6 Per Share", None, [("AGM", None, None, None, True), ("DIVIDEND", None, None, 6, True)]),
    ("Interim Dividend - Rs 8 Per Share Special Dividend - Rs 67 Per Share", None, [("INTERIM_DIVIDEND", None, None, 8, True), ("SPECIAL_DIVIDEND", None, None, 67, True)]),
    ("Interimdividend - Re 1 Per Share", None, [("INTERIM_DIVIDEND", None, None, 1, True)]),
    ("Interim Dividend - Rs 09 Per Share", None, [("INTERIM_DIVIDEND", None, None, 9, True)]),
    ("Dividend - Rs 1,250 Per Share", None, [("DIVIDEND", None, None, 1250, True)]),
    ("Scheme Of Arangement- Bonus - 1 Debenture For 1 Equity Share Held", None, [("SCHEME_OF_ARRANGEMENT", None, None, None, False)]),
    ("Return Of Capital - Re 0.3848 Per Unit", None, [("RETURN_OF_CAPITAL", None, None, 0.3848, True)]),
    ("Rs 1.4534 Per Unit As Return Of Capital", None, [("RETURN_OF_CAPITAL", None, None, 1.4534, True)]),
    ("Retun Of Capital Rs 1.2 Per Unit", None, [("RETURN_OF_CAPITAL", None, None, 1.2, True)]),
    ("Re 0.5 Return On Captial Per Unit", None, [("RETURN_OF_CAPITAL", None, None, 0.5, True)]),
    ("Principal Debt Repayment - Rs 9.9905 Per Unit", None, [("RETURN_OF_CAPITAL", None, None, 9.9905, True)]),
    ("Treasury Income Re 0.5 Per Unit", None, [("INTEREST_PAYMENT", None, None, None, True)]),
    ("Nterest Amount- Rs 3.0556", None, [("INTEREST_PAYMENT", None, None, None, True)]),
    ("Annual General Meetin", None, [("AGM", None, None, None, True)]),
    ("Extra-Ordinary General Meting", None, [("EGM", None, None, None, True)]),
    ("Demerger", None, [("DEMERGER", None, None, None, False)]),
    ("Capital Reduction", None, [("CAPITAL_REDUCTION", None, None, None, False)]),
    ("Redemption", None, [("REDEMPTION", None, None, None, False)]),
    ("Tresury Income Re 0.5 Per Unit", None, [("INTEREST_PAYMENT", None, None, None, True)]),
    ("Dividend - Rs.2.5 Per Share", None, [("DIVIDEND", None, None, 2.5, True)]),
    ("Dividend Of 3 Rs And Buy-Back", None, [("DIVIDEND", None, None, 3, True), ("BUYBACK", None, None, None, True)]),
    ("Final Special Dividend Rs 3", None, [("DIVIDEND", None, None, 3, True)]),
    ("Interim And Special Dividend .75 Re", None, [("UNKNOWN", None, None, None, False), ("SPECIAL_DIVIDEND", None, None, 0.75, True)]),
    ("Bonus Of N.C.R.P.S 3:2", None, [("BONUS_PREFERENCE", 3, 2, None, True)]),
    ("Bonus Pref. Shares", None, [("BONUS_PREFERENCE", None, None, None, True)]),
    ("Spin Off", None, [("SPINOFF", None, None, None, False)]),
    ("Repayment Of Spv Debt And Ncds - Rs 1.5 Per Unit", None, [("RETURN_OF_CAPITAL", None, None, None, False), ("RETURN_OF_CAPITAL", None, None, 1.5, True)]),
    ("Coupon 7.5%", None, [("INTEREST_PAYMENT", None, None, None, True)]),
    ("Financial Results", None, [("NO_ADJUST", None, None, None, True)]),
    ("Consolidation From Rs 1 To Rs 10", None, [("SPLIT", 1, 10, None, True)]),
    ("Split From Rs 5 To Rs 5", None, [("SPLIT", 5, 5, None, False)]),
    ("Mf", None, [("UNKNOWN", None, None, None, False)]),
    ("", None, []),
    (
        "Distribution - Rs 1.6876 Per Unit Consists Of Dividend Re 0.2958 Per Unit/ Interest - Re 0.7046 Per Unit/ Return Of Capital - Re 0.6872 Per Unit",
        None,
        [("NO_ADJUST", None, None, None, True), ("INTEREST_PAYMENT", None, None, None, True), ("RETURN_OF_CAPITAL", None, None, 0.6872, True)],
    ),
]


def test_purposes(spark):
    rows = [(k, text, face) for k, (text, face, _) in enumerate(PURPOSES)]
    parsed = purpose.parse(spark.createDataFrame(rows, "k int, purpose string, face_value int")).collect()
    number = lambda x: None if x is None else float(x)
    for k, (text, _, expected) in enumerate(PURPOSES):
        own = sorted((r for r in parsed if r.k == k), key=lambda r: r.component_ix)
        amount = lambda r: r.sub_price if r.type == "RIGHTS" else r.div_amount
        found = [(r.type, number(r.ratio_num), number(r.ratio_den), number(amount(r)), r.parsed_ok) for r in own]
        assert found == [pytest.approx(e) if None not in e else e for e in expected], text


def test_the_parser_compiles(spark, sf_dir):
    from candela.plans import text_queries

    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        assert text_queries.txt_parse(spark, sf_dir).count() > 0
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")


def test_severity(spark):
    rows = [("Bonus Issue", "high"), ("Demerger", "high"), ("Mf", "medium"), ("Dividend", "low"), ("Bonus 1:1", "low")]
    data = spark.createDataFrame([(t,) for t, _ in rows], "purpose string").withColumn("face_value", F.lit(None).cast("int"))
    assert {r.purpose: r.severity for r in purpose.parse(data).collect()} == dict(rows)


def test_scalars(spark):
    lit = F.lit
    assert value(spark, scalars.flexible_dmy(lit("13-Jul-20"))) == dt.date(2020, 7, 13)
    assert value(spark, scalars.flexible_dmy(lit("14-JUL-2020"))) == dt.date(2020, 7, 14)
    assert value(spark, scalars.flexible_dmy(lit("x"))) is None
    assert value(spark, scalars.to_float(lit(" 09 "))) == 9 and value(spark, scalars.to_float(lit("-"))) is None
    assert value(spark, scalars.number_token(lit("1,250/-"))) == 1250
    assert value(spark, scalars.clean(lit(" a – b’s "))) == "a - b's"
    assert value(spark, scalars.classify_series(lit("bt"))) == "T2T"
    same = [scalars.payload_hash(lit(i), lit("01-Jan-2026"), lit(p), lit("02-Jan-2026")) for i, p in (("INE123A01011", "Bonus 1:1"), ("ine123a01011", " bonus 1:1 "))]
    assert value(spark, same[0]) == value(spark, same[1])
    flag = lambda *x: value(spark, scalars.circuit_flag(*[lit(v) for v in x]))
    assert flag(1.0, 1.0, 1.0, 1.0, None, "5") is True and flag(1.0, 2.0, 1.0, 2.0, 1.0, "No Band") is False


def test_chains_end_and_cycles_stop(spark):
    edges = [("A", "B"), ("B", "C"), ("P", "Q"), ("Q", "P")] + [(f"n{k:02}", f"n{k + 1:02}") for k in range(15)]
    got = {r.isin: (r.canonical_isin, r.depth) for r in links.terminal(spark.createDataFrame(edges, "old_isin string, new_isin string")).collect()}
    assert got["A"] == ("C", 2) and got["B"] == ("C", 1) and got["P"][0] == "Q" and got["Q"][0] == "P"
    assert got["n00"] == ("n15", 15)


def test_guard_tells_orphans_from_pre_history(spark):
    events = spark.createDataFrame(
        [(1, "X1", "S", day(5), 0.5), (2, "X9", "S", day(5), 0.5), (3, "X1", "S", day(1), 0.5), (4, "X1", "S", day(5), 1.0)],
        "event_id int, chain string, symbol string, ex_date date, factor_price double",
    )
    bars = spark.createDataFrame([("X1", "S", day(2)), ("X1", "S", day(3))], "chain string, symbol string, trade_date date")
    assert {r.event_id: r.kind for r in checks.zero_multipliers(events, bars, "chain", "symbol").collect()} == {2: "ORPHANED", 3: "PRE_HISTORY"}


def test_a_failing_check_is_a_finding(spark):
    rows = checks.run_all(spark, {"broken": lambda: spark.table("no_such_table")})
    assert rows[0]["severity"] == "critical" and "constraint_violation" in rows[0]["detail"]
    assert checks.worst(spark.createDataFrame(rows, FINDING_SCHEMA)).first()[:] == (2, "critical")


def test_quality_keeps_blocked(spark):
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    one = lambda *x: spark.createDataFrame([(v,) for v in x], "id string")
    before = spark.createDataFrame([("c", "blocked")], "id string, status string")
    got = quality.statuses(ids, "id", one("b", "b"), one(), one(), before)
    assert {r.id: (r.status, r.note) for r in got.collect()} == {"a": ("verified", ""), "b": ("review_open", "2 open"), "c": ("blocked", "")}
    after = quality.quarantine(got, "id", one("a", "c"))
    assert {r.id: r.status for r in after.collect()} == {"a": "review_open", "b": "review_open", "c": "blocked"}


def test_review_rules():
    for text in ("99999", "0", "-1", "abc", ""):
        with pytest.raises(ValueError, match="factor"):
            review.factor_from_text(text)
    assert [review.factor_from_text(t) for t in ("0.5", "0.333333", "10", "1")] == [0.5, 0.333333, 10, 1]
    c = review.Counts
    assert review.cleared(c(2, 2, 0), c(0, 0, 0)) and review.cleared(c(2, 2, 0), c(2, 1, 0))
    assert not review.cleared(c(2, 2, 0), c(3, 1, 0)) and not review.cleared(c(2, 2, 0), c(0, 0, 1))
    assert review.Resolution("factor", "needs_external_price", factor="0.5", confirmed=True).refusals() == ["name the source of the price"]
    assert review.Resolution("reanchor", "x", confirmed=True, target_bars=0).refusals() == ["the target has no bars before the date"]
    assert review.Resolution("accept", "x").refusals() == []


def test_event_locator(spark):
    queue = spark.createDataFrame([(1, 10, "x event_id=77 y"), (2, 11, "x"), (3, 12, "x")], "review_id int, ca_raw_id int, raw_purpose string")
    events = spark.createDataFrame([(5, 11), (6, 12), (7, 12)], "event_id bigint, ca_raw_id int")
    assert {r.review_id: (r.event_id, r.n_live) for r in review.located(queue, events).collect()} == {1: (77, 0), 2: (5, 1), 3: (None, 2)}


def test_reviews_for_missing_identifiers(spark):
    rows = [(1, None, day(2), "Bonus 1:1", 10), (2, "I", None, "Bonus 1:1", 10), (3, "I", day(2), "Mf & Mf", 10), (None, "I", day(2), "Mf", 1), (None, "I", day(2), "Mf", 1)]
    raw = spark.createDataFrame(rows, "ca_raw_id int, isin string, ex_date date, purpose string, face_value int")
    events, reviews = ingest.events_and_reviews(raw)
    assert events.count() == 4
    found = sorted((r.ca_raw_id or 0, r.reason, r.severity) for r in reviews.collect())
    assert found == [(0, "unparsed_pattern", "medium"), (1, "ambiguous_ratio", "high"), (2, "unparsed_pattern", "high"), (3, "unparsed_pattern", "medium")]


def test_merge_and_swap(spark, tmp_path):
    make = lambda rows: storage.with_row_hash(spark.createDataFrame(rows, "k int, v double"), ["v"], [])
    old, new = make([(1, 1.0), (2, 2.0), (None, 9.0)]), make([(2, 2.5), (3, 3.0), (None, 9.0)])
    out = storage.merged(old, new, ["k"], storage.hash_gate())
    assert sorted((r.k or 0, r.v) for r in out.collect()) == [(0, 9.0), (1, 1.0), (2, 2.5), (3, 3.0)]
    assert [r.k for r in storage.restated(old, new, ["k"]).collect()] == [2]
    path = str(tmp_path / "t")
    storage.swap_in(old, path)
    storage.swap_in(storage.merged(spark.read.parquet(path), new, ["k"]), path)
    assert spark.read.parquet(path).count() == 4


def test_a_broken_swap_is_recovered(spark, tmp_path):
    path = str(tmp_path / "table")
    for n in (3, 5):
        storage.swap_in(spark.range(n), path)
    assert spark.read.parquet(path).count() == 5
    (tmp_path / "table").rename(tmp_path / "table.previous")  # as if the process died between the renames
    assert storage.recovered(spark, path) and spark.read.parquet(path).count() == 5
    storage.swap_in(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7 and not (tmp_path / "table.previous").exists()


def test_an_upsert_of_one_key_keeps_its_neighbours(spark):
    old = spark.range(1_000).select("id", F.lit("old").alias("v"))
    new = spark.createDataFrame([(3, "new"), (5_000, "new")], "id bigint, v string")
    out = {r.id: r.v for r in storage.replaced_buckets(old, new, "id", 16).collect()}
    assert out == {**{k: "old" for k in range(1_000)}, 3: "new", 5_000: "new"}


def test_no_machine_local_folder_on_a_cluster():
    class Cluster:
        master, applicationId = "spark://host:7077", "x"

    class Session:
        sparkContext = Cluster()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(RuntimeError):
        storage.shared_folder(Session())


def test_an_incremental_rebuild_equals_a_full_one(spark, sf_dir):
    from candela.plans.link_queries import gold_inputs

    inputs = gold_inputs(spark, sf_dir)
    full = panel.materialise(*inputs)
    ids = full.select("isin").distinct().orderBy("isin").limit(7)
    part = panel.materialise(*inputs, ids=ids)
    rows = lambda df: sorted(map(repr, df.select(sorted(full.columns)).collect()))
    assert part.select("isin").distinct().count() == 7
    assert rows(storage.scoped_replace(full, part, ids, "isin")) == rows(full)
    assert full.groupBy("isin", "trade_date", "series").count().filter("count > 1").isEmpty()


def test_migrations_run_in_order(spark, tmp_path):
    from candela.operators import migrations

    (tmp_path / "002_b.sql").write_text("CREATE OR REPLACE TEMP VIEW second AS SELECT * FROM first;")
    (tmp_path / "001_a.sql").write_text("-- a; b\nCREATE OR REPLACE TEMP VIEW first AS SELECT 'x;y' AS v /* ; */;\n;")
    (tmp_path / "notes.sql").write_text("not SQL")
    for _ in range(2):
        assert migrations.apply_migrations(spark, str(tmp_path)) == ["001_a.sql", "002_b.sql"]
    assert spark.table("second").first().v == "x;y"
