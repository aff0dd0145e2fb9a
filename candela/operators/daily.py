"""The daily run: one session's bars go through links, anchors, guard, gold, checks, quality and alert."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candela.operators import checks, links, panel, quality
from candela.operators.operations import RunSummary, alert
from candela.operators.storage import hash_gate, merged, restated, with_row_hash
from candela.schemas import FINDING_SCHEMA

KEYS = ["trade_date", "isin", "series"]
FLOATS = ["o", "h", "l", "c", "prev_close", "turnover"]
# Exit codes, and the ledger's word for each.
STATUS = {0: "success", 1: "warning", 2: "failed"}


@dataclass
class State:
    """Tables of the panel: bars with row_hash, events, links (or None: found here), gold, quality, ledger of content hashes."""

    bars: DataFrame
    events: DataFrame
    gold: DataFrame | None = None
    quality: DataFrame | None = None
    done: set[tuple[str, str]] = field(default_factory=set)


@dataclass
class Run:
    day: str
    status: str
    exit_code: int
    summary: dict[str, int]
    findings: list
    alert: str
    content_hash: str
    notes: list[str]
    finished_at: datetime


def content_hash(bars: DataFrame) -> str:
    """A hash of a day's rows in any order."""
    one = bars.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("row_hash").cast("decimal(38,0)")).alias("h")).first()
    return f"{one['n']}:{one['h']}"


def run(state: State, day: str, new: DataFrame, changed: DataFrame, now: datetime, force: bool = False) -> Run:
    """One session: ``new`` are the day's canonical bars, ``changed`` the events that were learned since the last run.

    The same content of the same day is loaded once. A step that fails is a
    critical finding and does not stop the others. Factors that multiply no bar
    eject their security from the universe and fail the run. ``state`` is
    replaced step by step.
    """
    spark, found, notes, totals = new.sparkSession, [], [], RunSummary()
    hashed = with_row_hash(new, FLOATS, ["volume"])
    content = content_hash(hashed)
    n_rows = hashed.count()
    if not force and (day, content) in state.done:
        return Run(day, "success", 0, totals.as_row(), [], "", content, ["no-op: the same content was loaded before"], now)

    def step(name: str, work: Callable[[], None]) -> None:
        try:
            work()
        except Exception as error:  # noqa: BLE001  a broken step must not hide the others
            found.extend(spark.createDataFrame([(name, "critical", None, None, f"constraint_violation: {str(error)[:150]}", None)], FINDING_SCHEMA).collect())

    def ingest() -> None:
        if not n_rows:
            row = ("rowcount", "warning", None, None, f"no bars for {day}", None)
            found.extend(spark.createDataFrame([row], FINDING_SCHEMA).collect())
            return
        totals.add(rows_read=n_rows, rows_restated=restated(state.bars, hashed, KEYS).count())
        state.bars = merged(state.bars, hashed, KEYS, hash_gate())
        totals.add(rows_written=n_rows)

    def actions() -> None:
        totals.add(events=changed.count())
        state.events = merged(state.events, changed, ["event_id"])

    def chains() -> DataFrame:
        return links.terminal(links.edges(links.judged(links.switches(state.bars))))

    chained: list[DataFrame] = []
    ejected: list[DataFrame] = []

    def guard() -> None:
        named = lambda df: panel.canonical(df, chained[0]).drop("isin").withColumnRenamed("canonical_isin", "isin")
        bars = named(state.bars)
        settled = named(state.events.join(changed.select("event_id"), "event_id", "left_semi")).filter("state = 'computed'")
        orphans = checks.zero_multipliers(settled, bars, "isin", "symbol").filter("kind = 'ORPHANED'")
        rows = orphans.select(*checks.finding("orphaned_factor", "critical", F.col("isin"), F.col("symbol"), F.format_string("event %s multiplies no bar", "event_id")))
        fresh = rows.collect()  # of one day's events
        found.extend(fresh)
        if fresh:
            ejected.append(quality.identities(bars, orphans, "symbol", "isin").union(orphans.select("isin")).distinct())

    def gold() -> None:
        ids = panel.affected(
            panel.canonical(new, chained[0]).select(F.col("canonical_isin").alias("isin")),
            panel.canonical(changed, chained[0]).select(F.col("canonical_isin").alias("isin")),
            "isin",
        )
        ids = None if state.gold is None else ids
        made = panel.materialise(state.bars, chained[0], state.events, ids)
        state.gold = made if state.gold is None else state.gold.join(ids, "isin", "left_anti").unionByName(made)

    def validate() -> None:
        edges = checks.right_edges(state.gold, "isin")
        off = checks.prev_close(state.bars, ["isin", "series"]).filter(F.col("trade_date") == F.lit(day).cast("date"))
        report = {
            "right_edge_identity": lambda: edges.select(*checks.finding("right_edge_identity", "critical", F.col("isin"), F.lit(None).cast("string"), F.lit("the last bar is adjusted"))),
            "prev_close_reconcile": lambda: off.select(*checks.finding("prev_close_reconcile", "warning", F.col("isin"), F.col("symbol"), F.format_string("%.4f off", "rel"))),
        }
        found.extend(checks.run_all(spark, report))

    def gate() -> None:
        ids = state.gold.select("isin").distinct()
        nothing = ids.limit(0)
        bad = ejected[0] if ejected else nothing
        state.quality = quality.statuses(ids, "isin", nothing, bad, nothing, state.quality)

    for name, work in (("ingest", ingest), ("corp_actions", actions), ("isin_link", lambda: chained.append(chains())),
                       ("factor_guard", guard), ("gold", gold), ("checks", validate), ("quality", gate)):
        step(name, work)
    levels = {f["severity"] for f in found}
    code = 2 if "critical" in levels else 1 if "warning" in levels else 0
    totals.add(findings=len(found))
    if code < 2:
        state.done.add((day, content))
    return Run(day, STATUS[code], code, totals.as_row(), found, alert(found), content, notes, now)
