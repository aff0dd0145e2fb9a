"""Operations: last success, missed sessions, views over the index tables, heartbeat, alerts, run counters."""

from __future__ import annotations

import json
import os
import tempfile
from dataclasses import asdict, dataclass, fields
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Statuses that count as success, and limits of an alert.
SUCCESS = ("success", "warning")
ALERT_LINES, ALERT_DETAIL, ALERT_TEXT = 12, 150, 2900
STALE_HOURS = 30


def last_success(runs: DataFrame) -> DataFrame:
    """One row for each command: last success, last run, its status, failures since."""
    good = F.col("status").isin(*SUCCESS)
    base = runs.groupBy("command").agg(
        F.max(F.when(good, F.col("finished_at"))).alias("last_success"),
        F.max("finished_at").alias("last_run"),
        F.max_by("status", "finished_at").alias("last_status"),
    )
    later = runs.join(base.select("command", "last_success"), "command").filter(~good)
    later = later.filter(F.col("last_success").isNull() | (F.col("finished_at") > F.col("last_success")))
    failed = later.groupBy("command").agg(F.count(F.lit(1)).alias("failures_since"))
    return base.join(failed, "command", "left").na.fill(0, ["failures_since"])


def sessions_missed(calendar: DataFrame, last_day: DataFrame, today: str) -> DataFrame:
    """One row: trading days after the last loaded one and before today."""
    edge = F.lit(last_day.agg(F.max("trade_date")).first()[0]).cast("date")
    after = F.col("is_trading") & (F.col("cal_date") > edge) & (F.col("cal_date") < F.lit(today).cast("date"))
    return calendar.agg(F.count_if(after).alias("missed"))


def index_view(index_daily: DataFrame, key: str) -> DataFrame:
    """One index's days."""
    return index_daily.filter(F.col("index_key") == key).select("trade_date", "index_key", "close", "pct_chg")


def heartbeat(path: str, content: dict) -> None:
    """Writes the freshness stamp: beside the file first, then moved over it."""
    folder = os.path.dirname(os.path.abspath(path))
    handle, staged = tempfile.mkstemp(dir=folder)
    with os.fdopen(handle, "w") as file:
        json.dump(content, file, sort_keys=True, default=str)
    os.replace(staged, path)


def is_stale(last: datetime | None, now: datetime, hours: float = STALE_HOURS) -> bool:
    return last is None or (now - last).total_seconds() > hours * 3600


def alert(findings: list) -> str:
    """The text of an alert: critical findings first, a bounded number of lines of bounded length."""
    urgent = [f for level in ("critical", "warning") for f in findings if f["severity"] == level]
    lines = [f"{f['severity']}: {f['check_name']} {f['detail'] or ''}"[:ALERT_DETAIL] for f in urgent[:ALERT_LINES]]
    if len(urgent) > ALERT_LINES:
        lines.append(f"...and {len(urgent) - ALERT_LINES} more")
    return "\n".join(lines)[:ALERT_TEXT]


@dataclass
class RunSummary:
    """Counters of a run, mirrored to the ledger."""

    rows_read: int = 0
    rows_written: int = 0
    rows_restated: int = 0
    events: int = 0
    reviews: int = 0
    findings: int = 0

    def add(self, **counts: int) -> RunSummary:
        known = {f.name for f in fields(self)}
        for name, n in counts.items():
            if name not in known:
                raise KeyError(name)
            setattr(self, name, getattr(self, name) + n)
        return self

    def as_row(self) -> dict[str, int]:
        return asdict(self)
