"""The daily report: one day's health rows as the frames a report is made of."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import health


@dataclass(frozen=True)
class Report:
    """Lazy frames; each is bounded by the number of processes, not by the log."""

    summary: DataFrame
    not_run: DataFrame
    issues: DataFrame
    reruns: DataFrame
    failed_logs: DataFrame


def daily_report(log: DataFrame, roster: DataFrame, day: dt.date, labels: Mapping[str, str]) -> Report:
    """What ran, what did not, what needs attention and how to rerun it.

    ``roster`` has ProcessName, ConfigName, IsPostProcess and, optionally, Tags; entries tagged
    on-demand are not expected to run. An empty roster takes every process of the day. Rows that tie
    on time and duration go by run and table.
    """
    expected = health.daily_only(roster)
    rows = health.rows_of_day(log, day)
    if not expected.isEmpty():
        rows = rows.join(expected.select("ProcessName").distinct(), "ProcessName", "left_semi")
    # Run and table stand in for the order rows were written in, which a folder of files lacks.
    order = F.struct("ProcessID", "TargetTableName")
    latest = health.latest_rows(rows, order)
    status = health.process_status(latest)
    return Report(
        summary=health.summary(status, expected).withColumn(
            "headline", F.concat(F.col("headline"), F.lit(f" for {day.isoformat()}"))
        ),
        not_run=health.not_run(expected, status).select("ProcessName").orderBy("ProcessName"),
        issues=health.issue_rows(latest, status, labels).orderBy(*health.report_order()),
        reruns=health.rerun_groups(health.rerun_plan(status, expected)),
        failed_logs=health.failed_log_paths(latest, order).orderBy("FirstSeen"),
    )
