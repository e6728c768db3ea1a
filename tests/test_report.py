import datetime as dt

import pytest

from tests.helpers import rows
from tidemark.operators.health import HEALTH_SCHEMA
from tidemark.plans.report import daily_report

AT = dt.datetime(2026, 7, 28, 6)


def row(process, server, kind, status, run="r1", at=AT, error=None, path="/l"):
    return (process, run, None, at, f"[t].[{kind}]", status, 1, None, path, "Not Applicable", "Daily", error, 1, server, "x", kind)


@pytest.fixture
def log(spark):
    return spark.createDataFrame(
        [
            row("Items", "s1", "STG", "SUCCESS"), row("Items", "s1", "PRD", "FAILED", error="PK VIOLATION", path="/l/items"),
            row("Orders", "s1", "STG", "FAILED"), row("Orders", "s1", "STG", "SUCCESS", run="r2", at=AT + dt.timedelta(hours=1)),
            row("Stranger", "s1", "STG", "FAILED"), row("Idle", "s1", "STG", "SUCCESS", at=AT - dt.timedelta(days=1)),
            row("Adhoc", "s1", "STG", "FAILED"),
        ],
        HEALTH_SCHEMA,
    )


def test_report_of_a_day(spark, log):
    roster = spark.createDataFrame(
        [("Items", "items", False, ["daily"]), ("Orders", "orders", False, None), ("Idle", "idle", False, []), ("Adhoc", "adhoc", False, ["on-demand"])],
        "ProcessName string, ConfigName string, IsPostProcess boolean, Tags array<string>",
    )
    report = daily_report(log, roster, AT.date(), {"s1": "Main"})
    assert report.summary.first().headline == "1/3 failed; 0/3 skipped; 1/3 succeeded; 1/3 not run for 2026-07-28"
    assert rows(report.not_run) == [("Idle",)]
    assert [(r.ProcessName, r.TargetTableType, r.Connection, r.Error) for r in report.issues.collect()] == [
        ("Items", "STG", "Main", "—"), ("Items", "PRD", "Main", "PK VIOLATION"),
    ]
    assert rows(report.reruns, "Action", "Targets") == [("prd-only", "items")]
    assert rows(report.failed_logs, "LogFilePath") == [("/l/items",)]


def test_without_a_roster_everything_of_the_day_counts(spark, log):
    empty = spark.createDataFrame([], "ProcessName string, ConfigName string, IsPostProcess boolean")
    report = daily_report(log, empty, AT.date(), {})
    assert report.summary.first().headline == "3/4 failed; 0/4 skipped; 1/4 succeeded for 2026-07-28"
    assert {action for (action,) in rows(report.reruns, "Action")} == {"by hand"}


def test_a_day_without_rows(spark, log):
    empty = spark.createDataFrame([], "ProcessName string, ConfigName string, IsPostProcess boolean")
    row_ = daily_report(log, empty, dt.date(2020, 1, 1), {}).summary.first()
    assert (row_.total, row_.all_success) == (0, True)
