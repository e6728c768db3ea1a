import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import plan, rows
from tidemark.operators import health as h

T0, T1 = dt.datetime(2026, 7, 28, 6), dt.datetime(2026, 7, 28, 7)
SCHEMA = (
    "ProcessName string, DBConnection string, TargetTableType string, TaskStatus string, LastRunTime timestamp_ntz, "
    "Duration int, LogFilePath string, Error string, n int"
)


@pytest.fixture
def log(spark):
    return spark.createDataFrame(
        [
            ("Items", "s1", "STG", "FAILED", T0, 5, "/l/1", "boom", 0),
            ("Items", "s1", "STG", "SUCCESS", T1, 1, "/l/2", None, 1),  # the rerun counts
            ("Items", "s1", "PRD", "FAILED", T1, 1, "/l/2", "PK VIOLATION", 2),
            ("Items", "s2", "PRD", "SUCCESS", T1, 1, "/l/2", None, 3),
            ("Orders", "s1", "STG", "SUCCESS", T1, 3, "/l/3", None, 4),
            ("Orders", "s1", "STG", "FAILED", T1, 9, "/l/4", "x  y", 5),  # tie on time: the longer run
            ("Lines", "s1", "STG", "FILE_NOT_FOUND", T1, None, None, None, 6),
            ("Lines", "s1", "STG", "FAILED", T1, 0, "/l/5", "z", 7),  # full tie: the later row
            ("Batch", "s1", "PROC", "BLOCKED", T1, 0, "/l/6", "waits", 8),
            ("Batch", "s2", "PROC", "SUCCESS", T1, 0, "/l/6", None, 9),
            ("Feed", "s1", "STG", "FILE_NOT_FOUND", T1, 0, None, None, 10),
            ("Post", "s1", "PROC", "BLOCKED", T1, 0, None, None, 11),
            (None, None, None, "SUCCESS", None, None, None, None, 12),
        ],
        SCHEMA,
    )


@pytest.fixture
def roster(spark):
    rows_ = [("Items", "items", False), ("Orders", "orders", False), ("Batch", "batch", True), ("Feed", "feed", False),
             ("Post", "post", True), ("Idle", "idle", False)]
    return spark.createDataFrame(rows_, "ProcessName string, ConfigName string, IsPostProcess boolean")


def test_latest(log):
    got = rows(h.latest_rows(log, F.col("n")), "n")
    assert sorted(n for (n,) in got) == [1, 2, 3, 5, 7, 8, 9, 10, 11, 12]


def test_latest_cuts_before_the_shuffle(spark):
    log = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr(
        "event_type ProcessName", "'s' DBConnection", "'STG' TargetTableType", "ts LastRunTime", "1 Duration", "event_id n"
    )
    text = plan(h.latest_rows(log, F.col("n")))
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_status(log):
    got = dict(r[:2] for r in rows(h.process_status(h.latest_rows(log, F.col("n")))))
    assert got == {"Items": "FAILED", "Orders": "FAILED", "Lines": "FAILED", "Batch": "SUCCESS", "Feed": "FILE_NOT_FOUND", "Post": "BLOCKED", "": "SUCCESS"}


def test_summary(log, roster):
    status = h.process_status(h.latest_rows(log, F.col("n")).where("ProcessName IS NOT NULL"))
    row = h.summary(status, roster).first()
    assert row.headline == "3/6 failed; 1/6 skipped; 1/6 blocked; 1/6 succeeded; 1/6 not run"
    assert (row.total, row.n_not_run, row.all_success, row.has_failures) == (6, 1, False, True)
    assert rows(h.not_run(roster, status), "ProcessName") == [("Idle",)]
    alone = h.summary(status, roster.limit(0)).first()
    assert alone.total == 6 and alone.n_not_run == 0


def test_rerun(log, roster):
    status = h.process_status(h.latest_rows(log, F.col("n")))
    planned = h.rerun_plan(status, roster)
    assert rows(planned, "ProcessName", "Action") == [
        ("Feed", "full"), ("Items", "prd-only"), ("Lines", "by hand"), ("Orders", "full"), ("Post", "post-run"),
    ]
    assert rows(h.rerun_groups(planned), "Action", "Targets", "Processes") == [
        ("by hand", "", "Lines"), ("full", "orders feed", "Orders, Feed"), ("post-run", "post", "Post"), ("prd-only", "items", "Items"),
    ]


def test_issue_rows_keep_whole_groups_in_report_order(log):
    latest = h.latest_rows(log, F.col("n"))
    got = h.issue_rows(latest, h.process_status(latest), {"s2": "Backup", "s1": "Main"}).orderBy(*h.report_order()).collect()
    assert [(r.ProcessName, r.Connection, r.TargetTableType, r.Error) for r in got] == [
        ("Items", "Backup", "PRD", "—"), ("Items", "Main", "STG", "—"), ("Items", "Main", "PRD", "PK VIOLATION"),
        ("Lines", "Main", "STG", "z"), ("Orders", "Main", "STG", "x y"),
        ("Feed", "Main", "STG", "—"), ("Post", "Main", "PROC", "—"),
    ]


def test_failed_log_paths(log):
    got = h.failed_log_paths(h.latest_rows(log, F.col("n")), F.col("n")).orderBy("FirstSeen")
    assert [r.LogFilePath for r in got.collect()] == ["/l/2", "/l/4", "/l/5"]


def test_day_scan(spark, log):
    assert rows(h.rows_of_day(log, dt.date(2026, 7, 28), ["Items"]), "n") == [(0,), (1,), (2,), (3,)]
    assert h.rows_of_day(log, dt.date(2026, 7, 28)).count() == 12
    assert h.rows_of_day(log, dt.date(2026, 7, 27)).count() == 0


def test_requirements(spark, log):
    latest = h.latest_rows(log, F.col("n"))
    needs = spark.createDataFrame(
        [("p", "s2", "Items", "destination"), ("q", "s2", "Items", "any"), ("q", "s2", "Feed", "any"), ("r", "s2", "Orders", "destination")],
        "Waiting string, Server string, ProcessName string, Scope string",
    )
    got = h.requirement_status(latest, needs)
    assert rows(got, "Waiting", "ProcessName", "Met", "Reason") == [
        ("p", "Items", True, None),
        ("q", "Feed", False, "Feed: FILE_NOT_FOUND on s1/STG"),
        ("q", "Items", False, "Items: FAILED on s1/PRD"),
        ("r", "Orders", False, "Orders: no health row on s2"),
    ]
    verdicts = h.gate(got)
    assert (["Feed: FILE_NOT_FOUND on s1/STG", "Items: FAILED on s1/PRD"],) in rows(verdicts, "Reasons")
    dated = h.requirement_status(latest, needs, on_day=dt.date(2026, 7, 28))
    assert ("Orders: no health row for 2026-07-28 on s2",) in rows(dated, "Reason")
    assert rows(verdicts.drop("Reasons")) == [
        ("p", "s2", True, ""),
        ("q", "s2", False, "Feed: FILE_NOT_FOUND on s1/STG; Items: FAILED on s1/PRD"),
        ("r", "s2", False, "Orders: no health row on s2"),
    ]


def test_step_kind(spark):
    frame = spark.createDataFrame([("a", "sql"), ("a", "sql"), ("b", "sql"), ("b", "python")], "k string, kind string")
    assert rows(frame.groupBy("k").agg(h.step_kind(F.col("kind")))) == [("a", "sql"), ("b", "mixed")]
