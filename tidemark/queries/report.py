"""Queries over a health log made from the events.

Each event is one logged step: the process is the user's nation, the table type and connection
come from the value and the customer's segment, the status from the event type. Run times are
cut to the hour, so that reruns tie.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import health
from tidemark.queries.base import ORACLES, query, table

LABELS = {"srv1": "Main", "srv2": "Backup"}

LOG_SQL = """
WITH log AS (
  SELECT n_name AS p, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'srv1' ELSE 'srv2' END AS c,
    CASE WHEN value < 20 THEN 'STG' ELSE 'PRD' END AS t,
    CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'signup' THEN 'FILE_NOT_FOUND' WHEN 'purchase' THEN 'BLOCKED' ELSE 'SUCCESS' END AS s,
    date_trunc('hour', ts) AS run, CAST(floor(value) AS INTEGER) AS dur, event_id,
    '/logs/' || n_name || '/' || CAST(user_id AS VARCHAR) AS path,
    CASE WHEN event_type <> 'click' THEN event_type || ' on  ' || props END AS err,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS day
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey),
latest AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY day, p, c, t ORDER BY run DESC, dur DESC, event_id DESC) = 1),
roster AS (SELECT n_name AS p, lower(n_name) AS config, n_regionkey = 4 AS post FROM nation WHERE n_regionkey <> 3),
status AS (
  SELECT day, p, CASE WHEN bool_or(s = 'FAILED') THEN 'FAILED'
      WHEN bool_and(s IN ('BLOCKED', 'FILE_NOT_FOUND')) THEN CASE WHEN bool_or(s = 'BLOCKED') THEN 'BLOCKED' ELSE 'FILE_NOT_FOUND' END
      ELSE 'SUCCESS' END AS st,
    coalesce(bool_and(t = 'PRD') FILTER (s = 'FAILED'), FALSE) AS only_prd
  FROM latest GROUP BY 1, 2),
plan AS (
  SELECT day, status.p, config, st, CASE WHEN config IS NULL THEN 'by hand' WHEN post THEN 'post-run'
      WHEN st = 'FAILED' AND only_prd THEN 'prd-only' ELSE 'full' END AS act,
    CASE st WHEN 'FAILED' THEN 0 WHEN 'FILE_NOT_FOUND' THEN 1 WHEN 'BLOCKED' THEN 2 ELSE 3 END AS rank
  FROM status LEFT JOIN roster ON status.p = roster.p WHERE st <> 'SUCCESS')
"""


def health_log(spark, sf_dir):
    """The events as health rows, with their day as text."""
    kind = F.col("event_type")
    return (
        table(spark, sf_dir, "events")
        .join(table(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("n_name").alias("ProcessName"),
            F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), "srv1").otherwise("srv2").alias("DBConnection"),
            F.when(F.col("value") < 20, "STG").otherwise("PRD").alias("TargetTableType"),
            F.when(kind == "error", "FAILED")
            .when(kind == "signup", "FILE_NOT_FOUND")
            .when(kind == "purchase", "BLOCKED")
            .otherwise("SUCCESS")
            .alias("TaskStatus"),
            F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("LastRunTime"),
            F.floor("value").cast("int").alias("Duration"),
            F.col("event_id").alias("ProcessID"),
            F.concat(F.lit("/logs/"), "n_name", F.lit("/"), F.col("user_id").cast("string")).alias("LogFilePath"),
            F.when(kind != "click", F.concat(kind, F.lit(" on  "), "props")).alias("Error"),
            F.to_date("ts").cast("string").alias("day"),
        )
    )


def latest(spark, sf_dir):
    return health.latest_rows(health_log(spark, sf_dir), F.col("ProcessID"), day="day")


def status(spark, sf_dir):
    return health.process_status(latest(spark, sf_dir), day="day")


def roster(spark, sf_dir):
    return table(spark, sf_dir, "nation").where(F.col("n_regionkey") != 3).select(
        F.col("n_name").alias("ProcessName"), F.lower("n_name").alias("ConfigName"), (F.col("n_regionkey") == 4).alias("IsPostProcess")
    )


@query(
    LOG_SQL
    + """SELECT day, p AS "ProcessName", c AS "DBConnection", t AS "TargetTableType", s AS "TaskStatus", run AS "LastRunTime",
dur AS "Duration", event_id AS "ProcessID", path AS "LogFilePath", err AS "Error" FROM latest"""
)
def health_latest(spark, sf_dir):
    """The row that counts per day, process, connection and table type."""
    return latest(spark, sf_dir)


@query(
    LOG_SQL
    + """SELECT p AS "ProcessName", c AS "DBConnection", t AS "TargetTableType", s AS "TaskStatus", run AS "LastRunTime", event_id AS "ProcessID"
FROM log WHERE day = '2024-01-15' AND p IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_5', 'NATION_8')"""
)
def health_day_rows(spark, sf_dir):
    """The log rows of one day and a set of processes."""
    names = ["NATION_1", "NATION_2", "NATION_3", "NATION_5", "NATION_8"]
    found = health.rows_of_day(health_log(spark, sf_dir), dt.date(2024, 1, 15), names)
    return found.select("ProcessName", "DBConnection", "TargetTableType", "TaskStatus", "LastRunTime", "ProcessID")


@query(LOG_SQL + 'SELECT day, p AS "ProcessName", st AS "Status", only_prd AS "OnlyPromotionFailed" FROM status')
def health_status(spark, sf_dir):
    """One status per process."""
    return status(spark, sf_dir)


@query(
    LOG_SQL
    + """, n AS (
  SELECT day, (SELECT count(*) FROM roster) AS total, count(*) FILTER (st = 'FAILED') AS f, count(*) FILTER (st = 'FILE_NOT_FOUND') AS k,
    count(*) FILTER (st = 'BLOCKED') AS b, count(*) FILTER (st = 'SUCCESS') AS s,
    (SELECT count(*) FROM roster) - count(*) FILTER (p IN (SELECT p FROM roster)) AS nr
  FROM status GROUP BY 1)
SELECT day, total, f AS n_failed, k AS n_skipped, b AS n_blocked, s AS n_succeeded, nr AS n_not_run,
  f + k + b + nr = 0 AS all_success, f > 0 AS has_failures,
  concat_ws('; ', f || '/' || total || ' failed', k || '/' || total || ' skipped', CASE WHEN b > 0 THEN b || '/' || total || ' blocked' END,
    s || '/' || total || ' succeeded', CASE WHEN nr > 0 THEN nr || '/' || total || ' not run' END) AS headline
FROM n"""
)
def health_summary(spark, sf_dir):
    """Counts against the whole roster, and the headline."""
    return health.summary(status(spark, sf_dir), roster(spark, sf_dir), day="day")


@query(LOG_SQL + 'SELECT day, p AS "ProcessName", config AS "ConfigName", st AS "Status", act AS "Action" FROM plan')
def rerun_plan(spark, sf_dir):
    """What to rerun, and how."""
    return health.rerun_plan(status(spark, sf_dir), roster(spark, sf_dir), day="day")


@query(
    LOG_SQL
    + """SELECT day, act AS "Action", coalesce(string_agg(config, ' ' ORDER BY rank, p), '') AS "Targets",
  string_agg(p, ', ' ORDER BY rank, p) AS "Processes",
  CASE act WHEN 'prd-only' THEN 'failed — prod promotion only' WHEN 'full' THEN 'failed / skipped — full rerun'
    WHEN 'post-run' THEN 'failed / blocked — rerun once the required loaders are SUCCESS' ELSE 'unmatched' END AS "Reason"
FROM plan GROUP BY day, act, CASE WHEN act = 'by hand' THEN p END"""
)
def rerun_groups(spark, sf_dir):
    """One rerun per kind."""
    return health.rerun_groups(health.rerun_plan(status(spark, sf_dir), roster(spark, sf_dir), day="day"), day="day")


@query(
    LOG_SQL
    + """SELECT l.day, CASE st WHEN 'FAILED' THEN 0 WHEN 'FILE_NOT_FOUND' THEN 1 ELSE 2 END AS "ProcessRank", l.p AS "ProcessName",
  CASE c WHEN 'srv1' THEN 0 ELSE 1 END AS "ConnectionRank", CASE t WHEN 'STG' THEN 0 ELSE 1 END AS "TypeRank", s AS "TaskStatus",
  CASE c WHEN 'srv1' THEN 'Main' ELSE 'Backup' END AS "Connection", t AS "TargetTableType", strftime(run, '%Y-%m-%d %H:%M:%S') AS "LastRun",
  CASE WHEN s <> 'SUCCESS' THEN replace(err, '  ', ' ') ELSE '—' END AS "Error"
FROM latest l JOIN status USING (day, p) WHERE st <> 'SUCCESS'"""
)
def issue_rows(spark, sf_dir):
    """Every row of the processes that need attention, in report order."""
    rows = health.issue_rows(latest(spark, sf_dir), status(spark, sf_dir), LABELS, day="day")
    return rows.orderBy("day", *health.report_order())


@query(LOG_SQL + """SELECT day, path AS "LogFilePath", min(event_id) AS "FirstSeen" FROM latest WHERE s = 'FAILED' GROUP BY 1, 2""")
def failed_log_paths(spark, sf_dir):
    """Distinct log paths of failures, first seen first."""
    return health.failed_log_paths(latest(spark, sf_dir), F.col("ProcessID"), day="day").orderBy("day", "FirstSeen")


@query("SELECT c_name AS \"ProcessName\", c_mktsegment AS segment FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def not_run(spark, sf_dir):
    """Roster entries that never ran."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("ProcessName"), F.col("c_mktsegment").alias("segment"))
    users = table(spark, sf_dir, "events").select(F.col("user_id").alias("c_custkey"))
    ran = customers.join(users, "c_custkey", "left_semi")
    return health.not_run(customers.select("ProcessName", "segment"), ran)


@query(
    """
SELECT e.event_id, c_name AS "ProcessName", CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN lower(c_name) END AS "ConfigName"
FROM events e JOIN customer ON user_id = c_custkey
"""
)
def display_names(spark, sf_dir):
    """Names from the roster; on-demand entries are not in it."""
    customers = table(spark, sf_dir, "customer")
    segment = F.col("c_mktsegment")
    listed = customers.select(
        F.col("c_name").alias("ProcessName"),
        F.lower("c_name").alias("ConfigName"),
        F.when(segment == "HOUSEHOLD", F.array(F.lit("daily"), F.lit("on-demand"))).otherwise(F.array(segment)).alias("Tags"),
    )
    ran = table(spark, sf_dir, "events").join(customers, F.col("user_id") == F.col("c_custkey")).select(
        "event_id", F.col("c_name").alias("ProcessName")
    )
    return health.display_names(ran, listed)


GATE_SQL = """,
last AS (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY p, c, t ORDER BY run DESC, dur DESC, event_id DESC) = 1),
need AS (SELECT r_name AS w, srv, n_name AS p, CASE WHEN n_regionkey < 2 THEN 'any' ELSE 'destination' END AS scope
         FROM nation JOIN region ON n_regionkey = r_regionkey, (VALUES ('srv1'), ('srv2')) v(srv)),
req AS (SELECT w, srv, scope, need.p AS p, count(last.p) AS n,
          string_agg(DISTINCT s || ' on ' || c || '/' || t, ', ' ORDER BY s || ' on ' || c || '/' || t) FILTER (s <> 'SUCCESS') AS bad
        FROM need LEFT JOIN last ON need.p = last.p AND (scope = 'any' OR c = srv) GROUP BY 1, 2, 3, 4),
verdict AS (SELECT w, srv, scope, p, CASE WHEN n = 0 THEN p || ': no health row' || CASE WHEN scope = 'any' THEN '' ELSE ' on ' || srv END
                           WHEN bad IS NOT NULL THEN p || ': ' || bad END AS reason FROM req)
"""


def requirement_rows(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    needs = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("Waiting"),
        F.explode(F.array(F.lit("srv1"), F.lit("srv2"))).alias("Server"),
        F.col("n_name").alias("ProcessName"),
        F.when(F.col("n_regionkey") < 2, "any").otherwise("destination").alias("Scope"),
    )
    rows = health.latest_rows(health_log(spark, sf_dir), F.col("ProcessID"))
    return health.requirement_status(rows, needs)


@query(
    LOG_SQL
    + GATE_SQL
    + 'SELECT w AS "Waiting", srv AS "Server", scope AS "Scope", p AS "ProcessName", reason IS NULL AS "Met", reason AS "Reason" FROM verdict'
)
def requirement_status(spark, sf_dir):
    """Every requirement, met or not, and why."""
    return requirement_rows(spark, sf_dir)


@query(
    LOG_SQL
    + GATE_SQL
    + """SELECT w AS "Waiting", srv AS "Server", bool_and(reason IS NULL) AS "Clear", coalesce(string_agg(reason, '; ' ORDER BY reason), '') AS "Unmet"
FROM verdict GROUP BY 1, 2"""
)
def requirement_gate(spark, sf_dir):
    """H2: clear to run, or blocked."""
    return health.gate(requirement_rows(spark, sf_dir)).drop("Reasons")


@query(
    """
SELECT user_id, CASE WHEN count(DISTINCT event_type = 'error') = 1 THEN min(CASE WHEN event_type = 'error' THEN 'sql' ELSE 'python' END)
  ELSE 'mixed' END AS kind
FROM events GROUP BY user_id
"""
)
def step_kinds(spark, sf_dir):
    """The one kind of step, or mixed."""
    kind = F.when(F.col("event_type") == "error", "sql").otherwise("python")
    return table(spark, sf_dir, "events").groupBy("user_id").agg(health.step_kind(kind).alias("kind"))


@query(ORACLES["requirement_gate"])
def requirement_gate_by_load(spark, sf_dir):
    """Requirements on loads, resolved against the roster; names it lacks wait for nothing."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    needs = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("r_name").alias("Waiting"),
        F.explode(F.array(F.lit("srv1"), F.lit("srv2"))).alias("Server"),
        "n_name",
        F.when(F.col("n_regionkey") < 2, "any").otherwise("destination").alias("Scope"),
    )
    needs = needs.select("Waiting", "Server", F.explode(F.array(F.lower("n_name"), F.concat(F.lit("no load "), "n_name"))).alias("LoadName"), "Scope")
    roster = nation.select(F.lower("n_name").alias("ConfigName"), F.col("n_name").alias("ProcessName"))
    resolved, unknown = health.by_load_name(needs, roster)
    if unknown.count() != nation.count():
        raise RuntimeError("every second name is unknown")
    rows = health.latest_rows(health_log(spark, sf_dir), F.col("ProcessID"))
    return health.gate(health.requirement_status(rows, resolved)).drop("Reasons")
