"""Queries over the health log: latest outcomes, roll-ups, gates, reports and rerun plans.

``day`` arguments name an extra key column: give it to run over many report days at once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.functions.health_text import (
    BLOCKED,
    FAILED,
    FILE_NOT_FOUND,
    STATUS_ORDER,
    SUCCESS,
    connection_label,
    last_run_text,
)
from tidemark.functions.text import one_line

# The log's columns, in table order.
HEALTH_SCHEMA = (
    "ProcessName string, ProcessID string, SourceFilePath string, LastRunTime timestamp_ntz, TargetTableName string, "
    "TaskStatus string, RowCount long, PackagePath string, LogFilePath string, STGTableName string, "
    "ProcessFrequency string, Error string, Duration int, DBConnection string, ProcessType string, "
    "TargetTableType string"
)
HEALTH_COLUMNS = tuple(part.split()[0] for part in HEALTH_SCHEMA.split(", "))
# Folder column of the log, so that one day's rows are found without reading the others.
RUN_DATE = "RunDate"


def _text(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


def _name(name: str = "ProcessName") -> Column:
    return _text(name).alias(name)


def _keys(day: str | None) -> list[Column]:
    return [col(day)] if day else []


def rows_of_day(health: DataFrame, day: dt.date, names: Sequence[str] = ()) -> DataFrame:
    """One day's rows, of the named processes when any are named.

    The day is a range on the stored stamp, which the scan can use; it is also matched on the
    folder column where the log has one.
    """
    start = F.lit(day).cast("timestamp_ntz")
    stop = F.lit(day + dt.timedelta(days=1)).cast("timestamp_ntz")
    rows = health.where((F.col("LastRunTime") >= start) & (F.col("LastRunTime") < stop))
    if RUN_DATE in health.columns:
        rows = rows.where(F.col(RUN_DATE) == F.lit(day))
    return rows.where(F.col("ProcessName").isin(*names)) if names else rows


def latest_rows(health: DataFrame, order: Column, day: str | None = None) -> DataFrame:
    """The last row per process, connection and table type: newest run, then longest, then the
    one written later (``order``)."""
    keys = [_text(name) for name in ("ProcessName", "DBConnection", "TargetTableType")]
    recency = [
        F.coalesce(F.col("LastRunTime"), F.lit("0001-01-01").cast("timestamp_ntz")).desc(),
        F.coalesce(F.col("Duration"), F.lit(0)).desc(),
        order.desc(),
    ]
    place = F.row_number().over(Window.partitionBy(*_keys(day), *keys).orderBy(*recency))
    return health.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def roll_up(statuses: Column) -> Column:
    """One status for a group of rows: any failure wins; a skip or block wins only when there is
    nothing else; otherwise success. An aggregate expression."""
    status = F.coalesce(statuses, F.lit(""))
    return (
        F.when(F.bool_or(status == FAILED), FAILED)
        .when(F.bool_and(status.isin(BLOCKED, FILE_NOT_FOUND)), F.when(F.bool_or(status == BLOCKED), BLOCKED).otherwise(FILE_NOT_FOUND))
        .otherwise(SUCCESS)
    )


def process_status(latest: DataFrame, day: str | None = None) -> DataFrame:
    """Status per process, and whether all its failed rows are production rows."""
    failed = F.col("TaskStatus") == FAILED
    promoted = F.upper(_text("TargetTableType")) == "PRD"
    return latest.groupBy(*_keys(day), _name()).agg(
        roll_up(F.col("TaskStatus")).alias("Status"),
        F.coalesce(F.bool_and(F.when(failed, promoted)), F.lit(False)).alias("OnlyPromotionFailed"),
    )


def not_run(roster: DataFrame, status: DataFrame) -> DataFrame:
    """Roster processes without a row."""
    return roster.join(status.select("ProcessName").distinct(), "ProcessName", "left_anti")


# Fixed value: the tag of processes that are not part of the daily roster.
ON_DEMAND = "on-demand"


def daily_only(roster: DataFrame) -> DataFrame:
    """The roster without on-demand entries."""
    if "Tags" not in roster.columns:
        return roster
    return roster.where(~F.array_contains(F.coalesce(F.col("Tags"), F.array().cast("array<string>")), ON_DEMAND))


def display_names(names: DataFrame, roster: DataFrame) -> DataFrame:
    """Config names joined to process names; on-demand entries are not in the daily roster."""
    return names.join(daily_only(roster).select("ProcessName", "ConfigName"), "ProcessName", "left")


def summary(status: DataFrame, roster: DataFrame, day: str | None = None) -> DataFrame:
    """Counts per status and the headline, one row (per day).

    The denominator is the whole roster, ran or not; without a roster it is what ran.
    """
    names = roster.select("ProcessName").distinct().withColumn("_listed", F.lit(True))
    marked = status.join(names, "ProcessName", "left")
    counts = marked.groupBy(*_keys(day)).agg(
        *(F.count_if(F.col("Status") == name).alias(f"n_{label}") for name, label in _LABELS),
        F.count(F.lit(1)).alias("n_attempted"),
        F.count("_listed").alias("_ran"),
    )
    roster_size = roster.agg(F.count_distinct("ProcessName")).scalar()
    counts = counts.withColumn("_roster", roster_size)
    counts = counts.withColumn("total", F.when(F.col("_roster") > 0, F.col("_roster")).otherwise(F.col("n_attempted")))
    counts = counts.withColumn("n_not_run", F.col("_roster") - F.col("_ran"))

    def part(name: str, text: str, always: bool) -> Column:
        said = F.concat(col(name), F.lit("/"), F.col("total"), F.lit(f" {text}"))
        return said if always else F.when(col(name) > 0, said)

    headline = F.concat_ws(
        "; ",
        part("n_failed", "failed", True),
        part("n_skipped", "skipped", True),
        part("n_blocked", "blocked", False),
        part("n_succeeded", "succeeded", True),
        part("n_not_run", "not run", False),
    )
    clean = (F.col("n_failed") + F.col("n_skipped") + F.col("n_blocked") + F.col("n_not_run")) == 0
    return counts.select(
        *_keys(day),
        "total",
        *(f"n_{label}" for _, label in _LABELS),
        "n_not_run",
        clean.alias("all_success"),
        (F.col("n_failed") > 0).alias("has_failures"),
        headline.alias("headline"),
    )


# A status and the word a report uses for it.
_LABELS = ((FAILED, "failed"), (FILE_NOT_FOUND, "skipped"), (BLOCKED, "blocked"), (SUCCESS, "succeeded"))


def status_rank(status: Column) -> Column:
    rank = F.when(status == STATUS_ORDER[0], 0)
    for place, name in enumerate(STATUS_ORDER[1:], start=1):
        rank = rank.when(status == name, place)
    return rank.otherwise(99)


def rerun_plan(status: DataFrame, roster: DataFrame, day: str | None = None) -> DataFrame:
    """What to rerun for each failed, skipped or blocked process.

    ``prd-only`` when only promotions failed, ``full`` when a read or staging failed or a file
    was missing, ``post-run`` for post-load processes, ``by hand`` when no config has the name.
    Roster columns: ProcessName, ConfigName, IsPostProcess.
    """
    broken = status.where(F.col("Status") != SUCCESS)
    joined = broken.join(roster.select("ProcessName", "ConfigName", "IsPostProcess"), "ProcessName", "left")
    action = (
        F.when(F.col("ConfigName").isNull(), "by hand")
        .when(F.col("IsPostProcess"), "post-run")
        .when((F.col("Status") == FAILED) & F.col("OnlyPromotionFailed"), "prd-only")
        .otherwise("full")
    )
    return joined.select(*_keys(day), "ProcessName", "ConfigName", "Status", action.alias("Action"))


# Why a group of processes is rerun.
_REASONS = {
    "prd-only": "failed — prod promotion only",
    "full": "failed / skipped — full rerun",
    "post-run": "failed / blocked — rerun once the required loaders are SUCCESS",
    "by hand": "unmatched",
}


def rerun_groups(plan: DataFrame, day: str | None = None) -> DataFrame:
    """One row per action with the config names to pass and the processes they stand for:
    failed first, then skipped, then blocked, each by name. Sizes are bounded by the roster."""
    entry = F.struct(status_rank(F.col("Status")).alias("rank"), F.col("ProcessName"), F.col("ConfigName"))
    # A process no config knows gets a row of its own.
    alone = F.when(F.col("Action") == "by hand", F.col("ProcessName")).otherwise("")
    grouped = plan.groupBy(*_keys(day), "Action", alone.alias("_alone")).agg(
        F.array_sort(F.collect_list(entry)).alias("_entries")
    )
    reason = F.create_map(*[F.lit(text) for pair in _REASONS.items() for text in pair])[F.col("Action")]
    return grouped.select(
        *_keys(day),
        "Action",
        F.array_join(F.transform("_entries", lambda e: e["ConfigName"]), " ").alias("Targets"),
        F.array_join(F.transform("_entries", lambda e: e["ProcessName"]), ", ").alias("Processes"),
        reason.alias("Reason"),
    )


def issue_rows(
    latest: DataFrame, status: DataFrame, labels: Mapping[str, str], day: str | None = None
) -> DataFrame:
    """Every row of each process that has an issue, ranked as the report lists them: worst
    process first, then name, connection in configured order, staging before production."""
    broken = status.where(F.col("Status") != SUCCESS).select(*_keys(day), "ProcessName", "Status")
    keys = [*([day] if day else []), "ProcessName"]
    rows = latest.withColumn("ProcessName", _text("ProcessName")).join(broken, keys, "inner")
    server = _text("DBConnection")
    connection_rank = F.lit(len(labels))
    for place, name in reversed(list(enumerate(labels))):
        connection_rank = F.when(server == name, place).otherwise(connection_rank)
    error = F.when((F.col("TaskStatus") != SUCCESS) & (F.col("Error") != ""), one_line(F.col("Error")))
    return rows.select(
        *_keys(day),
        status_rank(F.col("Status")).alias("ProcessRank"),
        "ProcessName",
        connection_rank.alias("ConnectionRank"),
        F.when(F.upper(_text("TargetTableType")) == "STG", 0).otherwise(1).alias("TypeRank"),
        "TaskStatus",
        connection_label(F.col("DBConnection"), labels).alias("Connection"),
        "TargetTableType",
        last_run_text(F.col("LastRunTime")).alias("LastRun"),
        F.coalesce(error, F.lit("—")).alias("Error"),
    )


def report_order() -> list[str]:
    return ["ProcessRank", "ProcessName", "ConnectionRank", "TypeRank"]


def failed_log_paths(latest: DataFrame, order: Column, day: str | None = None) -> DataFrame:
    """Distinct log paths of failed rows with the place each first appears at."""
    failed = latest.where((F.col("TaskStatus") == FAILED) & (F.col("LogFilePath") != ""))
    return failed.groupBy(*_keys(day), "LogFilePath").agg(F.min(order).alias("FirstSeen"))


def by_load_name(requirements: DataFrame, roster: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Requirements on loads (``LoadName``) as requirements on the processes that the roster (ConfigName,
    ProcessName) says they log as, and the names that no entry bears."""
    names = roster.select("ConfigName", "ProcessName").distinct()
    known = requirements.join(names, requirements["LoadName"] == names["ConfigName"])
    resolved = known.select(*(requirements[name] for name in requirements.columns if name != "ProcessName"), names["ProcessName"])
    unknown = requirements.join(names, requirements["LoadName"] == names["ConfigName"], "left_anti").select("LoadName").distinct()
    return resolved, unknown


def requirement_status(latest: DataFrame, requirements: DataFrame, day: str | None = None, on_day: dt.date | None = None) -> DataFrame:
    """Each requirement with whether it is met and, if not, why. ``on_day`` is named where no row is found.

    ``requirements`` has one row per waiting process, destination server and required process:
    Waiting, Server, ProcessName, Scope (and the day). Only rows of the server count unless the
    scope is ``any``.
    """
    days = [day] if day else []
    rows = latest.select(*days, "ProcessName", "DBConnection", "TargetTableType", "TaskStatus")
    on = (col("ProcessName", "q") == col("ProcessName", "h")) & (
        (F.col("q.Scope") == "any") | (_side("h", "DBConnection") == F.col("q.Server"))
    )
    for name in days:
        on = on & (col(name, "q") == col(name, "h"))
    joined = requirements.alias("q").join(rows.alias("h"), on, "left")
    bad = F.col("h.ProcessName").isNotNull() & (_side("h", "TaskStatus") != SUCCESS)
    detail = F.concat(_side("h", "TaskStatus"), F.lit(" on "), _side("h", "DBConnection"), F.lit("/"), _side("h", "TargetTableType"))
    by = [*(f"q.{name}" for name in days), "q.Waiting", "q.Server", "q.Scope", "q.ProcessName"]
    grouped = joined.groupBy(*by).agg(
        F.count("h.ProcessName").alias("_rows"),
        # One row per connection and table type is left, so this list is short.
        F.array_join(F.array_sort(F.collect_set(F.when(bad, detail))), ", ").alias("_bad"),
    )
    scope = F.when(F.col("Scope") == "any", "").otherwise(F.concat(F.lit(" on "), F.col("Server")))
    reason = (
        F.when(F.col("_rows") == 0, F.concat(F.col("ProcessName"), F.lit(f": no health row for {on_day.isoformat()}" if on_day else ": no health row"), scope))
        .when(F.col("_bad") != "", F.concat(F.col("ProcessName"), F.lit(": "), F.col("_bad")))
    )
    return grouped.select(
        *days, "Waiting", "Server", "Scope", "ProcessName", reason.isNull().alias("Met"), reason.alias("Reason")
    )


def gate(status: DataFrame, day: str | None = None) -> DataFrame:
    """Per waiting process and server: clear to run, or blocked and by what (as text and as a list)."""
    return status.groupBy(*_keys(day), "Waiting", "Server").agg(
        F.bool_and("Met").alias("Clear"),
        F.array_join(F.array_sort(F.collect_list("Reason")), "; ").alias("Unmet"),
        F.array_sort(F.collect_list("Reason")).alias("Reasons"),
    )


def _side(side: str, name: str) -> Column:
    return F.coalesce(col(name, side), F.lit(""))


def step_kind(kind: Column) -> Column:
    """The one kind of step a process has, or ``mixed``. An aggregate expression."""
    return F.when(F.min(kind) == F.max(kind), F.min(kind)).otherwise("mixed")
