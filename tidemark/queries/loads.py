"""Further whole runs: what a load notices, phases, direct loads, picked files, archives, steps, generated columns."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.archive import write_archive
from tidemark.plans.load import run_load
from tidemark.plans.process import run_process
from tidemark.plans.spec import Destination, LoadSpec, ProcessDestination, ProcessSpec, Promotion, SourceFile, Step, TableRef, mapping_rows
from tidemark.queries.base import ORACLES, query, scratch, table
from tidemark.queries.enrich import order_sides
from tidemark.queries.runs import RUN_AT, part_view
from tidemark.sources.tables import PartitionedTable, Table

STAMP_TEXT, STAMP_FORMAT = "MM/dd/yyyy hh:mm:ss a", "%m/%d/%Y %I:%M:%S %p"


def done(result):
    if result.status != "SUCCESS":
        raise RuntimeError(result.error)
    return result


@query(
    """
WITH m AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS company, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  WHERE r_name = 'ASIA' GROUP BY 1)
SELECT 'SUCCESS' AS "TaskStatus", 'PRD' AS "TargetTableType", (SELECT count(*) FROM orders JOIN customer ON o_custkey = c_custkey) AS "RowCount",
  'Unmapped companies: ' || string_agg(company, ', ' ORDER BY n DESC, company) || ' (' || CAST(sum(n) AS VARCHAR) || ' rows)' AS "Error"
FROM m
"""
)
def load_unmapped(spark, sf_dir):
    """A load that warns of unmapped companies, which its own write has counted."""
    home = scratch(spark, "load_unmapped")
    main, side = order_sides(spark, sf_dir)
    main = main.withColumns({"o_orderkey": F.col("o_orderkey").cast("string"), "ReleasedOn": F.date_format("ReleasedOn", "yyyy-MM-dd")})
    rows = [["o_orderkey", "o_orderkey", "string", "varchar(20)", "source"], ["Company", "Company", "string", "varchar(10)", "source"]]
    rows += [[name, name, "string", "varchar(60)", "computed"] for name in ("Name", "FD5Text", "EXC_FLAG")]
    spec = LoadSpec(
        "purchase", "Purchase Lines", (SourceFile(home, "main"), *(SourceFile(home, name, alias=name) for name in side)),
        (Destination("des1", TableRef(f"{home}/lines", "srv1")),), mapping_rows(rows), key=("o_orderkey",), transforms=("purchase_order_line",),
        transform_options={"system": "CORE", "release_date": "ReleasedOn"}, types={"ReleasedOn": "date"}, date_format="%Y-%m-%d",
    )
    done(run_load(spark, spec, run_at=RUN_AT, frames={"main": main, **side}, health_path=f"{home}/health"))
    return spark.read.parquet(f"{home}/health").select("TaskStatus", "TargetTableType", "RowCount", "Error")


@query('SELECT o_orderkey, o_orderdate AS "update stamp", (SELECT max(o_orderdate) FROM orders) AS "report stamp" FROM orders')
def load_report_stamp(spark, sf_dir):
    """The newest stamp of a text export on each of its rows; the export is parsed once."""
    home = scratch(spark, "load_report_stamp")
    table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("Order"), F.date_format("o_orderdate", STAMP_TEXT).alias("update stamp")
    ).write.option("header", True).csv(f"{home}/export")
    mapping = mapping_rows(
        [
            ["Order", "o_orderkey", "int", "bigint", "source"],
            ["update stamp", "update stamp", "datetime", "datetime", "source"],
            ["report stamp", "report stamp", "datetime", "datetime", "computed"],
        ]
    )
    target = TableRef(f"{home}/location")
    spec = LoadSpec(
        "location", "Location", (SourceFile(f"{home}/export", "*.csv", parts=True),), (Destination("des1", target),), mapping,
        key=("o_orderkey",), transforms=("inventory_location_report_stamp",), datetime_format=STAMP_FORMAT,
    )
    done(run_load(spark, spec, run_at=RUN_AT))
    return Table(spark, target.path).read()


@query("SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, count(*) AS orders, '2026-07-28' AS \"ReportDate\" FROM orders GROUP BY 1")
def load_newest_file(spark, sf_dir):
    """Of two reports the newer one, below its banner; renamed, required and stamped
    columns."""
    home = scratch(spark, "load_newest_file")
    # A report has a row for each day, so one file holds it.
    days = table(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).count()
    lead = spark.createDataFrame([(0, "Orders by day; all companies"), (1, "Day,Orders,Note")], "place int, value string")
    for factor in (2, 1):  # the older report counts twice as much
        rows = days.select(F.lit(2).alias("place"), F.concat_ws(",", "day", F.col("count") * factor, F.lit("x")).alias("value"))
        lead.unionByName(rows).coalesce(1).sortWithinPartitions("place").select("value").write.mode("append").text(f"{home}/reports")
    mapping = mapping_rows(
        [
            ["day", "day", "date", "date", "source"], ["orders", "orders", "int", "bigint", "source"],
            ["ReportDate", "ReportDate", "string", "varchar(10)", "computed"],
        ]
    )
    target = TableRef(f"{home}/days")
    spec = LoadSpec(
        "days", "Days", (SourceFile(f"{home}/reports", "part-*.txt", skip_rows=1),), (Destination("des1", target),), mapping, key=("day",),
        rename={"Day": "day", "Orders": "orders"}, drop=("Note",), transforms=("manufacturer",), destination_columns=("day", "orders", "ReportDate"),
        date_format="%Y-%m-%d",
    )
    done(run_load(spark, spec, run_at=RUN_AT))
    return Table(spark, target.path).read().withColumn("day", F.col("day").cast("string"))


@query(
    """
SELECT 'main' AS kept_in, o_orderkey, o_orderstatus FROM orders
UNION ALL SELECT 'open', o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'before promotion', count(*) FILTER (false), NULL FROM orders
"""
)
def load_phases(spark, sf_dir):
    """Staging in one run, both production tables in a later one."""
    home = scratch(spark, "load_phases")
    place = Destination("des1", TableRef(f"{home}/staging"), TableRef(f"{home}/prod"), aux_prod={"open": TableRef(f"{home}/open")})
    mapping = mapping_rows([["Order", "o_orderkey", "int", "bigint", "source"], ["Status", "o_orderstatus", "string", "varchar(1)", "source"]])
    spec = LoadSpec(
        "order", "Order", (SourceFile(home, "orders"),), (place,), mapping, strategy="truncate_insert", key=("o_orderkey",),
        promotions=(Promotion("open", "filter_active", where=("`o_orderstatus` = 'O'",)),),
    )
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("Order"), F.col("o_orderstatus").alias("Status"))
    done(run_load(spark, spec, run_at=RUN_AT, phase="stg", frames={"main": orders}))
    early = sum(Table(spark, ref.path).count() for ref in (place.prod, place.aux_prod["open"]))
    done(run_load(spark, spec, run_at=RUN_AT + dt.timedelta(hours=1), phase="prd"))
    tables = {"main": place.prod.path, "open": place.aux_prod["open"].path}
    main, further = (Table(spark, path).read().select(F.lit(name).alias("kept_in"), "*") for name, path in tables.items())
    before = spark.createDataFrame([("before promotion", early, None)], "kept_in string, o_orderkey long, o_orderstatus string")
    return main.unionByName(further).unionByName(before)


@query(
    """
SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 0.0 ELSE value END AS value, CAST(CAST(ts AS DATE) AS VARCHAR) AS "ArchiveDate"
FROM events WHERE ts >= TIMESTAMP '2024-01-13' AND ts < TIMESTAMP '2024-01-21'
"""
)
def archive_days(spark, sf_dir):
    """Two runs of the archive writer; the second replaces the days of its window and leaves the others."""
    path = scratch(spark, "archive_days")
    events = table(spark, sf_dir, "events").select("event_id", "value", "ts")
    write_archive(events.withColumn("value", F.lit(0.0)), "ts", path, dt.date(2024, 1, 18), 5)
    write_archive(events, "ts", path, dt.date(2024, 1, 20), 5)
    rows = PartitionedTable(spark, path, ["ArchiveDate"]).read()
    return rows.select("event_id", "value", F.col("ArchiveDate").cast("string").alias("ArchiveDate"))


@query(
    f"""
WITH t AS ({ORACLES["search_terms"]}), n AS (SELECT count(*) AS n FROM t)
SELECT "Item" AS "ITEM", "RefsSearch" AS "Refs", "ItemsSearch" AS "Items", "Date" AS "Day", n + 1 AS first_id, 2 * n AS last_id, n AS ids FROM t, n
"""
)
def search_terms_twice(spark, sf_dir):
    """Two rebuilds of a table with a generated column; terms go in by position, numbers go on."""
    home = scratch(spark, "search_terms_twice")
    part_view(spark, sf_dir).write.parquet(f"{home}/view")
    target = Table(spark, f"{home}/terms")
    target.overwrite(spark.createDataFrame([], "ITEM string, ID long, Refs string, Items string, Day int"))
    options = {"source_view": f"{home}/view", "target_table": target.path, "order": "p_partkey", "identity": ["ID"]}
    step = Step("search_terms", python="tidemark.plans.steps.build_search_terms", target="SearchTerms", options=options)
    spec = ProcessSpec("terms", "Search Terms", (ProcessDestination("des1", "srv1", "Parts", (step,)),))
    for hour in range(2):
        done(run_process(spark, spec, run_at=RUN_AT + dt.timedelta(hours=hour)))
    rows = target.read()
    first, last, ids = (rows.agg(measure).scalar() for measure in (F.min("ID"), F.max("ID"), F.count_distinct("ID")))
    return rows.select("ITEM", "Refs", "Items", "Day", first.alias("first_id"), last.alias("last_id"), ids.alias("ids"))


def keep_segment(context) -> int:
    """A step: keep the customers of a market segment; returns their number."""
    options = context.options
    customers = context.spark.read.parquet(options["source"]).where(F.col("c_mktsegment") == options["segment"])
    return Table(context.spark, options["target"]).overwrite(customers)


@query(
    """
WITH c AS (SELECT count(*) FILTER (c_mktsegment = 'BUILDING') AS b, count(*) FILTER (c_mktsegment = 'MACHINERY') AS m FROM customer)
SELECT 'des1' AS destination, 1 AS place, 'total' AS step, 'sql' AS kind, 'SUCCESS' AS status, NULL AS row_count, 'FAILED' AS verdict, b AS verdict_rows FROM c
UNION ALL SELECT 'des1', 2, 'keep', 'python', 'SUCCESS', b, 'FAILED', b FROM c
UNION ALL SELECT 'des1', 3, 'refuse', 'sql', 'FAILED', NULL, 'FAILED', b FROM c
UNION ALL SELECT 'des1', 4, 'keep more', 'python', 'NOT RUN', NULL, 'FAILED', b FROM c
UNION ALL SELECT 'des2', 1, 'total', 'sql', 'SUCCESS', NULL, 'SUCCESS', b + m FROM c
UNION ALL SELECT 'des2', 2, 'keep', 'python', 'SUCCESS', b, 'SUCCESS', b + m FROM c
UNION ALL SELECT 'des2', 3, 'refuse', 'sql', 'SUCCESS', NULL, 'SUCCESS', b + m FROM c
UNION ALL SELECT 'des2', 4, 'keep more', 'python', 'SUCCESS', m, 'SUCCESS', b + m FROM c
"""
)
def process_steps(spark, sf_dir):
    """H3, H4: SQL steps with parameters and Python steps in order; on one destination a row of the table makes
    the third fail, and the fourth is not run."""
    home, source = scratch(spark, "process_steps"), sf_dir.rstrip("/")

    def keep(name: str, place: str, segment: str) -> Step:
        options = {"source": f"{source}/customer.parquet", "segment": segment, "target": f"{home}/{place}/{segment}"}
        return Step(name, python=keep_segment, options=options)

    def steps(place: str, status: str) -> tuple[Step, ...]:
        total = f"SELECT sum(o_totalprice) FROM parquet.`{source}/orders.parquet` WHERE o_totalprice > :least"
        refuse = f"SELECT raise_error('refused order ' || o_orderkey) FROM parquet.`{source}/orders.parquet` WHERE o_orderstatus = :status"
        return (
            Step("total", sql=total, params={"least": 1000.0}), keep("keep", place, "BUILDING"),
            Step("refuse", sql=refuse, params={"status": status}), keep("keep more", place, "MACHINERY"),
        )

    places = tuple(ProcessDestination(name, f"srv-{name}", "Parts", steps(name, status)) for name, status in (("des1", "F"), ("des2", "none")))
    result = run_process(spark, ProcessSpec("steps", "Steps", places), run_at=RUN_AT)
    rows = [
        (outcome.destination.name, place, row.step.name, row.step.kind, row.status, row.row_count, outcome.status, outcome.row_count)
        for outcome in result.outcomes
        for place, row in enumerate(outcome.steps, 1)
    ]
    return spark.createDataFrame(
        rows, "destination string, place int, step string, kind string, status string, row_count long, verdict string, verdict_rows long"
    )
