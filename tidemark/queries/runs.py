"""Whole runs: an export loaded into two destinations, and a gated process after it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.transforms import Run
from tidemark.plans.load import StepResult, health_frame, run_load
from tidemark.plans.process import run_process
from tidemark.plans.spec import (
    AuxStaging,
    Destination,
    GuardedMerge,
    Lifecycle,
    LoadSpec,
    OverlapCheck,
    ProcessDestination,
    ProcessSpec,
    Requirement,
    SourceFile,
    Step,
    TableRef,
    mapping_rows,
)
from tidemark.queries.base import ORACLES, query, scratch, table
from tidemark.queries.ingest import DEDUP_SQL, LINE_KEY, first_lines
from tidemark.queries.promotion import ERROR_KEY, ERRORS_SQL, open_errors, stamp
from tidemark.sources.files import list_files
from tidemark.sources.tables import BucketedTable, Table, append_rows

RUN_AT = dt.datetime(2026, 7, 28, 6, 30)

COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate", "flags")

# Lines export: text headers to typed columns.
MAPPING = mapping_rows(
    [
        ["Order", "l_orderkey", "int", "bigint", "source"],
        ["Order.Line", "l_linenumber", "int", "int", "source"],
        ["Part", "l_partkey", "int", "bigint", "source"],
        ["Supplier", "l_suppkey", "int", "bigint", "source"],
        ["Quantity", "l_quantity", "float", "float", "source"],
        ["Extended Price", "l_extendedprice", "float", "float", "source"],
        ["Discount", "l_discount", "float", "float", "source"],
        ["update stamp", "l_shipdate", "datetime", "datetime", "source"],
        ["Flags", "flags", "string", "varchar(10)", "source"],
    ]
)

LOAD_SQL = f"""
WITH x AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_shipdate,
         l_returnflag || l_linestatus AS flags
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
stg AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, flags) AS rn FROM x) WHERE rn = 1),
d AS ({DEDUP_SQL}),
prod AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_shipdate, 'old' AS flags
         FROM d WHERE l_shipdate < TIMESTAMP '2000-01-01')
"""


# Input bytes a bucket of lines.
BUCKET_BYTES = 32 << 20


def lines_by_order(spark, sf_dir, path: str):
    """All lines, stored once in buckets of the order: neither finding an order's lines nor de-duplicating them moves
    them again. Buckets grow in number with the files, not in size."""
    size = list_files(spark, f"{sf_dir.rstrip('/')}/lineitem.parquet").agg(F.sum("length")).first()[0]
    kept = BucketedTable(spark, path, ["l_orderkey"], max(spark.sparkContext.defaultParallelism, size // BUCKET_BYTES))
    kept.overwrite(table(spark, sf_dir, "lineitem"))
    return kept.read()


def lines_export(spark, sf_dir, lines, path: str) -> None:
    """The lines of orders placed from 1998 on, as a text export with duplicates."""
    window = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= stamp("1998-01-01"))
    lines = lines.join(window, F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    lines.select(
        F.col("l_orderkey").alias("Order"),
        F.col("l_linenumber").alias("Order.Line"),
        F.col("l_partkey").alias("Part"),
        F.col("l_suppkey").alias("Supplier"),
        F.col("l_quantity").cast("string").alias("Quantity"),
        F.col("l_extendedprice").cast("string").alias("Extended Price"),
        F.col("l_discount").cast("string").alias("Discount"),
        F.date_format("l_shipdate", "MM/dd/yyyy hh:mm:ss a").alias("update stamp"),
        F.concat(F.lit(" "), "l_returnflag", "l_linestatus", F.lit(" ")).alias("Flags"),
    ).write.option("header", True).csv(path)


def line_load(home: str) -> LoadSpec:
    def place(name: str) -> Destination:
        return Destination(
            name,
            TableRef(f"{home}/{name}/staging", f"srv-{name}", "Lines", "dbo", "line_stg"),
            TableRef(f"{home}/{name}/prod", f"srv-{name}", "Lines", "dbo", "LINE"),
        )

    ties = ("Part", "Supplier", "Quantity", "Extended Price", "Discount", "Flags")
    order = [{"column": "update stamp", "direction": "desc"}, *({"column": name} for name in ties)]
    return LoadSpec(
        "line",
        "Order Line",
        (SourceFile(f"{home}/export", "*.csv", parts=True),),
        (place("des1"), place("des2")),
        MAPPING,
        strategy="pk_delete_insert_on_header",
        key=tuple(LINE_KEY),
        header_key=("l_orderkey",),
        transforms=("dedup_keep_first",),
        transform_options={"dedup": {"keys": ["Order", "Order.Line"], "order_by": order}},
        datetime_format="%m/%d/%Y %I:%M:%S %p",
        overlap=OverlapCheck("update stamp", "l_shipdate"),
    )


def loaded(spark, sf_dir, name: str) -> tuple[str, LoadSpec]:
    """Run the load over a new folder whose production tables hold the lines shipped before 2000."""
    home = scratch(spark, name)
    spec = line_load(home)
    lines = lines_by_order(spark, sf_dir, f"{home}/lines")
    lines_export(spark, sf_dir, lines, f"{home}/export")
    history = first_lines(lines).where(F.col("l_shipdate") < stamp("2000-01-01"))
    history = history.withColumn("flags", F.lit("old")).select(*COLUMNS)
    # De-duplicated for the first destination; the others get what that one holds.
    for destination in spec.destinations:
        prod = Table(spark, destination.prod.path)
        prod.overwrite(history)
        history = prod.read()
    result = run_load(spark, spec, run_at=RUN_AT, health_path=f"{home}/health")
    if result.status != "SUCCESS":
        raise RuntimeError(result.error)
    return home, spec


@query(
    LOAD_SQL
    + f"SELECT {', '.join(COLUMNS)} FROM prod WHERE l_orderkey NOT IN (SELECT l_orderkey FROM stg) UNION ALL SELECT {', '.join(COLUMNS)} FROM stg"
)
def load_lines(spark, sf_dir):
    """Files to production, second destination."""
    _, spec = loaded(spark, sf_dir, "load_lines")
    return Table(spark, spec.destinations[1].prod.path).read()


@query(
    LOAD_SQL
    + """
SELECT 'Order Line' AS "ProcessName", 'SUCCESS' AS "TaskStatus", '[Lines].[dbo].[line_stg]' AS "TargetTableName", 'Not Applicable' AS "STGTableName",
  'STG' AS "TargetTableType", 'truncate_insert' AS "ProcessType", (SELECT count(*) FROM stg) AS "RowCount", 'srv-' || d AS "DBConnection"
FROM (VALUES ('des1'), ('des2')) v(d)
UNION ALL
SELECT 'Order Line', 'SUCCESS', '[Lines].[dbo].[LINE]', '[Lines].[dbo].[line_stg]', 'PRD', 'pk_delete_insert_on_header', (SELECT count(*) FROM stg), 'srv-' || d
FROM (VALUES ('des1'), ('des2')) v(d)
"""
)
def load_health(spark, sf_dir):
    """The health rows that load wrote."""
    home, _ = loaded(spark, sf_dir, "load_health")
    return spark.read.parquet(f"{home}/health").select(
        "ProcessName", "TaskStatus", "TargetTableName", "STGTableName", "TargetTableType", "ProcessType", "RowCount", "DBConnection"
    )


ORDER_KEY = ("o_orderkey",)

FEED_SQL = """
WITH feed AS (SELECT l_orderkey, min(l_linestatus) AS status, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_custkey, CASE WHEN shipped > o_orderdate THEN status ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN shipped > o_orderdate THEN shipped ELSE o_orderdate END AS changed
FROM orders LEFT JOIN feed ON o_orderkey = l_orderkey
"""


@query(FEED_SQL)
def load_side_feed(spark, sf_dir):
    """Orders merged into production by key, then two columns from a second
    export that landed in its own staging table."""
    home = scratch(spark, "load_side_feed")
    text = "MM/dd/yyyy hh:mm:ss a"
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("Order"),
        F.col("o_custkey").cast("string").alias("Customer"),
        F.col("o_orderstatus").alias("Status"),
        F.date_format("o_orderdate", text).alias("Order.Date"),
    )
    shipped = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("Order")).agg(
        F.min("l_linestatus").alias("Status"), F.date_format(F.max("l_shipdate"), text).alias("Shipped")
    )
    main = mapping_rows(
        [
            ["Order", "o_orderkey", "int", "bigint", "source"],
            ["Customer", "o_custkey", "int", "bigint", "source"],
            ["Status", "o_orderstatus", "string", "varchar(1)", "source"],
            ["Order.Date", "changed", "datetime", "datetime", "source"],
        ]
    )
    feed = mapping_rows(
        [
            ["Order", "o_orderkey", "int", "bigint", "source"],
            ["Status", "o_orderstatus", "string", "varchar(1)", "source"],
            ["Shipped", "changed", "datetime", "datetime", "source"],
        ]
    )
    stamps = "%m/%d/%Y %I:%M:%S %p"
    place = Destination(
        "des1", TableRef(f"{home}/staging"), TableRef(f"{home}/prod"), aux_staging={"shipped": TableRef(f"{home}/shipped")}
    )
    spec = LoadSpec(
        "order", "Order", (SourceFile(home, "orders"), SourceFile(home, "shipped", alias="shipped")), (place,), main,
        strategy="pk_merge", key=ORDER_KEY, datetime_format=stamps,
        aux=(AuxStaging("shipped", "shipped", feed, ORDER_KEY, datetime_format=stamps),),
        guarded=GuardedMerge("shipped", ORDER_KEY, ("o_orderstatus", "changed"), "s.`changed` > p.`changed`"),
    )
    result = run_load(spark, spec, run_at=RUN_AT, frames={"main": orders, "shipped": shipped})
    if result.status != "SUCCESS":
        raise RuntimeError(result.error)
    return Table(spark, place.prod.path).read()


@query(
    ERRORS_SQL
    + """
SELECT "ErrorStatus", "ErrorMessageNumber", count(*) AS "ErrorCount", '2024-01-31' AS "ReportDate" FROM merged GROUP BY 1, 2
UNION ALL SELECT 'New', "ErrorMessageNumber", count(*), '2024-01-16' FROM prod GROUP BY 2
"""
)
def load_lifecycle(spark, sf_dir):
    """Two days of an error export; the second production table counts each day."""
    home = scratch(spark, "load_lifecycle")
    stat = TableRef(f"{home}/stat")
    place = Destination("des1", TableRef(f"{home}/staging"), TableRef(f"{home}/prod"), aux_prod={"stat": stat})
    spec = LoadSpec(
        "error", "Error", (SourceFile(home, "errors"),), (place,),
        mapping_rows(
            [
                ["Contract", "Contract", "int", "bigint", "source"],
                ["ContractLine", "ContractLine", "string", "varchar(20)", "source"],
                ["ErrorMessageNumber", "ErrorMessageNumber", "int", "int", "source"],
                ["worst", "worst", "float", "float", "source"],
            ]
        ),
        strategy="pk_merge", key=tuple(ERROR_KEY), lifecycle=Lifecycle(tuple(ERROR_KEY), stat_table="stat"),
    )
    for late, day in ((False, dt.datetime(2024, 1, 16, 6)), (True, dt.datetime(2024, 1, 31, 6))):
        errors = open_errors(spark, sf_dir, late)
        export = errors.select(*(F.col(name).cast("string").alias(name) for name in errors.columns))
        result = run_load(spark, spec, run_at=day, frames={"main": export})
        if result.status != "SUCCESS":
            raise RuntimeError(result.error)
    return Table(spark, stat.path).read().withColumn("ReportDate", F.col("ReportDate").cast("string"))


def part_view(spark, sf_dir):
    """Parts as the view that search terms are built from."""
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") > 15, F.col("p_brand")).alias("Item Group"),
        F.concat_ws(" ", "p_type", F.col("p_size").cast("string")).alias("Item"),
        F.col("p_name").alias("RefSearch"),
        F.concat_ws(" ", "p_name", "p_brand").alias("ItemSearch"),
        F.col("p_size").alias("Date"),
        "p_partkey",
    )


@query(ORACLES["search_terms"])
def search_terms_process(spark, sf_dir):
    """H2, H3, A5: a gated process rebuilds the search terms from a stored view."""
    home = scratch(spark, "search_terms_process")
    part_view(spark, sf_dir).write.parquet(f"{home}/view")
    parts = TableRef(f"{home}/view", "srv1", "Parts", "dbo", "PART")
    upstream = LoadSpec("part", "Part", (SourceFile("", "*"),), (Destination("des1", parts),))
    ran = health_frame(spark, upstream, [StepResult(parts, parts, "SUCCESS", "PRD")], process_id="1", run=Run(RUN_AT))
    append_rows(ran, f"{home}/health", ["RunDate"])
    options = {"source_view": f"{home}/view", "target_table": f"{home}/terms", "order": "p_partkey"}
    step = Step("search_terms", python="tidemark.plans.steps.build_search_terms", target="SearchTerms", options=options)
    place = ProcessDestination("des1", "srv1", "Parts", (step,), schema="Search")
    spec = ProcessSpec("terms", "Search Terms", (place,), Requirement(loads=("Part",)))
    result = run_process(spark, spec, run_at=RUN_AT, health_path=f"{home}/health")
    if result.status != "SUCCESS":
        raise RuntimeError(result.error)
    return Table(spark, f"{home}/terms").read()
