"""Promotion strategies and table writes.

Production holds the lines shipped before 2000. Staging is an export of the orders placed from
1998 on: quantities have changed, open lines carry a later stamp, returned lines are gone.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators import promote
from tidemark.operators.archive import rearchive
from tidemark.operators.backfill import copy_prod_table, fit_to_target
from tidemark.operators.guards import check_keys
from tidemark.queries.base import ORACLES, query, scratch, table
from tidemark.queries.ingest import DEDUP_SQL, LINE_KEY, deduped_lines
from tidemark.plans.spec import Destination, LoadSpec, SourceFile, TableRef
from tidemark.sources.tables import BucketedTable, PartitionedTable, Table, kept, open_table

LINE_COLUMNS = (
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)

SETUP = f"""
WITH d AS ({DEDUP_SQL}),
prod AS (SELECT {LINE_COLUMNS} FROM d WHERE l_shipdate < TIMESTAMP '2000-01-01'),
stg AS (
  SELECT d.* REPLACE (l_quantity + 1 AS l_quantity,
                      CASE WHEN l_linestatus = 'O' THEN l_shipdate + INTERVAL 1 DAY ELSE l_shipdate END AS l_shipdate)
  FROM d JOIN orders ON l_orderkey = o_orderkey
  WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND l_returnflag <> 'R')
"""


def stamp(text: str):
    return F.lit(text).cast("timestamp_ntz")


def marked_lines(spark, sf_dir):
    """De-duplicated lines, marked where their order was placed from 1998 on."""
    lines = deduped_lines(spark, sf_dir)
    window = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= stamp("1998-01-01"))
    window = window.select(F.col("o_orderkey").alias("l_orderkey")).distinct().withColumn("_late", F.lit(True))
    return lines.join(window, "l_orderkey", "left").select(*lines.columns, "_late")


def line_sides(spark, sf_dir):
    """Production and staging, both of the same lines, which are found and stored once."""
    lines = kept(marked_lines(spark, sf_dir), "lines")
    return prod_lines(lines), staged_lines(lines)


def prod_lines(lines):
    return lines.where(F.col("l_shipdate") < stamp("2000-01-01")).drop("_late")


def staged_lines(lines):
    later = F.col("l_shipdate") + F.expr("INTERVAL 1 DAY")
    return (
        lines.where(F.col("_late") & (F.col("l_returnflag") != "R"))
        .drop("_late")
        .withColumns(
            {
                "l_quantity": F.col("l_quantity") + 1,
                "l_shipdate": F.when(F.col("l_linestatus") == "O", later).otherwise(F.col("l_shipdate")),
            }
        )
    )


@query(SETUP + f"SELECT {LINE_COLUMNS} FROM stg")
def promote_truncate_insert(spark, sf_dir):
    """K4: production becomes staging."""
    lines = marked_lines(spark, sf_dir)
    return promote.promote(prod_lines(lines), staged_lines(lines), "truncate_insert")


@query(
    SETUP
    + f"""
SELECT {LINE_COLUMNS}, 'history' AS loaded_by FROM prod p
WHERE NOT EXISTS (SELECT 1 FROM stg s WHERE s.l_orderkey = p.l_orderkey AND s.l_linenumber = p.l_linenumber)
UNION ALL
SELECT {', '.join('s.' + c.strip() for c in LINE_COLUMNS.split(','))}, CASE WHEN p.l_orderkey IS NOT NULL THEN 'history' END
FROM stg s LEFT JOIN prod p ON s.l_orderkey = p.l_orderkey AND s.l_linenumber = p.l_linenumber
"""
)
def promote_pk_merge(spark, sf_dir):
    """K5: upsert; a column staging lacks keeps its value on matched rows."""
    prod, staged = line_sides(spark, sf_dir)
    return promote.promote(prod.withColumn("loaded_by", F.lit("history")), staged, "pk_merge", keys=LINE_KEY)


@query(
    SETUP
    + f"""
SELECT {LINE_COLUMNS} FROM prod p
WHERE NOT EXISTS (SELECT 1 FROM stg s WHERE s.l_orderkey = p.l_orderkey AND s.l_linenumber = p.l_linenumber)
UNION ALL SELECT {LINE_COLUMNS} FROM stg
"""
)
def promote_pk_delete_insert(spark, sf_dir):
    """Matched rows are replaced."""
    return promote.promote(*line_sides(spark, sf_dir), "pk_delete_insert", keys=LINE_KEY)


@query(
    SETUP
    + f"""
SELECT {LINE_COLUMNS} FROM prod WHERE l_orderkey NOT IN (SELECT l_orderkey FROM stg)
UNION ALL SELECT {LINE_COLUMNS} FROM stg
"""
)
def promote_on_header(spark, sf_dir):
    """K7: whole orders are replaced, so lines gone from the source go from production."""
    return promote.promote(
        *line_sides(spark, sf_dir), "pk_delete_insert_on_header", keys=LINE_KEY, header_key=["l_orderkey"],
    )


@query(
    SETUP
    + f"""
SELECT {LINE_COLUMNS} FROM prod p
WHERE NOT EXISTS (SELECT 1 FROM stg s WHERE s.l_orderkey = p.l_orderkey AND s.l_linenumber = p.l_linenumber
                  AND s.l_shipdate = p.l_shipdate)
UNION ALL SELECT {LINE_COLUMNS} FROM stg
"""
)
def promote_versioned(spark, sf_dir):
    """K8: a row with a new stamp is added beside its older versions."""
    return promote.promote(
        *line_sides(spark, sf_dir), "versioned_delete_insert", keys=LINE_KEY, stamps=["l_shipdate"],
    )


@query(SETUP + f"SELECT {LINE_COLUMNS} FROM stg WHERE l_linestatus = 'O' AND l_discount < 0.05")
def promote_filter_active(spark, sf_dir):
    """K9: only rows that pass every predicate."""
    lines = marked_lines(spark, sf_dir)
    return promote.promote(
        prod_lines(lines), staged_lines(lines), "filter_active",
        where=["`l_linestatus` = 'O'", "`l_discount` < 0.05D"],
    )


@query(
    """
WITH feed AS (SELECT l_orderkey, min(l_linestatus) AS status, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_custkey, CASE WHEN shipped > o_orderdate THEN status ELSE o_orderstatus END AS o_orderstatus,
  o_totalprice, CASE WHEN shipped > o_orderdate THEN shipped ELSE o_orderdate END AS o_orderdate, o_orderpriority
FROM orders LEFT JOIN feed ON o_orderkey = l_orderkey
"""
)
def guarded_column_merge(spark, sf_dir):
    """Two columns taken from a feed where its stamp is the later one."""
    feed = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_linestatus").alias("o_orderstatus"), F.max("l_shipdate").alias("o_orderdate")
    )
    return promote.guarded_merge(
        table(spark, sf_dir, "orders"), feed, ["o_orderkey"], ["o_orderstatus", "o_orderdate"],
        "s.`o_orderdate` > p.`o_orderdate`",
    )


ERROR_KEY = ["Contract", "ContractLine", "ErrorMessageNumber"]

ERRORS_SQL = """
WITH e AS (
  SELECT user_id AS "Contract", event_type AS "ContractLine", CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS "ErrorMessageNumber",
         value, ts FROM events),
prod AS (SELECT "Contract", "ContractLine", "ErrorMessageNumber", max(value) AS worst FROM e WHERE ts < TIMESTAMP '2024-01-16' GROUP BY ALL),
stg AS (SELECT "Contract", "ContractLine", "ErrorMessageNumber", max(value) AS worst FROM e WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY ALL),
merged AS (
  SELECT coalesce(s."Contract", p."Contract") AS "Contract", coalesce(s."ContractLine", p."ContractLine") AS "ContractLine",
         coalesce(s."ErrorMessageNumber", p."ErrorMessageNumber") AS "ErrorMessageNumber", coalesce(s.worst, p.worst) AS worst,
         CASE WHEN p."Contract" IS NULL THEN 'New' WHEN s."Contract" IS NULL THEN 'Resolved' ELSE 'Persisting' END AS "ErrorStatus",
         TIMESTAMP '2024-01-31 06:00:00' AS "LastUpdate"
  FROM prod p FULL JOIN stg s ON p."Contract" = s."Contract" AND p."ContractLine" = s."ContractLine"
       AND p."ErrorMessageNumber" = s."ErrorMessageNumber")
"""


def open_errors(spark, sf_dir, late: bool):
    cut = stamp("2024-01-16")
    rows = table(spark, sf_dir, "events").where(F.col("ts") >= cut if late else F.col("ts") < cut)
    return rows.groupBy(
        F.col("user_id").alias("Contract"),
        F.col("event_type").alias("ContractLine"),
        F.get_json_object("props", "$.k").cast("int").alias("ErrorMessageNumber"),
    ).agg(F.max("value").alias("worst"))


def merged_errors(spark, sf_dir):
    stored = open_errors(spark, sf_dir, late=False).withColumns(
        {"ErrorStatus": F.lit("New"), "LastUpdate": stamp("2024-01-16 06:00:00")}
    )
    return promote.lifecycle_merge(stored, open_errors(spark, sf_dir, late=True), ERROR_KEY, stamp("2024-01-31 06:00:00"))


@query(ERRORS_SQL + "SELECT * FROM merged")
def lifecycle_merge(spark, sf_dir):
    """New, Persisting and Resolved keys."""
    return merged_errors(spark, sf_dir)


@query(
    ERRORS_SQL
    + """
SELECT 'New' AS "ErrorStatus", "ErrorMessageNumber", count(*) AS "ErrorCount", '2024-01-16' AS "ReportDate" FROM prod GROUP BY 2
UNION ALL
SELECT "ErrorStatus", "ErrorMessageNumber", count(*), '2024-01-31' FROM merged GROUP BY 1, 2
"""
)
def status_snapshot(spark, sf_dir):
    """today's counts by status and number; what an earlier run wrote for today goes."""
    group = ["ErrorMessageNumber"]
    first = open_errors(spark, sf_dir, late=False).groupBy(*group).agg(F.count(F.lit(1)).alias("ErrorCount"))
    earlier = first.select(F.lit("New").alias("ErrorStatus"), *group, "ErrorCount", F.lit(dt.date(2024, 1, 16)).alias("ReportDate"))
    stale = earlier.withColumn("ReportDate", F.lit(dt.date(2024, 1, 31)))
    stats = promote.status_snapshot(earlier.unionByName(stale), merged_errors(spark, sf_dir), F.lit(dt.date(2024, 1, 31)))
    return stats.withColumn("ReportDate", F.col("ReportDate").cast("string"))


@query(
    """
SELECT event_id, user_id, 0.0 AS value, CAST(CAST(ts AS DATE) AS VARCHAR) AS "ArchiveDate" FROM events
WHERE ts < TIMESTAMP '2024-01-15'
UNION ALL
SELECT event_id, user_id, value, CAST(CAST(ts AS DATE) AS VARCHAR) FROM events
WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-21'
"""
)
def trailing_archive(spark, sf_dir):
    """The last six days archived again as a frame, older days kept as they were (the writer: `archive_days`)."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "ts")
    archived = events.where(F.col("ts") < stamp("2024-01-19")).withColumns(
        {"value": F.lit(0.0), "ArchiveDate": F.to_date("ts")}
    )
    rows = rearchive(archived, events, "ts", dt.date(2024, 1, 20), backfill_days=5)
    return rows.select("event_id", "user_id", "value", F.col("ArchiveDate").cast("string").alias("ArchiveDate"))


@query("SELECT o_totalprice, o_orderkey, CAST(NULL AS VARCHAR) AS comment, o_orderstatus FROM orders")
def backfill_copy(spark, sf_dir):
    """Shared columns in the target's order; the rest of the target stays NULL."""
    target = spark.createDataFrame([], "o_totalprice double, o_orderkey long, comment string, o_orderstatus string")
    return fit_to_target(table(spark, sf_dir, "orders"), target)


@query(
    """
WITH o AS (SELECT CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN '' ELSE o_orderpriority END AS grade, o_orderkey, o_totalprice FROM orders)
SELECT 'gaps' AS copy, o_totalprice, CAST(NULL AS VARCHAR) AS comment, grade, o_orderkey FROM o WHERE grade IS DISTINCT FROM '1-URGENT'
UNION ALL SELECT 'gaps', o_totalprice, 'held', grade, o_orderkey FROM o WHERE grade = '1-URGENT' AND o_orderkey % 2 = 0
UNION ALL SELECT 'plain', o_totalprice, NULL, grade, o_orderkey FROM o
"""
)
def backfill_copy_parts(spark, sf_dir):
    """A production table kept by partitions, copied into one that already holds a partition, and into
    one without partitions."""
    home = scratch(spark, "backfill_copy_parts")
    by = ("grade",)
    layouts = {"des1": by, "gaps": by, "plain": ()}
    places = tuple(Destination(name, TableRef(f"{home}/{name}-staging"), TableRef(f"{home}/{name}", partition_by=kept)) for name, kept in layouts.items())
    spec = LoadSpec("order", "Order", (SourceFile(home, "*"),), places)
    origin, gaps, plain = (open_table(spark, place.prod.path, place.prod.partition_by) for place in places)
    # Grades that are missing and empty are partitions of their own.
    status = F.col("o_orderstatus")
    grade = F.when(status == "P", F.lit(None)).when(status == "F", "").otherwise(F.col("o_orderpriority")).alias("grade")
    origin.overwrite(table(spark, sf_dir, "orders").select("o_orderkey", grade, "o_totalprice", "o_custkey"))
    held = origin.read().where("grade = '1-URGENT' and o_orderkey % 2 = 0")
    shaped = held.select("o_totalprice", F.lit("held").alias("comment"), "grade", "o_orderkey")
    gaps.overwrite(shaped)
    plain.overwrite(shaped.limit(0))
    for name, options in (("gaps", {"fill_gaps": True}), ("plain", {})):
        done = copy_prod_table(spark, spec, target=name, **options)
        if done.status != "COPIED":
            raise RuntimeError(done.message)
    return gaps.read().select(F.lit("gaps").alias("copy"), "*").unionByName(plain.read().select(F.lit("plain").alias("copy"), "*"))


@query(
    SETUP
    + f"""
SELECT {LINE_COLUMNS} FROM prod WHERE l_orderkey NOT IN (SELECT l_orderkey FROM stg)
UNION ALL SELECT {LINE_COLUMNS} FROM stg
"""
)
def stage_and_promote(spark, sf_dir):
    """Staging written and counted, keys checked, production replaced, read back."""
    home = scratch(spark, "stage_and_promote")
    staging, prod = Table(spark, f"{home}/staging"), Table(spark, f"{home}/prod")
    history, changes = line_sides(spark, sf_dir)
    prod.overwrite(history)
    staged = staging.stage(changes)
    check_keys(staging.staged_frame(staged), LINE_KEY)
    staging.commit(staged)
    prod.overwrite(
        promote.promote(
            prod.read(), staging.read(), "pk_delete_insert_on_header", keys=LINE_KEY, header_key=["l_orderkey"]
        )
    )
    return prod.read()


@query(
    SETUP
    + """
SELECT CASE l_returnflag WHEN 'A' THEN '' WHEN 'N' THEN NULL ELSE if(l_linenumber % 2 = 0, '01', '1') END AS l_returnflag,
  l_orderkey, l_linenumber, l_quantity
FROM (
  SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity FROM prod p
  WHERE NOT EXISTS (SELECT 1 FROM stg s WHERE s.l_orderkey = p.l_orderkey AND s.l_linenumber = p.l_linenumber AND s.l_returnflag = p.l_returnflag)
  UNION ALL SELECT l_returnflag, l_orderkey, l_linenumber, l_quantity FROM stg)
"""
)
def promote_by_partition(spark, sf_dir):
    """K6 on a table stored by a key column: only the partitions staging touches are rewritten."""
    columns = ["l_returnflag", "l_orderkey", "l_linenumber", "l_quantity"]
    keys = ["l_returnflag", *LINE_KEY]
    table = PartitionedTable(spark, scratch(spark, "promote_by_partition"), ["l_returnflag"])
    # Flags that are missing, empty and like numbers: partitions that folder names would mix up.
    odd = F.when(F.col("l_returnflag") == "A", "").when(F.col("l_returnflag") == "N", F.lit(None)).when(F.col("l_linenumber") % 2 == 0, "01").otherwise("1")
    history, changes = (side.withColumn("l_returnflag", odd).select(*columns) for side in line_sides(spark, sf_dir))
    table.overwrite(history)
    staging = Table(spark, scratch(spark, "promote_by_partition"))
    staging.overwrite(changes)
    staged = staging.read()
    promote.check_partitioning("pk_delete_insert", ["l_returnflag"], keys, [])
    promote.rewrite_partitions(table, staged, lambda prod: promote.promote(prod, staged, "pk_delete_insert", keys=keys))
    return table.read()


BUCKETS = 16


def bucketed_sides(spark, sf_dir, name: str, key):
    """Production and staging, both kept in buckets of a key."""
    prod, staging = (BucketedTable(spark, f"{scratch(spark, name)}/{side}", key, BUCKETS) for side in ("prod", "staging"))
    history, changes = line_sides(spark, sf_dir)
    prod.overwrite(history)
    staging.overwrite(changes)
    return prod, staging


@query(ORACLES["promote_pk_delete_insert"])
def promote_bucketed(spark, sf_dir):
    """K6, J4 on tables in buckets of the key: production is matched and rewritten without an exchange."""
    prod, staging = bucketed_sides(spark, sf_dir, "promote_bucketed", LINE_KEY)
    nulls = promote.has_null_keys(staging.read(), LINE_KEY)
    prod.overwrite(promote.promote(prod.read(), staging.read(), "pk_delete_insert", keys=LINE_KEY, null_keys=nulls))
    return prod.read()


@query(ORACLES["promote_on_header"])
def promote_bucketed_on_header(spark, sf_dir):
    """K7 on tables in buckets of the header key."""
    header = ["l_orderkey"]
    prod, staging = bucketed_sides(spark, sf_dir, "promote_bucketed_on_header", header)
    nulls = promote.has_null_keys(staging.read(), header)
    prod.overwrite(
        promote.promote(prod.read(), staging.read(), "pk_delete_insert_on_header", keys=LINE_KEY, header_key=header, null_keys=nulls)
    )
    return prod.read()
