"""Reading, typing, de-duplicating and checking."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.functions.typing import blank_to_null
from tidemark.operators import guards, shape
from tidemark.operators.transforms import keep_first, with_global_max
from tidemark.plans.spec import MapRow
from tidemark.queries.base import query, scratch, table
from tidemark.sources.files import read_text_export
from tidemark.sources.tables import rows_of, total_rows

LINE_KEY = ["l_orderkey", "l_linenumber"]

# Deduplicated lines: latest shipment per key, then the lowest other columns.
DEDUP_SQL = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus) AS rn
  FROM lineitem) WHERE rn = 1
"""


def first_lines(lines):
    """Of the lines of a key the one shipped last."""
    return keep_first(lines, LINE_KEY, [("l_shipdate", "desc")])


def deduped_lines(spark, sf_dir):
    return first_lines(table(spark, sf_dir, "lineitem"))


def orders_as_text(spark, sf_dir):
    """Orders the way an export ships them: every value text, some blank or in odd shape."""
    stamp = F.date_format("o_orderdate", "MM/dd/yyyy hh:mm:ss a")
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("OrderKey"),
        F.concat(F.lit(" "), status, F.lit("\t")).alias("Status"),
        F.when(status == "P", "N/A").when(status == "F", F.lit(None)).otherwise(F.col("o_orderpriority")).alias("Priority"),
        F.when(status == "P", "not a date").otherwise(stamp).alias("update stamp"),
        F.when(status == "O", F.date_format("o_orderdate", "yyyyMMdd"))
        .when(status == "F", F.date_format("o_orderdate", "M/d/yyyy"))
        .alias("Order.Date"),
        F.when(status != "F", F.format_string("%,d.25", F.floor("o_totalprice"))).alias("Total"),
        F.when(status != "P", F.concat(F.col("o_custkey").cast("string"), F.lit(".75"))).alias("Customer"),
        F.concat(F.lit("  "), F.col("o_orderpriority")).alias("PaddedKey"),
    )


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS "OrderKey", CAST(o_custkey AS VARCHAR) AS "Cust,Key",
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE '"' || o_orderstatus || '"' END AS "Status",
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderpriority || ', checked' END AS "Priority"
FROM orders
"""
)
def csv_scan(spark, sf_dir):
    """A text export read back with every column as text and missing-value texts as NULL."""
    path = scratch(spark, "csv_scan")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("OrderKey"),
        F.col("o_custkey").alias("Cust,Key"),
        F.when(status == "P", "NULL").otherwise(F.concat(F.lit('"'), status, F.lit('"'))).alias("Status"),
        F.when(priority == "5-LOW", "n/a").otherwise(F.concat(priority, F.lit(", checked"))).alias("Priority"),
    ).write.option("header", True).option("escape", '"').csv(path)
    return read_text_export(spark, path)


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus AS status,
  CASE WHEN o_orderstatus IN ('P', 'F') THEN '' ELSE o_orderpriority END AS priority,
  CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '1900-01-01' ELSE o_orderdate END AS updated,
  CASE WHEN o_orderstatus = 'P' THEN '1900-01-01' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS ordered_on,
  CASE WHEN o_orderstatus <> 'F' THEN floor(o_totalprice) + 0.25 END AS total,
  CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS customer,
  '  ' || o_orderpriority AS padded_key, 'export' AS origin, CAST(NULL AS VARCHAR) AS note
FROM orders
"""
)
def type_and_normalize(spark, sf_dir):
    """Text to typed, cleaned and mapped columns."""
    mapping = [
        MapRow("OrderKey", "order_key"),
        MapRow("Status", "status"),
        MapRow("Priority", "priority"),
        MapRow("update stamp", "updated", "datetime"),
        MapRow("Order.Date", "ordered_on", "date"),
        MapRow("Total", "total", "float"),
        MapRow("Customer", "customer", "int"),
        MapRow("PaddedKey", "padded_key"),
        MapRow("Unused", None, "ignore"),
        MapRow(None, "origin", value="export"),
        MapRow(None, "note"),
    ]
    types = {"update stamp": "datetime", "Order.Date": "date", "Total": "float", "Customer": "int"}
    raw = orders_as_text(spark, sf_dir)
    raw = raw.select(*(blank_to_null(name) for name in raw.columns))
    typed = shape.apply_types(raw, types, datetime_format="%m/%d/%Y %I:%M:%S %p")
    clean = shape.normalize(typed, types, keep_whitespace=["PaddedKey"])
    mapped = shape.map_columns(clean, mapping)
    # Dates as text, so that both engines give the same kind of value.
    return mapped.withColumn("ordered_on", F.col("ordered_on").cast("string"))


@query(
    """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS by_mixed, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS cut,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) ELSE '1900-01-01' END AS by_one_format
FROM orders
"""
)
def mixed_dates(spark, sf_dir):
    """a column that mixes date shapes, read per value; one format reads only its own."""
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    shaped = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"),
        F.when(urgent, F.date_format("o_orderdate", "MM/dd/yyyy")).otherwise(F.date_format("o_orderdate", "yyyyMMdd")).alias("by_mixed"),
        F.date_format("o_orderdate", "MM/dd/yyyy hh:mm:ss a").alias("cut"),
    ).withColumn("by_one_format", F.col("by_mixed"))
    mixed = shape.apply_types(shaped, {"by_mixed": "date"})
    one = shape.apply_types(
        mixed, {"cut": "datetime", "by_one_format": "date"},
        date_format="%m/%d/%Y", datetime_format="%m/%d/%Y %I:%M:%S %p", as_date=["cut"],
    )
    return one.select("o_orderkey", *(F.col(name).cast("string").alias(name) for name in ("by_mixed", "cut", "by_one_format")))


# The Spark patterns of all mixed shapes, written out, and two shapes that none of them reads.
DATE_SHAPES = (
    "MM/dd/yyyy", "yyyyMMdd", "yyyy-MM-dd", "MM/dd/yyyy hh:mm:ss a", "MM/dd/yyyy HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy/MM/dd", "M/d/yy", "MM-dd-yyyy", "M/d/yyyy HH:mm", "M/d/yyyy h:mm a", "yyyy/MM/dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd'T'HH:mm",
    "yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "MM/dd/yyyy HH:mm:ss.SSSSSS", "MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy",
    "d MMM yyyy", "d MMMM yyyy", "dd-MMM-yyyy",
)
ODD_SHAPES = ("yyyy.MM.dd", "'week' d 'of' yyyy")


def dates_in_all_shapes(spark, sf_dir):
    """Order dates as text, each in the shape that its key chooses."""
    patterns = [*DATE_SHAPES, *ODD_SHAPES]
    place = F.col("o_orderkey") % len(patterns)
    shaped = F
    for k, pattern in enumerate(patterns):
        shaped = shaped.when(place == k, F.date_format("o_orderdate", pattern))
    return table(spark, sf_dir, "orders").select("o_orderkey", shaped.alias("Order.Date"))


@query(
    """
SELECT o_orderkey, CASE WHEN o_orderkey % 26 < 24 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) ELSE '1900-01-01' END AS "Order.Date"
FROM orders
"""
)
def date_shapes(spark, sf_dir):
    """all known shapes in one column; an unknown one becomes the sentinel."""
    typed = shape.apply_types(dates_in_all_shapes(spark, sf_dir), {"Order.Date": "date"})
    return typed.select("o_orderkey", F.col("`Order.Date`").cast("string").alias("Order.Date"))


@query(
    """
WITH odd AS (
  SELECT CASE WHEN o_orderkey % 26 = 24 THEN strftime(o_orderdate, '%Y.%m.%d') ELSE 'week ' || day(o_orderdate) || ' of ' || year(o_orderdate) END AS value,
         CASE WHEN o_orderkey % 26 = 24 THEN 'Y.9.9' ELSE 'N 9 aa Y' END AS shape
  FROM orders WHERE o_orderkey % 26 >= 24)
SELECT 'Order.Date' AS column_name, shape, count(*) AS unread, min(value) AS example FROM odd GROUP BY shape
"""
)
def unread_date_shapes(spark, sf_dir):
    """values of unknown shape, counted by shape."""
    return guards.unread_shapes(dates_in_all_shapes(spark, sf_dir), ["Order.Date"])


@query(
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS status,
  CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS total
FROM orders
"""
)
def fill_text_blanks(spark, sf_dir):
    """blanks filled in text columns; numbers keep NULL."""
    frame = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_totalprice")).alias("total"),
    )
    return shape.fill_text_blanks(frame)


@query("SELECT o_custkey, o_orderkey, CAST(NULL AS VARCHAR) AS comment FROM orders")
def align_to_table(spark, sf_dir):
    """Extra columns drop out, missing ones are NULL, table order wins."""
    frame = shape.drop_present(table(spark, sf_dir, "orders"), ["o_orderpriority", "absent"])
    aligned = shape.align(frame, ["o_custkey", "o_orderkey", "comment"], mapped=False, allow_missing=True)
    return aligned.withColumn("comment", F.col("comment").cast("string"))


@query(DEDUP_SQL)
def dedup_keep_first(spark, sf_dir):
    """One row per key."""
    return deduped_lines(spark, sf_dir)


@query(
    """
SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1 ORDER BY count DESC, 1, 2 LIMIT 20
"""
)
def pk_duplicates(spark, sf_dir):
    """A1, O2: the most repeated keys."""
    return guards.duplicate_sample(table(spark, sf_dir, "lineitem"), LINE_KEY)


@query("SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def pk_duplicate_keys(spark, sf_dir):
    """A1: every repeated key."""
    return guards.duplicate_keys(table(spark, sf_dir, "lineitem"), LINE_KEY)


@query('SELECT l_orderkey, l_linenumber, l_shipdate, (SELECT max(l_shipdate) FROM lineitem) AS "report stamp" FROM lineitem')
def report_stamp(spark, sf_dir):
    """A2: the global maximum on each row."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    return with_global_max(lines, "l_shipdate", "report stamp")


@query(
    """
WITH w(name, stg_from, base_to) AS (
  VALUES ('gap', TIMESTAMP '1999-06-01', TIMESTAMP '1999-03-01'), ('meets', TIMESTAMP '1998-06-01', TIMESTAMP '1999-03-01'),
         ('first load', TIMESTAMP '1998-06-01', TIMESTAMP '1970-01-01')),
m AS (SELECT name, (SELECT min(o_orderdate) FROM orders WHERE o_orderdate >= stg_from) AS source_min,
             (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < base_to) AS baseline_max FROM w)
SELECT name, source_min, baseline_max,
  CASE WHEN source_min IS NULL THEN 'no source values' WHEN baseline_max IS NULL THEN 'baseline empty'
       WHEN source_min <= baseline_max THEN 'overlap' ELSE 'gap' END AS outcome,
  coalesce(source_min <= baseline_max, TRUE) AS passed
FROM m
"""
)
def overlap_check(spark, sf_dir):
    """A3: does the incoming window meet what is stored?"""
    orders = table(spark, sf_dir, "orders").select("o_orderdate")
    stamp = F.col("o_orderdate")
    windows = [("gap", "1999-06-01", "1999-03-01"), ("meets", "1998-06-01", "1999-03-01"), ("first load", "1998-06-01", "1970-01-01")]
    out = None
    for name, start, stop in windows:
        result = guards.overlap(
            orders.where(stamp >= F.lit(start).cast("timestamp_ntz")),
            orders.where(stamp < F.lit(stop).cast("timestamp_ntz")),
            "o_orderdate",
            "o_orderdate",
        ).select(F.lit(name).alias("name"), "*")
        out = result if out is None else out.unionByName(result)
    return out


@query(
    """
SELECT 'p_name' AS column_name, 10 AS width, count(*) FILTER (length(p_name) > 10) AS over_length FROM part
UNION ALL SELECT 'p_brand', 7, count(*) FILTER (length(p_brand) > 7) FROM part
UNION ALL SELECT 'p_type', 40, count(*) FILTER (length(p_type) > 40) FROM part
"""
)
def field_overflow(spark, sf_dir):
    """rows too long for their varchar(n) column."""
    types = {"p_name": "varchar(10)", "p_brand": "varchar(7)", "p_type": "varchar(40)", "p_size": "int"}
    return guards.overflow_counts(table(spark, sf_dir, "part"), types)


@query("SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, sf_dir):
    """A4: row count."""
    return rows_of(table(spark, sf_dir, "lineitem"))


@query("SELECT CAST(sum(n) AS BIGINT) AS total_rows FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE count(*) END AS n FROM orders GROUP BY o_orderstatus)")
def total_row_count(spark, sf_dir):
    """A10: rows over destinations, one of which reports none."""
    per_side = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return total_rows(per_side.select(F.when(F.col("o_orderstatus") != "P", F.col("n")).alias("RowCount")))


@query(
    """
SELECT o_orderkey, substr(CAST(o_orderdate AS VARCHAR), 1, 4) AS year, substr(CAST(o_orderdate AS VARCHAR), 1, 7) AS year_month,
  'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter FROM orders
"""
)
def year_month_quarter(spark, sf_dir):
    """reporting period texts."""
    day = F.to_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.year_of(day).alias("year"),
        text.year_month_of(day).alias("year_month"),
        text.quarter_of(day).alias("quarter"),
    )


@query(
    """
SELECT p_partkey, p_brand AS part_1, p_type AS part_2, CASE WHEN p_size > 25 THEN p_name ELSE '' END AS part_3,
  regexp_replace(CAST(p_size AS VARCHAR), '^0+', '') AS no_zeros,
  split_part(p_name, ' ', 2) AS token, 'Brand' AS before, CASE WHEN p_size > 25 THEN p_name ELSE 'nan' END AS after,
  CASE WHEN p_type = 'ECONOMY' THEN 1 ELSE 0 END AS flag,
  CASE WHEN length(p_name || p_type || p_brand) > 25 THEN '' ELSE p_name || p_type || p_brand END AS bounded,
  CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) ELSE 'NA' END AS stringified
FROM part
"""
)
def split_and_trim(spark, sf_dir):
    """Splitting, stripping and blanking text."""
    large = F.col("p_size") > 25
    parts = F.concat_ws("|", F.col("p_partkey").cast("string"), "p_brand", "p_type", F.when(large, F.col("p_name")))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        text.pipe_part(parts, 1).alias("part_1"),
        text.pipe_part(parts, 2).alias("part_2"),
        text.pipe_part(parts, 3).alias("part_3"),
        text.strip_leading_zeros(F.lpad(F.col("p_size").cast("string"), 8, "0")).alias("no_zeros"),
        text.last_token(F.col("p_name")).alias("token"),
        text.before_dash(F.concat(F.lit("Brand - "), "p_name")).alias("before"),
        text.after_dash(F.when(large, F.concat(F.lit("Brand - "), "p_name"))).alias("after"),
        text.flag_of(F.when(F.col("p_type") == "ECONOMY", "True").otherwise("False")).alias("flag"),
        text.blank_if_longer(F.concat("p_name", "p_type", "p_brand"), 25).alias("bounded"),
        text.stringify(F.when(large, F.col("p_size"))).alias("stringified"),
    )
