"""Lookups, derived reporting columns and search terms."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import health_text
from tidemark.functions.text import is_truthy, one_line
from tidemark.operators.guards import unmapped
from tidemark.operators.search_terms import search_terms as joined_search_terms
from tidemark.operators.transforms import TRANSFORMS, Run, exception_flag as flag_column, lookup_all, lookup_first
from tidemark.queries.base import query, table

RUN = Run(dt.datetime(2026, 7, 28, 6, 30))


@query(
    """
WITH best AS (
  SELECT s_nationkey, s_name, s_suppkey FROM (
    SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_name, s_suppkey) AS rn FROM supplier WHERE s_acctbal > 0)
  WHERE rn = 1),
side AS (SELECT CASE WHEN n_nationkey > 0 THEN n_nationkey END AS k, n_name AS v FROM nation
         UNION ALL SELECT n_nationkey, n_name || ' (old)' FROM nation WHERE n_regionkey = 1),
main AS (SELECT c_custkey, c_nationkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey END AS k FROM customer)
SELECT c_custkey, s_name AS supplier_name, s_suppkey AS supplier_key, v AS place,
  'NATION - ' || coalesce(v, '') AS place_text, 'CORE' AS system
FROM main LEFT JOIN best ON c_nationkey = s_nationkey LEFT JOIN side ON main.k IS NOT DISTINCT FROM side.k
"""
)
def lookup_enrich(spark, sf_dir):
    """First complete mapping row per key; then every row of a second mapping,
    NULL keys matching."""
    supplier = table(spark, sf_dir, "supplier")
    mapping = supplier.select(
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_name").alias("supplier_name"),
        F.when(F.col("s_acctbal") > 0, F.col("s_suppkey")).alias("supplier_key"),
    )
    nation = table(spark, sf_dir, "nation")
    side = nation.select(F.when(F.col("n_nationkey") > 0, F.col("n_nationkey")).alias("k"), F.col("n_name").alias("v"))
    renamed = nation.where(F.col("n_regionkey") == 1).select(
        F.col("n_nationkey").alias("k"), F.concat("n_name", F.lit(" (old)")).alias("v")
    )
    main = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey")).alias("k")
    )
    found = lookup_first(main, mapping, "c_nationkey", ["supplier_name", "supplier_key"])
    placed = lookup_all(found, side.unionByName(renamed), "k", "k", "v", "place")
    return placed.select(
        "c_custkey",
        "supplier_name",
        "supplier_key",
        "place",
        F.concat(F.lit("NATION - "), F.coalesce("place", F.lit(""))).alias("place_text"),
        F.lit("CORE").alias("system"),
    )


@query(
    """
SELECT DISTINCT l_suppkey FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)
"""
)
def unmapped_keys(spark, sf_dir):
    """Keys of the lines without a complete mapping row."""
    mapping = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.when(F.col("s_acctbal") > 5000, F.col("s_name")).alias("name")
    )
    return unmapped(table(spark, sf_dir, "lineitem"), "l_suppkey", mapping, ["l_suppkey", "name"])


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_returnflag = 'A' AND o_orderstatus = 'F' THEN 'Remove - released but canceled'
       WHEN l_linestatus = 'O' AND o_orderstatus <> 'P' THEN 'Remove - unreleased'
       WHEN o_orderpriority = '5-LOW' THEN 'Remove - legacy PO transferred' ELSE 'Default' END AS flag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
)
def exception_flag(spark, sf_dir):
    """The last matching rule wins."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    status = F.when(F.col("o_orderstatus") == "F", "Canceled").when(F.col("o_orderstatus") == "P", "Closed")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        flag_column(
            reference=F.when(F.col("o_orderpriority") == "5-LOW", "0123456789").otherwise(""),
            company=F.lit("0123"),
            released=F.when(F.col("l_linestatus") == "O", "No").otherwise("Yes"),
            status=status,
            line_released=F.when(F.col("l_returnflag") == "A", "Yes").otherwise("No"),
        ).alias("flag"),
    )


def order_sides(spark, sf_dir):
    """Order lines as an export ships them, and the side exports that enrich them."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    customers = table(spark, sf_dir, "customer")
    main = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey",
        F.col("c_nationkey").cast("string").alias("Company"),
        priority.alias("FD3"),
        F.col("c_mktsegment").alias("FD5"),
        F.col("c_name").alias("FD1Text"),
        F.when(status == "P", "INV").alias("InventoryFD1"),
        F.when(priority != "5-LOW", F.col("c_mktsegment")).alias("TransientInventoryLocation"),
        F.when(priority == "1-URGENT", F.lpad(F.col("o_custkey").cast("string"), 12, "0")).alias("PurchaseOrder.Reference1"),
        F.when(status == "O", "No").otherwise("Yes").alias("PurchaseOrder.IsReleased"),
        F.when(priority == "2-HIGH", "Yes").otherwise("No").alias("LineReleased"),
        F.when(status == "F", "Canceled").when(status == "P", "Closed").alias("PurchaseOrder.DerivedPurchaseOrderStatus"),
        F.to_date("o_orderdate").alias("ReleasedOn"),
    )
    regions = table(spark, sf_dir, "region").where(F.col("r_name") != "ASIA")
    company_map = table(spark, sf_dir, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("Company"),
        F.col("n_name").alias("Name"),
        F.col("r_name").alias("AP pay lv3"),
        F.col("r_regionkey").cast("string").alias("AP pay lv1"),
    )
    fd3 = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("FinanceDimension3"), F.concat(F.lit("priority "), "o_orderpriority").alias("Description")
    ).distinct()
    fd5 = customers.where(F.col("c_mktsegment") != "BUILDING").select(
        F.col("c_mktsegment").alias("FinanceDimension5"), F.concat(F.lit("segment "), "c_mktsegment").alias("Description")
    ).distinct()
    return main, {"company_map": company_map, "fd3": fd3, "fd5": fd5}


@query(
    """
WITH main AS (
  SELECT o_orderkey, CAST(c_nationkey AS VARCHAR) AS company, o_orderpriority AS fd3, c_mktsegment AS fd5, c_name AS fd1text,
    CASE WHEN o_orderstatus = 'P' THEN 'INV' END AS inv, CASE WHEN o_orderpriority <> '5-LOW' THEN c_mktsegment END AS loc,
    CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS reference,
    o_orderstatus, o_orderpriority, o_orderdate
  FROM orders JOIN customer ON o_custkey = c_custkey),
cmap AS (SELECT CAST(n_nationkey AS VARCHAR) AS company, n_name, r_name, CAST(r_regionkey AS VARCHAR) AS lv1
         FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA'),
j AS (SELECT main.*, n_name, r_name, lv1, 'priority ' || fd3 AS fd3text,
        CASE WHEN fd5 <> 'BUILDING' THEN 'segment ' || fd5 END AS fd5desc
      FROM main LEFT JOIN cmap ON main.company = cmap.company)
SELECT o_orderkey, company, n_name AS name, r_name AS lv3, lv1, fd3text,
  CASE WHEN inv IS NOT NULL THEN 'INVENTORY - ' || coalesce(loc, '') ELSE fd5 END AS fd5,
  CASE WHEN inv IS NOT NULL THEN 'INVENTORY - ' || coalesce(loc, '') ELSE coalesce(fd5desc, fd1text) END AS fd5text,
  CASE WHEN reference = '0' THEN '' ELSE reference END AS reference,
  CASE WHEN o_orderpriority = '2-HIGH' AND o_orderstatus = 'F' THEN 'Remove - released but canceled'
       WHEN o_orderstatus = 'O' THEN 'Remove - unreleased'
       WHEN reference NOT IN ('', '0') THEN 'Remove - legacy PO transferred' ELSE 'Default' END AS flag,
  'CORE' AS system, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%Y-%m') AS year_month,
  'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter
FROM j
"""
)
def purchase_order_lines(spark, sf_dir):
    """J1-J3, P8, P9, F8, F11, F16, F17 together: the order enrichment transform."""
    main, side = order_sides(spark, sf_dir)
    done = TRANSFORMS["purchase_order_line"](main, {"system": "CORE", "release_date": "ReleasedOn"}, side, RUN)
    names = {
        "o_orderkey": "o_orderkey", "Company": "company", "Name": "name", "AP pay lv3": "lv3", "AP pay lv1": "lv1",
        "FD3Text": "fd3text", "FD5": "fd5", "FD5Text": "fd5text", "PurchaseOrder.Reference1": "reference",
        "EXC_FLAG": "flag", "System": "system", "Year": "year", "YearMonth": "year_month", "Quarter": "quarter",
    }
    return done.select(*(F.col(f"`{old}`").alias(new) for old, new in names.items()))


@query(
    """
WITH v AS (SELECT CASE WHEN p_size > 15 THEN p_brand END AS g, p_type || ' ' || CAST(p_size AS VARCHAR) AS i, p_name AS r,
             p_name || ' ' || p_brand AS t, p_size AS d, p_partkey AS o FROM part),
gr AS (SELECT g, string_agg(r, '|' ORDER BY f) AS terms FROM (SELECT g, r, min(o) AS f FROM v WHERE g IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
ir AS (SELECT i, string_agg(r, '|' ORDER BY f) AS terms FROM (SELECT i, r, min(o) AS f FROM v GROUP BY 1, 2) GROUP BY 1),
it AS (SELECT i, string_agg(t, '|' ORDER BY f) AS terms FROM (SELECT i, t, min(o) AS f FROM v GROUP BY 1, 2) GROUP BY 1)
SELECT DISTINCT v.i AS "Item", coalesce(gr.terms, ir.terms) AS "RefsSearch", it.terms AS "ItemsSearch", d AS "Date"
FROM v LEFT JOIN gr ON v.g = gr.g LEFT JOIN ir ON v.i = ir.i LEFT JOIN it ON v.i = it.i
"""
)
def search_terms(spark, sf_dir):
    """Distinct terms joined per group and item."""
    view = table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") > 15, F.col("p_brand")).alias("Item Group"),
        F.concat_ws(" ", "p_type", F.col("p_size").cast("string")).alias("Item"),
        F.col("p_name").alias("RefSearch"),
        F.concat_ws(" ", "p_name", "p_brand").alias("ItemSearch"),
        F.col("p_size").alias("Date"),
        "p_partkey",
    )
    return joined_search_terms(view, F.col("p_partkey"))


@query(
    """
SELECT event_id, CASE event_type
    WHEN 'error' THEN 'FILE NOT FOUND: expected file(s) fd3, fd5 missing' WHEN 'signup' THEN 'PK VIOLATION'
    WHEN 'purchase' THEN CASE WHEN value > 20 THEN 'FIELD TRUNCATE' ELSE 'PARTIAL STAGING LOAD' END
    WHEN 'view' THEN 'See Log' END AS code
FROM events
"""
)
def classify_error(spark, sf_dir):
    """failure texts to short codes."""
    kind = F.col("event_type")
    message = (
        F.when(kind == "error", "no files matched in Downloads for input(s): fd3, fd5\nTraceback: primary key")
        .when(kind == "signup", F.concat(F.lit("Violation of PRIMARY KEY constraint "), "props"))
        .when((kind == "purchase") & (F.col("value") > 20), "PARTIAL STAGING LOAD: String data would be truncated")
        .when(kind == "purchase", "Partial staging load: stopped")
        .when(kind == "view", F.concat(F.lit("timeout "), "props"))
    )
    failures = table(spark, sf_dir, "events").select("event_id", message.alias("message"))
    return failures.select("event_id", health_text.classify_error(F.col("message")).alias("code"))


@query(
    """
SELECT event_id,
  CASE WHEN event_type IN ('click', 'view') THEN
    nullif(concat_ws('; ', CASE WHEN event_type = 'click' THEN 'log fallback' END, CASE WHEN value > 20 THEN 'column missing' END), '')
  ELSE 'See Log' END AS step_error,
  CASE event_type WHEN 'error' THEN 'See Log' WHEN 'purchase' THEN 'BLOCKED: requires ' || event_type || ': no row; ' || props END AS process_error,
  CASE WHEN event_type = 'click' THEN 'Not Applicable' WHEN event_type = 'view' THEN '[db].[s].[stg]; [db].[s].[aux]'
       ELSE '[db].[s].[stg]' END AS staging_tables,
  CASE WHEN event_type = 'error' THEN NULL ELSE 'own.job_' || event_type END AS object_name,
  CASE event_type WHEN 'click' THEN '[db].[home].[click]' WHEN 'view' THEN '[db].[own].[view]' WHEN 'signup' THEN '[x].[own].[a]]b]'
       ELSE '[b].[c].[d]' END AS qualified,
  CASE WHEN value > 20 THEN 'Main' WHEN event_type = 'click' THEN '—' ELSE event_type END AS connection,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS last_run,
  event_type IN ('click', 'view') AS truthy,
  substr('a b ' || event_type || ' ' || props, 1, 11) || '…' AS cut
FROM events
"""
)
def health_texts(spark, sf_dir):
    """Texts and labels of the health log."""
    kind, value = F.col("event_type"), F.col("value")
    ok = kind.isin("click", "view")
    notes = F.array(F.when(kind == "click", "log fallback"), F.when(value > 20, "column missing"))
    unmet = F.array(F.concat(kind, F.lit(": no row")), F.col("props"))
    staging = F.lit("[db].[s].[stg]")
    target = F.when(kind == "click", staging).otherwise("[db].[s].[prod]")
    extra = F.when(kind == "view", F.array(F.lit("[db].[s].[aux]")))
    statement = F.when(kind != "error", F.concat(F.lit("  exec  own.job_"), kind, F.lit(" @a = 1"))).otherwise("SELECT 1")
    raw = F.when(kind == "click", "click").when(kind == "view", "own.[view]").when(kind == "signup", "x.own.[a]b]").otherwise("a.b.c..d")
    server = F.when(value > 20, "srv1").when(kind == "click", F.lit(None)).otherwise(kind)
    return table(spark, sf_dir, "events").select(
        "event_id",
        health_text.step_error(F.when(ok, "SUCCESS").otherwise("FAILED"), F.lit("boom"), notes).alias("step_error"),
        health_text.process_error(
            F.when(kind == "error", "FAILED").when(kind == "purchase", "BLOCKED").otherwise("SUCCESS"),
            F.lit("boom"), unmet, F.lit(None).cast("string"),
        ).alias("process_error"),
        health_text.staging_names(target, staging, extra).alias("staging_tables"),
        health_text.exec_object(statement).alias("object_name"),
        health_text.qualified_object(raw, F.lit("db"), F.lit("home")).alias("qualified"),
        health_text.connection_label(server, {"srv1": "Main"}).alias("connection"),
        health_text.last_run_text(F.col("ts")).alias("last_run"),
        is_truthy(F.when(kind == "click", " YES").when(kind == "view", "1").when(kind == "signup", "no")).alias("truthy"),
        one_line(F.concat(F.lit(" a \t b\n"), kind, F.lit("  "), "props"), 12).alias("cut"),
    )
