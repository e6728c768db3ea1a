"""How often rows are moved, sorted and stored."""

import datetime as dt
import os

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tests.helpers import plan, rows
from tidemark.queries import promotion, runs
from tidemark.queries.ingest import first_lines
from tidemark.sources.tables import PART, PartitionedTable, Table

LINE = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
NEW, OLD = dt.datetime(1999, 5, 1), dt.datetime(1997, 5, 1)


@pytest.fixture
def sf_dir(spark, tmp_path):
    """Lines of an early and a late order and of none; one key comes twice, one is null."""
    orders = [(1, OLD), (2, NEW), (2, NEW), (None, NEW)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    keys = [(1, 1, OLD), (2, 1, OLD), (2, 1, NEW), (2, 2, NEW), (3, 1, NEW), (None, 1, NEW)]
    lines = [(order, 7, 7, line, 1.0, 1.0, 0.1, 0.0, "N", "O", day) for order, line, day in keys]
    spark.createDataFrame(lines, LINE).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_a_load_moves_its_lines_once(spark, sf_dir, tmp_path):
    """Kept in buckets of the order, lines are de-duplicated where they are."""
    lines = runs.lines_by_order(spark, sf_dir, str(tmp_path / "lines"))
    first = first_lines(lines)
    assert lines.count() == 6 and "Exchange" not in plan(first)
    assert rows(first, "l_orderkey", "l_linenumber", "l_shipdate") == sorted([(1, 1, OLD), (2, 1, NEW), (2, 2, NEW), (3, 1, NEW), (None, 1, NEW)], key=repr)


def test_history_is_found_once_for_all_destinations(spark, sf_dir, monkeypatch):
    plans = []
    overwrite = Table.overwrite
    monkeypatch.setattr(Table, "overwrite", lambda table, frame: plans.append(plan(frame)) or overwrite(table, frame))
    runs.loaded(spark, sf_dir, "moves")
    assert sum("Window" in text for text in plans) == 1


def test_states_are_written_small(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    table.overwrite(spark.range(5).toDF("k"))
    names = [name for name in os.listdir(tmp_path / "t" / "v00000001") if name.endswith(".parquet")]
    assert names and all(name.endswith(".zstd.parquet") for name in names)


def test_both_sides_of_a_promotion_come_of_lines_found_once(spark, sf_dir):
    prod, staged = promotion.line_sides(spark, sf_dir)
    assert not any(node in plan(side) for side in (prod, staged) for node in ("Window", "Join"))
    assert rows(prod, "l_orderkey", "l_linenumber", "l_quantity") == sorted([(1, 1, 1.0), (2, 1, 1.0), (2, 2, 1.0), (3, 1, 1.0), (None, 1, 1.0)], key=repr)
    assert rows(staged, "l_orderkey", "l_linenumber", "l_shipdate") == [(2, 1, NEW + dt.timedelta(1)), (2, 2, NEW + dt.timedelta(1))]


@pytest.mark.parametrize("parts", [3, 40])
def test_partitions_are_written_without_sorting_a_task(spark, tmp_path, monkeypatch, parts):
    """Also where a task has more partitions than it keeps files open."""
    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.parquet
    before = spark.conf.get(name)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *args, **more: seen.append(int(spark.conf.get(name))) or write(*args, **more))
    table = PartitionedTable(spark, str(tmp_path / "t"), ["g"])
    staged = table.stage(spark.range(500).select((F.col("id") % parts).alias("g"), "id"))
    assert seen[0] > 0 and spark.conf.get(name) == before
    table.commit(staged)
    assert rows(table.read(), "id") == sorted(((n,) for n in range(500)), key=repr) and len(table.part_rows()) == parts
    stored = spark.read.parquet(str(tmp_path / "t" / staged.folder))
    assert stored.groupBy(PART).agg(F.count_distinct("g").alias("n")).where("n <> 1").isEmpty()
