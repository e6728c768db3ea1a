import pytest

from tests.helpers import rows
from tidemark.sources import tables as t
from tidemark.sources.tables import Table


def frame(spark, *items):
    return spark.createDataFrame([(item,) for item in items], "k int")


def test_versions(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    assert table.read() is None and table.count() == 0 and not table.exists()
    assert table.overwrite(frame(spark, 1, 2)) == 2
    assert table.exists() and rows(table.read(["k"])) == [(1,), (2,)]
    # The table may be an input of its own next state.
    table.overwrite(table.read().union(frame(spark, 3)))
    assert rows(table.read()) == [(1,), (2,), (3,)] and table.count() == 3


def test_uncommitted_and_failed_writes_stay_invisible(spark, tmp_path):
    table = Table(spark, str(tmp_path / "t"))
    table.overwrite(frame(spark, 1))
    staged = table.stage(frame(spark, 7, 8))
    assert rows(table.read()) == [(1,)] and rows(table.staged_frame(staged)) == [(7,), (8,)]
    with pytest.raises(Exception):
        table.overwrite(spark.sql("SELECT raise_error('boom') AS k"))
    assert rows(table.read()) == [(1,)]
    table.overwrite(frame(spark, 9))
    assert rows(table.read()) == [(9,)]


def test_partial_load_is_refused(spark, tmp_path, monkeypatch):
    table = Table(spark, str(tmp_path / "t"))
    table.overwrite(frame(spark, 1))
    real = t.write_counted
    monkeypatch.setattr(t, "write_counted", lambda *args: real(*args) + 1)
    with pytest.raises(t.PartialLoadError, match="PARTIAL STAGING LOAD"):
        table.overwrite(frame(spark, 5))
    assert rows(table.read()) == [(1,)]


def test_reads(spark, tmp_path):
    path = str(tmp_path / "r")
    spark.createDataFrame([(1, "a")], "`x.y` int, z string").write.parquet(path)
    assert t.read_table(spark, path, ["x.y"]).columns == ["x.y"]
    spark.read.parquet(path).createOrReplaceTempView("some_view")
    assert t.read_view(spark, "some_view", ["z"]).count() == 1
    with pytest.raises(ValueError, match="lacks column"):
        t.read_view(spark, "some_view", ["q"])
    meta = t.table_columns(spark.table("some_view"), identity=["z"])
    assert rows(meta, "name", "data_type", "is_identity", "ordinal_position") == [("x.y", "int", False, 1), ("z", "string", True, 2)]
    assert t.insert_columns(spark.table("some_view"), ["z"]) == ["x.y"]


def test_jdbc_options():
    options = t.jdbc_options("jdbc:x", "s.t", split=("id", 0, 100, 8))
    assert options["fetchsize"] == "500000" and options["batchsize"] == "50000" and options["numPartitions"] == "8"


def test_append_by_day(spark, tmp_path):
    path = str(tmp_path / "log")
    for day in ("2026-01-01", "2026-01-02"):
        t.append_rows(frame(spark, 1).selectExpr("k", f"date'{day}' AS d"), path, ["d"])
    assert spark.read.parquet(path).count() == 2
