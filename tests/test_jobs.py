"""Search terms, trailing archive and back-fill."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import plan, rows
from tidemark.operators.archive import daily_rows, rearchive, window_dates, write_archive
from tidemark.operators.backfill import copy_prod_table, copy_table, copyable_tables, shared_columns
from tidemark.operators.search_terms import search_terms, term_sets
from tidemark.plans.spec import Destination, LoadSpec, Promotion, SourceFile, TableRef
from tidemark.sources.tables import PartitionedTable, Table, open_table

VIEW = "`Item Group` string, Item string, RefSearch string, ItemSearch string, Date string, o int"


def test_search_terms(spark):
    view = spark.createDataFrame(
        [
            ("g", "i1", "r2", "t1", "d", 0), ("g", "i1", "r1", "t2", "d", 1), ("g", "i2", "r2", "t3", "d", 2),
            (None, "i3", "r9", "t4", "d", 3), (None, "i3", "r8", "t4", "d", 4), ("h", "i3", "r7", "t5", "d", 5),
        ],
        VIEW,
    ).repartition(4)
    assert rows(search_terms(view, F.col("o"))) == sorted(
        [
            ("i1", "r2|r1", "t1|t2", "d"), ("i2", "r2|r1", "t3", "d"),
            ("i3", "r9|r8|r7", "t4|t5", "d"), ("i3", "r7", "t4|t5", "d"),
        ]
    )


def test_a_null_term_stops_the_job(spark):
    view = spark.createDataFrame([("g", "i", None, "t", "d", 0)], VIEW)
    with pytest.raises(PySparkException, match="search term is NULL"):
        search_terms(view, F.col("o")).collect()
    with pytest.raises(ValueError, match="lacks column"):
        search_terms(view.drop("Date"), F.col("o"))


def test_the_view_is_scanned_once(spark, tmp_path):
    view = spark.createDataFrame([("g", "i1", "r2", "t1", "d", 0), (None, None, "r1", "t2", "d", 1), (None, None, "r1", "t2", None, 2)], VIEW)
    view.write.parquet(str(tmp_path / "view"))
    stored = spark.read.parquet(str(tmp_path / "view"))
    text = plan(term_sets(stored, F.col("o")))
    assert text.count("FileScan") == 1 and text.count("Expand") == 1 and text.count("Exchange") == 1
    assert "/view" not in plan(search_terms(stored, F.col("o")))
    assert rows(search_terms(stored, F.col("o"))) == sorted([("i1", "r2", "t1", "d"), (None, None, None, "d"), (None, None, None, None)], key=repr)


def events(spark, *items):
    rows_ = [(n, dt.datetime.fromisoformat(stamp)) for n, stamp in items]
    return spark.createDataFrame(rows_, "n int, ts timestamp_ntz")


def test_window_dates():
    assert window_dates(dt.date(2026, 3, 2), 2) == [dt.date(2026, 2, 28), dt.date(2026, 3, 1), dt.date(2026, 3, 2)]
    with pytest.raises(ValueError):
        window_dates(dt.date(2026, 3, 2), -1)


def test_archive_is_idempotent_and_takes_late_rows(spark, tmp_path):
    path, end = str(tmp_path / "a"), dt.date(2026, 3, 3)
    first = events(spark, (1, "2026-03-01T10:00:00"), (2, "2026-03-03T00:00:00"), (9, "2026-02-01T00:00:00"))
    assert write_archive(first, "ts", path, end, 2) == {dt.date(2026, 3, 1): 1, dt.date(2026, 3, 2): 0, dt.date(2026, 3, 3): 1}
    write_archive(first, "ts", path, end, 2)
    assert rows(PartitionedTable(spark, path, ["ArchiveDate"]).read(), "n") == [(1,), (2,)]
    later = events(spark, (3, "2026-03-02T23:59:59.999"), (4, "2026-03-04T00:00:00"))
    write_archive(later, "ts", path, end, 1)
    # The 3rd has no rows any more; the 1st is outside the window.
    assert rows(PartitionedTable(spark, path, ["ArchiveDate"]).read(), "n") == [(1,), (3,)]


def test_rearchive_as_frames(spark):
    source = events(spark, (1, "2026-03-01T10:00:00"), (2, "2026-03-03T00:00:00"))
    once = rearchive(None, source, "ts", dt.date(2026, 3, 3), 2)
    assert rows(rearchive(once, source, "ts", dt.date(2026, 3, 3), 2)) == rows(once)


def test_archive_window_reaches_the_scan(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    text = plan(daily_rows(frame, "ts", dt.date(2024, 1, 2), dt.date(2024, 1, 3)))
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


@pytest.fixture
def pair(spark, tmp_path):
    source, target = Table(spark, str(tmp_path / "a")), Table(spark, str(tmp_path / "b"))
    source.overwrite(spark.createDataFrame([(1, "x", 2.0)], "id int, name string, gone double"))
    target.overwrite(spark.createDataFrame([], "name string, extra int, id long"))
    return source, target


def test_copy_when_empty(pair):
    source, target = pair
    assert copy_table(source, target, dry_run=True).status == "DRY_RUN" and target.count() == 0
    assert copy_table(source, target, confirm=lambda message: False).status == "ABORTED" and target.count() == 0
    done = copy_table(source, target)
    assert (done.status, done.rows_copied, done.copy_columns) == ("COPIED", 1, ["name", "id"])
    assert rows(target.read()) == [("x", None, 1)]
    again = copy_table(source, target)
    assert (again.status, again.target_rows_before) == ("SKIPPED_NONEMPTY", 1)
    forced = copy_table(source, target, truncate=True)
    assert (forced.status, forced.rows_truncated) == ("COPIED", 1) and target.count() == 1


def test_copy_checks(pair):
    with pytest.raises(ValueError, match="share no column"):
        shared_columns(["a"], ["b"])


def test_copy_between_destinations(spark, tmp_path):
    def side(name, **extra):
        return Destination(name, TableRef(str(tmp_path / f"{name}s")), TableRef(str(tmp_path / name)), **extra)

    one = side("des1", aux_prod={"stat": TableRef(str(tmp_path / "x1"))})
    two = side("des2", aux_prod={"stat": TableRef(str(tmp_path / "x2"))})
    spec = LoadSpec("l", "L", (SourceFile("f", "*"),), (one, two), promotions=(Promotion("stat"),))
    assert copyable_tables(spec) == ["main", "stat"]
    Table(spark, one.prod.path).overwrite(spark.createDataFrame([(1,)], "k int"))
    Table(spark, two.prod.path).overwrite(spark.createDataFrame([], "k int"))
    assert copy_prod_table(spark, spec).status == "COPIED"
    with pytest.raises(ValueError, match="onto itself"):
        copy_prod_table(spark, spec, target="des1")
    with pytest.raises(ValueError, match="no prod table"):
        copy_prod_table(spark, spec, table="zz")
    with pytest.raises(ValueError, match="no destination des9"):
        copy_prod_table(spark, spec, target="des9")


ODD_FLAGS = ["", None, "01", "1", "x"]


def flagged(spark, n=100, extra="id long, flag string, note string"):
    return spark.createDataFrame([(k, ODD_FLAGS[k % 5], f"n{k}") for k in range(n)], extra)


@pytest.mark.parametrize(("origin_by", "goal_by"), [(["flag"], []), ([], ["flag"]), (["flag"], ["flag"]), (["flag"], ["id"]), ([], [])])
def test_copy_between_layouts_keeps_every_row(spark, tmp_path, origin_by, goal_by):
    frame = flagged(spark, 50)
    origin = open_table(spark, str(tmp_path / "a"), origin_by)
    goal = open_table(spark, str(tmp_path / "b"), goal_by)
    origin.overwrite(frame)
    goal.overwrite(spark.createDataFrame([], "flag string, extra int, id long"))
    wanted = sorted([(flag, None, k) for k, flag, _ in frame.collect()], key=str)
    assert copy_table(origin, goal, dry_run=True).status == "DRY_RUN" and goal.count() == 0
    assert copy_table(origin, goal, confirm=lambda message: "50 rows" not in message).status == "ABORTED"
    done = copy_table(origin, goal)
    assert (done.status, done.source_rows, done.rows_copied) == ("COPIED", 50, 50)
    assert sorted(map(tuple, goal.read().collect()), key=str) == wanted and goal.count() == 50
    assert copy_table(origin, goal).status == "SKIPPED_NONEMPTY"
    origin.overwrite(frame.where("id < 7"))
    forced = copy_table(origin, goal, truncate=True)
    assert (forced.status, forced.rows_copied, forced.rows_truncated) == ("COPIED", 7, 50)
    assert sorted(map(tuple, goal.read().collect()), key=str) == [row for row in wanted if row[2] < 7]


@pytest.mark.parametrize("origin_by", [["flag"], []])
def test_gaps_are_filled_partition_by_partition(spark, tmp_path, origin_by):
    origin, goal = open_table(spark, str(tmp_path / "a"), origin_by), open_table(spark, str(tmp_path / "b"), ["flag"])
    origin.overwrite(flagged(spark))
    kept = spark.createDataFrame([("x", -1), (None, -2)], "flag string, id long")
    goal.overwrite(kept)
    planned = copy_table(origin, goal, fill_gaps=True, dry_run=True)
    assert planned.status == "DRY_RUN" and len(planned.partitions) == 3
    log = len(spark.read.parquet(f"{goal.path}/commits").select("version").distinct().collect())
    done = copy_table(origin, goal, fill_gaps=True)
    assert (done.status, done.rows_copied, done.target_rows_before, done.partitions) == ("COPIED", 60, 2, planned.partitions)
    got = goal.read().collect()
    assert {r.id for r in got if r.flag in ("x", None)} == {-1, -2} and len(got) == 62
    assert len(spark.read.parquet(f"{goal.path}/commits").select("version").distinct().collect()) == log + 1
    assert copy_table(origin, goal, fill_gaps=True).status == "SKIPPED_NONEMPTY"
    with pytest.raises(ValueError, match="not both"):
        copy_table(origin, goal, fill_gaps=True, truncate=True)
    with pytest.raises(ValueError, match="no gaps"):
        copy_table(goal, Table(spark, str(tmp_path / "c")) if Table(spark, str(tmp_path / "c")).overwrite(kept) else None, fill_gaps=True)


def test_gaps_of_tables_kept_alike_read_only_their_folders(spark, tmp_path, monkeypatch):
    origin, goal = (open_table(spark, str(tmp_path / name), ["flag"]) for name in "ab")
    origin.overwrite(flagged(spark))
    goal.overwrite(flagged(spark).where("flag = 'x'"))
    asked = []
    monkeypatch.setattr(type(goal), "count_parts", lambda *a: pytest.fail("counted what the commit rows tell"))
    read = type(origin).read
    monkeypatch.setattr(type(origin), "read", lambda self, parts=None: asked.append((self.path, parts)) or read(self, parts))
    done = copy_table(origin, goal, fill_gaps=True)
    assert done.rows_copied == 80 and (origin.path, done.partitions) in asked


def test_a_target_filled_meanwhile_is_left(spark, tmp_path):
    for by in ([], ["flag"]):
        origin, goal = open_table(spark, str(tmp_path / f"a{len(by)}"), by), open_table(spark, str(tmp_path / f"b{len(by)}"), by)
        origin.overwrite(flagged(spark))
        goal.overwrite(spark.createDataFrame([], "id long, flag string"))

        def other(message):
            open_table(spark, goal.path, by).overwrite(spark.createDataFrame([(5, "x")], "id long, flag string"))
            return True

        assert copy_table(origin, goal, confirm=other).status == "SKIPPED_NONEMPTY"
        assert [tuple(r) for r in goal.read().collect()] == [(5, "x")]


def test_copy_of_a_partitioned_production_table(spark, tmp_path):
    def side(name, by):
        return Destination(name, TableRef(str(tmp_path / f"{name}s")), TableRef(str(tmp_path / name), partition_by=by))

    spec = LoadSpec("l", "L", (SourceFile("f", "*"),), (side("des1", ("flag",)), side("des2", ("flag",))))
    open_table(spark, spec.destinations[0].prod.path, ("flag",)).overwrite(flagged(spark))
    open_table(spark, spec.destinations[1].prod.path, ("flag",)).overwrite(flagged(spark, 0))
    done = copy_prod_table(spark, spec)
    assert (done.status, done.source_rows, done.rows_copied) == ("COPIED", 100, 100)
    assert open_table(spark, spec.destinations[1].prod.path, ("flag",)).count() == 100
