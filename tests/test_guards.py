import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from tidemark.operators import guards as g


def test_duplicate_keys_count_null_as_equal(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("b", None), ("b", None), ("c", 1), ("A", 1)], "k string, n int")
    assert [tuple(r) for r in g.duplicate_sample(frame, ["k", "n"]).collect()] == [("b", None, 3), ("a", 1, 2)]
    with pytest.raises(g.GuardError, match="pk_check"):
        g.check_keys(frame, ["k", "n"])
    assert "pk_check" in g.check_keys(frame, ["k", "n"], fail=False)
    assert g.check_keys(frame.distinct(), ["k", "n"]) is None
    assert g.check_keys(frame, []) is None
    with pytest.raises(ValueError, match="the frame lacks"):
        g.check_keys(frame, ["zz"])


def test_duplicate_sample_is_the_top_twenty(spark):
    frame = spark.range(60).selectExpr("id % 30 AS k")
    assert g.duplicate_sample(frame, ["k"]).count() == 20


@pytest.fixture
def stamps(spark):
    def make(*days):
        return spark.createDataFrame([(day,) for day in days], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))

    return make


@pytest.mark.parametrize(
    "source, base, empty_ok, outcome, passed",
    [
        (["2026-01-02", "2026-01-05"], ["2026-01-02"], True, "overlap", True),
        (["2026-01-03"], ["2026-01-02"], True, "gap", False),
        ([None], ["2026-01-02"], True, "no source values", False),
        (["2026-01-03"], [None], True, "baseline empty", True),
        (["2026-01-03"], [None], False, "baseline empty", False),
        (["1900-01-01", "2026-01-05"], ["2026-01-02"], True, "overlap", True),
    ],
)
def test_overlap(stamps, source, base, empty_ok, outcome, passed):
    row = g.overlap(stamps(*source), stamps(*base), "t", "t", skip_if_empty=empty_ok).first()
    assert (row.outcome, row.passed) == (outcome, passed)


def test_overlap_can_ignore_blank_stamps_and_missing_tables(stamps):
    blank = F.lit("1900-01-01").cast("timestamp_ntz")
    row = g.overlap(stamps("1900-01-01", "2026-01-05"), stamps("2026-01-02"), "t", "t", ignore=blank).first()
    assert row.outcome == "gap"
    assert g.overlap(stamps("2026-01-05"), None, "t", "t").first().passed
    with pytest.raises(ValueError, match="not in the source"):
        g.overlap(stamps("2026-01-05"), None, "zz", "t")


def test_overlap_modes(stamps):
    bad = g.overlap(stamps("2026-01-03"), stamps("2026-01-02"), "t", "t")
    with pytest.raises(g.GuardError, match="Overlap check FAILED"):
        g.check_overlap("des1", "enforce", bad)
    assert "FAILED" in g.check_overlap("des1", "warn", bad)
    assert g.check_overlap("des1", "skip", bad) is None


def test_overflow_counts(spark):
    frame = spark.createDataFrame([("abc", "x"), ("ab", None)], "a string, b string")
    got = g.overflow_counts(frame, {"a": "varchar(2)", "b": "varchar(1)", "c": "int", "d": "varchar(max)"})
    assert rows(got) == [("a", 2, 1), ("b", 1, 0)]


def test_unmapped(spark):
    frame = spark.createDataFrame([("1",), ("1",), ("2",), (None,)], "`Co.` string")
    mapping = spark.createDataFrame([("1", "x"), ("2", None)], "`Co.` string, v string")
    assert rows(g.unmapped(frame, "Co.", mapping, ["Co.", "v"])) == [("2",), (None,)]


def test_missing_columns():
    assert g.missing_columns(["a", "b"], ["a"], ["b"]) is None
    assert "COLUMN NOT FOUND (warning)" in g.missing_columns(["a"], ["a"], ["b"])
    with pytest.raises(g.GuardError, match="missing expected columns"):
        g.missing_columns(["a"], ["z"])


def test_unread_shapes(spark):
    frame = spark.createDataFrame(
        [("1/2/2026", "2026.01.02"), ("31/31/2026", "2026.01.03"), (None, "soon"), ("20260102", None)], "`Order.Date` string, due string"
    )
    got = rows(g.unread_shapes(frame, ["Order.Date", "due"]))
    assert got == [("Order.Date", "9/9/Y", 1, "31/31/2026"), ("due", "N", 1, "soon"), ("due", "Y.9.9", 2, "2026.01.02")]
