import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import values
from tidemark.functions import typing as ty

SENTINEL = dt.datetime(1900, 1, 1)
STAMP = "%m/%d/%Y %I:%M:%S %p"


def texts(spark, *items):
    return spark.createDataFrame([(item,) for item in items], "c string").coalesce(1)


def test_pattern_of_format():
    assert ty.spark_pattern(STAMP) == "M/d/yyyy h:m:s a"
    assert ty.spark_pattern("%Y%m%d") == "yyyyMMdd"
    assert ty.spark_pattern("%Y-%m-%dT%H") == "yyyy-M-d'T'H"
    with pytest.raises(ValueError):
        ty.spark_pattern("%q")


def test_datetime_by_format(spark):
    frame = texts(spark, "05/29/2026 02:36:28 PM", "5/9/2026 2:36:28 am", "05/29/2026", "", None, "soon", "12/31/9999 01:00:00 AM")
    got = values(frame.select(ty.to_datetime(F.col("c"), STAMP)))
    assert got == [dt.datetime(2026, 5, 29, 14, 36, 28), dt.datetime(2026, 5, 9, 2, 36, 28)] + [SENTINEL] * 5


def test_mixed_dates(spark):
    frame = texts(spark, "20250402", "04/02/2025", "2025-04-02", "04/02/2025 11:00:00 PM", "13/40/2025", None)
    day = dt.date(2025, 4, 2)
    assert values(frame.select(ty.to_date(F.col("c")))) == [day] * 4 + [SENTINEL.date()] * 2


def test_separators_choose_the_format(spark):
    frame = texts(spark, "2025-04-02T10:00:00", "2025-04-02 10:00:00", "4/2/2025 10:00:00", "2025/04/02", "04-02-2025")
    at = dt.datetime(2025, 4, 2, 10)
    assert values(frame.select(ty.to_datetime(F.col("c")))) == [at] * 3 + [dt.datetime(2025, 4, 2)] * 2


def test_infinite_text_is_a_number(spark):
    assert values(texts(spark, "inf", "-inf").select(ty.to_float(F.col("c")))) == [float("inf"), float("-inf")]


def test_strict_date_format_rejects_other_shape(spark):
    got = values(texts(spark, "20250402", "04/02/2025").select(ty.to_date(F.col("c"), "%m/%d/%Y")))
    assert got == [SENTINEL.date(), dt.date(2025, 4, 2)]


def test_numbers(spark):
    frame = texts(spark, "1,000.0000000", " -12.75 ", None, "1e3")
    assert values(frame.select(ty.to_float(F.col("c")))) == [1000.0, -12.75, None, 1000.0]
    assert values(frame.select(ty.to_int(F.col("c")))) == [1000, -12, None, 1000]


@pytest.mark.parametrize("bad", ["12x", "", "  ", "1.5d", "2f", "1 000"])
def test_bad_number_fails_the_load(spark, bad):
    with pytest.raises(PySparkException):
        texts(spark, bad).select(ty.to_float(F.col("c"))).collect()


def test_na_tokens(spark):
    frame = texts(spark, "NA", "null", "nan", "None", "N/A", "", "na", " ", "x")
    assert values(frame.select(ty.blank_to_null("c"))) == [None] * 6 + ["na", " ", "x"]


def test_strip_is_all_whitespace(spark):
    samples = ["\t a ", "\x1cb\x1f", " c d　\n", "  "]
    got = values(texts(spark, *samples).select(ty.strip(F.col("c"))))
    assert got == [sample.strip() for sample in samples]


def test_clean_text(spark):
    frame = texts(spark, " a ", None)
    assert values(frame.select(ty.clean_text(F.col("c")))) == ["a", ""]
    assert values(frame.select(ty.clean_text(F.col("c"), keep_whitespace=True))) == [" a ", ""]


def test_table_types(spark):
    frame = texts(spark, "abc")
    assert values(frame.select(ty.fit_sql_type("c", F.col("c"), "varchar(3)"))) == ["abc"]
    with pytest.raises(PySparkException, match="would be truncated"):
        frame.select(ty.fit_sql_type("c", F.col("c"), "varchar(2)")).collect()
    assert ty.varchar_limit("varchar(max)") is None
    kinds = {"numeric(19, 4)": "decimal(19,4)", "money": "decimal(19,4)", "int": "int", "date": "date", "datetime": "timestamp_ntz"}
    for sql_type, kind in kinds.items():
        assert frame.select(ty.fit_sql_type("c", F.lit(None), sql_type).alias("x")).dtypes == [("x", kind)]
    with pytest.raises(ValueError):
        ty.fit_sql_type("c", F.col("c"), "geometry")


def test_mixed_shapes(spark):
    shapes = {
        "2025/04/02": "2025-04-02", "2025-04-02 10:00": "2025-04-02 10:00", "2025-04-02 10:00:00.123": "2025-04-02 10:00:00.123",
        "04/02/2025 10:05": "2025-04-02 10:05", "04/02/25": "2025-04-02", "04/02/99": "1999-04-02", "Apr 2, 2025": "2025-04-02",
        "April 2, 2025": "2025-04-02", "2 Apr 2025": "2025-04-02", "02-Apr-2025": "2025-04-02", "20250402": "2025-04-02",
        "04/02/2025": "2025-04-02", "04/02/2025 10:05 PM": "2025-04-02 22:05", "2025-04-02T10:00:00.5": "2025-04-02 10:00:00.5",
        "13/45/2025": "1900-01-01", "soon": "1900-01-01",
    }
    frame = spark.createDataFrame(list(shapes.items()), "given string, wanted string")
    got = frame.select("given", ty.to_datetime(F.col("given")).alias("g"), F.col("wanted").cast("timestamp_ntz").alias("w")).collect()
    assert {row.given: row.g for row in got} == {row.given: row.w for row in got}


def test_every_mixed_format_has_shapes_of_its_own():
    seen = {}
    for fmt in ty.MIXED_DATE_FORMATS:
        for shape in ty.shapes_of_format(fmt):
            seen.setdefault(shape, []).append(fmt)
    # Only "May" is the same in short and in full.
    assert {tuple(formats) for formats in seen.values() if len(formats) > 1} == {("%b %d, %Y", "%B %d, %Y"), ("%d %b %Y", "%d %B %Y")}


def test_shapes_choose_the_format(spark):
    stamp = dt.datetime(2024, 5, 7, 9, 8, 6)
    rows_ = [
        ("5/7/2024", "9/9/Y", dt.datetime(2024, 5, 7)), ("20240507", "YY", dt.datetime(2024, 5, 7)), ("May 7, 2024", "aaa 9, Y", dt.datetime(2024, 5, 7)),
        ("September 7, 2024", "NNa 9, Y", dt.datetime(2024, 9, 7)), ("05/07/2024 09:08:06 am", "9/9/Y 9:9:9 aa", stamp),
        ("2024-05-07T09:08:06", "Y-9-9a9:9:9", stamp), ("2024-05-07 09:08:06.250000", "Y-9-9 9:9:9.Y9", stamp.replace(microsecond=250000)),
        ("13/45/2024", "9/9/Y", None), ("2024.05.07", "Y.9.9", None), ("٢٠٢٤-05-07", "٢٠٢٤-9-9", None), ("", "", None), (None, None, None),
    ]
    frame = spark.createDataFrame([(k, text) for k, (text, _, _) in enumerate(rows_)], "k int, c string")
    parsed = ty.parse_stamp(F.col("c"), ty.MIXED_DATE_FORMATS)
    got = frame.select("k", ty.shape_of(F.col("c")).alias("shape"), parsed.alias("stamp")).orderBy("k").collect()
    assert [(r.shape, r.stamp) for r in got] == [(shape, stamp) for _, shape, stamp in rows_]
