import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows, values
from tidemark.functions import health_text as ht
from tidemark.functions import text


def texts(spark, *items):
    return spark.createDataFrame([(item,) for item in items], "c string").coalesce(1)


def test_pipe_part(spark):
    frame = texts(spark, "|||620621||", "a|b", "", None)
    assert values(frame.select(text.pipe_part(F.col("c"), 3))) == ["620621", "", "", ""]
    assert values(frame.select(text.pipe_part(F.col("c"), 0))) == ["", "a", "", ""]


def test_strip_leading_zeros(spark):
    frame = texts(spark, "000123", " 0450 ", "0000", "nan", None, "12")
    assert values(frame.select(text.strip_leading_zeros(F.col("c")))) == ["123", "450", "", "", "", "12"]


def test_last_token_and_dashes(spark):
    frame = texts(spark, "9.6700 BX", "BX", "BX ", None, "1 - EXAMPLE, LTD", "a - - b")
    assert values(frame.select(text.last_token(F.col("c")))) == ["BX", "BX", "", "", "LTD", "b"]
    assert values(frame.select(text.before_dash(F.col("c")))) == ["9.6700 BX", "BX", "BX", "nan", "1", "a"]
    assert values(frame.select(text.after_dash(F.col("c")))) == [
        item.split(" - ")[-1] for item in ("9.6700 BX", "BX", "BX ", "nan", "1 - EXAMPLE, LTD", "a - - b")
    ]


def test_periods(spark):
    frame = spark.createDataFrame([(dt.date(1900, 1, 1),), (dt.date(2026, 12, 5),)], "c date").coalesce(1)
    assert rows(frame.select(text.year_of(F.col("c")), text.year_month_of(F.col("c")), text.quarter_of(F.col("c")))) == [
        ("1900", "1900-01", "Q1"),
        ("2026", "2026-12", "Q4"),
    ]


def test_flags_and_bounds(spark):
    frame = texts(spark, "True", "true", None, "x" * 41, "x" * 40)
    assert values(frame.select(text.flag_of(F.col("c")))) == [1, 0, 0, 0, 0]
    assert values(frame.select(text.blank_if_longer(F.col("c")))) == ["True", "true", "", "", "x" * 40]
    assert values(frame.select(text.stringify(F.col("c"))))[2] == "NA"
    truthy = texts(spark, "1", " Yes", "TRUE", "y", "no", "", None)
    assert values(truthy.select(text.is_truthy(F.col("c")))) == [True] * 4 + [False] * 3


def test_cutting(spark):
    frame = texts(spark, "  a \t\n b  ", "x" * 12, None)
    assert values(frame.select(text.one_line(F.col("c"), 10))) == ["a b", "x" * 9 + "…", None]
    assert values(frame.select(text.fit_width(F.col("c"), 12))) == ["  a \t\n b  ", "x" * 12, None]


@pytest.mark.parametrize(
    "message, code",
    [
        (None, None),
        ("", None),
        (" Staging load failed ", "STAGING LOAD FAILED"),
        ("the staging load failed badly", "See Log"),
        ("no files matched in Downloads for input(s): fd3, fd5\nTraceback", "FILE NOT FOUND: expected file(s) fd3, fd5 missing"),
        ("FileNotFoundError: x.csv", "FILE NOT FOUND"),
        ("no files matched for input(s):  ", "FILE NOT FOUND"),
        ("source file is missing expected columns: ['a']", "COLUMN NOT FOUND"),
        ("Invalid object name 'x'", "TABLE NOT FOUND"),
        ("Cannot find the object", "TABLE NOT FOUND"),
        ("PARTIAL STAGING LOAD: Violation of PRIMARY KEY constraint", "PK VIOLATION"),
        ("failed pk_check", "PK VIOLATION"),
        ("Violation of UNIQUE KEY constraint", "UX VIOLATION"),
        ("String or binary data would be truncated", "FIELD TRUNCATE"),
        ("PARTIAL STAGING LOAD: stopped", "PARTIAL STAGING LOAD"),
        ("timeout", "See Log"),
    ],
)
def test_error_codes(spark, message, code):
    assert values(texts(spark, message).select(ht.classify_error(F.col("c")))) == [code]


def test_step_and_process_errors(spark):
    one = texts(spark, "x")
    notes = F.array(F.lit("a"), F.lit(None).cast("string"), F.lit("b"))
    assert values(one.select(ht.step_error(F.lit("SUCCESS"), F.lit(None), notes))) == ["a; b"]
    assert values(one.select(ht.step_error(F.lit("SUCCESS"), F.lit(None), F.array(F.lit(""))))) == [None]
    assert values(one.select(ht.step_error(F.lit("FAILED"), F.lit("pk_check"), notes))) == ["PK VIOLATION"]
    unmet = F.array(F.lit("A: no health row"), F.lit("B: FAILED on s/STG"))
    blocked = ht.process_error(F.lit("BLOCKED"), F.lit(None), unmet, F.lit(None).cast("string"))
    assert values(one.select(blocked)) == ["BLOCKED: requires A: no health row; B: FAILED on s/STG"]


def test_object_names(spark):
    frame = texts(spark, "EXEC [PLM].[usp_Run]", "execute own.job @a=1", "exec job(1)", "SELECT 1", "exec ;")
    assert values(frame.select(ht.exec_object(F.col("c")))) == ["[PLM].[usp_Run]", "own.job", "job", None, None]
    frame = texts(spark, "job", "[own].[job]", "db2.own.job", "srv.db2.own.job", "", "a]b")
    assert values(frame.select(ht.qualified_object(F.col("c"), F.lit("db"), F.lit(None).cast("string")))) == [
        "[db].[dbo].[job]", "[db].[own].[job]", "[db2].[own].[job]", "[db2].[own].[job]", "", "[db].[dbo].[a]]b]",
    ]


def test_staging_names_and_labels(spark):
    one = texts(spark, "x")
    none = F.lit(None).cast("array<string>")
    assert values(one.select(ht.staging_names(F.lit("t"), F.lit("t"), none))) == ["Not Applicable"]
    assert values(one.select(ht.staging_names(F.lit("p"), F.lit("t"), F.array(F.lit("u"))))) == ["t; u"]
    frame = texts(spark, "s1", "s9", None, "")
    assert values(frame.select(ht.connection_label(F.col("c"), {"s1": "Main"}))) == ["Main", "s9", "—", "—"]
