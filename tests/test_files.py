import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.helpers import rows
from tidemark.sources import files as f


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_all_columns_are_text_and_na_tokens_null(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a.b,c d,e\n001,"x, ""y""",NA\n,nan, z \n')
    frame = f.read_text_export(spark, path)
    assert frame.dtypes == [("a.b", "string"), ("c d", "string"), ("e", "string")]
    assert rows(frame) == sorted([("001", 'x, "y"', None), (None, None, " z ")], key=repr)


def test_row_lengths(spark, tmp_path):
    short = write(tmp_path / "a.csv", "a,b\n1\n2,x\n\n3,\n")
    assert rows(f.read_text_export(spark, short)) == sorted([("1", None), ("2", "x"), ("3", None)], key=repr)
    long = f.read_text_export(spark, write(tmp_path / "b.csv", "a,b\n1,2\n4,5,6\n"))
    for frame in (long, long.select("a"), long.selectExpr("count(*)")):
        with pytest.raises(PySparkException, match="more than 2 values, from: 6"):
            frame.collect()
    banner = write(tmp_path / "c.csv", "one,two,three\nfour,five,six,seven\na,b\n1,2\n")
    assert rows(f.read_text_export(spark, banner, skip_rows=2)) == [("1", "2")]


def test_quoted_line_breaks(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'a,b\n1,"two\nlines"\n')
    assert rows(f.read_text_export(spark, path, options={"multiLine": "true"})) == [("1", "two\nlines")]


def test_banner_rows_are_skipped_even_when_data_repeats_them(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'Report of, the day\nid,"na,me"\n1,a\nid,"na,me"\nReport of, the day\n')
    frame = f.read_text_export(spark, path, skip_rows=1)
    assert frame.columns == ["id", "na,me"]
    assert rows(frame) == [("1", "a"), ("Report of", " the day"), ("id", "na,me")]
    two = write(tmp_path / "b.csv", "one\ntwo\nid,v\n1,a\n")
    assert rows(f.read_text_export(spark, two, skip_rows=2)) == [("1", "a")]
    blank = write(tmp_path / "d.csv", "one\n\nid,v\n1,a\n2,b\n")
    assert rows(f.read_text_export(spark, blank, skip_rows=2)) == [("1", "a"), ("2", "b")]
    with pytest.raises(ValueError, match="no header"):
        f.read_text_export(spark, write(tmp_path / "c.csv", "one\n"), skip_rows=2)


def test_banner_over_many_blocks(spark, tmp_path):
    lines = "".join(f"{i},v{i}\n" for i in range(20000))
    path = write(tmp_path / "big.csv", "banner\nid,v\n" + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        frame = f.read_text_export(spark, path, skip_rows=1, with_order=True)
        assert frame.rdd.getNumPartitions() > 4
        ordered = frame.orderBy(f.FILE_ORDER).select("id").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert [int(row.id) for row in ordered] == list(range(20000))


def test_values_far_beyond_the_header_stop_the_job(spark, tmp_path):
    for text in ("a,b\n1,2,,x\n", "a,b\n1,2,,\n"):
        with pytest.raises(Exception, match="MALFORMED_CSV_RECORD"):
            f.read_text_export(spark, write(tmp_path / "a.csv", text)).collect()
    assert rows(f.read_text_export(spark, write(tmp_path / "a.csv", "a,b\n1,2,\n3\n"))) == [("1", "2"), ("3", None)]


def test_headers_after_rename_and_drop(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b,c\n1,2,3\n")
    assert f.source_headers(spark, path, rename={"a": "x.y"}, drop=["c"]) == ["x.y", "b"]


def test_pick_file_and_listing(spark, tmp_path):
    for age, name in ((30, "in_1.csv"), (10, "in_2.csv"), (20, "other.csv")):
        write(tmp_path / name, "a\n")
        stamp = 1_700_000_000 - age
        os.utime(tmp_path / name, (stamp, stamp))
    assert f.pick_file(spark, str(tmp_path), "in_*.csv").endswith("in_2.csv")
    assert f.pick_file(spark, str(tmp_path), "in_*.csv", pick_latest=False).endswith("in_1.csv")
    assert f.list_files(spark, str(tmp_path)).count() == 3
    with pytest.raises(FileNotFoundError, match="No files matched"):
        f.pick_file(spark, str(tmp_path), "zz*.csv")


def test_listing_does_not_read_contents(spark, tmp_path):
    write(tmp_path / "a.csv", "a\n")
    from tests.helpers import plan

    text = plan(f.list_files(spark, str(tmp_path)))
    assert "content" not in text.split("ReadSchema:")[1].splitlines()[0]


def test_missing_inputs(spark, tmp_path):
    import datetime as dt

    write(tmp_path / "main.csv", "a\n")
    os.utime(tmp_path / "main.csv", (1_700_000_000, 1_700_000_000))
    inputs = [("main", str(tmp_path), "main*.csv"), ("fd3", str(tmp_path), "fd3*.csv"), ("fd5", str(tmp_path / "no"), "*.csv")]
    assert f.missing_inputs(spark, inputs) == ["fd3", "fd5"]
    assert f.missing_inputs(spark, inputs[:1]) == []
    assert f.missing_inputs(spark, inputs[:1], since=dt.datetime(2026, 1, 1)) == ["main"]
    assert f.missing_inputs(spark, []) == []


def test_only_asked_columns_are_parsed(spark, tmp_path):
    from tests.helpers import plan

    path = write(tmp_path / "a.csv", "a,b,c\n1,2,3\n")
    text = plan(f.read_text_export(spark, path).select(F.col("b")))
    assert "ReadSchema: struct<b:string,_beyond_header:string>" in text
