import pytest

from tests.helpers import rows
from tidemark.operators import shape
from tidemark.plans.spec import MapRow, cut_to_date, mapping_rows, typed_columns


@pytest.fixture
def frame(spark):
    return spark.createDataFrame([(" 1 ", None, "x")], "`a.b` string, `c d` string, e string")


def test_rename_and_drop_take_literal_names(frame):
    assert shape.rename(frame, {"a.b": "z.z"}).columns == ["z.z", "c d", "e"]
    assert shape.drop_present(frame, ["a.b", "absent"]).columns == ["c d", "e"]


def test_require_columns(frame):
    assert shape.require_columns(frame, ["e", "a.b"]).columns == ["e", "a.b"]
    with pytest.raises(ValueError, match="frame lacks"):
        shape.require_columns(frame, ["nope"])


def test_mapping(frame):
    mapping = [
        MapRow("a.b", "A", "int", "int"),
        MapRow("c d", "C", value=None),
        MapRow(None, "N", "float", "money"),
        MapRow(None, "K", value="const"),
        MapRow("e", "E", "ignore"),
        MapRow("e", None),
    ]
    got = shape.map_columns(frame, mapping)
    assert got.dtypes == [("A", "int"), ("C", "void"), ("N", "decimal(19,4)"), ("K", "string")]
    with pytest.raises(ValueError, match="the frame lacks"):
        shape.map_columns(frame, [MapRow("nope", "X")])


def test_mapping_rows():
    mapping = mapping_rows([["s", "d", "datetime", "date", "source"], ["n", "m", "int", "int", "computed"]])
    assert typed_columns(mapping) == {"s": "datetime", "n": "int"}
    assert cut_to_date(mapping) == ["s"]
    with pytest.raises(ValueError):
        mapping_rows([["a", "b", "c"]])
    with pytest.raises(ValueError):
        mapping_rows([["s", "d", "datetime", "date", "elsewhere"]])


def test_align(frame):
    assert shape.align(frame, ["e", "a.b", "zz"], mapped=False, allow_missing=True).columns == ["e", "a.b", "zz"]
    with pytest.raises(ValueError, match="frame lacks"):
        shape.align(frame, ["e", "zz"], mapped=False)
    with pytest.raises(ValueError, match="table has no column"):
        shape.align(frame, ["e"], mapped=True)
    assert shape.align(frame.select("e"), ["zz", "e"], mapped=True).columns == ["e"]


def test_normalize_keeps_whitespace_and_passes_numbers(spark):
    frame = spark.createDataFrame([(" k ", " v ", None, None, None)], "k string, v string, n int, f double, `report stamp` string")
    got = shape.normalize(frame, {"n": "int", "f": "float"}, keep_whitespace=["k"])
    assert rows(got) == [(" k ", "v", None, None, None)]


def test_relabel(frame):
    assert shape.relabel(frame, ["x", "y", "z"]).columns == ["x", "y", "z"]
    with pytest.raises(ValueError):
        shape.relabel(frame, ["x"])


def test_mapping_template(spark):
    got = shape.mapping_template(spark, ["a", "c"], ["a", "b"])
    assert rows(got, "destination", "source", "note") == sorted(
        [("a", "a", "mapped"), ("b", None, "unmapped"), (None, "c", "ignored")], key=repr
    )


def test_generated_columns_go_on_from_the_stored_numbers(spark):
    present = spark.createDataFrame([("x", 7, 1), ("y", 41, 2)], "a string, id int, b long")
    fresh = spark.range(1000).selectExpr("concat('n', id) as a", "id as b").repartition(7)
    got = shape.generated(fresh, present, ["id"])
    assert got.columns == ["a", "id", "b"] and got.schema["id"].dataType.simpleString() == "int"
    rows_ = got.collect()
    assert sorted(r.id for r in rows_) == list(range(42, 1042)) and {(r.a, r.b) for r in rows_} == {(f"n{k}", k) for k in range(1000)}
    assert [r.id for r in shape.generated(fresh.limit(1), present.where("false"), ["id"]).collect()] == [1]
    assert shape.generated(fresh, present, []) is fresh and shape.generated(fresh.where("false"), present, ["id"]).count() == 0
