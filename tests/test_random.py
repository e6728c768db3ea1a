"""Operators against plain Python on random rows, with repeats, NULLs and one hot key."""

import random

import pytest
from pyspark.sql import functions as F

from tests.helpers import rows
from tidemark.operators import promote as pr
from tidemark.operators.search_terms import search_terms
from tidemark.operators.transforms import dedup_keep_first, keep_first

SCHEMA = "h string, n int, v int, q int"


def random_rows(seed, count, unique):
    rng = random.Random(seed)
    made = {}
    for place in range(count):
        header = "hot" if rng.random() < 0.34 else rng.choice(["a", "b", "c", "d", "e", None])
        row = (header, rng.choice([None, *range(8 if header != "hot" else 40)]), rng.randrange(3), rng.randrange(50))
        made[row[:2] if unique else place] = row
    return list(made.values())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_promotions(spark, seed):
    old, new = random_rows(seed, 120, True), random_rows(seed + 100, 60, True)
    prod, stg = spark.createDataFrame(old, SCHEMA), spark.createDataFrame(new, SCHEMA)

    def model(width):
        gone = {width(row) for row in new}
        return sorted([row for row in old if width(row) not in gone] + new, key=repr)

    options = dict(keys=["h", "n"], header_key=["h"], stamps=["v"])
    expected = {
        "pk_merge": model(lambda r: r[:2]),
        "pk_delete_insert": model(lambda r: r[:2]),
        "pk_delete_insert_on_header": model(lambda r: r[:1]),
        "versioned_delete_insert": model(lambda r: r[:3]),
        "truncate_insert": sorted(new, key=repr),
    }
    for strategy, want in expected.items():
        assert rows(pr.promote(prod, stg, strategy, **options)) == want, strategy

    by_key, was = {row[:2]: row for row in new}, {row[:2] for row in old}
    life = pr.lifecycle_merge(
        prod.withColumns({"ErrorStatus": F.lit("New"), "LastUpdate": F.lit(1)}), stg, ["h", "n"], F.lit(2)
    )
    want = [(*by_key.get(row[:2], row), "Persisting" if row[:2] in by_key else "Resolved", 2) for row in old]
    want += [(*row, "New", 2) for row in new if row[:2] not in was]
    assert rows(life) == sorted(want, key=repr)

    guarded = pr.guarded_merge(prod, stg, ["h", "n"], ["q"], "s.v > p.v")
    want = [
        (*row[:3], by_key[row[:2]][3] if row[:2] in by_key and by_key[row[:2]][2] > row[2] else row[3]) for row in old
    ]
    assert rows(guarded) == sorted(want, key=repr)


@pytest.mark.parametrize("seed", [4, 5])
def test_keep_first(spark, seed):
    data = [(*row, place) for place, row in enumerate(random_rows(seed, 300, False))]
    frame = spark.createDataFrame(data, SCHEMA + ", _file_order int").repartition(5)
    best = {}
    for row in sorted(data, key=lambda r: (r[2], -r[3], r[4])):
        best.setdefault(row[:2], row)
    assert rows(keep_first(frame, ["h", "n"], [("v", "asc"), ("q", "desc")])) == sorted(best.values(), key=repr)
    options = {"dedup": {"keys": ["h", "n"], "order_by": [{"column": "v"}, {"column": "q", "direction": "DESC "}]}}
    assert rows(dedup_keep_first(frame, options, {}, None)) == sorted(best.values(), key=repr)


@pytest.mark.parametrize("seed", [6, 7])
def test_search_terms(spark, seed):
    rng = random.Random(seed)
    data = [
        ("hot" if rng.random() < 0.34 else rng.choice(["g", "h", None]), rng.choice("ijk"), rng.choice("rstu") * 2, rng.choice("xyz"), rng.choice(["d1", "d2"]), place)
        for place in range(150)
    ]
    view = spark.createDataFrame(data, "`Item Group` string, Item string, RefSearch string, ItemSearch string, Date string, o int").repartition(4)

    def joined(key, term):
        found = {}
        for row in data:
            found.setdefault(row[key], {}).setdefault(row[term])
        return {name: "|".join(terms) for name, terms in found.items()}

    by_group, by_item, items = joined(0, 2), joined(1, 2), joined(1, 3)
    want = {(r[1], by_group[r[0]] if r[0] is not None else by_item[r[1]], items[r[1]], r[4]) for r in data}
    assert rows(search_terms(view, F.col("o"))) == sorted(want)
