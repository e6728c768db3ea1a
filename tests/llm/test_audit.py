"""Filter audit against applying every order to every document."""

import re
from itertools import permutations

import duckdb

import __spark_entry__ as entry_points
from tests.llm.conftest import SF
from tidemark.llm.filter_audit import FILTERS, audit_filters, failures, removals

COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def fails(rows):
    """The letters that each document fails, by the contract's words."""
    first = {}
    for doc, _, text in rows:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    found = []
    for doc, source, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found.append((doc, source or "", {
            letter for letter, failed in zip("ABCDE", (
                len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                re.search("[#$%&*|]", text), doc is not None and doc > first[text],
            )) if failed
        }))
    return found


def plain_audit(rows, labels):
    good = {doc for doc, quality, _ in labels if quality == 1 and doc is not None}
    toxic = {doc for doc, _, mark in labels if mark == 1 and doc is not None}
    judged, result = fails(rows), []
    for part in {source for _, source, _ in judged}:
        docs = [(doc, letters) for doc, source, letters in judged if source == part]
        shares = dict.fromkeys("ABCDE", 0)
        steps = []
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, letter in enumerate(order, 1):
                gone = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                shares[letter] += len(gone)
                redundant = sum(letter in d[1] for d in docs) - len(gone)
                alone = sum(d[1] == {letter} for d in docs)
                steps.append((part, order, step, len(left), len(gone), redundant, alone, sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone), letter))
        result += [(*s[:-1], shares[s[-1]]) for s in steps]
    return sorted(result)


def as_rows(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


def test_query_against_sql(spark):
    duck = duckdb.connect()
    for name in ("documents", "labels"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    sql = duck.execute(entry_points.oracle_sql()["op11_filter_audit"]).fetchdf()[COLUMNS]
    got = as_rows(entry_points.queries()["op11_filter_audit"](spark, SF))
    assert got == sorted(map(tuple, sql.itertuples(index=False))) and len(got) % 600 == 0


def test_awkward_documents(spark, awkward, nothing):
    sources = ["s", None, "", "s2"]
    rows = [(r.doc_id, sources[k % 4], r.text) for k, r in enumerate(awkward.collect())] + [(40, "s", "same words same words"), (40, "s2", "same words same words"), (41, "s", None), (42, "s", "ONE " * 70)]
    frame = spark.createDataFrame([(*row, "mask", 1, True) for row in rows], "doc_id long, source string, text string, mask string, docs int, same boolean")
    labels = [(40, 1, 0), (40, 0, 1), (None, 1, 1), (3, 1, 1), (5, None, 1), (99, 1, 1), (42, 1, None)]
    marked = spark.createDataFrame([(*row, "part") for row in labels], "doc_id long, quality int, toxic int, part string")
    assert as_rows(audit_filters(frame, marked)) == plain_audit(rows, labels)
    assert audit_filters(nothing, marked).count() == 0
    assert as_rows(audit_filters(frame, marked.where("false"))) == plain_audit(rows, [])


def test_one_text_a_third_of_all_rows(spark):
    frame = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'copy', concat('text ', id)) as text", "'s' as source")
    masks = failures(frame).groupBy("mask").count().collect()
    assert {r["mask"]: r["count"] for r in masks} == {0b00001: 2001, 0b10001: 999}


def test_two_filters_by_hand(spark):
    counted = spark.createDataFrame([("p", 0, 1, 1, 0), ("p", 1, 4, 1, 1), ("p", 2, 6, 0, 2), ("p", 3, 10, 3, 0)], "part string, mask int, docs long, good long, toxic long")
    got = {(r.filter_order, r.step): tuple(r[3:]) for r in removals(counted, "XY").collect()}
    # X removes 14 first and 4 second, Y 16 and 6.
    assert got == {
        ("XY", 1): (7, 14, 0, 4, 4, 1, 18), ("XY", 2): (1, 6, 10, 6, 0, 2, 22),
        ("YX", 1): (5, 16, 0, 6, 3, 2, 22), ("YX", 2): (1, 4, 10, 4, 1, 1, 18),
    }
    assert list(FILTERS) == ["A", "B", "C", "D"]
