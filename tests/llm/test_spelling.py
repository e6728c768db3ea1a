"""Spelling variants against brute force."""

import re
import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry_points
from tests.llm.conftest import SF
from tidemark.llm.spelling import EVERY, count_words, cuts, gram_dictionary, group_variants, near_words, reversed_cuts, unaffected


def plain_counts(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % EVERY == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return counts


def plain_near(words):
    """Near words by taking a code point out and by replacing it."""
    masked = {}
    for word in words:
        for k in range(len(word)):
            masked.setdefault((word[:k], word[k + 1 :]), set()).add(word)
    near = {word: set() for word in words}
    for group in masked.values():
        for word in group:
            near[word] |= group - {word}
    for word in words:
        for k in range(len(word)):
            shorter = word[:k] + word[k + 1 :]
            if shorter in near:
                near[word].add(shorter)
                near[shorter].add(word)
    return near


def plain_groups(counts, times=5):
    near = plain_near(counts)
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        if best is not None and counts[best] >= times * counts[word]:
            forms[word] = best
    rows = {}
    for word in counts:
        root = word
        while root in forms:
            root = forms[root]
        rows[word] = (forms.get(word), root, counts[word], len(near[word]), counts[forms[word]] if word in forms else None)
    return rows


def as_rows(frame):
    got = frame.collect()
    assert len({r.word for r in got}) == len(got)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


def test_whole_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    counts = {w: n for w, n in plain_counts(rows).items() if len(w) >= 6 and n >= 5}
    assert len(counts) > 500
    assert as_rows(entry_points.queries()["op13_spelling_variants"](spark, SF)) == plain_groups(counts)


def test_counts_of_awkward_texts(spark, awkward):
    extra = [(7, "Straße ÉTÉ été × ÷ naïve—naïve é Ωmega Schüler schüler\x00x"), (8, "Repeated " * 3000), (None, "Missing Missing")]
    frame = awkward.select("doc_id", "text", "n_chars").unionByName(spark.createDataFrame([(i, t, 1) for i, t in extra], "doc_id long, text string, n_chars int"))
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    got = {r.word: r.n for r in count_words(frame, least_length=1).collect()}
    assert got == {w: n for w, n in plain_counts(rows).items() if w}


def test_some_words_are_misspelt(spark):
    rows = [(k, "Spelling variants group") for k in range(2000)]
    got = {r.word: r.n for r in count_words(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {w: n for w, n in plain_counts(rows).items() if len(w) >= 6} and len(got) > 4


@pytest.mark.parametrize(("longest", "share"), [(1, 4), (2, 3), (3, 64), (4, 12)])
def test_near_words_for_any_dictionary(spark, longest, share):
    import random

    rng = random.Random(longest)
    words = {"".join(rng.choice("abé𝒳") for _ in range(rng.randint(1, 7))) for _ in range(700)} | {"aaaaaa", "aaaaaaa", "aaaaaaaa", "banana", "ban ana"}
    words = {w for w in words if " " not in w}
    frame = spark.createDataFrame([(w, len(w)) for w in sorted(words)], "word string, n long")
    got = {}
    pairs = near_words(frame, longest, share).collect()
    for r in pairs:
        got.setdefault(r.word, []).append(r.near)
    assert {w: sorted(v) for w, v in got.items()} == {w: sorted(v) for w, v in plain_near(words).items() if v}


def test_cuts_depend_on_their_own_grams_only():
    known = frozenset({"a", "b", "ab", "ba"})
    assert cuts("abaxab", known) == [0, 3, 4] and reversed_cuts("abaxab", known) == [0, 3, 6]
    assert cuts("", known) == [0] and reversed_cuts("", known) == [0]
    changed, grown = unaffected("x", frozenset())
    assert changed == {"1  "} and grown == {"2  x", "2 x "}


def test_dictionary_is_bounded(spark):
    words = spark.createDataFrame([("ab" * 5 + chr(97 + k % 26) + chr(97 + k // 26), 1) for k in range(600)], "word string, n long")
    known = gram_dictionary(words, 3, 64)
    assert {"a", "b", "ab", "ba"} <= known and len([g for g in known if len(g) == 1]) < 64 and len([g for g in known if len(g) == 2]) < 64


def test_ties_chains_repeats_and_nothing(spark):
    # colour -> colours -> colors by fivefold counts; two near words of equal counts: the first by code point.
    counts = {"colour": 5, "colours": 25, "colors": 125, "kitten": 1, "mitten": 9, "bitten": 9, "alone": 3}
    rows = [(w, n) for w, n in counts.items()]
    frame = spark.createDataFrame([*rows[:-1], ("alone", 1), ("alone", 2), (None, 4)], "word string, n long")
    assert as_rows(group_variants(frame)) == plain_groups(counts)
    assert plain_groups(counts)["colour"][1] == "colors" and plain_groups(counts)["kitten"][0] == "bitten"
    assert group_variants(frame.where("false")).count() == 0


def test_empty_table(nothing):
    assert group_variants(count_words(nothing)).count() == 0
