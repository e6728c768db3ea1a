"""Near duplicates, components, sketches against brute force."""

import numpy as np
import pytest

from tidemark.llm import near_dedup
from tidemark.llm.components import components
from tidemark.llm.near_dedup import bands_for, near_duplicates, shingle_set, sketch


def plain_components(rows, size, percent):
    """Least id of each row's component, by comparing all pairs."""
    sets = []
    for _, text in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        sets.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set())
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return [(i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)]


def edited(random, words, edits):
    words = list(words)
    for _ in range(edits):
        words[random.integers(len(words))] = f"w{random.integers(10**6)}"
    return words


@pytest.fixture(scope="module")
def corpus():
    """Chains, a large group of near copies on both sides of the limit, texts that share a passage."""
    random = np.random.default_rng(5)
    word = lambda: f"w{random.integers(3000)}"
    base, passage = [word() for _ in range(120)], [word() for _ in range(40)]
    rows = [edited(random, base, int(random.integers(0, 9))) for _ in range(150)]
    rows += [[word() for _ in range(60)] + passage for _ in range(60)]
    chain = [word() for _ in range(90)]
    for _ in range(25):
        rows.append(chain)
        chain = edited(random, chain, 2)
    rows += [[word() for _ in range(int(n))] for n in random.integers(1, 50, 80)]
    texts = [" ".join(r) for r in rows] + ["Hot Copy of a text"] * 90 + ["a b", "A  B", "a", None, "", " \n"]
    return [(int(i), t) for i, t in zip(random.permutation(len(texts)), texts)]


@pytest.mark.parametrize(("size", "percent", "block"), [(5, 80, 512), (3, 85, 16)])
def test_against_all_pairs(spark, corpus, size, percent, block, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    got = near_duplicates(spark.createDataFrame(corpus, "doc_id long, text string"), size, percent).collect()
    want = [(i, n, i if n == 0 else c) for i, n, c in plain_components(corpus, size, percent)]
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_awkward_rows(awkward, nothing):
    got = near_duplicates(awkward, 3, 85).collect()
    want = plain_components([(r.doc_id, r.text) for r in awkward.collect()], 3, 85)
    assert sorted(str((r.doc_id, r.n_shingles)) for r in got) == sorted(str((i, n)) for i, n, _ in want)
    assert sum(r.kept for r in got if r.doc_id is not None) >= 15
    assert near_duplicates(nothing).count() == 0


def test_sketch_fills_and_estimates():
    random = np.random.default_rng(1)
    for size in (1, 2, 7, 300, 9000):
        assert sketch(random.integers(0, 2**63, size).astype(np.uint64), 256).max() < 2**63
    pool = random.integers(0, 2**63, 3000).astype(np.uint64)
    a, b = sketch(pool[:2000], 1200), sketch(pool[500:2500], 1200)
    assert abs((a == b).mean() - 1500 / 2500) < 0.06


def test_sketch_does_not_depend_on_the_chunk(monkeypatch):
    elements = np.random.default_rng(2).integers(0, 2**63, 40).astype(np.uint64)
    want = sketch(elements, 300)
    monkeypatch.setattr(near_dedup, "_CHUNK", 64)
    assert (sketch(elements, 300) == want).all()


def test_bands_miss_little():
    for similarity in (0.8, 0.85, 0.9):
        rows, bands = bands_for(similarity)
        assert (1 - similarity**rows) ** bands <= 2e-7


def test_short_texts_are_one_run():
    assert len(shingle_set(b"A b", 3)) == 1 and (shingle_set(b"A b", 3) == shingle_set(b"a\tB", 3)).all()
    assert len(shingle_set(b"", 3)) == 0


def test_components(spark):
    links = [(k + 1, k) for k in range(60)] + [(200, 100 + k) for k in range(50)] + [(7, 7), (300, 301), (301, 300)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    want = [(k, 0) for k in range(1, 61)] + [(k, 100) for k in [*range(101, 150), 200]] + [(301, 300)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_many_rows_without_an_id(spark):
    # Each row would meet each class by the missing id alone.
    texts = [f"{' '.join(f'w{k}x{j}' for j in range(12))}{' tail' if k % 2 else ''}" for k in range(3000)]
    frame = spark.createDataFrame([(None, text) for text in texts for _ in range(2)], "doc_id long, text string")
    got = near_duplicates(frame, size=3, percent=80)
    assert got.count() == 6000 and got.where("kept").count() == 6000
    row = got.groupBy("n_shingles").count().orderBy("n_shingles").collect()
    assert [tuple(r) for r in row] == [(10, 3000), (11, 3000)]


def test_rows_of_a_repeated_text_are_packed_by_many_tasks(spark):
    from tidemark.llm.packing import pack

    pieces = spark.createDataFrame([(None, 0, 0, 700, 5)] * 3000, "doc_id long, piece int, start long, length long, ids_crc32 long")
    got = pack(pieces, shard_pieces=500).collect()
    shards = {(r.sequence_id >> 24) & 0xFFFF for r in got}
    assert len(got) == 3000 and len(shards) > 3
    used = {}
    for r in got:
        used.setdefault(r.sequence_id, []).append(r.offset)
    assert all(sorted(offsets) == [700 * k for k in range(len(offsets))] for offsets in used.values()) and len(used) <= 600 + 6
