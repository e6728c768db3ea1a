"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A sketch has a fixed number of coordinates. In rounds, every element of a set is hashed to one
coordinate with a value; an earlier round always wins and within a round the least value. After as
many rounds as coordinates, round number ``coordinates + k`` puts all elements at coordinate ``k``,
so every coordinate is filled. Two sets agree in a coordinate with the probability of their
similarity, and the agreements are concentrated as if sampled without repetition, while a large set
needs only a few rounds.

Bands of coordinates are buckets. Sets that are equal count as one class from the start. Per bucket,
members are first compared with pivots only, in rounds that leave out what is in one component
already. What the pivots do not connect is compared in blocks of bounded size, so that a large group
of near copies neither meets in one task nor gives a row for each of its pairs. Every comparison that counts
is made on the full sets. A link of the least similarity is missed with a probability of about
``(1 - s**rows) ** bands``, some 2e-7 for the settings chosen here.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.base import documents, fields, query, renamed, stored
from tidemark.llm.components import components
from tidemark.llm.words import LOWER, WordNumbers, mixed, shingles

# Elements hashed at once; bounds the memory of a round.
_CHUNK = 4096
# Classes of a block (on average); two blocks are compared in one task.
BLOCK = 512
_VALUE_BITS = np.uint64(40)
_VALUE = np.uint64((1 << 40) - 1)
_STEP = 0x9E3779B97F4A7C15


def sketch(elements: np.ndarray, coordinates: int) -> np.ndarray:
    """The sketch of a non-empty set of 64-bit elements."""
    found = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
    at, size = 0, len(elements)
    while at < coordinates:
        rounds = np.arange(at, min(coordinates, at + max(1, _CHUNK // size)), dtype=np.uint64)
        code = mixed(elements[None, :] + (rounds * np.uint64(_STEP))[:, None])
        place = ((code >> _VALUE_BITS) * np.uint64(coordinates)) >> np.uint64(24)
        np.minimum.at(found, place.astype(np.int64).ravel(), ((rounds[:, None] << _VALUE_BITS) | (code & _VALUE)).ravel())
        at += len(rounds)
        if found.max() < np.iinfo(np.uint64).max:
            return found
    for k in np.flatnonzero(found == np.iinfo(np.uint64).max):
        turn = coordinates + int(k)
        code = mixed(elements + np.uint64(turn * _STEP % (1 << 64)))
        found[k] = np.uint64(turn << 40) | (code & _VALUE).min()
    return found


def bands_for(similarity: float) -> tuple[int, int]:
    """Rows of a band and bands, so that the least similarity is missed about twice in ten million.

    Long bands keep texts apart that merely share a passage: at half the similarity of the links a
    pair hardly ever meets, and the price, more bands, is paid per text and not per pair.
    """
    rows = max(4, round(2 / (1 - similarity)) - 1)
    return rows, int(np.ceil(np.log(2e-7) / np.log1p(-(similarity**rows))))


_known = WordNumbers()


def shingle_set(raw: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    words = (raw or b"").translate(LOWER).split()
    return np.unique(shingles(_known.hashes(words), size)) if words else np.zeros(0, np.uint64)


def _key(elements: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(elements.tobytes())


SIGNATURE = fields(n="long", key=T.BinaryType(), bands=T.ArrayType(T.LongType()), bits=T.ArrayType(T.LongType()))


def signature_udf(size: int, rows: int, bands: int):
    """Set size, 128-bit name of the set, bucket numbers, and one bit of every coordinate."""
    salts = np.arange(1, bands + 1, dtype=np.uint64)

    def signatures(texts: pa.Array) -> pa.Array:
        found = []
        for raw in texts.cast(pa.binary()).to_pylist():
            elements = shingle_set(raw, size)
            if not len(elements):
                found.append({"n": 0})
                continue
            values = sketch(elements, rows * bands)
            code = salts.copy()
            for column in values.reshape(bands, rows).T:
                code = mixed(code * np.uint64(_STEP) + column)
            bits = np.packbits((mixed(values) >> np.uint64(63)).astype(np.uint8))
            bits = np.concatenate([bits, np.zeros(-len(bits) % 8, np.uint8)]).view(np.int64)
            found.append({"n": len(elements), "key": _key(elements), "bands": code.view(np.int64), "bits": bits})
        return pa.array(found, to_arrow_type(SIGNATURE))

    return arrow_udf(signatures, SIGNATURE).asNondeterministic()  # so that it is never evaluated twice


SET = fields(key=T.BinaryType(), elements=T.ArrayType(T.LongType()))


def set_udf(size: int):
    def sets(texts: pa.Array) -> pa.Array:
        found = [shingle_set(raw, size) for raw in texts.cast(pa.binary()).to_pylist()]
        return pa.array([{"key": _key(one), "elements": one.view(np.int64)} for one in found], to_arrow_type(SET))

    return arrow_udf(sets, SET).asNondeterministic()


def _differences(coordinates: int, left: str, right: str) -> Column:
    """In how many coordinates' bits two sketches differ."""
    return sum(
        (F.bit_count(F.col(f"{left}.bits")[k].bitwiseXOR(F.col(f"{right}.bits")[k])) for k in range(-(-coordinates // 64))),
        F.lit(0),
    )


def _allowed(coordinates: int, similarity: float) -> int:
    """Differing bits at the least similarity, and six deviations more."""
    share = (1 - similarity) / 2
    return int(np.ceil(coordinates * share + 6 * np.sqrt(coordinates * share * (1 - share))))


LINK = fields(a=T.BinaryType(), b=T.BinaryType())


def links_between(rows: pa.Table, percent: int) -> pa.Table:
    """Links of one task of a cluster: between the classes of two blocks, or within one. For a class and
    another component one link is enough."""
    keys, roots = rows.column("key").to_pylist(), rows.column("root").to_pylist()
    sets = [np.asarray(one, np.int64) for one in rows.column("elements").to_numpy()]
    _, root = np.unique(np.array([r.hex() for r in roots]), return_inverse=True)
    block = rows.column("block").to_numpy()
    within = rows.column("low")[0].as_py() == rows.column("high")[0].as_py()
    sizes = np.array([len(one) for one in sets])
    _, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    here = np.flatnonzero(block == block.min())
    there = here if within else np.flatnonzero(block != block.min())
    found_a, found_b = [], []
    if len(there):
        places = np.concatenate([np.arange(ends[k] - sizes[k], ends[k]) for k in there])
        held, starts = numbers[places], np.cumsum(sizes[there]) - sizes[there]
        flag = np.zeros(numbers.max() + 1, bool)
        for k in here:
            mine = numbers[ends[k] - sizes[k] : ends[k]]
            flag[mine] = True
            common = np.add.reduceat(flag[held].astype(np.int32), starts)
            flag[mine] = False
            linked = (100 * common >= percent * (sizes[k] + sizes[there] - common)) & (root[there] != root[k])
            if within:
                linked &= there > k
            hits = there[linked]
            for other in hits[np.unique(root[hits], return_index=True)[1]]:
                found_a.append(max(keys[k], keys[other]))
                found_b.append(min(keys[k], keys[other]))
    return pa.table({"a": pa.array(found_a, pa.binary()), "b": pa.array(found_b, pa.binary())})


class _Search:
    """One search for links: classes, buckets and verified pairs."""

    def __init__(self, rows: DataFrame, size: int, percent: int) -> None:
        self.rows, self.size, self.percent = rows, size, percent
        self.band_rows, self.bands = bands_for(percent / 100)
        self.coordinates = self.band_rows * self.bands
        signature = signature_udf(size, self.band_rows, self.bands)
        marked = rows.select("doc_id", F.xxhash64("text").alias("text_hash"), signature("text").alias("s"))
        self.marked = stored(marked.select("doc_id", "text_hash", "s.*"), "signatures")
        one = self.marked.where("n > 0").groupBy("key").agg(
            F.min("doc_id").alias("rep"), F.coalesce(F.min_by("text_hash", "doc_id"), F.min("text_hash")).alias("rep_hash"), F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("bits").alias("bits")
        )
        self.classes = stored(one, "classes")
        members = self.classes.select("key", F.explode("bands").alias("bucket"))
        # Most buckets hold one class; only the others are worth a row with a key.
        shared = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
        self.members = stored(members.join(stored(shared, "shared"), "bucket"), "members")
        self.full = self.sets()

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and sketches allow the similarity."""
        left = self.classes.select(F.col("key").alias("a"), F.struct("n", "bits").alias("x"))
        right = self.classes.select(F.col("key").alias("b"), F.struct("n", "bits").alias("y"))
        both = pairs.join(left, "a").join(right, "b")
        fits = 100 * F.least("x.n", "y.n") >= self.percent * F.greatest("x.n", "y.n")
        close = _differences(self.coordinates, "x", "y") <= _allowed(self.coordinates, self.percent / 100)
        return both.where(fits & close).select("a", "b")

    def sets(self) -> DataFrame:
        """``key, elements``: the full sets of all classes that share a bucket, made anew from the text of
        one document each. Their names grow with the input, so the join never broadcasts them."""
        met = self.members.select("key").distinct().join(self.classes.select("key", "rep", "rep_hash"), "key")
        met = stored(met.select(F.col("key").alias("wanted"), "rep", "rep_hash"), "wanted")
        # By the text's hash too, so that rows without an id do not all meet.
        same = self.rows["doc_id"].eqNullSafe(met["rep"]) & (F.xxhash64(self.rows["text"]) == met["rep_hash"])
        texts = self.rows.join(met.hint("merge"), same).select("wanted", "text")
        sets = texts.select("wanted", set_udf(self.size)("text").alias("s")).where("s.key = wanted")
        return stored(sets.groupBy(F.col("wanted").alias("key")).agg(F.first("s.elements").alias("elements")), "sets")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """Pairs that reach the similarity on their full sets."""
        pairs = stored(self.likely(pairs), "pairs")
        left = self.full.select(F.col("key").alias("a"), F.col("elements").alias("x"))
        right = self.full.select(F.col("key").alias("b"), F.col("elements").alias("y"))
        both = pairs.select("a", "b").join(left, "a").join(right, "b")
        both = both.select("a", "b", F.size(F.array_intersect("x", "y")).alias("common"), (F.size("x") + F.size("y")).alias("sizes"))
        return both.where(100 * F.col("common") >= self.percent * (F.col("sizes") - F.col("common"))).select("a", "b")

    def first_pairs(self) -> DataFrame:
        """Each class with the least and the greatest key it shares a bucket with."""
        ends = stored(self.members.groupBy("bucket").agg(F.min("key").alias("low"), F.max("key").alias("high")), "ends")
        met = self.members.join(ends, "bucket").groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        pairs = met.select("key", F.explode(F.array("low", "high")).alias("other")).where("key <> other")
        return pairs.select(F.greatest("key", "other").alias("a"), F.least("key", "other").alias("b")).distinct()

    def apart(self, roots: DataFrame) -> DataFrame:
        """Members, with their component's root, of the buckets that hold more than one component."""
        roots = roots.select(F.col("a").alias("key"), F.col("b").alias("root"))
        members = self.members.join(roots, "key", "left").select("bucket", "key", F.coalesce("root", "key").alias("root"))
        members = stored(members, "rooted")
        parted = members.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
        return stored(members.join(stored(parted.select("bucket"), "parted"), "bucket"), "apart")

    def pivot_pairs(self, apart: DataFrame) -> DataFrame:
        """Members of other components than the least and the greatest key of their bucket, with that key."""
        ends = apart.groupBy("bucket").agg(F.min(F.struct("key", "root")).alias("low"), F.max(F.struct("key", "root")).alias("high"))
        met = apart.join(stored(ends, "ends"), "bucket").select("key", "root", F.explode(F.array("low", "high")).alias("p"))
        pairs = met.where("root <> p.root").select(F.greatest("key", "p.key").alias("a"), F.least("key", "p.key").alias("b"))
        return pairs.distinct()

    def blocked_links(self, apart: DataFrame) -> DataFrame:
        """Links across components among all classes that hang together by shared buckets.

        The classes of such a cluster are dealt to blocks of bounded size, and two blocks at a time meet in
        a task that intersects the full sets; only links leave it, not pairs.
        """
        lows = stored(apart.groupBy("bucket").agg(F.min("key").alias("low")), "lows")
        hung = components(apart.join(lows, "bucket").select(F.col("key").alias("a"), F.col("low").alias("b")))
        keys = apart.select("key", "root").distinct()
        keys = keys.join(hung.select(F.col("a").alias("key"), F.col("b").alias("cluster")), "key", "left")
        keys = stored(keys.select("key", "root", F.coalesce("cluster", "key").alias("cluster")), "keys")
        sizes = stored(keys.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks")), "clusters")
        block = F.pmod(F.xxhash64("key"), F.col("blocks"))
        dealt = keys.join(sizes, "cluster").select("cluster", "key", "root", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        dealt = dealt.select("cluster", "key", "root", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
        percent = self.percent

        def compare(rows: pa.Table) -> pa.Table:
            return links_between(rows, percent)

        return dealt.join(self.full, "key").groupBy("cluster", "low", "high").applyInArrow(compare, LINK)

    def run(self) -> DataFrame:
        """All rows with ``n_shingles`` and ``component_id``."""
        roots = components(self.verified(self.first_pairs()))
        roots = components(roots.unionByName(self.verified(self.pivot_pairs(self.apart(roots)))))
        roots = components(roots.unionByName(stored(self.blocked_links(self.apart(roots)), "blocked")))
        named = self.classes.select("key", "rep").join(roots.select(F.col("a").alias("key"), F.col("b").alias("root")), "key", "left")
        named = stored(named.select("key", "rep", F.coalesce("root", "key").alias("root")), "roots")
        least = stored(named.groupBy("root").agg(F.min("rep").alias("component_id")), "least")
        named = named.join(least, "root").select("key", "component_id", (F.col("key") == F.col("root")).alias("is_root"))
        found = self.marked.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "key").join(stored(named, "named"), "key", "left")
        alone = F.col("n_shingles") == 0
        component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
        # A component without any id is stood for by its root.
        kept = F.coalesce(F.col("doc_id") == component, component.isNull() & (alone | F.col("is_root")), F.lit(False))
        return found.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), "text_hash")


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept, text_hash``.

    Documents are linked when the intersection of their sets of ``size``-word shingles is ``percent``
    percent of the union or more; a component is named by its least id. Texts that are missing or
    have no words link with nothing. Rows without an id take part: they bear the name of their
    component, which is missing when no member has an id; one set of such a component is kept.
    Repeated rows are linked and share a name, so each of them is kept if one is. An empty table gives an
    empty result; other columns are not read.
    """
    return _Search(renamed(docs, doc_id=id_column, text=text_column), size, percent).run()


_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS g FROM w),
x AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
c AS (SELECT doc_id, doc_id AS r FROM s UNION SELECT c.doc_id, l.b FROM c JOIN l ON c.r = l.a)
SELECT s.doc_id, any_value(len(s.g)) AS n_shingles, min(c.r) AS component_id, s.doc_id = min(c.r) AS kept
FROM s JOIN c USING (doc_id) GROUP BY s.doc_id
"""


@query(_SQL)
def op6_near_duplicates(spark, sf_dir):
    """Components of documents with three-word shingles of similarity 0.85 and more."""
    return near_duplicates(documents(spark, sf_dir), size=3, percent=85).drop("text_hash")
