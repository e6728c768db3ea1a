"""Benchmark decontamination: pairs of words as seeds, then Smith-Waterman alignment.

Words are runs of letters (in lower case), digits and everything else beyond ASCII. An alignment whose
score reaches ``need`` words (the threshold's share of an item of n words, rounded up) has at most one
run of matching words more than it has errors, so it leaves ``need - 1`` pairs of neighbouring
words intact, within ``2 n - need`` words of the document. Both bounds are exact, so
nothing that reaches the threshold is lost by what follows from them:

One pass over the documents looks each pair up in a bit table of the benchmark's pairs, whose size is fixed,
and writes out the stretches around hits that lie dense enough for the items of a class of lengths.
Hits meet the benchmark by a join on the pair. Since so many pairs stay intact, the ``n - need + 1`` rarest
of an item, by the frequencies of their words in the corpus, hold one that does; only these are joined. A
passage is aligned if it holds ``need - 1`` of the item's pairs; the score is the best local alignment's
share of the item. Items of which one word reaches the threshold are sought by their single words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from tidemark.llm.base import documents, fields, query, renamed, stored, table
from tidemark.llm.licenses import normal_words
from tidemark.llm.words import WordNumbers, mixed, shingles

SEED = 2
THRESHOLD = 0.5
# Items whose lengths differ by less than this factor are sought together.
CLASS = 1.25
# Bits of the table that hits are looked up in (8 MB); a larger benchmark only means more false hits,
# which the join sorts out.
TABLE_BITS = 1 << 26

_known = WordNumbers()
_LONGS = T.ArrayType(T.LongType())
_ITEMS = fields(words=_LONGS, pairs=_LONGS, singles=_LONGS)
# A stretch of a document (kind 0), or how often a word occurs in the rows of a task (kind 1).
_FOUND = fields(kind="int", class_="int", doc_id="long", text_hash="long", stretch="long", first="long", words=_LONGS, places=_LONGS, runs=_LONGS, n="long")


def word_hashes(text: str | None) -> np.ndarray:
    words = normal_words((text or "").lower().encode())
    return _known.hashes(words) if words else np.zeros(0, np.uint64)


def seed_runs(hashes: np.ndarray, size: int = SEED) -> np.ndarray:
    """Hashes of all runs of ``size`` words; none for fewer words."""
    return shingles(hashes, size) if len(hashes) >= size else np.zeros(0, np.uint64)


@arrow_udf(_ITEMS)
def _item_words(texts: pa.Array) -> pa.Array:
    words = [word_hashes(text) for text in texts.to_pylist()]
    found = (words, [seed_runs(w) for w in words], [seed_runs(w, 1) for w in words])
    return pa.StructArray.from_arrays([pa.array([x.view(np.int64) for x in xs], pa.list_(pa.int64())) for xs in found], names=_ITEMS.names)


_item_words = _item_words.asNondeterministic()


def aligned(passage: np.ndarray, item: np.ndarray) -> tuple[int, int]:
    """Best local alignment (match 1, mismatch and gap -1): its score and where it ends in the passage."""
    row, place = np.zeros(len(passage) + 1, np.int64), np.arange(len(passage) + 1)
    best, end = 0, 0
    for word in item:
        step = np.zeros_like(row)
        step[1:] = np.maximum(row[:-1] + np.where(passage == word, 1, -1), row[1:] - 1)
        np.maximum(step, 0, out=step)
        # A gap in the item: the best cell to the left, less one for each place.
        row = np.maximum.accumulate(step + place) - place
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


_SCORED = fields(score="double", first="long", last="long")


@arrow_udf(_SCORED)
def _align(passages: pa.Array, items: pa.Array, starts: pa.Array, needs: pa.Array) -> pa.Array:
    def lists(array):
        offsets, values = array.offsets.to_numpy(), array.values.to_numpy(zero_copy_only=False)
        return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])]

    score, first, last = [], [], []
    for passage, item, start, need in zip(lists(passages), lists(items), starts.to_pylist(), needs.to_pylist()):
        intact = np.isin(seed_runs(item.view(np.uint64)), seed_runs(passage.view(np.uint64))).sum()
        best, end = aligned(passage, item) if intact >= need - 1 else (0, 0)
        back = aligned(passage[:end][::-1], item[::-1])[1] if best >= need else 0
        score.append(best / max(1, len(item)))
        first.append(start + end - back)
        last.append(start + end - 1)
    return pa.StructArray.from_arrays([pa.array(score, pa.float64()), pa.array(first, pa.int64()), pa.array(last, pa.int64())], names=_SCORED.names)


_align = _align.asNondeterministic()


def _of_class(codes: np.ndarray, number: int) -> np.ndarray:
    """Codes of runs that are different for each class of lengths."""
    return mixed(codes + np.uint64(number + 1))


@arrow_udf(T.ArrayType(T.IntegerType()))
def _slots(runs: pa.Array, classes: pa.Array) -> pa.Array:
    """Where an item's runs stand in the bit table, alone and with their class."""
    found = []
    for codes, number in zip(runs.to_pylist(), classes.to_pylist()):
        codes = np.array(codes, np.int64).view(np.uint64)
        found.append((np.concatenate([codes, _of_class(codes, number)]) % np.uint64(TABLE_BITS)).astype(np.int32))
    return pa.array(found, pa.list_(pa.int32()))


def _bit_table(slots: DataFrame) -> np.ndarray:
    """The bits of a column ``slot``: at most ``TABLE_BITS`` numbers reach the driver, however large the benchmark."""
    bits = np.zeros(TABLE_BITS, bool)
    bits[slots.distinct().toArrow().column("slot").to_numpy()] = True
    return np.packbits(bits)


def dense(at: np.ndarray, least: int, span: int) -> np.ndarray:
    """Which of the ascending places lie among ``least`` that are no further apart than ``span``."""
    starts = np.flatnonzero(at[least - 1 :] - at[: len(at) - least + 1] <= span) if len(at) >= least else np.zeros(0, np.int64)
    change = np.zeros(len(at) + 1, np.int64)
    change[starts] += 1
    change[starts + least] -= 1
    return change[:-1].cumsum() > 0


def _stretches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Stretches around dense hits and word counts, see ``_FOUND``."""
    context = docs.sparkSession.sparkContext
    table_bits = context.broadcast(_bit_table(items.select(F.explode(_slots("runs", "class")).alias("slot"))))
    vocabulary = items.select(F.explode("words").alias("word")).select(F.pmod("word", F.lit(TABLE_BITS)).cast("int").alias("slot"))
    words_bits = context.broadcast(_bit_table(vocabulary))
    # One row for each class of lengths, so about as many as the longest item's length has digits.
    size = F.size("words")
    classes = items.groupBy("class").agg(F.min("need").alias("need"), F.max(2 * size - F.col("need")).alias("span"), F.max(size).alias("longest"))
    classes = sorted(tuple(row) for row in classes.collect())

    def marked(bits: np.ndarray, codes: np.ndarray) -> np.ndarray:
        slot = (codes & np.uint64(TABLE_BITS - 1)).astype(np.int64)
        return (bits[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 > 0

    def search(batches):
        bits, word_bits = table_bits.value, words_bits.value
        part, serial, counts, total = TaskContext.get().partitionId(), 0, {}, 0
        for batch in batches:
            rows = []
            for doc_id, text_hash, text in zip(*(column.to_pylist() for column in batch.columns)):
                words = word_hashes(text)
                total += len(words)
                seen, often = np.unique(words[marked(word_bits, words)], return_counts=True)
                for word, n in zip(seen.view(np.int64).tolist(), often.tolist()):
                    counts[word] = counts.get(word, 0) + n
                pairs = seed_runs(words)
                near = np.flatnonzero(marked(bits, pairs))
                for number, need, span, longest in classes:
                    if number:
                        runs, least, apart = pairs, need - 1, span - SEED
                        hits = near[dense(near, least, apart)]
                    else:
                        runs, least, apart = seed_runs(words, 1), 1, 0
                        hits = np.flatnonzero(marked(bits, runs))
                    if len(hits):
                        hits = hits[marked(bits, _of_class(runs[hits], number))]
                        hits = hits[dense(hits, least, apart)]
                    if not len(hits):
                        continue
                    for group in np.split(hits, np.flatnonzero(np.diff(hits) > 4 * longest) + 1):
                        low, high = max(0, int(group[0]) - 2 * longest), int(group[-1]) + SEED + 2 * longest
                        serial += 1
                        rows.append((0, number, doc_id, text_hash, (part << 40) | serial, low, words[low:high].view(np.int64), group - low, runs[group].view(np.int64), None))
            if len(counts) > 200_000:  # emptied early, summed later
                yield _count_rows(counts)
                counts = {}
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _TYPES)], names=_FOUND.names)
        counts[None] = total
        yield _count_rows(counts)

    return docs.mapInArrow(search, _FOUND)


_TYPES = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64())


def _count_rows(counts: dict) -> pa.RecordBatch:
    rows = [(1, None, word, None, None, None, None, None, None, n) for word, n in counts.items()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _TYPES)], names=_FOUND.names)


def _seeds(items: DataFrame, counts: DataFrame) -> DataFrame:
    """``item, class, place, run`` of each item's rarest runs: as many as hold one that is intact in any
    alignment that reaches the threshold."""
    total = counts.where("word is null").agg(F.sum("n").alias("total"))
    known = counts.where("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    places = items.select("item", F.posexplode("words").alias("place", "word")).join(known, "word", "left")
    share = places.crossJoin(F.broadcast(total)).select("item", "place", (F.log(F.coalesce("n", F.lit(1))) - F.log(F.greatest("total", F.lit(1)))).alias("share"), "total")
    # A run's chance is the product over its words; every item is a group of its own size.
    run = Window.partitionBy("item").orderBy("place").rowsBetween(0, SEED - 1)
    chance = share.select("item", "place", (F.sum("share").over(run) + F.log("total")).alias("expected"))
    runs = items.select("item", "class", (F.size("runs") - F.col("need") + 2).alias("enough"), F.posexplode("runs").alias("place", "run"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy("expected", "place"))
    ranked = runs.join(chance, ["item", "place"]).withColumn("rank", rank)
    return ranked.where(F.col("rank") <= F.col("enough")).select("item", "class", "place", "run")


def leaks(
    docs: DataFrame, benchmark: DataFrame, *, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word, text_hash``: a row for each document and item whose
    alignment reaches ``threshold``, with the best score and where it stands in the document.

    Missing and empty texts leak nothing, and items without words are found nowhere. Items of one or two words
    are reached by one of them. Rows without an id, repeated rows and repeated items are searched like others and
    give one row for each different pair. Without documents or items the result is empty.
    """
    items = renamed(benchmark, item_id=item_column, text=item_text).select("item_id", _item_words("text").alias("w")).select("item_id", "w.*")
    size = F.size("words")
    need = F.greatest(F.ceil(size * threshold - 1e-9), F.lit(1)).cast("int")
    # Class 0 is sought by single words.
    number = F.when(need == 1, 0).otherwise(1 + F.floor(F.log(size) / F.log(F.lit(CLASS)))).cast("int")
    runs = F.when(need == 1, F.col("singles")).otherwise(F.col("pairs"))
    items = items.where(size > 0).distinct().select("item_id", "words", need.alias("need"), number.alias("class"), runs.alias("runs"))
    items = stored(items.withColumn("item", F.monotonically_increasing_id()), "items")
    rows = renamed(docs, doc_id=id_column, text=text_column)
    rows = rows.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    found = stored(_stretches(rows, items), "stretches")
    seeds = _seeds(items, found.where("kind = 1").select(F.col("doc_id").alias("word"), "n"))
    stretches = found.where("kind = 0").select(F.col("class_").alias("class"), "doc_id", "text_hash", "stretch", "first", "words", "places", "runs")
    hits = stretches.select("stretch", "class", F.explode(F.arrays_zip("places", "runs")).alias("hit"))
    hits = hits.select("stretch", "class", F.col("hit.places").alias("at"), F.col("hit.runs").alias("run"))
    sizes = items.select("item", "item_id", "need", size.alias("size"), F.col("words").alias("item_words"))
    near = hits.join(stored(seeds, "seeds"), ["run", "class"]).join(sizes.select("item", "need", "size"), "item")
    # Hits of one copy lie near one diagonal; copies far apart are aligned apart.
    near = near.withColumn("diagonal", F.col("at") - F.col("place"))
    near = near.groupBy("stretch", "item", "need", "size", F.floor(F.col("diagonal") / F.col("size")).alias("band")).agg(
        F.min("diagonal").alias("low"), F.max("diagonal").alias("high")
    )
    # An alignment leaves the diagonal of any of its hits by no more than its errors.
    margin = F.col("size") - F.col("need")
    near = near.join(stretches.select("doc_id", "text_hash", "stretch", "first", "words"), "stretch").join(sizes.select("item", "item_id", "item_words"), "item")
    low = F.greatest(F.col("low") - margin, F.lit(0))
    high = F.least(F.col("high") + F.col("size") + margin, F.size("words"))
    near = near.select("doc_id", "text_hash", "item_id", "item_words", "need", (F.col("first") + low).alias("start"), F.slice("words", (low + 1).cast("int"), (high - low).cast("int")).alias("passage"))
    scored = near.select("doc_id", "text_hash", "item_id", _align("passage", "item_words", "start", "need").alias("s"))
    best = F.max(F.struct("s.score", (-F.col("s.first")).alias("first"), "s.last"))
    scored = scored.where(F.col("s.score") >= threshold).groupBy("doc_id", "text_hash", "item_id").agg(best.alias("s"))
    return scored.select("doc_id", "item_id", "s.score", (-F.col("s.first")).alias("first_word"), F.col("s.last").alias("last_word"), "text_hash")


@query()
def op9_benchmark_leaks(spark, sf_dir):
    """Documents that hold an item of the benchmark, whole or edited."""
    return leaks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")).drop("text_hash")
