"""Grouping of spelling variants: words one edit apart, through an index of variable-length grams.

Words are cut into grams of one to ``LONGEST`` code points. A gram dictionary says how long: it holds the
grams that make up more than one part in ``SHARE`` of the vocabulary's, and a gram grows while it is in the
dictionary; all rarer grams are pruned, so the dictionary has a fixed bound however many words there are.
Every word is cut twice, from its beginning and from its end. Where a gram ends depends on its own
characters only, so an edit leaves all grams before it (of the first cut) and all after it (of the second)
as they are. The word's bound on affected grams at each place is thus the stretch between the last cut
before the place and the first cut after it; a near word must stand in the lists of all other grams. These
lists are merged by one key, the unaffected grams of both sides in order, and what meets under a key is
verified by edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import documents, fields, query, renamed, stored

# Words: least code points, least occurrences; a form has so many times the word's occurrences.
LEAST_LENGTH, LEAST_COUNT, TIMES = 6, 5, 5
# Of so many different (document, word) pairs, one is misspelt.
EVERY = 199
LONGEST, SHARE = 3, 64
# Different words that a task counts before it hands the counts on.
_HELD = 300_000

# To lower case, and all that is ASCII but no letter to blanks.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in range(256))
_OTHER = re.compile(rb"[\xc2\xc4-\xff]")  # bytes that begin characters beyond U+00FF, or are no letters below it
_RUN = re.compile("[a-zÀ-ÿ]+")


def runs(text: str, least: int = 1) -> list[bytes]:
    """Lower-cased runs of letters in UTF-8, without those of fewer bytes than ``least``."""
    data = text.encode("utf-8", "replace").translate(_FOLD)
    found = [run.encode() for run in _RUN.findall(data.decode("utf-8", "replace"))] if _OTHER.search(data) else data.split()
    return [run for run in found if len(run) >= least] if least > 1 else found


def misspelt(run: bytes, checksum: int) -> bytes:
    """The run without the code point that its checksum names."""
    text = run.decode()
    at = checksum % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def count_words(docs: DataFrame, least_length: int = LEAST_LENGTH, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``word, n`` over all whole texts. Missing texts have no words; a missing id counts as empty text.

    Tasks count first, so a frequent word is shuffled once for each of them.
    """
    schema = fields(word="string", n="long")

    def counted(batches):
        held: Counter = Counter()

        def flush() -> pa.RecordBatch:
            kept = [(word, n) for word, n in held.items() if n and len(word) - word.count(b"\xc3") >= least_length]
            words, numbers = zip(*kept) if kept else ((), ())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()).cast(pa.string()), pa.array(numbers, pa.int64())], names=schema.names)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                words = runs(text, least_length)
                held.update(words)
                base = zlib.crc32(b"%d:" % doc if doc is not None else b":")
                wrong = [word for word in set(words) if zlib.crc32(word, base) % EVERY == 0]
                if wrong:
                    times = Counter(words) if len(wrong) > 8 else {word: words.count(word) for word in wrong}
                    for word in wrong:
                        held[word] -= times[word]
                        held[misspelt(word, zlib.crc32(word, base))] += times[word]
                if len(held) > _HELD:
                    yield flush()
        yield flush()

    rows = renamed(docs, doc_id=id_column, text=text_column).select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(counted, schema).groupBy("word").agg(F.sum("n").cast("long").alias("n"))


def gram_dictionary(words: DataFrame, longest: int = LONGEST, share: int = SHARE) -> frozenset[str]:
    """Grams, shorter than the longest, that more than one in ``share`` places of the words begin: fewer
    than ``share`` of each length."""
    length = F.char_length("word")
    grams = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.lit(longest - 1)),
            lambda size: F.transform(
                F.filter(F.sequence(F.lit(1), length), lambda at: at + size - 1 <= length), lambda at: F.substr("word", at, size)
            ),
        )
    )
    places = words.agg(F.coalesce(F.sum(length), F.lit(0))).first()[0]
    counted = words.select(F.explode(grams).alias("gram")).groupBy("gram").count()
    return frozenset(row.gram for row in counted.where(F.col("count") * share > places).collect())


def cuts(word: str, known: frozenset[str], longest: int = LONGEST) -> list[int]:
    """Where the word's grams end, from its beginning on; a last gram that could still grow has no end."""
    found, start, size = [0], 0, len(word)
    while start < size:
        end = start + 1
        while end - start < longest and word[start:end] in known:
            end += 1
            if end > size:
                return found
        found.append(end)
        start = end
    return found


def reversed_cuts(word: str, known: frozenset[str], longest: int = LONGEST) -> list[int]:
    """The same from the end on: where grams begin, in ascending order."""
    found, end = [len(word)], len(word)
    while end > 0:
        start = end - 1
        while end - start < longest and word[start:end] in known:
            start -= 1
            if start < 0:
                return found[::-1]
        found.append(start)
        end = start
    return found[::-1]


def unaffected(word: str, known: frozenset[str], longest: int = LONGEST) -> tuple[set[str], set[str]]:
    """Keys of what an edit can leave of a word: where a code point is replaced or taken out, and where one
    is put in. Each begins with the length of the longer word."""
    size = len(word)
    left, right = cuts(word, known, longest), reversed_cuts(word, known, longest)
    before, after, k = [], [0] * (size + 1), 0
    for at in range(size + 1):
        while k + 1 < len(left) and left[k + 1] <= at:
            k += 1
        before.append(left[k])
    k = len(right) - 1
    for at in range(size, -1, -1):
        while k > 0 and right[k - 1] >= at:
            k -= 1
        after[at] = right[k]
    changed = {f"{size} {word[: before[at]]} {word[after[at + 1] :]}" for at in range(size)}
    grown = {f"{size + 1} {word[: before[at]]} {word[after[at] :]}" for at in range(size + 1)}
    return changed, grown


def near_words(words: DataFrame, longest: int = LONGEST, share: int = SHARE) -> DataFrame:
    """``word, n, near, near_n``: every ordered pair of words one edit apart. ``words`` (``word, n``) is
    stored and holds each word once."""
    known = gram_dictionary(words, longest, share)
    schema = fields(key="string", grown="boolean", word="string", n="long")

    def listed(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 10_000):
                part = batch.slice(start, 10_000)
                rows = []
                for word, n in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    changed, grown = unaffected(word, known, longest)
                    rows += [(key, False, word, n) for key in changed]
                    rows += [(key, True, word, n) for key in grown]
                columns = list(zip(*rows)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(columns, (pa.string(), pa.bool_(), pa.string(), pa.int64()))],
                    names=schema.names,
                )

    lists = stored(words.select("word", "n").mapInArrow(listed, schema), "gram-lists")
    one = lists.where("not grown").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"))
    two = lists.select("key", "grown", F.col("word").alias("b"), F.col("n").alias("b_n"))
    met = one.join(two, "key").where("(grown or b < a) and levenshtein(a, b, 1) = 1").select("a", "a_n", "b", "b_n")
    pairs = stored(met.distinct(), "near-words")
    turned = pairs.select(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n"))
    return pairs.toDF("word", "n", "near", "near_n").unionByName(turned)


def roots_of(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the last word that the forms lead to. Each round doubles the
    steps; forms grow ``TIMES``-fold, so chains, and rounds, are few."""
    found = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = stored(found.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if found.where("moved").isEmpty():
            return found.select("word", "root")
        found = found.select("word", "root")


def group_variants(words: DataFrame, times: int = TIMES, longest: int = LONGEST, share: int = SHARE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each word of ``word, n``.

    A word's form is its near word of largest n (ties: the first in code-point order) where that has at
    least ``times`` its n. Rows without a word are none; a repeated word is one, its counts added. No words
    give no rows.
    """
    words = stored(words.where("word is not null").groupBy("word").agg(F.sum("n").cast("long").alias("n")), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    near = near_words(words, longest, share).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    judged = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "best")
    formed = -F.col("best.less") >= times * F.col("n")
    judged = stored(
        judged.select("word", "n", "n_near", F.when(formed, F.col("best.form")).alias("form"), F.when(formed, -F.col("best.less")).alias("form_n")),
        "forms",
    )
    roots = roots_of(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


@query()
def op13_spelling_variants(spark, sf_dir):
    """Frequent words of all documents, and the words they are variants of."""
    return group_variants(count_words(documents(spark, sf_dir)).where(F.col("n") >= LEAST_COUNT))
