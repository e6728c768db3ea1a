"""Toxicity: a weighted lexicon matched by Aho-Corasick on folded text.

Folding lowers letters, turns look-alikes from other scripts and digits that stand for letters into
plain letters, and leaves single blanks between words. The lexicon holds beginnings of words and whole words with
weights, and exceptions: words and phrases of two or three words of weight 0 that win over what they contain.
Weights, exceptions and the calibration are learned from labelled documents. A document's weight is
set against its length before it becomes a score.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from tidemark.llm.base import documents, fields, labels_of, query, renamed, stored, table
from tidemark.llm.words import WordNumbers, shingles

# Labelled rows that are learned from, at most: those with the smallest hashed ids.
LEARN_ROWS = 20_000
# Weighted patterns in the lexicon, at most: the surest ones. Exceptions are bounded by the rows learned from.
PATTERNS = 5_000
SHORTEST, LONGEST = 3, 14

# Letters of other scripts that look like Latin ones, and digits and signs read as letters.
_LOOK_ALIKE = "аaеeоoрpсcуyхxіiјjѕsԁdһhкkмmтtвbнhαaεeοoρpτtυuνvκkιi"
_SPOKEN = "0o1i3e4a5s7t8b@a$s"


class _Folding(dict):
    """Translation table that is worked out as characters are met: letters stay, all else is a blank."""

    def __missing__(self, code: int) -> int:
        self[code] = code if unicodedata.category(chr(code))[0] in "LM" else 32
        return self[code]


_FOLD = _Folding({ord(a): ord(b) for pairs in (_LOOK_ALIKE, _SPOKEN) for a, b in zip(pairs[::2], pairs[1::2])})


def folded(text: str | None) -> str:
    """The folded text, with a blank before every word and at the end."""
    return " " + " ".join((text or "").lower().translate(_FOLD).split()) + " "


def _words(plain: str) -> int:
    """Words of a folded text; an empty one is two blanks."""
    return plain.count(" ") - 1 if len(plain) > 2 else 0


@dataclass(frozen=True)
class Lexicon:
    """Patterns (a word's beginning after a blank, or a phrase between blanks) and their weights; the
    calibration turns a document's evidence into a score."""

    weights: dict[str, float]
    calibration: tuple[float, ...] = (-3.0, 1.0, 1.0, 0.0)

    def automaton(self):
        made = ahocorasick.Automaton()
        for pattern, weight in self.weights.items():
            made.add_word(pattern, (len(pattern), weight))
        made.make_automaton()
        return made


def counted(automaton, plain: str) -> list[tuple[int, int, float]]:
    """``(start, end, weight)`` of what counts in a folded text: of the weighted patterns that begin at a
    word the longest, unless an exception contains it. Matches may share the blank between two words."""
    weighted: dict[int, tuple[int, int, float]] = {}
    exceptions = []
    for last, (size, weight) in automaton.iter(plain):
        start = last + 1 - size
        if weight > 0:
            weighted[start] = (start, last + 1, weight)  # matches come by their ends, so the longest is the last
        else:
            exceptions.append((start, last + 1))
    if not weighted:
        return []
    # The furthest end of the exceptions that begin no later.
    reach, at, found = -1, 0, []
    exceptions.sort()
    for start in sorted(weighted):
        while at < len(exceptions) and exceptions[at][0] <= start:
            reach = max(reach, exceptions[at][1])
            at += 1
        if weighted[start][1] > reach:
            found.append(weighted[start])
    return found


EVIDENCE = fields(words="long", hits="long", weight="double")


def evidence_udf(lexicon: Lexicon):
    """Words, hits and summed weight of each text."""
    made: list = []

    def evidence(texts: pa.Array) -> pa.Array:
        if not made and lexicon.weights:
            made.append(lexicon.automaton())
        words, hits, weights = [], [], []
        for text in texts.to_pylist():
            plain = folded(text)
            found = [w for _, _, w in counted(made[0], plain)] if made else []
            words.append(_words(plain))
            hits.append(len(found))
            weights.append(math.fsum(found))
        columns = [pa.array(words, pa.int64()), pa.array(hits, pa.int64()), pa.array(weights, pa.float64())]
        return pa.StructArray.from_arrays(columns, names=EVIDENCE.names)

    return arrow_udf(evidence, EVIDENCE).asNondeterministic()  # so that it is never evaluated twice


def _inputs(evidence: str) -> list[Column]:
    """What the calibration weighs: a constant, weight by length, weight, and length."""
    weight, words = F.col(f"{evidence}.weight"), F.greatest(F.col(f"{evidence}.words"), F.lit(1))
    return [F.lit(1.0), F.log1p(100 * weight / words), F.log1p(weight), F.log1p(words.cast("double"))]


def score_column(lexicon: Lexicon, evidence: str = "evidence") -> Column:
    total = sum((value * F.lit(float(factor)) for value, factor in zip(_inputs(evidence), lexicon.calibration)), F.lit(0.0))
    return 1 / (1 + F.exp(-F.greatest(F.least(total, F.lit(30.0)), F.lit(-30.0))))


_known = WordNumbers()
_COUNTS = fields(pattern="string", marked_docs="long", other_docs="long", marked="long", other="long")


@arrow_udf(T.LongType())
def _gist(texts: pa.Array) -> pa.Array:
    """The least shingle of a text: near copies mostly share it."""
    found = []
    for text in texts.to_pylist():
        words = folded(text).encode().split()
        found.append(int(shingles(_known.hashes(words), 5).min().astype(np.int64)) if words else 0)
    return pa.array(found, pa.int64())


def _patterns(plain: str) -> Counter:
    """How often each beginning of a word occurs in a folded text, and each whole word."""
    words, found = Counter(plain.split()), Counter()
    for word, n in words.items():
        for size in range(SHORTEST, min(LONGEST, len(word)) + 1):
            found[f" {word[:size]}"] += n
        found[f" {word} "] += n
    return found


def _phrases(lexicon: Lexicon):
    """Counts in a folded text the phrases of two and three words around each word that counts."""
    made: list = []

    def phrases(plain: str) -> Counter:
        if not made:
            made.append(lexicon.automaton())
        hits = counted(made[0], plain)
        if not hits:
            return Counter()
        words, windows = plain.split(), set()
        for start, _, _ in hits:
            place = plain.count(" ", 0, start)
            for size in (2, 3):
                windows |= {(first, first + size) for first in range(max(0, place - size + 1), min(place, len(words) - size) + 1)}
        return Counter(f" {' '.join(words[first:stop])} " for first, stop in windows)

    return phrases


def _pattern_counts(rows: DataFrame, patterns: Callable[[str], Counter] = _patterns) -> DataFrame:
    """Over training rows ``(text, mark)``: documents and occurrences of each pattern by label."""

    def count(batches):
        held: dict[str, list[int]] = {}

        def out():
            columns = list(zip(*([p, *n] for p, n in held.items()))) or [[]] * 5
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.string()] + [pa.int64()] * 4)], names=_COUNTS.names)

        for batch in batches:
            for text, mark in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                plain = folded(text)
                totals = held.setdefault("", [0, 0, 0, 0])
                totals[0 if mark else 1] += 1
                totals[2 if mark else 3] += _words(plain)
                for pattern, n in patterns(plain).items():
                    row = held.setdefault(pattern, [0, 0, 0, 0])
                    row[0 if mark else 1] += 1
                    row[2 if mark else 3] += n
                if len(held) > 300_000:
                    yield out()
        yield out()

    counted = rows.mapInArrow(count, _COUNTS)
    return counted.groupBy("pattern").agg(*(F.sum(name).alias(name) for name in _COUNTS.names[1:]))


def _judged(counts: DataFrame, totals: Row) -> DataFrame:
    """Pattern counts with ``value``, the log odds of the rates in marked and other text, and ``sure``, the signed
    root of the likelihood ratio that documents with a pattern are marked as often as all are."""
    share = totals.marked_docs / (totals.marked_docs + totals.other_docs)
    value = F.log((F.col("marked") + 0.5) / (totals.marked + 1)) - F.log((F.col("other") + 0.5) / (totals.other + 1))
    both, ratio = F.col("marked_docs") + F.col("other_docs"), F.lit(0.0)
    for name, part in (("marked_docs", share), ("other_docs", 1 - share)):
        ratio += F.when(F.col(name) > 0, F.col(name) * F.log(F.col(name) / (both * part))).otherwise(0.0)
    sure = F.signum(F.col("marked_docs") - both * share) * F.sqrt(F.greatest(F.lit(0.0), 2 * ratio))
    return counts.where("pattern != ''").withColumns({"value": value, "sure": sure})


def _surest(family: pa.Table) -> pa.Table:
    """Of patterns with a common beginning those of which the documents are surest, none a beginning of another.
    Of equally sure ones a beginning comes before a whole word, as it also stands for inflections."""
    chosen: list[str] = []
    rows = family.to_pylist()
    for row in sorted(rows, key=lambda row: (-row["sure"], row["pattern"].endswith(" "), -len(row["pattern"]), row["pattern"])):
        if not any(row["pattern"].startswith(other) or other.startswith(row["pattern"]) for other in chosen):
            chosen.append(row["pattern"])
    return pa.Table.from_pylist([row for row in rows if row["pattern"] in set(chosen)], family.schema)


def choose(judged: DataFrame, surely: float = 5.0, weight: float = 1.5) -> dict[str, float]:
    """The weighted patterns: beginnings and whole words. They come in families; two of which one begins the other
    have their first letters in common."""
    fit = judged.where((F.col("sure") >= surely) & (F.col("value") >= weight) & (F.col("marked_docs") >= 4)).select("pattern", "value", "sure")
    fit = fit.groupBy(F.substring("pattern", 1, 1 + SHORTEST)).applyInArrow(_surest, fit.schema)
    return {row.pattern: round(row.value, 4) for row in fit.orderBy(F.desc("sure"), "pattern").limit(PATTERNS).collect()}


def _harmless(judged: DataFrame) -> dict[str, float]:
    """Patterns that are no sign of the label, as exceptions."""
    rows = judged.where((F.col("value") < 0.5) & (F.col("sure") < 1.0) & (F.col("other_docs") >= 3)).select("pattern")
    return {row.pattern: 0.0 for row in rows.collect()}


def logistic(inputs: np.ndarray, marks: np.ndarray, penalty: float = 1e-2, steps: int = 40) -> tuple[float, ...]:
    """Logistic regression by Newton's method."""
    factors = np.zeros(inputs.shape[1])
    ridge = np.full(len(factors), penalty)
    for _ in range(steps):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ factors, -30, 30)))
        slope = inputs.T @ (marks - chance) - ridge * factors
        curve = (inputs * (chance * (1 - chance))[:, None]).T @ inputs + np.diag(ridge)
        step = np.linalg.solve(curve, slope)
        factors += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(x) for x in factors)


def learn_lexicon(docs: DataFrame, labels: DataFrame, rows: int = LEARN_ROWS) -> Lexicon:
    """Learn from at most ``rows`` labelled documents (``doc_id, text`` and ``id, mark``, 1 is toxic); near
    copies count once. Without both labels the lexicon is empty and all scores are alike and low."""
    chosen = labels.orderBy(F.xxhash64("id"), "id").limit(rows)
    # The chosen labels are bounded by ``rows``, so they go to the texts and not the texts to them.
    known = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["id"]).select("text", "mark", _gist("text").alias("gist"))
    known = stored(known.groupBy("gist", "mark").agg(F.min("text").alias("text")).select("text", "mark"), "learned")
    counts = _pattern_counts(known).where((F.col("pattern") == "") | (F.col("marked_docs") >= 4) | F.col("pattern").endswith(" "))
    counts = stored(counts, "patterns")
    whole = counts.where("pattern = ''").first()
    if whole is None or not whole.marked_docs or not whole.other_docs:
        return Lexicon({})
    judged = _judged(counts, whole)
    weights = choose(judged)
    if not weights:
        return Lexicon({})
    # Exceptions need a chosen beginning, so whole words are only fetched for those.
    beginnings, under = [p for p in weights if not p.endswith(" ")], F.lit(False)
    for size in sorted({len(p) for p in beginnings}):
        under = under | F.substring("pattern", 1, size).isin([p for p in beginnings if len(p) == size])
    lexicon = Lexicon(weights | _harmless(judged.where(F.col("pattern").endswith(" ") & under)))
    # What still counts may be harmless beside certain words.
    phrases = _judged(_pattern_counts(known, _phrases(lexicon)), whole)
    lexicon = Lexicon(lexicon.weights | _harmless(phrases))
    seen = known.select("mark", evidence_udf(lexicon)("text").alias("evidence"))
    seen = seen.select("mark", *(c.alias(f"x{k}") for k, c in enumerate(_inputs("evidence")))).toPandas()
    return Lexicon(lexicon.weights, logistic(seen.filter(like="x").to_numpy(float), seen["mark"].to_numpy(float)))


def score_toxicity(docs: DataFrame, lexicon: Lexicon, text_column: str = "text", name: str = "toxicity") -> DataFrame:
    """All columns of the documents and a struct ``toxicity``: ``score`` (0 to 1), ``words``, ``hits``, ``weight``.

    A missing or empty text has no hits and gets the score of no evidence. Rows without an id and
    repeated rows are scored like others; an empty table gives an empty result. A column of the
    struct's name is replaced.
    """
    scored = docs.withColumn(name, evidence_udf(lexicon)(docs[f"`{text_column}`"]))
    return scored.withColumn(
        name, F.struct(score_column(lexicon, name).alias("score"), *(F.col(f"{name}.{x}").alias(x) for x in EVIDENCE.names))
    )


def held_out(id_column: str = "doc_id") -> Column:
    """A fifth of the ids, which no label is learned from; rows without an id are held out."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(True))


@query()
def op4_toxicity(spark, sf_dir):
    """Toxicity of every document by a lexicon learned from four fifths of the labels."""
    docs = documents(spark, sf_dir)
    labels = labels_of(table(spark, sf_dir, "labels"), "toxic").where(~held_out("id"))
    lexicon = learn_lexicon(renamed(docs, doc_id="doc_id", text="text"), labels)
    scored = score_toxicity(docs, lexicon).select("doc_id", held_out().alias("held_out"), "toxicity.*")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits")
