"""Quality rules: a decision list learned by sequential covering.

Statistics of a text (ratios of symbols, repeats, capitals, word length and so on) are the
features. Rules for bad texts are grown one at a time on labelled statistics: conditions are added
by information gain while they shut out good texts, pruned on rows that did not grow them, kept
if they stay precise there, and the texts they cover are taken out before the next. The list is a
Spark conditional expression, so applying it is plain column work on the statistics.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.base import documents, fields, labels_of, query, renamed, table
from tidemark.llm.words import WordNumbers

# Labelled rows the list is learned from, at most: those with the smallest hashed ids.
LEARN_ROWS = 20_000
WINDOW = 8

_LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_OTHERS = ("n_lines", "n_distinct", "n_capitals", "n_marks", "n_digits", "n_ends", "longest_word")
STATISTICS = fields(**dict.fromkeys((*_LONGS, *_OTHERS), "long"))

# What is taken out of a text's bytes to count the rest: white space and the later bytes of a
# character, so that the rest has one byte for each code point of a word.
_NOT_WORD_CHARS = bytes([9, 10, 11, 12, 13, 32, *range(0x80, 0xC0)])


def repeated_words(words: list[bytes], numbers: np.ndarray) -> int:
    """Words inside any run of :data:`WINDOW` words that occurs twice or more in the text."""
    runs = len(words) - WINDOW + 1
    if runs < 2:
        return 0
    code = np.zeros(runs, np.uint64)
    for k in range(WINDOW):
        code = code * np.uint64(0x9E3779B97F4A7C15) + numbers[k : k + runs].astype(np.uint64) + np.uint64(1)
        code ^= code >> np.uint64(29)
    order = np.sort(code)
    if not (order[1:] == order[:-1]).any():
        return 0
    # Equal codes are compared word by word, so that a chance equality of codes counts for nothing.
    twice = np.isin(code, order[1:][order[1:] == order[:-1]])
    seen: dict[tuple, list[int]] = {}
    for at in np.flatnonzero(twice).tolist():
        seen.setdefault(tuple(words[at : at + WINDOW]), []).append(at)
    edges = np.zeros(len(words) + 1, np.int64)
    for places in seen.values():
        if len(places) > 1:
            for at in places:
                edges[at] += 1
                edges[at + WINDOW] -= 1
    return int((np.cumsum(edges)[:-1] > 0).sum())


def statistics(raw: bytes, known: WordNumbers) -> tuple[int, ...]:
    """The statistics of one text, in the order of :data:`STATISTICS`."""
    size = len(raw)

    def count(characters: bytes) -> int:
        return size - len(raw.translate(None, characters))

    words = raw.split()
    numbers = known.numbers(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words),
        len(raw.translate(None, _NOT_WORD_CHARS)),
        count(b"#*$%&|<>"),
        len(lines) - len(set(lines)),
        repeated_words(words, numbers),
        len(lines),
        len(np.unique(numbers)),
        count(bytes(range(65, 91))),
        count(b"!?"),
        count(b"0123456789"),
        count(b".,;:"),
        max(map(len, words), default=0),
    )


_known = WordNumbers()


@arrow_udf(STATISTICS)
def text_statistics(texts: pa.Array) -> pa.Array:
    rows = [statistics(raw or b"", _known) for raw in texts.cast(pa.binary()).to_pylist()]
    columns = np.array(rows, np.int64).reshape(len(rows), len(STATISTICS)).T
    return pa.StructArray.from_arrays([pa.array(column) for column in columns], fields=list(to_arrow_type(STATISTICS)))


text_statistics = text_statistics.asNondeterministic()  # so that it is never evaluated twice


def features(at: Callable[[str], Column] = F.col) -> dict[str, Column]:
    """Columns of the rules' features, by name; ``at`` gives the column of a statistic."""

    def ratio(part: str, whole: str) -> Column:
        return at(part) / F.greatest(at(whole), F.lit(1))

    return {
        "n_words": at("n_words").cast("double"),
        "word_length": ratio("word_chars", "n_words"),
        "longest_word": at("longest_word").cast("double"),
        "symbols": ratio("n_symbols", "n_words"),
        "duplicate_lines": ratio("n_dup_lines", "n_lines"),
        "repeated_words": ratio("n_repeat_words", "n_words"),
        # Distinct words grow as a power of all words; the power compares texts of any length.
        "variety": F.log1p(at("n_distinct")) / F.log1p(F.greatest(at("n_words"), F.lit(1))),
        "capitals": ratio("n_capitals", "word_chars"),
        "marks": ratio("n_marks", "n_words"),
        "digits": ratio("n_digits", "word_chars"),
        "sentence_ends": ratio("n_ends", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    """``feature <= threshold``, or ``>`` when not ``below``."""

    feature: str
    below: bool
    threshold: float

    def column(self, at: Callable[[str], Column] = F.col) -> Column:
        value = features(at)[self.feature]
        return value <= self.threshold if self.below else value > self.threshold

    def mask(self, values: dict[str, np.ndarray]) -> np.ndarray:
        value = values[self.feature]
        return value <= self.threshold if self.below else value > self.threshold


Rule = tuple[Condition, ...]


def covered(rule: Sequence[Condition], values: dict[str, np.ndarray], rows: int) -> np.ndarray:
    mask = np.ones(rows, bool)
    for condition in rule:
        mask &= condition.mask(values)
    return mask


def _gain(before: tuple[int, int], p: np.ndarray, n: np.ndarray) -> np.ndarray:
    start = math.log2(before[0] / (before[0] + before[1]))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(p > 0, p * (np.log2(p / (p + n)) - start), -1.0)


def _best_condition(values: dict[str, np.ndarray], bad: np.ndarray, mask: np.ndarray) -> tuple[float, Condition | None]:
    """The condition of largest gain on the rows of ``mask``; all places between values are tried."""
    best: tuple[float, Condition | None] = (0.0, None)
    before = (int(bad[mask].sum()), int((~bad)[mask].sum()))
    for name, column in values.items():
        value, target = column[mask], bad[mask]
        order = np.argsort(value, kind="stable")
        value, target = value[order], target[order]
        places = np.flatnonzero(value[1:] > value[:-1])
        if not len(places):
            continue
        p, n = np.cumsum(target)[places], np.cumsum(~target)[places]
        for below, gains in ((True, _gain(before, p, n)), (False, _gain(before, before[0] - p, before[1] - n))):
            at = int(np.argmax(gains))
            if gains[at] > best[0] + 1e-9:
                best = (float(gains[at]), Condition(name, below, float((value[places[at]] + value[places[at] + 1]) / 2)))
    return best


def learn(
    values: dict[str, np.ndarray], bad: np.ndarray, *, precision: float = 0.9, support: int = 4, longest: int = 4, most: int = 30
) -> list[Rule]:
    """Sequential covering. Every third row prunes, the others grow; a rule must cover ``support`` bad
    rows of all and be right on ``precision`` of what it covers, in all rows and in the pruning ones.
    """
    rows = len(bad)
    left, prunes = np.ones(rows, bool), np.arange(rows) % 3 == 2
    rules: list[Rule] = []
    while len(rules) < most and (bad & left & ~prunes).any():
        rule: list[Condition] = []
        mask = left & ~prunes
        while len(rule) < longest and (mask & ~bad).any():
            _, condition = _best_condition(values, bad, mask)
            if condition is None:
                break
            rule.append(condition)
            mask &= condition.mask(values)
        held = left & prunes

        def worth(size: int) -> float:
            hit = covered(rule[:size], values, rows) & held
            p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
            return (p - n) / (p + n) if p + n else -1.0

        if not rule:
            break
        size = max(range(1, len(rule) + 1), key=lambda k: (worth(k), -k))
        rule = rule[:size]
        hit = covered(rule, values, rows) & left
        right, hits = int((hit & bad).sum()), int(hit.sum())
        pruned, pruned_hits = int((hit & bad & prunes).sum()), int((hit & prunes).sum())
        if right < support or right < precision * hits or pruned + 1 < precision * (pruned_hits + 1):
            break
        rules.append(tuple(rule))
        left &= ~hit
    return rules


def verdict(rules: Sequence[Rule], at: Callable[[str], Column] = F.col) -> Column:
    """Number of the first rule that holds (from 1), or 0: an ordered conditional expression."""
    chain = None
    for number, rule in enumerate(rules, 1):
        holds = F.lit(True)
        for condition in rule:
            holds = holds & condition.column(at)
        chain = F.when(holds, number) if chain is None else chain.when(holds, number)
    return F.lit(0) if chain is None else chain.otherwise(0)


def learn_rules(docs: DataFrame, labels: DataFrame, rows: int = LEARN_ROWS, **options) -> list[Rule]:
    """Learn from at most ``rows`` labelled documents (``doc_id, text`` and ``id, mark``, 1 is good)."""
    chosen = labels.orderBy(F.xxhash64("id"), "id").limit(rows)
    # Bounded by ``rows``, so the labels go to the texts and not the texts to them.
    known = docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["id"])
    known = known.select("doc_id", "mark", text_statistics("text").alias("s")).select("doc_id", "mark", "s.*")
    found = known.select("doc_id", (F.col("mark") == 0).alias("bad"), *(column.alias(f"f_{name}") for name, column in features().items()))
    # Repeated ids could bring more rows than labels; the order makes the result the same each time.
    found = found.orderBy(F.xxhash64("doc_id"), *found.columns).limit(rows).toPandas()
    if found.empty or not found.bad.any():
        return []
    return learn({name: found[f"f_{name}"].to_numpy(float) for name in features()}, found.bad.to_numpy(bool), **options)


def base_failed(at: Callable[[str], Column] = F.col) -> Column:
    """The fixed rule: fewer than 20 words, or more than 30 % of them in repeated runs."""
    return (at("n_words") < 20) | (100 * at("n_repeat_words") > 30 * at("n_words"))


def judge_quality(
    docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", rows: int = LEARN_ROWS
) -> DataFrame:
    """All columns of the documents and a struct ``quality``: the statistics, ``base_failed``, ``rule``
    (the first learned rule that holds, or 0) and ``kept``. ``labels`` has ``id`` and ``mark`` (1 is good).

    A missing or empty text has no words and fails the base rule. Without labels, or without bad
    ones, there are no learned rules and the base rule alone decides. Rows without id are judged, not
    learned from; repeated rows are judged alike. A column named ``quality`` is replaced.
    """
    rules = learn_rules(renamed(docs, doc_id=id_column, text=text_column), labels, rows)
    judged = docs.withColumn("quality", text_statistics(docs[f"`{text_column}`"]))

    def at(name: str) -> Column:
        return F.col(f"quality.{name}")

    failed, rule = base_failed(at), verdict(rules, at)
    return judged.withColumn(
        "quality",
        F.struct(
            *(at(name).alias(name) for name in STATISTICS.names),
            failed.alias("base_failed"),
            rule.alias("rule"),
            (~failed & (rule == 0)).alias("kept"),
        ),
    )


@query()
def op3_quality_rules(spark, sf_dir):
    """Base statistics and the verdict of base rule and learned list for every document."""
    judged = judge_quality(documents(spark, sf_dir), labels_of(table(spark, sf_dir, "labels"), "quality"))
    return judged.select("doc_id", *(f"quality.{name}" for name in (*_LONGS, "base_failed", "kept", "rule")))
