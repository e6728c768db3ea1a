"""Audit of how filters interact: what each removes, in every order, and its fair share.

A coalition is a set of filters; its worth is the number of documents that fail at least one of them.
The potential of a removal game is found coalition by coalition,

    P(S) = (worth(S) + sum of P(S without i) over i in S) / |S|,      P(nothing) = 0,

and a filter's Shapley value is P(all) - P(all without it). Multiplied by the number of orders, potentials
stay whole numbers. What a step of an order removes is worth(before and it) - worth(before), so no order is
ever applied to documents: each document is read once and counted under the set of filters that it fails.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import documents, query, renamed, stored
from tidemark.queries.base import table

SPACE = r"[\x20\x09-\x0D]+"
MEASURES = ("docs", "good", "toxic")
#: The audited filters but for the copies, in SQL; `words` are the text's.
FILTERS = {
    "A": "size(words) < 50",
    "B": "100 * size(array_distinct(words)) < 65 * size(words)",
    "C": "100 * char_length(regexp_replace(text, '[^A-Z]+', '')) > 5 * char_length(text)",
    "D": "text rlike '[#$%&*|]'",
}
COPIES = "E"


def _added(columns) -> Column:
    return reduce(lambda a, b: a + b, columns)


def failures(docs: DataFrame, filters: Mapping[str, str] = FILTERS, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source") -> DataFrame:
    """``doc_id, part, mask`` for each row: bit k of the mask tells that it fails filter k; the last bit, that
    a smaller id has the same text.

    A missing text is an empty one, a missing part the empty text. A row without an id is no copy and makes
    none; rows that repeat an id and a text are copies only of smaller ids.
    """
    rows = renamed(docs, doc_id=id_column, text=text_column, part=part_column)
    rows = rows.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    bits = [F.when(F.expr(test), 1 << k).otherwise(0) for k, test in enumerate(filters.values())]
    same = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("same")
    facts = stored(rows.select("doc_id", "part", _added(bits).cast("int").alias("mask"), same), "failures")
    # Stored, so that the join shuffles its two sides by themselves and a hot text is split.
    firsts = facts.groupBy("same").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    firsts = stored(firsts.select("same", "first"), "firsts")
    copied = F.when(F.col("doc_id") > F.col("first"), 1 << len(filters)).otherwise(0)
    return facts.join(firsts, "same", "left").select("doc_id", "part", (F.col("mask") + copied).alias("mask"))


def marks(labels: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``label_id, good, toxic``: one row per labelled id, 1 where any of its labels is."""
    rows = renamed(labels, label_id=id_column, quality="quality", toxic="toxic").where("label_id is not null")
    return rows.groupBy("label_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )


def cells(failed: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, docs, good, toxic``: documents of a part by the set of filters they fail. Masks of one
    document are counted before they meet the labels, so repeated ids merge."""
    once = stored(failed.groupBy("doc_id", "part", "mask").agg(F.count(F.lit(1)).alias("docs")), "masks")
    known = stored(marks(labels), "marks")
    joined = once.join(known, once["doc_id"] == known["label_id"], "left")
    weighed = [F.sum(F.col("docs") * F.coalesce(F.col(name), F.lit(0))).cast("long").alias(name) for name in ("good", "toxic")]
    return joined.groupBy("part", "mask").agg(F.sum("docs").cast("long").alias("docs"), *weighed)


def worths(counted: DataFrame, players: int) -> DataFrame:
    """One row per part: ``total``, and for each measure an array with the worth of every coalition."""
    held = F.collect_list(F.struct("mask", *MEASURES))  # a row for each mask at most
    parts = counted.groupBy("part").agg(held.alias("held"), F.sum("docs").alias("total"))
    coalitions = F.sequence(F.lit(0), F.lit((1 << players) - 1))

    def worth(measure: str) -> Column:
        def of(coalition: Column) -> Column:
            hit = lambda cell: cell["mask"].bitwiseAND(coalition) != 0
            return F.aggregate("held", F.lit(0).cast("long"), lambda total, cell: total + F.when(hit(cell), cell[measure]).otherwise(0))

        return F.transform(coalitions, of)

    return parts.select("part", "total", *(worth(measure).alias(measure) for measure in MEASURES))


def potential(worth: Column, players: int) -> Column:
    """The potential of every coalition, times the number of orders, as an array: each from those of the
    coalitions with one filter less, which have smaller numbers."""
    bits, orders = [1 << k for k in range(players)], factorial(players)

    def grown(found: Column, coalition: Column) -> Column:
        lesser = [F.when(coalition.bitwiseAND(bit) != 0, F.get(found, coalition - bit)).otherwise(0) for bit in bits]
        whole = F.get(worth, coalition) * orders + _added(lesser)
        return F.concat(found, F.array(F.call_function("div", whole, F.bit_count(coalition).cast("long"))))

    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << players) - 1)), F.array(F.lit(0).cast("long")), grown)


def removals(counted: DataFrame, letters: str) -> DataFrame:
    """One row per part, order and step, from the counts of :func:`cells`; bit k is the k-th letter."""
    players, everything = len(letters), (1 << len(letters)) - 1
    games = worths(counted, players).withColumn("potential", potential(F.col("docs"), players))
    orders = F.split(F.lit(",".join(map("".join, permutations(letters)))), ",")
    rows = games.select("*", F.explode(orders).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(players))).alias("step"))
    earlier = F.substr("filter_order", F.lit(1), F.col("step") - 1)
    bit = {letter: 1 << k for k, letter in enumerate(letters)}
    rows = rows.withColumn("before", _added(F.when(F.contains(earlier, F.lit(x)), bit[x]).otherwise(0) for x in letters))
    rows = rows.withColumn("own", _added(F.when(F.substr("filter_order", "step", F.lit(1)) == x, bit[x]).otherwise(0) for x in letters))
    upto, rest = F.col("before") + F.col("own"), F.lit(everything) - F.col("own")
    lost = {measure: F.get(measure, upto) - F.get(measure, "before") for measure in MEASURES}
    return rows.select(
        "part", "filter_order", "step",
        (F.col("total") - F.get("docs", upto)).alias("kept"),
        lost["docs"].alias("removed"),
        (F.get("docs", "own") - lost["docs"]).alias("redundant"),
        (F.get("docs", F.lit(everything)) - F.get("docs", rest)).alias("unique_fails"),
        lost["good"].alias("good_lost"),
        lost["toxic"].alias("toxic_lost"),
        (F.get("potential", F.lit(everything)) - F.get("potential", rest)).alias("shapley"),
    )


def audit_filters(docs: DataFrame, labels: DataFrame, filters: Mapping[str, str] = FILTERS) -> DataFrame:
    """Every order of the filters (and of the copies, :data:`COPIES`) applied to every part of the documents.

    Nulls and repeats are as told at :func:`failures`; a document is good or toxic if any label of its id says
    so. No documents give no rows.
    """
    return removals(cells(failures(docs, filters), labels), "".join(filters) + COPIES)


@query(
    r"""
    WITH said AS (
        SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
        FROM labels GROUP BY doc_id
    ), worded AS (
        SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
        FROM documents
    ), failed AS (
        SELECT doc_id, part,
               [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
                100 * length(regexp_replace(body, '[^A-Z]+', '', 'g')) > 5 * length(body), regexp_matches(body, '[#$%&*|]'),
                coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false)] AS fails
        FROM worded
    ), counted AS (
        SELECT part, fails, count(*) AS docs, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
        FROM failed LEFT JOIN said USING (doc_id) GROUP BY part, fails
    ), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
    ), orders AS (
        SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
        FROM letters a, letters b, letters c, letters d, letters e
        WHERE b.x <> a.x AND c.x NOT IN (a.x, b.x) AND d.x NOT IN (a.x, b.x, c.x) AND e.x NOT IN (a.x, b.x, c.x, d.x)
    ), steps AS (
        SELECT filter_order, CAST(s AS INTEGER) AS step, filter_order[s] AS own,
               list_transform(string_split(filter_order[1:s - 1], ''), lambda x: ascii(x) - 64) AS earlier
        FROM orders, range(1, 6) AS r(s)
    ), taken AS (
        SELECT part, filter_order, step, own, docs, good, toxic,
               fails[ascii(own) - 64] AS fails_own,
               coalesce(list_bool_or(list_transform(earlier, lambda k: fails[k])), false) AS gone,
               len(list_filter(fails, lambda f: f)) AS n_fails
        FROM counted, steps
    ), each AS (
        SELECT part, filter_order, step, own,
               sum(CASE WHEN NOT gone AND NOT fails_own THEN docs ELSE 0 END) AS kept,
               sum(CASE WHEN NOT gone AND fails_own THEN docs ELSE 0 END) AS removed,
               sum(CASE WHEN gone AND fails_own THEN docs ELSE 0 END) AS redundant,
               sum(CASE WHEN fails_own AND n_fails = 1 THEN docs ELSE 0 END) AS unique_fails,
               sum(CASE WHEN NOT gone AND fails_own THEN good ELSE 0 END) AS good_lost,
               sum(CASE WHEN NOT gone AND fails_own THEN toxic ELSE 0 END) AS toxic_lost
        FROM taken GROUP BY part, filter_order, step, own
    )
    SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
           CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
           CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
    FROM each
    """
)
def op11_filter_audit(spark, sf_dir):
    """Five filters in all their orders, over all documents by source."""
    return audit_filters(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
