"""Sharding by a minimax contiguous partition.

Rows of one group (equal texts) stay together. Groups stand in the order of their smallest id;
the smallest capacity is searched with which cutting that order greedily needs no more than the
wanted number of shards. The search asks only for "the last group end at or below x", which a
summary of the ends answers within bounds: the ends are counted off into a fixed number of equal
buckets (smallest and largest end of each), a check with the lower bounds proves a capacity, one
with the upper bounds disproves it, and the few stretches in which the cuts can still lie are
summarised again, finer, until one capacity is left. The driver never holds more than
``BUCKETS`` buckets, whatever the number of groups.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import documents, query, renamed, stored
from tidemark.llm.ordered import global_starts, ranged, running

BUCKETS = 1 << 15
OVERHEAD = 16


class Ends:
    """Bounds on the last group end at or below a point, from bucketed ends."""

    def __init__(self, buckets: list[tuple[int, int]]) -> None:
        self.low = [low for low, _ in buckets]
        self.high = [high for _, high in buckets]

    def last(self, x: int, sure: bool) -> int:
        """A group end at or below ``x`` (``sure``), or a bound that the last one does not exceed."""
        at = bisect_right(self.low, x) - 1
        if at < 0:
            return 0
        if self.high[at] <= x:
            return self.high[at]
        return self.low[at] if sure else x


def cuts(ends: Ends, capacity: int, shards: int, total: int, sure: bool) -> list[int]:
    """Where greedy shards of ``capacity`` end; the last is ``total`` if they suffice."""
    at, found = 0, []
    for _ in range(shards):
        at = total if at + capacity >= total else max(at, ends.last(at + capacity, sure))
        found.append(at)
    return found


def smallest(low: int, high: int, holds) -> int:
    """The least number from ``low`` to ``high`` for which ``holds``; it holds for ``high``."""
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if holds(middle) else (middle + 1, high)
    return low


def _summary(groups: DataFrame, stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Smallest and largest group end of each bucket; the buckets divide the stretches evenly."""
    each = max(1, BUCKETS // len(stretches))
    bucket = F.lit(None).cast("long")
    for k, (start, end) in enumerate(stretches):
        width = max(1, -(-(end - start + 1) // each))
        bucket = F.when(F.col("end").between(start, end), F.floor((F.col("end") - start) / width) + k * each).otherwise(bucket)
    rows = groups.select("end", bucket.alias("bucket")).where("bucket is not null")
    found = rows.groupBy("bucket").agg(F.min("end").alias("low"), F.max("end").alias("high")).collect()
    return sorted((row.low, row.high) for row in found)


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping stretches as one."""
    found: list[tuple[int, int]] = []
    for start, end in sorted(stretches):
        if found and start <= found[-1][1] + 1:
            found[-1] = (found[-1][0], max(end, found[-1][1]))
        else:
            found.append((start, end))
    return found


def minimax_cuts(groups: DataFrame, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """The least capacity and the shard ends for it. ``groups`` has the running total ``end``."""
    if not total:
        return 0, [0] * shards
    low, high = max(largest, -(-total // shards)), total
    stretches = [(0, total)]
    while True:
        ends = Ends(_summary(groups, stretches))
        high = smallest(low, high, lambda c: cuts(ends, c, shards, total, True)[-1] >= total)
        low = smallest(low, high, lambda c: cuts(ends, c, shards, total, False)[-1] >= total)
        if low >= high:
            return high, cuts(ends, high, shards, total, True)
        first, last = cuts(ends, low, shards, total, True), cuts(ends, high, shards, total, False)
        narrowed = merged([(a, b) for a, b in zip(first, last)])
        if narrowed == stretches:  # every bucket is one end wide already
            return high, cuts(ends, high, shards, total, True)
        stretches = narrowed


def assign_shards(docs: DataFrame, shards: int = 40, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Put every row into a contiguous shard by size: ``doc_id, size, text_crc32, shard, slot, start``.

    The size is the text's UTF-8 bytes plus 16. A missing text has no bytes, checksum 0, and all
    missing texts are one group, apart from the empty one. Ids may be missing (first in order) or
    repeated. With fewer groups than shards the last shards stay empty; an empty table gives an
    empty result.
    """
    rows = renamed(docs, doc_id=id_column, text=text_column).select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0).cast("long")).alias("text_crc32"),
        F.coalesce(F.unhex(F.sha2(F.col("text").cast("binary"), 256)), F.lit(b"")).alias("same"),
    )
    slim = stored(rows, "sizes")
    # Stored, so that the join below shuffles its two sides by themselves and a hot group is split.
    groups = stored(slim.groupBy("same").agg(F.min("doc_id").alias("first"), F.sum("size").alias("weight")), "groups")
    placed = slim.join(groups, "same").select(
        "first", "same", "doc_id", "size", "text_crc32", "weight", F.lit(1).cast("long").alias("one")
    )
    totals = {"start": "size", "place": "one"}
    ordered = running(ranged(placed, ["first", "same", "doc_id"]), totals).drop("first")
    ordered = global_starts(stored(ordered, "order"), totals)
    heads = ordered.groupBy("same").agg((F.min("start") + F.max("weight")).alias("end"), F.max("weight").alias("weight"))
    heads = stored(heads, "ends")
    seen = heads.agg(F.coalesce(F.sum("weight"), F.lit(0)).alias("total"), F.coalesce(F.max("weight"), F.lit(0)).alias("largest")).first()
    _, found = minimax_cuts(heads, seen.total, seen.largest, shards)
    shard = sum((F.when(F.col("start") >= cut, 1).otherwise(0) for cut in found[:-1]), F.lit(0))
    ordered = ordered.select("doc_id", "size", "text_crc32", "start", "place", shard.cast("int").alias("shard"))
    first = ordered.groupBy("shard").agg(F.min("place").alias("head"))  # one row per shard
    return ordered.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("head")).alias("slot"), "start"
    )


@query()
def op10_shards(spark, sf_dir):
    """All documents in 40 shards of near equal bytes, equal texts together."""
    return assign_shards(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
