"""Connected components of a link table, by joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.base import stored


def _hooked(links: DataFrame, larger: bool) -> DataFrame:
    """One round: every node links its neighbours (``larger``: those above it; else those below it,
    and itself) to the least of them. Only a node's least neighbour is aggregated; the join deals
    a node with many neighbours out."""
    if larger:
        sides = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = sides.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        found = sides.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("low"))
        found = links.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        found = found.unionByName(least.select("a", F.col("low").alias("b")))
    return found.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(a, b)``: for each linked node but the least of its component, that least node.

    Rounds of hooking neighbours to larger, then to smaller nodes, until the links are stars; each
    round is stored. The number of rounds grows with the logarithm of the component's length, not
    with its size. Links of a node to itself or to nothing are ignored.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()
    links, mark = stored(links, "links"), None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == mark:
            return links
        mark = state
        links = stored(_hooked(_hooked(links, True), False), "links")
