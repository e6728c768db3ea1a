"""Promotion of a staging table into a production table.

Every function takes the production frame and the staging frame and returns the next
production frame; nothing is written here. Staging is a window of changes and production is
the long history. Replacing strategies join production to the staged keys with production on
the streamed side: the engine sizes the keys, broadcasts a small side, otherwise shuffles both sides on the key
and splits a hot header by the adaptive skew join. Merging ones need both sides' rows and match them in one full
outer join. A table kept by partitions is read only where staging falls; one kept in buckets of the key is
not exchanged at all (:mod:`tidemark.sources.tables`).

Keys match NULL to NULL. The exact bodies of the promotion jobs are not published; the
strategies follow their written definitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.functions.typing import as_columns
from tidemark.sources.tables import PartitionedTable

# The strategy names.
STRATEGIES = (
    "truncate_insert",
    "pk_merge",
    "pk_delete_insert",
    "pk_delete_insert_on_header",
    "versioned_delete_insert",
    "filter_active",
)

NEW, PERSISTING, RESOLVED = "New", "Persisting", "Resolved"

def same_key(left: str, right: str, keys: Sequence[str], null_keys: bool = True) -> Column:
    """Equality of the key columns of two aliased frames; NULL matches NULL, unless ``null_keys`` is off."""

    def same(key: str) -> Column:
        ours, theirs = col(key, left), col(key, right)
        return ours.eqNullSafe(theirs) if null_keys else ours == theirs

    return reduce(lambda a, b: a & b, map(same, keys))


def has_null_keys(stg: DataFrame, keys: Sequence[str]) -> bool:
    """Whether any staged key has a NULL part. If none has, NULLs of production match nothing either way, and
    plain equality, which buckets can serve, says the same."""
    return not stg.where(reduce(lambda a, b: a | b, (col(key).isNull() for key in keys))).isEmpty()


def _check_columns(prod: DataFrame, stg: DataFrame) -> None:
    unknown = [name for name in stg.columns if name not in prod.columns]
    if unknown:
        raise ValueError(f"Staging columns do not exist in the production table: {unknown}")


def distinct_keys(stg: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; rows of a hot key merge before they are shuffled."""
    return stg.select(*as_columns(keys)).distinct()


def matching(prod: DataFrame, stg: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Production rows whose key is in staging."""
    return prod.alias("p").join(distinct_keys(stg, keys).alias("s"), same_key("p", "s", keys), "left_semi")


def not_matching(prod: DataFrame, stg: DataFrame, keys: Sequence[str], null_keys: bool = True) -> DataFrame:
    """Production rows whose key is not in staging."""
    staged = distinct_keys(stg, keys)
    if not null_keys:
        # Sides in buckets of the key meet bucket by bucket; a broadcast would mix the buckets for the write.
        staged = staged.hint("merge")
    return prod.alias("p").join(staged.alias("s"), same_key("p", "s", keys, null_keys), "left_anti")


def truncate_insert(prod: DataFrame | None, stg: DataFrame) -> DataFrame:
    """Production becomes staging."""
    return stg


def delete_insert(
    prod: DataFrame | None, stg: DataFrame, keys: Sequence[str], null_keys: bool = True
) -> DataFrame:
    """Delete the production rows that match staging on ``keys``, then insert all of staging.

    With the primary key this replaces rows, with a header key whole headers (lines that left
    the source go too), with key and stamps it keeps changed rows as history.
    """
    if prod is None:
        return stg
    _check_columns(prod, stg)
    kept = not_matching(prod, stg, keys, null_keys)
    return kept.unionByName(stg, allowMissingColumns=True).select(*as_columns(prod.columns))


def versioned_delete_insert(
    prod: DataFrame | None, stg: DataFrame, keys: Sequence[str], stamps: Sequence[str], null_keys: bool = True
) -> DataFrame:
    """:func:`delete_insert` on the key and the version stamps."""
    return delete_insert(prod, stg, [*keys, *stamps], null_keys)


def merge(prod: DataFrame | None, stg: DataFrame, keys: Sequence[str], null_keys: bool = True) -> DataFrame:
    """Upsert: matched rows take the staging values and keep the columns staging lacks."""
    if prod is None:
        return stg
    _check_columns(prod, stg)
    if not set(prod.columns) - set(stg.columns):
        return delete_insert(prod, stg, keys, null_keys)
    staged = F.col("s._staged").isNotNull()
    return _matched(prod, stg, keys, null_keys).select(
        *(
            (F.when(staged, col(name, "s")).otherwise(col(name, "p")) if name in stg.columns else col(name, "p")).alias(name)
            for name in prod.columns
        )
    )


def _matched(prod: DataFrame, stg: DataFrame, keys: Sequence[str], null_keys: bool = True) -> DataFrame:
    """Production ``p`` and staging ``s`` side by side by key, rows without a partner too; ``p._stored`` and
    ``s._staged`` tell which sides a row has. Each side is read once and exchanged once (not at all where it
    is bucketed by the key)."""
    left = prod.select(*as_columns(prod.columns), F.lit(True).alias("_stored")).alias("p")
    right = stg.select(*as_columns(stg.columns), F.lit(True).alias("_staged")).alias("s")
    return left.join(right, same_key("p", "s", keys, null_keys), "full_outer")


def filter_active(prod: DataFrame | None, stg: DataFrame, where: Sequence[str]) -> DataFrame:
    """Production becomes the staging rows that pass every predicate (Spark SQL text)."""
    return reduce(lambda frame, predicate: frame.where(F.expr(predicate)), where, stg)


def guarded_merge(
    prod: DataFrame, feed: DataFrame, keys: Sequence[str], columns: Sequence[str], guard: str
) -> DataFrame:
    """Set ``columns`` from a side feed on rows whose key matches and whose guard holds.

    ``guard`` is Spark SQL over ``s`` (the feed) and ``p`` (production). ``feed`` has one row
    per key. Rows without a match, and all other columns, stay as they are.
    """
    update = feed.select(*as_columns(feed.columns), F.lit(True).alias("_fed"))
    joined = prod.alias("p").join(update.alias("s"), same_key("p", "s", keys), "left")
    hit = F.coalesce(F.col("s._fed") & F.expr(guard), F.lit(False))
    return joined.select(
        *(
            F.when(hit, col(name, "s")).otherwise(col(name, "p")).alias(name) if name in columns else col(name, "p")
            for name in prod.columns
        )
    )


def lifecycle_merge(
    prod: DataFrame | None,
    stg: DataFrame,
    keys: Sequence[str],
    now: Column,
    status: str = "ErrorStatus",
    stamp: str = "LastUpdate"
) -> DataFrame:
    """Stamp keys New, Persisting or Resolved; nothing is deleted.

    Matched rows take the staging values. Rows gone from staging are stamped Resolved again on
    each run. One full outer match tells all three.
    """
    if prod is None:
        return stg.select(*as_columns(stg.columns), F.lit(NEW).alias(status), now.alias(stamp))
    _check_columns(prod, stg)
    is_open, was_there = F.col("s._staged").isNotNull(), F.col("p._stored").isNotNull()

    def value(name: str) -> Column:
        if name == status:
            return F.when(is_open & was_there, PERSISTING).when(is_open, NEW).otherwise(RESOLVED)
        if name == stamp:
            return now
        return F.when(is_open, col(name, "s")).otherwise(col(name, "p")) if name in stg.columns else col(name, "p")

    return _matched(prod, stg, keys).select(*(value(name).alias(name) for name in prod.columns))


def status_snapshot(
    stats: DataFrame | None,
    errors: DataFrame,
    report_date: Column,
    groups: Sequence[str] = ("ErrorStatus", "ErrorMessageNumber"),
    stamp: str = "LastUpdate",
) -> DataFrame:
    """Count the rows stamped on or after the date by status and number; a rerun on the same
    date replaces that date's rows."""
    today = (
        errors.where(col(stamp) >= report_date)
        .groupBy(*as_columns(groups))
        .agg(F.count(F.lit(1)).alias("ErrorCount"))
        .select(*as_columns(groups), F.col("ErrorCount"), report_date.alias("ReportDate"))
    )
    if stats is None:
        return today
    return stats.where(~F.col("ReportDate").eqNullSafe(report_date)).unionByName(today)


def matched_key(strategy: str, keys: Sequence[str], header_key: Sequence[str] = (), stamps: Sequence[str] = ()) -> list[str]:
    """The columns on which a strategy matches production and staging; none for one that does not match."""
    if strategy in {"truncate_insert", "filter_active"}:
        return []
    if strategy == "pk_delete_insert_on_header":
        return [*header_key]
    return [*keys, *stamps] if strategy == "versioned_delete_insert" else [*keys]


def promote(
    prod: DataFrame | None,
    stg: DataFrame,
    strategy: str,
    *,
    keys: Sequence[str] = (),
    header_key: Sequence[str] = (),
    stamps: Sequence[str] = ("create stamp", "update stamp"),
    where: Sequence[str] = (),
    null_keys: bool = True
) -> DataFrame:
    """The next production frame under a strategy by name. ``null_keys`` may be turned off where no staged key
    has a NULL part (:func:`has_null_keys`)."""
    if strategy == "truncate_insert":
        return truncate_insert(prod, stg)
    if strategy == "filter_active":
        return filter_active(prod, stg, where)
    if not keys:
        raise ValueError(f"{strategy} needs key columns.")
    if strategy == "pk_merge":
        return merge(prod, stg, keys, null_keys)
    if strategy == "pk_delete_insert":
        return delete_insert(prod, stg, keys, null_keys)
    if strategy == "pk_delete_insert_on_header":
        if not header_key or [*keys][: len(header_key)] != [*header_key]:
            raise ValueError(f"header_key {list(header_key)} must be a prefix of the key {list(keys)}.")
        return delete_insert(prod, stg, header_key, null_keys)
    if strategy == "versioned_delete_insert":
        return versioned_delete_insert(prod, stg, keys, stamps, null_keys)
    raise ValueError(f"no strategy {strategy!r}; there are {', '.join(STRATEGIES)}")


def rewrite_partitions(
    table: PartitionedTable,
    changes: DataFrame,
    rewrite: Callable[[DataFrame | None], DataFrame],
) -> int:
    """Rewrite only the partitions that ``changes`` touches.

    ``rewrite`` is given the rows of those partitions; the rest of the table is neither read nor
    written. Right only when a key never moves between partitions, that is when the table's columns
    are part of the key that ``rewrite`` matches on.
    """
    parts = table.named(changes)
    return table.overwrite(rewrite(table.read(parts)), parts)


def check_partitioning(strategy: str, partition_by: Sequence[str], keys: Sequence[str], header_key: Sequence[str]) -> None:
    """A strategy may run by partitions only when it matches on the partition columns."""
    matched = matched_key(strategy, keys, header_key)
    if not matched or not set(partition_by) <= set(matched):
        raise ValueError(f"{strategy} on {list(matched)} cannot be done by partitions of {list(partition_by)}.")


def check_bucketing(bucket_by: Sequence[str], matched: Sequence[str]) -> None:
    """Buckets save the exchange only when they are those of the whole matched key."""
    if list(bucket_by) != list(matched):
        raise ValueError(f"a table in buckets of {list(bucket_by)} cannot be matched on {list(matched)} without moving it.")
