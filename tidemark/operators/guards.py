"""Checks that stop a bad load before it is visible. Each returns rows; :func:`decide` acts."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.functions.typing import MIXED_DATE_FORMATS, as_columns, parse_stamp, shape_of, varchar_limit

log = logging.getLogger("tidemark")

MODES = ("enforce", "warn", "skip")

# Fixed value: what the log says of a load whose file lacked optional columns.
OPTIONAL_MISSING = "COLUMN NOT FOUND (warning): expected file column(s) {} missing; not loaded, ETL continued."


class GuardError(ValueError):
    """A check in enforce mode failed."""


def decide(mode: str, message: str | None) -> str | None:
    """Raise, log or ignore a failed check; returns the message it logged."""
    if mode not in MODES:
        raise ValueError(f"no mode {mode!r}; there are {', '.join(MODES)}")
    if message is None or mode == "skip":
        return None
    if mode == "enforce":
        raise GuardError(message)
    log.warning(message)
    return message


def duplicate_keys(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their count. NULL keys count as equal."""
    missing = [key for key in keys if key not in frame.columns]
    if missing:
        raise ValueError(f"pk_check names columns the frame lacks: {missing}")
    return frame.groupBy(*as_columns(keys)).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def duplicate_sample(frame: DataFrame, keys: Sequence[str], top: int = 20) -> DataFrame:
    """The ``top`` most repeated keys; ties go by key."""
    return duplicate_keys(frame, keys).orderBy(F.col("count").desc(), *as_columns(keys)).limit(top)


def check_keys(frame: DataFrame, keys: Sequence[str], *, fail: bool = True) -> str | None:
    """Fail or warn when a key repeats."""
    if not keys:
        return None
    sample = [row.asDict() for row in duplicate_sample(frame, keys).collect()]
    message = f"failed pk_check: duplicate keys; sample={sample}" if sample else None
    return decide("enforce" if fail else "warn", message)


def overlap(
    source: DataFrame,
    baseline: DataFrame | None,
    source_column: str,
    db_column: str,
    *,
    skip_if_empty: bool = True,
    ignore: Column | None = None,
) -> DataFrame:
    """One row telling whether the source window meets the stored data:
    ``MIN(source) <= MAX(baseline)``.

    Blank stamps were filled with the sentinel before this runs, so one of them makes the
    check pass; ``ignore`` (a sentinel literal) leaves them out.
    """
    if source_column not in source.columns:
        raise ValueError(f"overlap_check column {source_column!r} is not in the source: {source.columns}")
    values = source if ignore is None else source.where(col(source_column) != ignore)
    low = values.agg(F.min(col(source_column)).alias("source_min"))
    high = (
        F.lit(None).cast(low.schema[0].dataType)
        if baseline is None
        else baseline.agg(F.max(col(db_column))).scalar()
    )
    measured = low.select("source_min", high.alias("baseline_max"))
    outcome = (
        F.when(F.col("source_min").isNull(), "no source values")
        .when(F.col("baseline_max").isNull(), "baseline empty")
        .when(F.col("source_min") <= F.col("baseline_max"), "overlap")
        .otherwise("gap")
    )
    measured = measured.withColumn("outcome", outcome)
    passed = (F.col("outcome") == "overlap") | ((F.col("outcome") == "baseline empty") & F.lit(skip_if_empty))
    return measured.withColumn("passed", passed)


def check_overlap(name: str, mode: str, result: DataFrame) -> str | None:
    """Act on an :func:`overlap` row."""
    if mode == "skip":
        return None
    row = result.first()
    message = None
    if not row.passed:
        message = (
            f"Overlap check FAILED for {name}: {row.outcome}; source MIN {row.source_min}, "
            f"baseline MAX {row.baseline_max}."
        )
    return decide(mode, message)


def overflow_counts(frame: DataFrame, sql_types: Mapping[str, str]) -> DataFrame:
    """Rows whose text is longer than its ``varchar(n)`` column, per column, in one pass."""
    limits = {name: varchar_limit(kind) for name, kind in sql_types.items()}
    limits = {name: limit for name, limit in limits.items() if limit is not None}
    counts = frame.agg(
        *(F.count(F.when(F.length(col(name)) > limit, 1)).alias(f"n{i}") for i, (name, limit) in enumerate(limits.items()))
    )
    entries = [
        F.struct(F.lit(name).alias("column_name"), F.lit(limit).alias("width"), F.col(f"n{i}").alias("over_length"))
        for i, (name, limit) in enumerate(limits.items())
    ]
    return counts.select(F.inline(F.array(*entries)))


def unmapped(frame: DataFrame, key: str, mapping: DataFrame, required: Sequence[str]) -> DataFrame:
    """Distinct keys without a complete row in the mapping table."""
    complete = reduce(lambda rows, name: rows.where(col(name).isNotNull()), required, mapping)
    complete = complete.select(col(key)).distinct()
    keys = frame.select(col(key)).distinct()
    return keys.alias("f").join(complete.alias("m"), col(key, "f") == col(key, "m"), "left_anti")


def unread_shapes(frame: DataFrame, columns: Sequence[str], formats: Sequence[str] | None = None) -> DataFrame:
    """Values of text columns that no date format reads, counted by column and shape, with the least of them.

    Blank values are not asked. Without ``formats`` the mixed ones are meant.
    """
    entries = F.array(*(F.struct(F.lit(name).alias("column_name"), col(name).alias("value")) for name in columns))
    values = frame.select(F.inline(entries)).where(F.col("value").isNotNull())
    unread = values.where(parse_stamp(F.col("value"), formats or MIXED_DATE_FORMATS).isNull())
    return unread.groupBy("column_name", shape_of(F.col("value")).alias("shape")).agg(
        F.count(F.lit(1)).alias("unread"), F.min("value").alias("example")
    )


def missing_columns(present: Sequence[str], required: Sequence[str], optional: Sequence[str] = ()) -> str | None:
    """Fail on a missing required column; return a warning for missing optional ones."""
    absent = sorted(set(required) - set(present))
    if absent:
        raise GuardError(f"file: missing expected columns {absent}")
    loose = sorted(set(optional) - set(present))
    if not loose:
        return None
    warning = OPTIONAL_MISSING.format(", ".join(loose))
    log.warning(warning)
    return warning
