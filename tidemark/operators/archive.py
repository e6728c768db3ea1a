"""Daily archive over a trailing window, so that late rows are picked up on later runs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.sources.tables import PartitionedTable


def window_dates(end: dt.date, backfill_days: int) -> list[dt.date]:
    """The end date and the ``backfill_days`` before it, oldest first."""
    if backfill_days < 0:
        raise ValueError(f"backfill_days is negative: {backfill_days}")
    return [end - dt.timedelta(days=back) for back in range(backfill_days, -1, -1)]


def daily_rows(source: DataFrame, stamp: str, first: dt.date, last: dt.date) -> DataFrame:
    """Rows of whole days with the day as ``ArchiveDate``.

    The window is a range on the stored column, so it reaches the scan; a cast would not.
    """
    start = F.lit(first).cast("timestamp_ntz")
    stop = F.lit(last + dt.timedelta(days=1)).cast("timestamp_ntz")
    return source.where((col(stamp) >= start) & (col(stamp) < stop)).withColumn("ArchiveDate", F.to_date(col(stamp)))


def rearchive(archive: DataFrame | None, source: DataFrame, stamp: str, end: dt.date, backfill_days: int) -> DataFrame:
    """The archive with every date of the window replaced by the source's present rows."""
    dates = window_dates(end, backfill_days)
    fresh = daily_rows(source, stamp, dates[0], dates[-1])
    if archive is None:
        return fresh
    kept = archive.where(~F.col("ArchiveDate").between(F.lit(dates[0]), F.lit(dates[-1])))
    return kept.unionByName(fresh)


def write_archive(source: DataFrame, stamp: str, path: str, end: dt.date, backfill_days: int) -> dict[dt.date, int]:
    """Replace the dates of the window, all in one commit; other dates are not read or touched. A run
    that dies leaves the archive as it was, and a date without rows ends up empty."""
    spark, dates = source.sparkSession, window_dates(end, backfill_days)
    archive = PartitionedTable(spark, path, ["ArchiveDate"])
    days = archive.parts_of(spark.createDataFrame([(day,) for day in dates], "ArchiveDate date"))
    parts = {row[-1]: row.ArchiveDate for row in days.collect()}
    archive.overwrite(daily_rows(source, stamp, dates[0], dates[-1]), list(parts))
    return dict(sorted((parts[name], rows) for name, rows in archive.part_rows().items() if name in parts))
