"""Renaming, mapping and aligning columns."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.functions.typing import as_columns, clean_text, fit_sql_type, text_columns, to_date, to_datetime, to_float, to_int
from tidemark.plans.spec import MapRow
from tidemark.sources.tables import kept

log = logging.getLogger("tidemark")

# A stamp column that is never rewritten as text.
REPORT_STAMP = "report stamp"


def rename(frame: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return frame.withColumnsRenamed(dict(names)) if names else frame


def drop_present(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop the named columns that exist; names are literal, dots included."""
    gone = set(names)
    return frame.select(*as_columns([name for name in frame.columns if name not in gone])) if gone else frame


def require_columns(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exactly these columns in this order; a missing one fails."""
    missing = [name for name in names if name not in frame.columns]
    if missing:
        raise ValueError(f"frame lacks destination column(s) {missing}")
    return frame.select(*as_columns(names))


def apply_types(
    frame: DataFrame,
    types: Mapping[str, str],
    *,
    date_format: str | Sequence[str] | None = None,
    datetime_format: str | Sequence[str] | None = None,
    as_date: Sequence[str] = (),
) -> DataFrame:
    """Convert text columns in one projection. ``as_date`` names datetime columns that land in
    a date column and so lose their time."""

    def typed(name: str):
        kind, value = types.get(name), col(name)
        if kind == "date":
            return to_date(value, date_format)
        if kind == "datetime":
            return (to_date if name in as_date else to_datetime)(value, datetime_format)
        if kind == "float":
            return to_float(value)
        if kind == "int":
            return to_int(value)
        return value

    return frame.select(*(typed(name).alias(name) for name in frame.columns))


def normalize(frame: DataFrame, types: Mapping[str, str], keep_whitespace: Sequence[str] = ()) -> DataFrame:
    """Blank text becomes ``''`` and is trimmed; numbers, dates and the report stamp pass."""
    passing = {"date", "datetime", "float", "int"}

    def value(name: str):
        if types.get(name) in passing or name == REPORT_STAMP:
            return col(name)
        return clean_text(col(name), keep_whitespace=name in keep_whitespace).alias(name)

    return frame.select(*(value(name) for name in frame.columns))


def fill_text_blanks(frame: DataFrame) -> DataFrame:
    """``''`` for NULL in text columns only; numbers and dates keep NULL."""
    texts = set(text_columns(frame.schema))
    return frame.select(
        *(F.coalesce(col(name), F.lit("")).alias(name) if name in texts else col(name) for name in frame.columns)
    )


def projection(mapping: Sequence[MapRow], have: Sequence[str], sink_types: bool = True) -> list[Column]:
    """Compile mapping rows to the columns of a projection: renamed, constant, or NULL."""
    loaded = [row for row in mapping if row.destination and row.type != "ignore"]
    unread = {row.source for row in loaded if not row.has_value and row.source is not None} - set(have)
    if unread:
        raise ValueError(f"the frame lacks columns that the mapping reads: {sorted(unread)}")

    def compiled(row: MapRow) -> Column:
        value = F.lit(row.value) if row.has_value else F.lit(None).cast("string") if row.source is None else col(row.source)
        return (fit_sql_type(row.destination, value, row.sql_type) if sink_types else value).alias(row.destination)

    return [compiled(row) for row in loaded]


def map_columns(frame: DataFrame, mapping: Sequence[MapRow], sink_types: bool = True) -> DataFrame:
    """Project source columns to destination columns, see :func:`projection`."""
    return frame.select(*projection(mapping, frame.columns, sink_types))


def align(
    frame: DataFrame,
    table_columns: Sequence[str],
    *,
    mapped: bool,
    allow_missing: bool = False,
) -> DataFrame:
    """Put columns in table order.

    Mapped frames may leave table columns out but not bring unknown ones. Unmapped frames must
    bring every table column (or get NULL with ``allow_missing``); their extra ones drop out.
    """
    brought, asked = dict.fromkeys(frame.columns), dict.fromkeys(table_columns)
    beyond, short = brought.keys() - asked.keys(), asked.keys() - brought.keys()
    if mapped and beyond:
        raise ValueError(f"the table has no column(s) {sorted(beyond)}")
    if short and not (mapped or allow_missing):
        raise ValueError(f"the frame lacks the table's column(s) {sorted(short)}")
    if beyond:
        log.info("not loaded, since the table has no such column: %s", sorted(beyond))
    taken = [name for name in asked if name in brought or not mapped]
    return frame.select(*(F.lit(None).alias(name) if name in short else col(name) for name in taken))


def relabel(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """Take table column names by position; warn when the names differ."""
    if len(names) != len(frame.columns):
        raise ValueError(f"table has {len(names)} insertable column(s) {list(names)}; frame has {frame.columns}")
    if [name.lower() for name in names] != [name.lower() for name in frame.columns]:
        log.warning("column names differ from the table; inserting by position: %s -> %s", frame.columns, list(names))
    return frame.toDF(*names)


# Low bits of monotonically_increasing_id(): the row's place in its partition; the partition stands above.
_PLACE_BITS = 33


def generated(frame: DataFrame, present: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Insertable rows in the table's shape, with its generated columns continued from their stored maxima.

    Rows are stored with their partition and place; each partition's first number follows from the counts of
    those before it, one row per partition, so no task sees all rows.
    """
    if not identity:
        return frame
    last = present.agg(*(F.coalesce(F.max(col(name)), F.lit(0)).cast("long").alias(name) for name in identity)).first()
    placed = kept(frame.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_part", F.shiftright("_place", _PLACE_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    number = F.col("_start") + F.col("_place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + 1
    kinds = {field.name: field.dataType for field in present.schema}
    return placed.join(F.broadcast(starts), "_part").select(
        *((number + last[name]).cast(kinds[name]).alias(name) if name in identity else col(name) for name in present.columns)
    )


def mapping_template(spark, headers: Sequence[str], table_columns: Sequence[str]) -> DataFrame:
    """Header names against table columns by name: matched, table only, or file only."""
    left = spark.createDataFrame([(n, i) for i, n in enumerate(table_columns)], "destination string, position int")
    right = spark.createDataFrame([(n,) for n in headers], "source string")
    joined = left.join(right, F.col("destination") == F.col("source"), "full_outer")
    note = F.when(F.col("destination").isNull(), "ignored").when(F.col("source").isNull(), "unmapped").otherwise("mapped")
    return joined.select("destination", "source", note.alias("note"), "position")
