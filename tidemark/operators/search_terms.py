"""Search terms: the distinct terms of each item, and of its group, joined in first-seen order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col
from tidemark.sources.tables import kept

REQUIRED = ("Item Group", "Item", "RefSearch", "ItemSearch", "Date")
OUTPUT = ("Item", "RefsSearch", "ItemsSearch", "Date")


def _required_term(term: Column) -> Column:
    """A term is expected in every row; one without stops the job."""
    return F.when(term.isNull(), F.raise_error(F.lit("search term is NULL"))).otherwise(term)


# Columns of the grouping sets, and what each set is for, by its grouping id (a bit for each column left out).
_GROUP, _ITEM, _REF, _TERM, _DATE = _COLUMNS = ("_group", "_item", "_ref", "_term", "_date")
_SETS = {"group_refs": (_GROUP, _REF), "item_refs": (_ITEM, _REF), "item_terms": (_ITEM, _TERM), "rows": (_GROUP, _ITEM, _DATE)}


def _set_id(names: tuple[str, ...]) -> int:
    return sum(1 << (len(_COLUMNS) - 1 - place) for place, name in enumerate(_COLUMNS) if name not in names)


def term_sets(view: DataFrame, order: Column) -> DataFrame:
    """The distinct terms of groups and items, and the distinct rows, each with the place it first appears at.

    One aggregate over grouping sets, and so one scan of the view. Rows merge on the map side: a key with many
    rows sends on no more than its own distinct terms.
    """
    columns = {_GROUP: col("Item Group"), _ITEM: col("Item"), _REF: _required_term(col("RefSearch")), _TERM: _required_term(col("ItemSearch")), _DATE: col("Date")}
    named = view.select(*(column.alias(name) for name, column in columns.items()), order.alias("_order"))
    grouped = named.groupingSets([[F.col(name) for name in names] for names in _SETS.values()], *_COLUMNS)
    return grouped.agg(F.min("_order").alias("_first"), F.grouping_id().alias("_set"))


def joined_terms(sets: DataFrame, which: str, name: str) -> DataFrame:
    """Per non-NULL key of a set, its terms joined with ``|`` in the order they first appear: ``_key`` and the
    text. What meets in one place is what the text itself holds."""
    key, term = _SETS[which]
    rows = sets.where((F.col("_set") == _set_id((key, term))) & F.col(key).isNotNull())
    listed = F.transform(F.array_sort(F.collect_list(F.struct("_first", F.col(term).alias("_said")))), lambda item: item["_said"])
    return rows.groupBy(F.col(key).alias("_key")).agg(F.array_join(listed, "|").alias(name))


def search_terms(view: DataFrame, order: Column) -> DataFrame:
    """Item, RefsSearch, ItemsSearch and Date, distinct.

    RefsSearch takes the terms of the item's group, or of the item where it has no group. The distinct terms
    are written once and read by what follows, so the view is scanned a single time.
    """
    missing = [name for name in REQUIRED if name not in view.columns]
    if missing:
        raise ValueError(f"view lacks column(s) {missing}; it has {view.columns}.")
    sets = kept(term_sets(view, order), "search-terms")
    rows = sets.where(F.col("_set") == _set_id(_SETS["rows"])).select(_GROUP, _ITEM, _DATE)
    by_group, by_item = joined_terms(sets, "group_refs", "GroupRefs"), joined_terms(sets, "item_refs", "ItemRefs")
    items = joined_terms(sets, "item_terms", "ItemsSearch")
    return (
        rows.join(by_group.withColumnRenamed("_key", "_g"), F.col(_GROUP) == F.col("_g"), "left")
        .join(by_item.withColumnRenamed("_key", "_i"), F.col(_ITEM) == F.col("_i"), "left")
        .join(items.withColumnRenamed("_key", "_t"), F.col(_ITEM) == F.col("_t"), "left")
        .select(
            F.col(_ITEM).alias("Item"),
            # A group always has joined terms, so NULL means that the row has no group.
            F.coalesce("GroupRefs", "ItemRefs").alias("RefsSearch"),
            "ItemsSearch",
            F.col(_DATE).alias("Date"),
        )
        .distinct()
    )
