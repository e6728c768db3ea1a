"""Ready-made Python steps for processes.

Use one as ``Step("search_terms", python="tidemark.plans.steps.build_search_terms", options={...})``.
"""

from __future__ import annotations

from tidemark.functions.columns import col
from tidemark.operators import search_terms as terms
from tidemark.operators.archive import write_archive
from tidemark.operators.shape import generated, relabel
from tidemark.plans.process import StepContext
from tidemark.sources.tables import Table, insert_columns, read_table, read_view


def build_search_terms(context: StepContext) -> int:
    """Rebuild the search-term table from its view; returns the rows loaded.

    Options: ``source_view`` (view name or path), ``target_table`` (path), ``order`` (the view's
    column that tells which row comes first), ``identity`` (generated target columns). An existing
    target gives its column names by position, and its generated columns go on from their last numbers.
    """
    options = context.options
    view = read_view(context.spark, options["source_view"], [*terms.REQUIRED, options["order"]])
    rows = terms.search_terms(view, col(options["order"]))
    table = Table(context.spark, options["target_table"])
    present = table.read()
    if present is not None:
        identity = options.get("identity", ())
        rows = generated(relabel(rows, insert_columns(present, identity)), present, identity)
    return table.overwrite(rows)


def insert_daily_archive(context: StepContext) -> None:
    """Archive the report date and the ``backfill_days`` before it, one date at a time.

    Options: ``source`` (table name or path), ``stamp`` (its day column), ``archive`` (path),
    ``backfill_days`` (default 3, so four dates).
    """
    options = context.options
    source = read_table(context.spark, options["source"])
    write_archive(
        source, options["stamp"], options["archive"], context.report_date, int(options.get("backfill_days", 3))
    )
