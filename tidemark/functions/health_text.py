"""Texts and labels of the health log."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import fit_width
from tidemark.functions.typing import strip

# Statuses, and the order a report lists them in.
FAILED, FILE_NOT_FOUND, BLOCKED, SUCCESS = "FAILED", "FILE_NOT_FOUND", "BLOCKED", "SUCCESS"
STATUS_ORDER = (FAILED, FILE_NOT_FOUND, BLOCKED, SUCCESS)
NOT_RUN = "NOT RUN"

# Widths of the log's Error and TargetTableName columns.
ERROR_WIDTH, TARGET_WIDTH = 400, 100

STAGING_FAILED = "STAGING LOAD FAILED"
NOT_APPLICABLE = "Not Applicable"
NO_VALUE = "—"

# An error whose lower-cased text holds one of the phrases gets the code; the
# first line that matches decides.
ERROR_CODES = (
    (("missing expected column",), "COLUMN NOT FOUND"),
    (("invalid object name", "cannot find the object"), "TABLE NOT FOUND"),
    (("primary key", "pk_check"), "PK VIOLATION"),
    (("unique key", "unique index"), "UX VIOLATION"),
    (("would be truncated",), "FIELD TRUNCATE"),
    (("partial staging load",), "PARTIAL STAGING LOAD"),
)


def classify_error(text: Column) -> Column:
    """The short code of a failure text; NULL for none, ``See Log`` for an unknown one."""
    lowered = F.lower(text)
    inputs = strip(F.regexp_extract(text, r"(?s)input\(s\):([^\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]*)", 1))
    no_file = F.when(inputs == "", "FILE NOT FOUND").otherwise(
        F.concat(F.lit("FILE NOT FOUND: expected file(s) "), inputs, F.lit(" missing"))
    )
    code = F.when(F.coalesce(text, F.lit("")) == "", F.lit(None).cast("string"))
    code = code.when(strip(lowered) == STAGING_FAILED.lower(), STAGING_FAILED)
    code = code.when(lowered.contains("filenotfounderror") | lowered.contains("no files matched"), no_file)
    for phrases, name in ERROR_CODES:
        hit = F.lit(False)
        for phrase in phrases:
            hit = hit | lowered.contains(phrase)
        code = code.when(hit, name)
    return code.otherwise("See Log")


def step_error(status: Column, error: Column, notes: Column) -> Column:
    """Failure code, or on success the joined notes (an array; NULLs and blanks drop out)."""
    kept = F.concat_ws("; ", F.filter(notes, lambda note: note.isNotNull() & (note != "")))
    return F.when(status != SUCCESS, classify_error(error)).when(kept != "", kept)


def process_error(status: Column, error: Column, unmet: Column, note: Column) -> Column:
    """A failed process gets its code, a blocked one names what it waits for."""
    waits = fit_width(F.concat(F.lit("BLOCKED: requires "), F.array_join(unmet, "; ")), ERROR_WIDTH)
    return (
        F.when(status == FAILED, classify_error(error))
        .when(status == BLOCKED, waits)
        .when(note != "", note)
    )


def staging_names(target: Column, staging: Column, extra: Column) -> Column:
    """The staging tables that fed a step, or Not Applicable when the target is the staging
    table and nothing else fed it. ``extra`` is an array of names."""
    more = F.coalesce(extra, F.array().cast("array<string>"))
    alone = (target == staging) & (F.size(more) == 0)
    return F.when(alone, NOT_APPLICABLE).otherwise(F.concat_ws("; ", staging, more))


def exec_object(statement: Column) -> Column:
    """The procedure an ``EXEC``/``EXECUTE`` statement calls, else NULL."""
    name = F.regexp_extract(strip(statement), r"(?is)^(?:execute|exec) \s*([^ \t\r\n(;]+)", 1)
    return F.when(name != "", name)


def qualified_object(raw: Column, database: Column, schema: Column) -> Column:
    """``[database].[schema].[object]``; missing parts come from the destination."""
    parts = F.filter(
        F.transform(F.split(raw, r"\.", -1), lambda part: F.trim(strip(part), F.lit("[]"))),
        lambda part: part != "",
    )
    home = F.array(database, F.coalesce(schema, F.lit("dbo")))

    def named(found: Column) -> Column:
        full = F.when(F.size(found) == 1, F.concat(home, found)).otherwise(F.concat(F.array(database), found))
        quoted = F.transform(
            F.slice(full, -3, 3),
            lambda part: F.concat(F.lit("["), F.replace(part, F.lit("]"), F.lit("]]")), F.lit("]")),
        )
        return F.when(F.size(found) == 0, raw).otherwise(F.array_join(quoted, "."))

    # The one-element array lets the parts be split once and used by name.
    return F.element_at(F.transform(F.array(parts), named), 1)


def connection_label(server: Column, labels: Mapping[str, str]) -> Column:
    """The friendly name of a server; unknown ones keep theirs."""
    shown = F.when(F.coalesce(server, F.lit("")) == "", NO_VALUE).otherwise(server)
    if not labels:
        return shown
    pairs = [F.lit(text) for pair in labels.items() for text in pair]
    return F.coalesce(F.create_map(*pairs)[server], shown)


def last_run_text(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit(NO_VALUE))
