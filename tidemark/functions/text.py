"""Splitting, stripping and deriving text and report columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.typing import strip

# Fixed value: a missing value turned to text without a blank check.
NULL_TEXT = "nan"


def pipe_part(c: Column, index: int) -> Column:
    """The zero-based part of ``a|b|c``; ``''`` when NULL or too short."""
    return F.coalesce(F.split_part(c, F.lit("|"), F.lit(index + 1)), F.lit(""))


def strip_leading_zeros(c: Column) -> Column:
    """Trimmed text without leading zeros; NULL and its text form become ``''``."""
    text = F.coalesce(strip(c), F.lit(""))
    return F.when(text == NULL_TEXT, "").otherwise(F.ltrim(text, F.lit("0")))


def last_token(c: Column) -> Column:
    """Text after the last space (``9.6700 BX`` -> ``BX``); NULL becomes ``''``."""
    return F.coalesce(F.substring_index(c, " ", -1), F.lit(""))


def before_dash(c: Column) -> Column:
    """Trimmed text before the first ``" - "``; NULL gives its text form."""
    return strip(F.substring_index(F.coalesce(c, F.lit(NULL_TEXT)), " - ", 1))


def after_dash(c: Column) -> Column:
    """Text after the last ``" - "``, split from the left; NULL gives its text form."""
    return F.element_at(F.split(F.coalesce(c, F.lit(NULL_TEXT)), " - ", -1), -1)


def year_of(c: Column) -> Column:
    return F.date_format(c, "yyyy")


def year_month_of(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def quarter_of(c: Column) -> Column:
    return F.concat(F.lit("Q"), F.quarter(c).cast("string"))


def flag_of(c: Column) -> Column:
    """1 for the text ``True``, else 0."""
    return F.when(c == "True", 1).otherwise(0)


def blank_if_longer(c: Column, limit: int = 40) -> Column:
    """``''`` for NULL and for text over the limit."""
    text = F.coalesce(c, F.lit(""))
    return F.when(F.length(text) > limit, "").otherwise(text)


def stringify(c: Column, missing: str = "NA") -> Column:
    return F.coalesce(c.cast("string"), F.lit(missing))


def is_truthy(c: Column) -> Column:
    """True for 1 / true / yes / y in any case; NULL is false."""
    return F.coalesce(F.lower(strip(c.cast("string"))).isin("1", "true", "yes", "y"), F.lit(False))


def fit_width(c: Column, limit: int) -> Column:
    """Cut to a column width, the last character showing that it was cut."""
    return F.when(F.length(c) > limit, F.concat(F.substring(c, 1, limit - 1), F.lit("…"))).otherwise(c)


def one_line(c: Column, limit: int = 200) -> Column:
    """Whitespace runs become one space, then cut as :func:`fit_width`."""
    return fit_width(strip(F.regexp_replace(c, r"(?U)[\s\x1c-\x1f]+", " ")), limit)
