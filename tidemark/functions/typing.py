"""Text to typed values.

Dates are lenient: a blank or bad value becomes the sentinel. Numbers are strict: a bad
value fails the load, a blank one stays NULL.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import quoted

# The texts the public pandas CSV reader takes as missing.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Fixed value: what a blank or unreadable date becomes.
SENTINEL = "1900-01-01"

# The first and last whole days a nanosecond timestamp can hold. A date outside
# them cannot be read and so becomes the sentinel (9999-12-31 is the usual case).
FIRST_DAY, LAST_DAY = "1677-09-22", "2262-04-10"

# Date shapes tried in turn when no format is declared. No text fits two.
MIXED_DATE_FORMATS = (
    "%m/%d/%Y", "%Y%m%d", "%Y-%m-%d", "%m/%d/%Y %I:%M:%S %p", "%m/%d/%Y %H:%M:%S",
    "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y/%m/%d", "%m/%d/%y", "%m-%d-%Y", "%m/%d/%Y %H:%M", "%m/%d/%Y %I:%M %p",
    "%Y/%m/%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y-%m-%dT%H:%M", "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S.%f", "%m/%d/%Y %H:%M:%S.%f",
    "%b %d, %Y", "%B %d, %Y", "%b %d %Y", "%d %b %Y", "%d %B %Y", "%d-%b-%Y",
)

# Every character Python's str.strip() removes; Spark's one-argument trim removes spaces only.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

# Strptime directives and the Spark datetime pattern letters they stand for.
_DIRECTIVES = {
    "%Y": "yyyy", "%y": "yy", "%m": "M", "%d": "d", "%H": "H", "%I": "h",
    "%M": "m", "%S": "s", "%p": "a", "%f": "SSSSSS", "%b": "MMM", "%B": "MMMM",
}


def spark_pattern(fmt: str) -> str:
    """The Spark datetime pattern for a strptime format.

    One-letter fields take one or two digits. Where directives touch (``%Y%m%d``) the widths
    must be fixed, so those get two letters.
    """
    pieces = re.findall(r"%.|[^%]+", fmt)
    touching = any(a.startswith("%") and b.startswith("%") for a, b in zip(pieces, pieces[1:]))
    out = []
    for piece in pieces:
        if not piece.startswith("%"):
            out.append("".join(f"'{ch}'" if ch.isalpha() else ch for ch in piece))
            continue
        if piece not in _DIRECTIVES:
            raise ValueError(f"Unsupported date directive {piece!r} in {fmt!r}")
        letters = _DIRECTIVES[piece]
        out.append(letters * 2 if touching and len(letters) == 1 and letters != "a" else letters)
    return "".join(out)


def strip(c: Column) -> Column:
    """Remove all leading and trailing whitespace, not only spaces."""
    return F.trim(c, F.lit(WHITESPACE))


def blank_to_null(name: str) -> Column:
    """A text column with NULL for the missing-value texts (a reader's ``nullValue`` is single).

    Written as SQL text, since exports have many columns and each would need many literals.
    """
    tokens = ", ".join(f"'{token}'" for token in NA_TOKENS)
    return F.expr(f"CASE WHEN {quoted(name)} NOT IN ({tokens}) THEN {quoted(name)} END").alias(name)


# How a shape is written: every digit a 9 and every letter an a, then the commonest runs as one sign.
_LETTERS = "".join(chr(code) for code in (*range(65, 91), *range(97, 123)))
_RUNS = (("9999", "Y"), ("99", "9"), ("aaaa", "N"))
# Digits a directive takes, or letters; month names in full have three to nine.
_DIGITS = {"%Y": (4,), "%y": (2,), "%f": range(1, 7), **dict.fromkeys(("%m", "%d", "%H", "%I", "%M", "%S"), (1, 2))}
_NAMES = {"%b": (3,), "%B": range(3, 10), "%p": (2,)}


def shape_of(c: Column) -> Column:
    """A value's shape: where its digits, letters and separators stand. Values of one date format have few
    shapes, whatever their number, and no two of :data:`MIXED_DATE_FORMATS` share one that both could read."""
    shape = F.translate(c, "0123456789" + _LETTERS, "9" * 10 + "a" * len(_LETTERS))
    for run, sign in _RUNS:
        shape = F.replace(shape, F.lit(run), F.lit(sign))
    return shape


@lru_cache(maxsize=None)
def shapes_of_format(fmt: str) -> tuple[str, ...]:
    """Every shape that a value of a format can have."""
    pieces = re.findall(r"%.|[^%]+", fmt)
    touching = any(a.startswith("%") and b.startswith("%") for a, b in zip(pieces, pieces[1:]))
    shapes = {""}
    for piece in pieces:
        if piece in _DIGITS:
            widths = _DIGITS[piece]
            parts = ["9" * width for width in (widths[-1:] if touching else widths)]
        elif piece in _NAMES:
            parts = ["a" * width for width in _NAMES[piece]]
        else:
            parts = ["".join("a" if sign in _LETTERS else sign for sign in piece)]
        shapes = {shape + part for shape in shapes for part in parts}
    for run, sign in _RUNS:
        shapes = {shape.replace(run, sign) for shape in shapes}
    return tuple(sorted(shapes))


def _attempt(c: Column, fmt: str) -> Column:
    """A value read by one format. Years of two digits from 69 on belong to the last century."""
    stamp = F.try_to_timestamp(c, F.lit(spark_pattern(fmt)))
    if "%y" not in fmt:
        return stamp
    return F.when(F.year(stamp) >= 2069, F.add_months(stamp, -1200).cast("timestamp")).otherwise(stamp)


def parse_stamp(c: Column, formats: Sequence[str]) -> Column:
    """The value by the format of its shape (of formats that share one, the first), as a zone-less timestamp;
    NULL where it has none or cannot be read by it."""
    if len(formats) == 1:
        stamp = _attempt(c, formats[0])
    else:
        # The shape names the format, so a value is parsed at most once, and not at all in an unknown shape.
        shape, stamp = shape_of(c), F
        for fmt in formats:
            stamp = stamp.when(shape.isin(*shapes_of_format(fmt)), _attempt(c, fmt))
    stamp = stamp.cast(T.TimestampNTZType())
    low = F.lit(FIRST_DAY).cast(T.TimestampNTZType())
    high = F.lit(LAST_DAY).cast(T.TimestampNTZType())
    return F.when(stamp.between(low, high), stamp)


def _formats(fmt: str | Sequence[str] | None) -> Sequence[str]:
    if fmt is None:
        return MIXED_DATE_FORMATS
    return [fmt] if isinstance(fmt, str) else list(fmt)


def to_datetime(c: Column, fmt: str | Sequence[str] | None = None) -> Column:
    """Timestamp by format; blank or bad becomes the sentinel. No format: mixed shapes."""
    return F.coalesce(parse_stamp(c, _formats(fmt)), F.lit(SENTINEL).cast(T.TimestampNTZType()))


def to_date(c: Column, fmt: str | Sequence[str] | None = None) -> Column:
    """As :func:`to_datetime`, cut to the day."""
    return to_datetime(c, fmt).cast(T.DateType())


def _digits(c: Column) -> Column:
    return F.translate(strip(c), ",", "")


def to_float(c: Column) -> Column:
    """Number without thousands separators. Bad text raises; NULL stays NULL."""
    text = _digits(c)
    # Java also reads a type suffix ("1.5d"), which is bad text here.
    suffixed = F.substring(text, -1, 1).isin("d", "D", "f", "F") & ~F.lower(text).isin("inf", "+inf", "-inf")
    return F.when(suffixed, F.raise_error(F.concat(F.lit("could not convert string to float: "), text))).otherwise(
        text.cast("double")
    )


def to_int(c: Column) -> Column:
    """As :func:`to_float`, cut toward zero."""
    return to_float(c).cast("bigint")


def clean_text(c: Column, keep_whitespace: bool = False) -> Column:
    """Blank becomes ``''``; trimmed unless the whitespace carries meaning."""
    text = c.cast("string")
    return F.coalesce(text if keep_whitespace else strip(text), F.lit(""))


_VARCHAR = re.compile(r"^\s*n?(?:var)?char\s*\(\s*(\d+|max)\s*\)\s*$", re.I)
_DECIMAL = re.compile(r"^\s*(?:numeric|decimal)\s*\(\s*(\d+)\s*,\s*(\d+)\s*\)\s*$", re.I)


def varchar_limit(sql_type: str | None) -> int | None:
    """n of ``varchar(n)``; None when there is no limit."""
    match = _VARCHAR.match(sql_type or "")
    return int(match.group(1)) if match and match.group(1).lower() != "max" else None


def fit_sql_type(name: str, c: Column, sql_type: str | None) -> Column:
    """Cast a prepared value to its declared table type.

    Over-long text and over-wide numbers raise, as an insert into such a column does.
    """
    if not sql_type:
        return c
    limit = varchar_limit(sql_type)
    if limit is not None:
        message = f"String data would be truncated: column {name} holds more than {limit} characters"
        return F.when(F.length(c) > limit, F.raise_error(F.lit(message))).otherwise(c.cast("string"))
    if _VARCHAR.match(sql_type):
        return c.cast("string")
    match = _DECIMAL.match(sql_type)
    if match:
        return c.cast(T.DecimalType(int(match.group(1)), int(match.group(2))))
    plain = {
        "money": T.DecimalType(19, 4), "int": T.IntegerType(), "bigint": T.LongType(), "float": T.DoubleType(),
        "date": T.DateType(), "datetime": T.TimestampNTZType(), "datetime2": T.TimestampNTZType(), "bit": T.IntegerType(),
    }
    kind = plain.get(sql_type.strip().lower())
    if kind is None:
        raise ValueError(f"Column {name}: unknown table type {sql_type!r}")
    return c.cast(kind)


def text_columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema if isinstance(field.dataType, T.StringType)]


def as_columns(names: Sequence[str]) -> list[Column]:
    return [F.col(quoted(name)) for name in names]
