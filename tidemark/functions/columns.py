"""Helpers for naming columns. Source headers hold dots and spaces, so names are quoted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col(name: str, side: str | None = None) -> Column:
    """A column by its literal name, optionally of an aliased frame."""
    return F.col(quoted(name) if side is None else f"{side}.{quoted(name)}")


def bracketed(name: str) -> str:
    """The form table names take in the health log."""
    return "[" + name.replace("]", "]]") + "]"
