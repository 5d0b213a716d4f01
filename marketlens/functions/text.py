"""Text clean-up with Unicode blanks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import as_col


def trim_blanks(value) -> Column:
    """Drop leading and trailing blanks, the ideographic space included."""
    return F.regexp_replace(F.regexp_replace(as_col(value), "^[\\s　]+", ""), "[\\s　]+$", "")


def strip_blanks(value) -> Column:
    """Drop every blank inside the text as well."""
    return F.translate(as_col(value), " 　", "")


def letters_digits(value) -> Column:
    return F.regexp_replace(as_col(value), "[^\\p{L}\\p{N}]", "")


def strip_suffix(value, characters: str) -> Column:
    return F.regexp_replace(F.upper(as_col(value)), f"[{characters}]$", "")
