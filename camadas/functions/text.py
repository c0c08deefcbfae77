"""String clean-up and tolerant casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that mean true in flat files.
TRUE_WORDS = ("true", "1", "sim")

_CLEANERS = {
    None: lambda c: c,
    "trim": F.trim,
    "lower": lambda c: F.lower(F.trim(c)),
    "upper": lambda c: F.upper(F.trim(c)),
    "digits": lambda c: F.regexp_replace(c, r"\D", ""),
}


def clean(column: Column, how: str | None) -> Column:
    """Only spaces are trimmed; tabs and line breaks stay. ``digits`` keeps 0-9 alone."""
    return _CLEANERS[how](column)


def to_number(text: Column, target: str) -> Column:
    """Text to a number; what does not parse is null. '12.7' as a whole number is 12."""
    if target in ("bigint", "long", "int"):
        return text.try_cast("decimal(38,6)").try_cast(target)
    return text.try_cast(target)


def cell(text: Column, kind: str) -> Column:
    """One flat-file cell to its typed value; an empty cell is null."""
    present = F.nullif(text, F.lit(""))
    if kind == "int":
        return to_number(present, "bigint")
    if kind == "float":
        return present.try_cast("double")
    if kind == "bool":
        return F.lower(F.trim(present)).isin(*TRUE_WORDS)
    if kind == "date":
        return F.try_to_timestamp(present)
    return present
