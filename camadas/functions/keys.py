"""Hashes and derived keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats that make keys comparable with existing tables.
KEY_SEPARATOR = "||"
VERSION_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
INVALID_PREFIX = "__invalid__"


def digest(columns: Iterable[str]) -> Column:
    """sha256 over the JSON of the named columns; a null is the same as an absent column."""
    return F.sha2(F.to_json(F.struct(*columns)), 256)


def surrogate_key(natural: Column, valid_from: Column) -> Column:
    """The same version of the same key always gets the same surrogate."""
    stamp = F.date_format(valid_from, VERSION_FORMAT)
    return F.sha2(F.concat_ws(KEY_SEPARATOR, natural.cast("string"), stamp), 256)


def day_key(day: Column) -> Column:
    """yyyymmdd as a number; a year before 1 gives a negative one, where a format would drop the era."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def dedup_key(key: Column, document: Column) -> Column:
    """A missing key is replaced by the document's own hash: only equal documents then collapse."""
    own = F.concat(F.lit(INVALID_PREFIX), F.sha2(document, 256))
    return F.coalesce(key.cast("string"), own)


def spread_nulls(key: Column, unique: Column, ways: int = 4096) -> Column:
    """Scatter null join keys over ``ways`` values below every real id.

    Null keys never match, yet a shuffle join would send them all to one task. Callers must still
    require ``key IS NOT NULL`` in the join condition, which keeps the result exact.
    """
    filler = -(F.pmod(F.xxhash64(unique), F.lit(ways)) + F.lit(1 << 62))
    return F.coalesce(key.cast("bigint"), filler)
