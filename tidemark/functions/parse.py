"""Tolerant parsers for counts, integers, times and names; whatever can't be read is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_count(c: Column) -> Column:
    """'8.9万', '1,234', '2亿' as whole numbers; negative, non-finite and unreadable ones are null."""
    s = F.regexp_replace(c, r"[,\s]", "")
    scale = F.when(F.endswith(s, F.lit("万")), F.lit(1e4)).when(F.endswith(s, F.lit("亿")), F.lit(1e8)).otherwise(F.lit(1.0))
    v = F.regexp_replace(s, "[万亿]$", "")
    number = F.when(v.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), v.try_cast("double")) * scale
    return F.when((number >= 0) & (number < 9.2e18), F.floor(number).cast("bigint"))


def as_int(c: Column) -> Column:
    """Digits, with thousands commas allowed; all else is null."""
    s = F.replace(F.trim(c), F.lit(","), F.lit(""))
    return F.when(s.rlike(r"^[0-9]+$"), s.try_cast("bigint"))


def parse_datetime(c: Column) -> Column:
    """Digits are epoch seconds, or milliseconds beyond 1e10; ISO 8601 with or without an offset (UTC); else null."""
    n = F.when(c.rlike(r"^[0-9]+(\.[0-9]+)?$"), c.try_cast("double"))
    seconds = F.when(n > 1e10, n / 1000).otherwise(n)
    iso = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?(Z|[+-]\d{2}:?\d{2})?)?$"), c.try_cast("timestamp"))
    return F.when(n.isNotNull(), F.when(seconds < 2.5e11, F.timestamp_micros((seconds * 1_000_000).cast("bigint")))).otherwise(iso)


def first_of(*cols: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.when(c != "", c) for c in cols))


def level_number(name: Column, ordinal: Column) -> Column:
    """The number at the end of 'level_3', or the level's place."""
    n = F.regexp_extract(name, r"_(\d+)$", 1)
    return F.when(n != "", n.try_cast("int")).otherwise(ordinal.cast("int"))


def fenced_json(c: Column) -> Column:
    """The body of a ```json fence, or the text itself, trimmed."""
    t = F.trim(F.regexp_replace(c, r"^\s+|\s+$", ""))
    return F.regexp_replace(F.regexp_replace(t, r"^```[A-Za-z]*\s*", ""), r"\s*```$", "")
