"""Timestamps from text in a given pattern or an ISO form."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the one output form, and the ISO forms tried after the pattern
OUTPUT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ISO_ZONED = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2}(:\d{2})?)(\[[^\]]+\])?$"
ISO_LOCAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def pattern_has_zone(pattern: str) -> bool:
    return re.search(r"[VzOXxZ]", re.sub(r"'[^']*'", "", pattern)) is not None


def check_pattern(pattern: str) -> None:
    """Refuse a pattern Spark could not parse with, before any job starts."""
    letters = re.sub(r"'[^']*'", "", pattern)
    bad = sorted(set(re.findall(r"[A-Za-z]", letters)) - set("GyMLdDQqEaFhHkKmsSVzOXxZ"))
    if bad or not pattern.strip():
        raise ValueError(f"timestamp pattern {pattern!r} is not valid")


def instant_of(text: Column, pattern: str, zone: str) -> Column:
    """The instant a text names, null when neither the pattern nor an ISO form fits.

    Zoned pattern, ISO with zone, local pattern, ISO local, ISO date: the first that fits.
    Local forms are read in `zone`, whatever the session's own zone is.
    """
    check_pattern(pattern)
    in_zone = F.concat(text, F.lit(" " + zone))
    tries: list[Column] = []
    if pattern_has_zone(pattern):
        tries.append(F.try_to_timestamp(text, F.lit(pattern)))
    # without a region behind the offset, and with seconds
    bare = F.regexp_replace(text, r"\[[^\]]+\]$", "")
    full = F.regexp_replace(bare, r"(T\d{2}:\d{2})(?=$|[Z+-])", "$1:00")
    tries.append(F.when(text.rlike(ISO_ZONED), full.try_cast("timestamp")))
    if not pattern_has_zone(pattern):
        tries.append(F.try_to_timestamp(in_zone, F.lit(pattern + " VV")))
    tries.append(F.when(text.rlike(ISO_LOCAL), F.concat(full, F.lit(" " + zone)).try_cast("timestamp")))
    tries.append(
        F.when(text.rlike(ISO_DATE), F.concat(text, F.lit("T00:00:00 " + zone)).try_cast("timestamp"))
    )
    return F.coalesce(*tries)


def utc_text(instant: Column) -> Column:
    return F.date_format(F.to_utc_timestamp(instant, F.current_timezone()), OUTPUT)


def parse_timestamp_any(text: Column, pattern: str, zone: str = "UTC") -> Column:
    """Struct of the UTC text form (`ts`) and an error text (`error`, empty when parsed)."""
    parsed = utc_text(instant_of(text, pattern, zone))
    message = F.concat(
        F.lit("no timestamp in "),
        F.coalesce(text, F.lit("null")),
        F.lit(f" (pattern {pattern}, zone {zone})"),
    )
    return F.struct(
        parsed.alias("ts"), F.when(parsed.isNull(), message).otherwise(F.lit("")).alias("error")
    )


def derive_ts(columns: list[Column], pattern: str, zone: str = "UTC") -> Column:
    """Several source columns joined by spaces (null is empty), trimmed and parsed."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return parse_timestamp_any(F.trim(F.concat_ws(" ", *parts)), pattern, zone)
