"""Timestamp parsing and rendering, always UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Textual time formats on the wire.
UTC_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
UTC_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
NAIVE_MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"
NAIVE_SECONDS = "yyyy-MM-dd HH:mm:ss"
DAY_PATTERN = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
OFFSET_PATTERN = r"(Z|[+-][0-9]{2}:[0-9]{2}(:[0-9]{2})?)$"


def normalize_offset_timestamp(c: Column) -> Column:
    """ISO-8601 with an offset -> UTC seconds; anything else stays as it is."""
    raw = F.trim(c)
    parsed = F.when(raw.rlike("^[^ ]+T[^ ]+$") & raw.rlike(OFFSET_PATTERN), F.try_to_timestamp(raw))
    return F.coalesce(F.date_format(parsed, UTC_SECONDS), c)


def normalize_naive_timestamp(c: Column) -> Column:
    """Zone-less database timestamp (six or no fraction digits), taken as UTC."""
    parsed = F.coalesce(
        F.try_to_timestamp(c, F.lit(NAIVE_MICROS)),
        F.try_to_timestamp(c, F.lit(NAIVE_SECONDS)),
    )
    return F.coalesce(F.date_format(parsed, UTC_SECONDS), c)


def normalize_day(c: Column) -> Column:
    """``yyyy-MM-dd`` -> start of that day in UTC; anything else stays."""
    parsed = F.when(c.rlike(DAY_PATTERN), F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))
    return F.coalesce(F.date_format(parsed, UTC_SECONDS), c)


def event_time(c: Column, fallback: Column | None = None) -> Column:
    """Parsed event time; ``fallback`` (for instance the processing time) replaces
    unreadable values, without it they become null and are set aside as invalid."""
    parsed = F.try_to_timestamp(c)
    return parsed if fallback is None else F.coalesce(parsed, fallback)


def audited_event_time(c: Column, processing: Column) -> Column:
    """Struct of ``at`` and ``is_fallback``: the event time, or the time of processing where it
    cannot be read, and a mark that tells the two apart."""
    parsed = F.try_to_timestamp(c)
    return F.struct(F.coalesce(parsed, processing).alias("at"), parsed.isNull().alias("is_fallback"))


def iso_millis(c: Column) -> Column:
    return F.date_format(c, UTC_MILLIS)


def iso_seconds(c: Column) -> Column:
    return F.date_format(c, UTC_SECONDS)


def month_key(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def micros(c: Column) -> Column:
    """Microseconds since the epoch, for both timestamp kinds."""
    return F.unix_micros(c.cast("timestamp"))


def seconds(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} SECONDS")


def floor_to(at: Column, width: int) -> Column:
    """Start of the ``width``-wide slot a whole number falls into."""
    return at - F.pmod(at, F.lit(width).cast("bigint"))
