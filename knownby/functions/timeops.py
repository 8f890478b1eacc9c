"""Instants, wall times and lags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OFFSET = r"(?:[Zz]|[+-]\d{2}(?::?\d{2}(?::?\d{2})?)?)$"
_DAY_MICROS = 86_400_000_000


def text_instant(col: Column) -> Column:
    """ISO-8601 text with an explicit offset -> instant; anything else -> null."""
    return F.when(col.rlike(_OFFSET) & col.rlike(r"[T ]\d{2}"), F.try_to_timestamp(col))


def text_instant_violation(col: Column) -> Column:
    """INVALID_TIMESTAMP, NAIVE_DATETIME or null for a text instant."""
    naive = F.try_to_timestamp(col).isNotNull() & ~(col.rlike(_OFFSET) & col.rlike(r"[T ]\d{2}"))
    return (
        F.when(col.isNull(), None)
        .when(naive, F.lit("NAIVE_DATETIME"))
        .when(F.try_to_timestamp(col).isNull(), F.lit("INVALID_TIMESTAMP"))
    )


def utc_z_instant(col: Column) -> Column:
    """Text that ends in ``Z`` -> instant; a numeric offset is refused."""
    return F.when(col.endswith("Z"), text_instant(col))


def lag_seconds(requested: Column, provider: Column) -> Column:
    """requested - provider in seconds; negative when the snapshot is later."""
    return (F.unix_micros(requested) - F.unix_micros(provider)) / F.lit(1_000_000.0)


def _zone_offset(instant: Column, zone: Column) -> Column:
    return F.unix_micros(F.from_utc_timestamp(instant, zone)) - F.unix_micros(instant)


def localize_strict(wall: Column, zone: Column, known_zone: Column) -> tuple[Column, Column]:
    """Wall time (read as if UTC) in an IANA zone -> (utc instant, status).

    Both offsets in force around the wall time are tried; the wall time is usable only
    when they give exactly one instant that reads back as the same wall time.
    """
    safe_zone = F.when(known_zone, zone).otherwise(F.lit("UTC"))
    wall_us = F.unix_micros(wall)
    before = F.timestamp_micros(
        wall_us - _zone_offset(F.timestamp_micros(wall_us - F.lit(_DAY_MICROS)), safe_zone)
    )
    after = F.timestamp_micros(
        wall_us - _zone_offset(F.timestamp_micros(wall_us + F.lit(_DAY_MICROS)), safe_zone)
    )
    before_ok = F.from_utc_timestamp(before, safe_zone) == wall
    after_ok = F.from_utc_timestamp(after, safe_zone) == wall
    status = (
        F.when(~known_zone | zone.isNull(), "UNKNOWN_ZONE")
        .when(wall.isNull(), "MISSING_WALL_TIME")
        .when(before_ok & after_ok & (before != after), "AMBIGUOUS")
        .when(~before_ok & ~after_ok, "NONEXISTENT")
        .otherwise("OK")
    )
    return F.when(status == "OK", F.when(before_ok, before).otherwise(after)), status


def zone_violation(status: Column) -> Column:
    """INVALID_TIMEZONE for a wall time that ``localize_strict`` refuses: unknown zone, repeated or skipped hour."""
    return F.when(status.isin("UNKNOWN_ZONE", "AMBIGUOUS", "NONEXISTENT"), "INVALID_TIMEZONE")


def local_reading(instant: Column, zone: Column) -> tuple[Column, Column]:
    """(local date, local time HH:mm) of an instant in the zone of its own row."""
    wall = F.from_utc_timestamp(instant, zone)
    return F.to_date(wall), F.date_format(wall, "HH:mm")


def localize_lenient(wall: Column, zone: Column) -> Column:
    """First reading of a repeated hour; a skipped hour keeps the offset before the gap."""
    wall_us = F.unix_micros(wall)
    before = F.timestamp_micros(
        wall_us - _zone_offset(F.timestamp_micros(wall_us - F.lit(_DAY_MICROS)), zone)
    )
    after = F.timestamp_micros(
        wall_us - _zone_offset(F.timestamp_micros(wall_us + F.lit(_DAY_MICROS)), zone)
    )
    before_ok = F.from_utc_timestamp(before, zone) == wall
    after_ok = F.from_utc_timestamp(after, zone) == wall
    return F.when(~before_ok & after_ok, after).otherwise(before)
