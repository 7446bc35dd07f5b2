"""Column expressions: tolerant parsing, clock times, time zones, differences."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_DAY = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?=$|[T ])"
NULL_MARKER = "\\N"  # two characters: backslash, N


def safe_number(c: Column) -> Column:
    """Text to whole number, halves away from zero; anything unreadable is NULL."""
    return c.try_cast("decimal(38,0)")


def safe_int(c: Column) -> Column:
    return safe_number(c).try_cast("int")


def safe_long(c: Column) -> Column:
    return safe_number(c).try_cast("bigint")


def safe_double(c: Column) -> Column:
    return c.try_cast("double")


def safe_boolean(c: Column) -> Column:
    word = F.lower(F.trim(c.cast("string")))
    return (
        F.when(word == "on", F.lit(True))
        .when(word == "off", F.lit(False))
        .otherwise(word.try_cast("boolean"))
    )


def safe_date(c: Column) -> Column:
    """Year, month and day to a date, with or without leading zeros or a time; less is not one."""
    day = F.regexp_extract(F.trim(c), _DAY, 0)
    return F.nullif(day, F.lit("")).try_cast("date")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def marker_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(NULL_MARKER))


def flag(c: Column) -> Column:
    """``'1.00'`` is true, everything else (NULL too) false."""
    return F.coalesce(safe_number(c), F.lit(0)) == 1


def hhmm_to_minutes(hhmm: Column) -> Column:
    """Clock time written as a number (1345, 2400) to minutes after midnight."""
    return (hhmm % 100 + F.floor(hhmm / 100) * 60).cast("int")


def at_clock(day: Column, hhmm: Column) -> Column:
    """The wall-clock timestamp ``hhmm`` on ``day``."""
    return F.timestamp_add("MINUTE", hhmm_to_minutes(hhmm), day.cast("timestamp"))


@lru_cache(maxsize=1)
def known_zones() -> str:
    """The zone names of the JVM, which does the conversion."""
    spark = SparkSession.active()
    return ",".join(sorted(spark._jvm.java.time.ZoneId.getAvailableZoneIds()))


def valid_zone(zone: Column) -> Column:
    """``zone`` if it is a zone name that exists, else NULL (conversion would fail on it)."""
    return F.when(F.find_in_set(zone, F.lit(known_zones())) > 0, zone)


def local_to_utc(wall_clock: Column, zone: Column) -> Column:
    return F.to_utc_timestamp(wall_clock, F.coalesce(zone, F.lit("UTC")))


def minute_boundaries(start: Column, end: Column) -> Column:
    """Minute marks crossed between two instants (not minutes elapsed)."""
    first = F.unix_seconds(F.date_trunc("minute", start))
    last = F.unix_seconds(F.date_trunc("minute", end))
    return ((last - first) / 60).cast("bigint")


def seconds_apart(a: Column, b: Column) -> Column:
    return F.abs(F.unix_seconds(a) - F.unix_seconds(b))


def month_number(day: Column) -> Column:
    """Partition value for a month, e.g. 202401."""
    return (F.year(day) * 100 + F.month(day)).cast("int")
