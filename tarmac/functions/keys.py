"""Natural keys, surrogate keys and change markers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _or_blank(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _stamp(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "yyyy-MM-dd HH:mm:ss"), F.lit(""))


def flight_key(day: Column, carrier: Column, number: Column, origin: Column, hhmm: Column) -> Column:
    parts = [_or_blank(c) for c in (day, carrier, number, origin, hhmm)]
    return F.md5(F.concat_ws("|", *parts))


def flight_surrogate(natural_key: Column) -> Column:
    return F.md5(natural_key)


def change_marker(
    natural_key: Column, departed: Column, arrived: Column, cancelled: Column, code: Column
) -> Column:
    return F.sha2(
        F.concat_ws("|", natural_key, _stamp(departed), _stamp(arrived),
                    _or_blank(cancelled), _or_blank(code)),
        256,
    )


def version_key(code: Column, valid_from: Column) -> Column:
    return F.md5(F.concat_ws("|", code, _stamp(valid_from)))


def row_hash(columns: Iterable[str]) -> Column:
    """Tells rows apart that agree on everything a rule orders by."""
    return F.xxhash64(*[F.col(c) for c in columns])
