"""Poll payloads and stream messages: decoding, coercion, dead letters, encoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.values import blank_to_null, safe_boolean, safe_double, safe_long
from tarmac.schemas import PAYLOAD_SCHEMA, STATE_ARRAY_FIELDS, STATES_RAW

_CORRUPT = "_corrupt_record"


def _not_zero(c: Column) -> Column:
    return F.nullif(c, F.lit(0).cast("bigint"))


def decode_payload(payloads: DataFrame, column: str = "value") -> DataFrame:
    """One typed event per aircraft in a poll payload.

    State arrays that are too short or have no airframe id are left out. The event time
    is the first that is neither missing nor zero: time of position, last contact, poll.
    """
    polled = payloads.withColumn("_payload", F.from_json(column, PAYLOAD_SCHEMA))
    rows = polled.select(
        *payloads.drop(column).columns,
        F.col("_payload.time").alias("polled_at"),
        F.explode("_payload.states").alias("_state"),
    ).filter(F.size("_state") >= len(STATE_ARRAY_FIELDS))

    def at(name: str) -> Column:
        return F.get("_state", F.lit(STATE_ARRAY_FIELDS.index(name)))

    doubles = ["longitude", "latitude", "baro_altitude", "velocity", "true_track",
               "vertical_rate", "geo_altitude"]
    columns = {
        "icao24": F.lower(at("icao24")),
        "callsign": blank_to_null(at("callsign")),
        "origin_country": at("origin_country"),
        "event_ts": F.coalesce(
            _not_zero(safe_long(at("time_position"))), _not_zero(safe_long(at("last_contact"))),
            F.col("polled_at")),
        "polled_at": F.col("polled_at"),
        "time_position": safe_long(at("time_position")),
        "last_contact": safe_long(at("last_contact")),
        **{name: safe_double(at(name)) for name in doubles},
        "on_ground": safe_boolean(at("on_ground")),
        "squawk": at("squawk"),
        "spi": safe_boolean(at("spi")),
        "position_source": safe_long(at("position_source")),
    }
    passed_on = [c for c in payloads.columns if c != column]
    return rows.filter(F.length(at("icao24")) > 0).select(
        *passed_on, *[columns[f.name].alias(f.name) for f in STATES_RAW.fields])


def parse_messages(messages: DataFrame, column: str = "value") -> DataFrame:
    """Adds ``event`` (fixed schema: unknown keys dropped, absent ones NULL) and ``reject``.

    A message is rejected if it is no JSON object, has a value of the wrong type, or
    lacks the airframe id or the event time.
    """
    relaxed = T.StructType(
        [T.StructField(f.name, f.dataType) for f in STATES_RAW.fields]
        + [T.StructField(_CORRUPT, T.StringType())]
    )
    event = F.from_json(column, relaxed, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    parsed = messages.withColumn("event", event)
    missing = F.col("event.icao24").isNull() | F.col("event.event_ts").isNull()
    return parsed.withColumn(
        "reject",
        F.when(F.col("event").isNull() | F.col(f"event.{_CORRUPT}").isNotNull(), "unparseable")
        .when(missing, "missing_key"),
    )


def accepted(parsed: DataFrame, *keep: str) -> DataFrame:
    names = [f.name for f in STATES_RAW.fields]
    return parsed.filter(F.col("reject").isNull()).select(
        *keep, *[F.col(f"event.{n}").alias(n) for n in names])


def dead_letters(parsed: DataFrame, *keep: str) -> DataFrame:
    """Rejected messages as they came, key and value untouched, with the reason."""
    return parsed.filter(F.col("reject").isNotNull()).select(*keep, "reject")


def coerce_state_json(messages: DataFrame, column: str = "value") -> DataFrame:
    return accepted(parse_messages(messages, column))


def events_to_json(events: DataFrame) -> DataFrame:
    """One message per event: keyed by airframe, stamped with the event time."""
    return events.select(
        F.col("icao24").alias("key"),
        F.to_json(F.struct(*events.columns)).alias("value"),
        F.timestamp_seconds("event_ts").alias("timestamp"),
    )
