"""Typed staging views over the four bronze tables.

All of them are plain projections and filters, so column pruning and predicates
pass through them to the scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegralType, LongType, NumericType

from tarmac.functions.columns import column_or_null, first_present
from tarmac.functions.keys import flight_key
from tarmac.functions.values import (
    blank_to_null, flag, marker_to_null, safe_boolean, safe_date, safe_double, safe_int, safe_long,
)

# Accepted epoch range, 2000-01-01 to 2100-01-01.
EPOCH_MIN = 946684800
EPOCH_MAX = 4102444800


def stg_flights(raw: DataFrame) -> DataFrame:
    """Monthly on-time rows; a column the file lacks becomes NULL."""

    def text(name: str):
        return column_or_null(raw, name)

    rows = raw
    if "ds" in {c.lower() for c in raw.columns}:
        rows = raw.filter(F.col("ds").isNotNull())
    typed = rows.select(
        safe_date(text("FlightDate")).alias("flight_date"),
        F.upper(F.trim(text("Reporting_Airline"))).alias("carrier_code"),
        blank_to_null(text("Flight_Number_Reporting_Airline")).alias("flight_number"),
        blank_to_null(F.upper(text("Tail_Number"))).alias("tail_number"),
        F.upper(F.trim(text("Origin"))).alias("origin_iata"),
        F.upper(F.trim(text("Dest"))).alias("dest_iata"),
        safe_int(text("CRSDepTime")).alias("crs_dep_time_hhmm"),
        safe_int(text("DepTime")).alias("dep_time_hhmm"),
        safe_int(text("DepDelay")).alias("dep_delay_min"),
        safe_int(text("CRSArrTime")).alias("crs_arr_time_hhmm"),
        safe_int(text("ArrTime")).alias("arr_time_hhmm"),
        safe_int(text("ArrDelay")).alias("arr_delay_min"),
        flag(text("Cancelled")).alias("cancelled_flag"),
        blank_to_null(F.upper(text("CancellationCode"))).alias("cancellation_code"),
        flag(text("Diverted")).alias("diverted_flag"),
        safe_int(text("Distance")).alias("distance_miles"),
        F.coalesce(
            safe_int(first_present(raw, "Div_Airport_Landings", "DivAirportLandings")), F.lit(0)
        ).alias("div_airport_landings"),
        column_or_null(raw, "ds", "date").cast("date").alias("flight_date_partition"),
        column_or_null(raw, "bronze_loaded_at", "timestamp").alias("bronze_loaded_at"),
    )
    return typed.dropna(subset=["flight_date", "carrier_code", "flight_number"]).withColumn(
        "flight_event_natural_key",
        flight_key(F.col("flight_date"), F.col("carrier_code"), F.col("flight_number"),
                   F.col("origin_iata"), F.col("crs_dep_time_hhmm")),
    )


def stg_states(raw: DataFrame) -> DataFrame:
    """Aircraft state vectors with an epoch inside the accepted range."""

    def text(name: str):
        return column_or_null(raw, name).cast("string")

    columns = {f.name.lower(): f.dataType for f in raw.schema}

    def value(name: str, parse, kind: str):
        """A typed column as it is, so that filters reach the scan; text is parsed."""
        exact = {"boolean": BooleanType, "double": NumericType}.get(kind, IntegralType)
        if isinstance(columns.get(name), exact):
            return F.col(name).try_cast(kind)
        return parse(text(name))

    epoch = value("event_ts", safe_long, "bigint")
    if isinstance(columns.get("event_ts"), LongType):
        epoch = F.col("event_ts")
    return (
        raw.filter(F.col("icao24").isNotNull() & epoch.between(EPOCH_MIN, EPOCH_MAX))
        .select(
            F.lower(F.trim(text("icao24"))).alias("icao24"),
            blank_to_null(text("callsign")).alias("callsign"),
            text("origin_country").alias("origin_country"),
            F.timestamp_seconds(epoch).alias("event_ts"),
            F.timestamp_seconds(value("time_position", safe_long, "bigint")).alias("time_position_ts"),
            F.timestamp_seconds(value("last_contact", safe_long, "bigint")).alias("last_contact_ts"),
            value("longitude", safe_double, "double").alias("longitude"),
            value("latitude", safe_double, "double").alias("latitude"),
            value("baro_altitude", safe_double, "double").alias("baro_altitude_m"),
            F.coalesce(value("on_ground", safe_boolean, "boolean"), F.lit(False)).alias("on_ground"),
            value("velocity", safe_double, "double").alias("velocity_mps"),
            value("true_track", safe_double, "double").alias("true_track_deg"),
            value("vertical_rate", safe_double, "double").alias("vertical_rate_mps"),
            value("geo_altitude", safe_double, "double").alias("geo_altitude_m"),
            blank_to_null(text("squawk")).alias("squawk"),
            value("position_source", safe_int, "int").alias("position_source"),
            column_or_null(raw, "ds", "date").cast("date").alias("event_date"),
            safe_int(text("hr")).alias("event_hour"),
            column_or_null(raw, "bronze_loaded_at", "timestamp").alias("bronze_loaded_at"),
        )
    )


def stg_airports(raw: DataFrame, run_ts: dt.datetime) -> DataFrame:
    iata = F.col("iata")
    return raw.filter(F.length(F.trim(iata)) == 3).select(
        safe_int(F.col("openflights_id")).alias("openflights_id"),
        blank_to_null(F.col("name")).alias("name"),
        blank_to_null(F.col("city")).alias("city"),
        blank_to_null(F.col("country")).alias("country"),
        F.upper(F.trim(iata)).alias("iata"),
        marker_to_null(F.upper(F.col("icao"))).alias("icao"),
        safe_double(F.col("latitude")).alias("latitude"),
        safe_double(F.col("longitude")).alias("longitude"),
        safe_int(F.col("altitude")).alias("elevation_ft"),
        safe_double(F.col("timezone_offset")).alias("utc_offset_hours"),
        marker_to_null(F.col("dst")).alias("dst"),
        marker_to_null(F.col("tz_database")).alias("timezone"),
        marker_to_null(F.col("type")).alias("airport_type"),
        marker_to_null(F.col("source")).alias("source_system"),
        F.lit(run_ts).cast("timestamp").alias("ingested_at"),
    )


def stg_airlines(raw: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Airlines with a two-character code; the NULL marker is not a code."""
    code = marker_to_null(F.upper(F.col("iata")))
    active = F.upper(F.trim(F.col("active")))
    return raw.filter(F.length(code) == 2).select(
        safe_int(F.col("openflights_id")).alias("openflights_id"),
        blank_to_null(F.col("name")).alias("carrier_name"),
        marker_to_null(F.col("alias")).alias("alias"),
        code.alias("carrier_key"),
        marker_to_null(F.upper(F.col("icao"))).alias("icao_code"),
        marker_to_null(F.col("callsign")).alias("callsign"),
        blank_to_null(F.col("country")).alias("country"),
        F.when(active == "Y", True).when(active == "N", False).alias("is_active"),
        F.lit(run_ts).cast("timestamp").alias("ingested_at"),
    )


def parse_callsigns(states: DataFrame) -> DataFrame:
    """Carrier letters and flight number of callsigns such as ``AAL0123``.

    The number loses its leading zeros. More digits than a number can hold (38) are no
    flight number; the pattern says so, which spares a filter on the parsed value.
    """
    carrier = F.rtrim("callsign", F.lit("0123456789"))
    digits = F.substring("callsign", F.length(carrier) + 1, F.length("callsign"))
    return states.filter(F.col("callsign").rlike("^[A-Z]{2,3}[0-9]{1,38}$")).select(
        "icao24", "callsign", carrier.alias("cs_carrier"),
        digits.try_cast("decimal(38,0)").cast("string").alias("cs_flight_num"), "event_ts",
    )
