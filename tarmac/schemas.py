"""Table schemas and fixed column lists."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Declared columns of the bronze tables.
FLIGHTS_RAW_COLUMNS = [
    "flightdate", "reporting_airline", "flight_number_reporting_airline", "tail_number",
    "origin", "dest", "crsdeptime", "deptime", "depdelay", "crsarrtime", "arrtime",
    "arrdelay", "cancelled", "cancellationcode", "diverted", "distance",
]
AIRPORTS_RAW = _strings(
    "openflights_id", "name", "city", "country", "iata", "icao", "latitude", "longitude",
    "altitude", "timezone_offset", "dst", "tz_database", "type", "source",
)
AIRLINES_RAW = _strings(
    "openflights_id", "name", "alias", "iata", "icao", "callsign", "country", "active",
)

# Order of the fields inside one state array of a poll payload.
STATE_ARRAY_FIELDS = [
    "icao24", "callsign", "origin_country", "time_position", "last_contact", "longitude",
    "latitude", "baro_altitude", "on_ground", "velocity", "true_track", "vertical_rate",
    "sensors", "geo_altitude", "squawk", "spi", "position_source",
]

STATES_RAW = T.StructType([
    T.StructField("icao24", T.StringType(), False),
    T.StructField("callsign", T.StringType()),
    T.StructField("origin_country", T.StringType()),
    T.StructField("event_ts", T.LongType(), False),
    T.StructField("polled_at", T.LongType()),
    T.StructField("time_position", T.LongType()),
    T.StructField("last_contact", T.LongType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("baro_altitude", T.DoubleType()),
    T.StructField("on_ground", T.BooleanType()),
    T.StructField("velocity", T.DoubleType()),
    T.StructField("true_track", T.DoubleType()),
    T.StructField("vertical_rate", T.DoubleType()),
    T.StructField("geo_altitude", T.DoubleType()),
    T.StructField("squawk", T.StringType()),
    T.StructField("spi", T.BooleanType()),
    T.StructField("position_source", T.LongType()),
])

PAYLOAD_SCHEMA = "time bigint, states array<array<string>>"

MANIFEST = (
    "source_url string, downloaded_at timestamp, content_length bigint, sha256 string, "
    "member_filename string, row_count_estimate bigint, partition date"
)

DRIFT_LOG = (
    "detected_at timestamp, source_name string, table_name string, kind string, "
    "column_name string, reviewed_at timestamp, reviewed_by string, notes string"
)

SILVER_FLIGHT_COLUMNS = [
    "flight_event_natural_key", "flight_date", "carrier_code", "flight_number", "tail_number",
    "origin_iata", "dest_iata", "scheduled_dep_ts", "actual_dep_ts", "scheduled_arr_ts",
    "actual_arr_ts", "dep_delay_min", "arr_delay_min", "cancelled_flag", "cancellation_code",
    "diverted_flag", "distance_miles", "live_actual_arr_ts", "reconciliation_status",
    "source_system", "bronze_loaded_at", "ingested_at",
]
SILVER_STATE_COLUMNS = [
    "icao24", "callsign", "origin_country", "event_ts", "longitude", "latitude",
    "baro_altitude_m", "geo_altitude_m", "on_ground", "velocity_mps", "true_track_deg",
    "vertical_rate_mps", "squawk", "position_source", "bronze_loaded_at", "ingested_at",
]
