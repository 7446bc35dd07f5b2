"""From staged flights and states to reconciled flight events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.values import (
    at_clock, local_to_utc, minute_boundaries, safe_number, valid_zone,
)
from tarmac.operators.matching import nearest_landings
from tarmac.operators.staging import parse_callsigns

# Fixed value: arrivals this many minutes apart still agree.
AGREE_MINUTES = 15


def airport_zones(airports: DataFrame) -> DataFrame:
    """One zone per airport code. Unknown zone names count as missing, that is UTC."""
    return airports.groupBy("iata").agg(
        F.min_by(valid_zone(F.col("timezone")), "openflights_id").alias("timezone")
    )


def with_zones(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Time zones of origin and destination; the airport list plays both roles.

    No broadcast is forced: the optimizer broadcasts the list while its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles beyond it.
    """
    zones = airport_zones(airports)
    origin = zones.select(F.col("iata").alias("origin_iata"), F.col("timezone").alias("origin_timezone"))
    dest = zones.select(F.col("iata").alias("dest_iata"), F.col("timezone").alias("dest_timezone"))
    return flights.join(origin, "origin_iata", "left").join(dest, "dest_iata", "left")


def _instant(hhmm: str, zone: str) -> Column:
    return local_to_utc(at_clock(F.col("flight_date"), F.col(hhmm)), F.col(zone))


def int_flights(flights: DataFrame, airports: DataFrame, roll_overnight: bool = False) -> DataFrame:
    """Scheduled and actual times in UTC.

    Arrival clock times are read on the departure date. ``roll_overnight`` moves an
    arrival that would precede its departure to the next day.
    """

    flown = ~F.col("cancelled_flag")
    timed = with_zones(flights, airports).withColumns({
        "scheduled_dep_ts": _instant("crs_dep_time_hhmm", "origin_timezone"),
        "scheduled_arr_ts": _instant("crs_arr_time_hhmm", "dest_timezone"),
        "actual_dep_ts": F.when(flown, _instant("dep_time_hhmm", "origin_timezone")),
        "actual_arr_ts": F.when(flown, _instant("arr_time_hhmm", "dest_timezone")),
    })
    if roll_overnight:
        for left, reached in (("scheduled_dep_ts", "scheduled_arr_ts"), ("actual_dep_ts", "actual_arr_ts")):
            timed = timed.withColumn(
                reached,
                F.when(F.col(reached) < F.col(left), F.timestamp_add("DAY", F.lit(1), F.col(reached)))
                .otherwise(F.col(reached)),
            )
    return timed.select(
        "flight_event_natural_key", "flight_date", "carrier_code", "flight_number", "tail_number",
        "origin_iata", "dest_iata", "scheduled_dep_ts", "actual_dep_ts", "scheduled_arr_ts",
        "actual_arr_ts", "dep_delay_min", "arr_delay_min", "cancelled_flag", "cancellation_code",
        "diverted_flag", "distance_miles", "bronze_loaded_at",
    )


def scheduled_arrivals(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """The part of ``int_flights`` a landing is looked up by."""
    zones = airport_zones(airports).withColumnRenamed("iata", "dest_iata")
    return flights.join(zones, "dest_iata", "left").select(
        "carrier_code", "flight_number",
        _instant("crs_arr_time_hhmm", "timezone").alias("scheduled_arr_ts"))


def live_arrivals(
    flights: DataFrame, aircraft: DataFrame, landings: DataFrame, plain_numbers: bool = False
) -> DataFrame:
    """(carrier, number, scheduled arrival) -> nearest landing of the airframe.

    Works on the distinct arrivals asked for, not on flights: copies of a flight and
    busy flight numbers collapse in the map-side half of the ``distinct``. Flight numbers
    are compared as written; ``plain_numbers`` drops leading zeros, which those taken
    from callsigns never have.
    """
    number = F.col("flight_number")
    if plain_numbers:
        number = F.coalesce(safe_number(number).cast("string"), number)
    asked = (
        flights.filter(F.col("scheduled_arr_ts").isNotNull())
        .select("carrier_code", "flight_number", "scheduled_arr_ts").distinct()
        .withColumn("called", number)
        .join(aircraft.withColumnRenamed("flight_number", "called"), ["carrier_code", "called"])
    )
    nearest = nearest_landings(asked, landings)
    return asked.join(nearest, ["icao24", "scheduled_arr_ts"]).select(
        "carrier_code", "flight_number", "scheduled_arr_ts", "live_actual_arr_ts", "ts_diff_s"
    )


def reconcile(
    flights: DataFrame,
    aircraft: DataFrame,
    landings: DataFrame,
    asked: DataFrame | None = None,
    plain_numbers: bool = False,
) -> DataFrame:
    """Flights with their live landing, and how the two arrival times compare.

    ``asked`` may name a cheaper source of the arrivals to look up, for instance the
    flights before deduplication; extra arrivals in it change nothing.
    """
    live = live_arrivals(
        flights if asked is None else asked, aircraft, landings, plain_numbers).drop("ts_diff_s")
    joined = flights.join(live, ["carrier_code", "flight_number", "scheduled_arr_ts"], "left")
    actual, seen = F.col("actual_arr_ts"), F.col("live_actual_arr_ts")
    agree = F.abs(minute_boundaries(actual, seen)) <= AGREE_MINUTES
    status = (
        F.when(actual.isNotNull() & seen.isNotNull(), F.when(agree, "matched").otherwise("mismatch"))
        .when(actual.isNull() & seen.isNotNull(), "live_only")
        .otherwise("bts_only")
    )
    source = F.when(actual.isNull() & seen.isNotNull(), "opensky_reconciled").otherwise("bts")
    return joined.select(
        *flights.columns, "live_actual_arr_ts",
        status.alias("reconciliation_status"), source.alias("source_system"),
    )


def mapped_callsigns(states: DataFrame, map_icao: DataFrame | None = None) -> DataFrame:
    """Callsigns in parts. ``map_icao`` (carrier_key, icao_code) turns three-letter prefixes
    into two-letter carrier codes; by default prefixes are compared as they are."""
    callsigns = parse_callsigns(states)
    if map_icao is None:
        return callsigns
    codes = map_icao.filter(F.col("icao_code").isNotNull()).groupBy(
        F.col("icao_code").alias("cs_carrier")
    ).agg(F.min("carrier_key").alias("mapped"))
    return callsigns.join(codes, "cs_carrier", "left").withColumn(
        "cs_carrier", F.coalesce("mapped", "cs_carrier"))


def reconcile_staged(
    staged_flights: DataFrame, unique_flights: DataFrame, airports: DataFrame,
    aircraft: DataFrame, landings: DataFrame, roll_overnight: bool = False, plain_numbers: bool = False,
) -> DataFrame:
    """Reconciliation of staged flights; arrivals to look up are taken before deduplication."""
    if roll_overnight:
        asked = int_flights(staged_flights, airports, roll_overnight)
    else:
        asked = scheduled_arrivals(staged_flights, airports)
    return reconcile(
        int_flights(unique_flights, airports, roll_overnight), aircraft, landings,
        asked=asked, plain_numbers=plain_numbers,
    )
