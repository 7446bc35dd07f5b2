"""Registered queries: staging, joins, windows, derived tables, serving."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac import standins
from tarmac.functions import keys, values
from tarmac.functions.columns import column_or_null, first_present
from tarmac.operators import matching, requests
from tarmac.operators.dedupe import keep_latest, latest_aircraft
from tarmac.operators.landings import landing_events
from tarmac.operators.staging import parse_callsigns, stg_states
from tarmac.plans import gold, serving, silver
from tarmac.plans.flights import live_arrivals, with_zones
from tarmac.registry import frames
from tarmac.registry.oracle import minutes, sql, stamp

RUN_TS, START, END = frames.RUN_TS, frames.START, frames.END


def landings(spark: SparkSession, d: str) -> DataFrame:
    return landing_events(silver.unique_states(frames.states(spark, d)))


def aircraft(spark: SparkSession, d: str) -> DataFrame:
    return latest_aircraft(parse_callsigns(frames.states(spark, d)))


def located_flights(spark: SparkSession, d: str) -> DataFrame:
    return matching.flights_with_aircraft(frames.timed_flights(spark, d), aircraft(spark, d))


def q_column_or_null(spark: SparkSession, d: str) -> DataFrame:
    raw = standins.flights_raw(spark, d)
    return raw.select(
        column_or_null(raw, "flightdate").alias("flight_date_raw"),
        column_or_null(raw, "TAIL_NUMBER").alias("tail_number"),
        column_or_null(raw, "Wheels_Off").alias("wheels_off"),
        column_or_null(raw, "bronze_loaded_at").alias("bronze_loaded_at"),
    )


def q_coalesce_renamed(spark: SparkSession, d: str) -> DataFrame:
    raw = standins.flights_raw(spark, d)
    return raw.select(
        first_present(raw, "Div_Airport_Landings", "DivAirportLandings").alias("div_airport_landings"),
        "bronze_loaded_at")


def q_dedupe_latest(spark: SparkSession, d: str) -> DataFrame:
    twice = standins.replayed(standins.states_raw(spark, d))
    return keep_latest(stg_states(twice), silver.STATE_KEY, "bronze_loaded_at")


def q_hhmm_to_minutes(spark: SparkSession, d: str) -> DataFrame:
    return frames.flights(spark, d).select(
        "bronze_loaded_at",
        values.hhmm_to_minutes(F.col("crs_dep_time_hhmm")).alias("dep_minutes"),
        values.hhmm_to_minutes(F.col("arr_time_hhmm")).alias("arr_minutes"))


def q_local_to_utc(spark: SparkSession, d: str) -> DataFrame:
    zoned = with_zones(silver.unique_flights(frames.flights(spark, d)), frames.airports(spark, d))
    local = values.at_clock(F.col("flight_date"), F.col("crs_dep_time_hhmm"))
    return zoned.select(
        "flight_event_natural_key", local.alias("local_ts"),
        values.local_to_utc(local, F.col("origin_timezone")).alias("utc_ts"))


def q_minute_boundary_diff(spark: SparkSession, d: str) -> DataFrame:
    e = standins.table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    later = F.timestamp_add("SECOND", (F.col("event_id") % 200).cast("int"), F.col("ts"))
    return e.select("event_id", values.minute_boundaries(F.col("ts"), later).alias("minutes"))


def q_record_hash(spark: SparkSession, d: str) -> DataFrame:
    marker = keys.change_marker(
        F.col("flight_event_natural_key"), F.col("actual_dep_ts"), F.col("actual_arr_ts"),
        F.col("cancelled_flag"), F.col("cancellation_code"))
    return frames.timed_flights(spark, d).select("flight_event_natural_key", marker.alias("record_hash"))


def q_nearest_landing(spark: SparkSession, d: str) -> DataFrame:
    flights = frames.timed_flights(spark, d)
    live = live_arrivals(flights, aircraft(spark, d), landings(spark, d))
    return flights.join(live, ["carrier_code", "flight_number", "scheduled_arr_ts"]).select(
        "flight_event_natural_key", "live_actual_arr_ts", "ts_diff_s")


def q_dim_date(spark: SparkSession, d: str) -> DataFrame:
    days = gold.date_spine(gold.calendar_bounds(frames.flights(spark, d)))
    return gold.dim_date(days, gold.holiday_frame(spark))


def q_fct(spark: SparkSession, d: str) -> DataFrame:
    return gold.fct_flight_event(frames.silver_flights(spark, d), frames.airport_dim(spark, d), RUN_TS)


def q_lookup(spark: SparkSession, d: str) -> DataFrame:
    table = frames.gold_tables(spark, d)["silver_flight_event"]
    return silver.silver_lookup(table, "AA", "25", dt.date(2024, 1, 12))


def _daily(spark: SparkSession, d: str) -> DataFrame:
    return frames.gold_tables(spark, d)["agg_carrier_otp_daily"]


def q_overview(spark: SparkSession, d: str) -> DataFrame:
    t = frames.gold_tables(spark, d)
    return serving.otp_overview(
        t["agg_carrier_otp_daily"], t["dim_carrier"], START, END, ["AA", "DL", "UA"])


def q_pivot(spark: SparkSession, d: str) -> DataFrame:
    t = frames.gold_tables(spark, d)
    overview = serving.otp_overview(t["agg_carrier_otp_daily"], t["dim_carrier"], START, END)
    return serving.otp_pivot(overview, ["AA", "B6", "DL", "UA", "WN"])


def q_kpi(spark: SparkSession, d: str) -> DataFrame:
    k = serving.kpi_summary(_daily(spark, d), START, END)
    return k.withColumn("on_time_pct", F.round("on_time_pct", 6))


def q_requests(spark: SparkSession, d: str) -> DataFrame:
    """Orders as score requests, with mistakes that depend on priority and status."""
    o = standins.table(spark, d, "orders")
    asked = o.selectExpr(
        "o_orderkey",
        f"case when o_orderstatus = 'P' then '?' else lower({standins.carrier_of('o_custkey')}) end as carrier_code",
        f"case when o_orderpriority = '5-LOW' then 'Denver' else {standins.airport_of('(o_custkey % 25)')} end as origin_iata",
        f"{standins.airport_of('((o_orderkey * 7) % 10)')} as dest_iata",
        "cast(o_totalprice / 20 as int) as distance_miles",
        "cast(o_orderkey % 30 as int) as scheduled_dep_hour",
        "cast(o_orderkey % 7 as int) as day_of_week", "month(o_orderdate) as month",
        "case when o_orderkey % 5 = 0 then null else cast(o_orderkey % 1000 - 100 as int) end as dep_delay_min",
    )
    checked = requests.validate_requests(asked)
    return checked.withColumn("reasons", F.concat_ws(",", "reasons"))


def requests_by_id(spark: SparkSession, d: str) -> DataFrame:
    """Requests for flights by carrier, number and time; partial orders ask for unknown numbers."""
    o = standins.table(spark, d, "orders")
    return o.selectExpr(
        "o_orderkey", f"lower({standins.carrier_of('o_custkey')}) as carrier_code",
        "case when o_orderstatus = 'P' then 'x' else '' end || cast(o_custkey % 150 as string) as flight_number",
        "timestamp_seconds(1704067200 + (o_orderkey % 30) * 86400 + 3600) as scheduled_dep_ts")


def q_hydrate(spark: SparkSession, d: str) -> DataFrame:
    return requests.hydrate(requests_by_id(spark, d), frames.gold_tables(spark, d)["silver_flight_event"])


QUERIES = {
    "stg_flights": frames.flights,
    "stg_states": frames.states,
    "stg_airports": frames.airports,
    "stg_airlines": frames.airlines,
    "column_or_null": q_column_or_null,
    "coalesce_renamed": q_coalesce_renamed,
    "callsign_parse": lambda s, d: parse_callsigns(frames.states(s, d)),
    "dedupe_latest": q_dedupe_latest,
    "hhmm_to_minutes": q_hhmm_to_minutes,
    "local_to_utc": q_local_to_utc,
    "minute_boundary_diff": q_minute_boundary_diff,
    "natural_key": lambda s, d: frames.flights(s, d).select(
        "flight_date", "carrier_code", "flight_number", "origin_iata", "crs_dep_time_hhmm",
        "flight_event_natural_key"),
    "record_hash": q_record_hash,
    "join_role_dims": lambda s, d: with_zones(
        silver.unique_flights(frames.flights(s, d)), frames.airports(s, d)
    ).select("flight_event_natural_key", "origin_iata", "dest_iata", "origin_timezone", "dest_timezone"),
    "int_flights": frames.timed_flights,
    "latest_aircraft": aircraft,
    "flight_to_aircraft": lambda s, d: located_flights(s, d).select(
        "flight_event_natural_key", "carrier_code", "flight_number", "icao24"),
    "landing_events": landings,
    "landing_candidates": lambda s, d: matching.landing_candidates(located_flights(s, d), landings(s, d)),
    "nearest_landing": q_nearest_landing,
    "reconcile": lambda s, d: frames.silver_flights(s, d).drop("ingested_at"),
    "silver_aircraft_state": lambda s, d: silver.silver_aircraft_state(frames.states(s, d), RUN_TS),
    "silver_flight_event": frames.silver_flights,
    "silver_point_lookup": q_lookup,
    "dim_airport": frames.airport_dim,
    "dim_carrier": frames.carrier_dim,
    "dim_aircraft": lambda s, d: gold.dim_aircraft(frames.flights(s, d), RUN_TS),
    "dim_date": q_dim_date,
    "date_spine": lambda s, d: gold.date_spine(gold.calendar_bounds(frames.flights(s, d))),
    "fct_flight_event": q_fct,
    "agg_carrier_otp_daily": lambda s, d: gold.agg_carrier_otp_daily(q_fct(s, d), RUN_TS),
    "distinct_tails": lambda s, d: frames.flights(s, d).select("tail_number").distinct(),
    "carrier_options": lambda s, d: serving.carrier_options(
        frames.gold_tables(s, d)["dim_carrier"], _daily(s, d), END),
    "otp_overview": q_overview,
    "otp_pivot": q_pivot,
    "top_delay_routes": lambda s, d: serving.top_delay_routes(
        frames.gold_tables(s, d)["fct_flight_event"], START, END),
    "recent_flights": lambda s, d: serving.recent_flights(
        frames.gold_tables(s, d)["fct_flight_event"], dt.date(2024, 1, 20), "WN"),
    "kpi_summary": q_kpi,
    "validate_requests": q_requests,
    "hydrate_features": q_hydrate,
    "feature_matrix": lambda s, d: requests.feature_matrix(
        frames.gold_tables(s, d)["silver_flight_event"], "flight_event_natural_key"),
}

_DAILY_RANGE = "flight_date between date '2024-01-01' and date '2024-01-31'"
_LATEST_TRACK = """
    select * from replayed
    qualify row_number() over (partition by icao24, event_ts order by bronze_loaded_at desc) = 1"""
_SILVER = """select flight_event_natural_key, flight_date, carrier_code, flight_number, tail_number,
    origin_iata, dest_iata, scheduled_dep_ts, actual_dep_ts, scheduled_arr_ts, actual_arr_ts,
    dep_delay_min, arr_delay_min, cancelled_flag, cancellation_code, diverted_flag, distance_miles,
    live_actual_arr_ts, reconciliation_status, source_system, bronze_loaded_at"""
_REQUEST = """
    select o_orderkey,
      upper(case when o_orderstatus = 'P' then '?' else {carrier} end) as carrier_code,
      upper(case when o_orderpriority = '5-LOW' then 'Denver' else {origin} end) as origin_iata,
      {dest} as dest_iata, cast(trunc(o_totalprice / 20) as integer) as distance_miles,
      cast(o_orderkey % 30 as integer) as scheduled_dep_hour, cast(o_orderkey % 7 as integer) as day_of_week,
      cast(month(o_orderdate) as integer) as month,
      case when o_orderkey % 5 = 0 then 0 else cast(o_orderkey % 1000 - 100 as integer) end as dep_delay_min
    from orders"""


def _request_sql() -> str:
    from tarmac.registry.oracle import _airport, _carrier

    rules = {
        "carrier_code": "regexp_full_match(carrier_code, '[A-Z0-9]{2,3}')",
        "origin_iata": "regexp_full_match(origin_iata, '[A-Z]{3}')",
        "dest_iata": "regexp_full_match(dest_iata, '[A-Z]{3}')",
        "distance_miles": "distance_miles between 1 and 15000",
        "scheduled_dep_hour": "scheduled_dep_hour between 0 and 23",
        "day_of_week": "day_of_week between 0 and 6",
        "month": "month between 1 and 12",
        "dep_delay_min": "dep_delay_min between -60 and 720",
    }
    reasons = ", ".join(f"case when not ({ok}) then '{c}' end" for c, ok in rules.items())
    rows = _REQUEST.format(
        carrier=_carrier("o_custkey"), origin=_airport("(o_custkey % 25)"),
        dest=_airport("((o_orderkey * 7) % 10)"))
    return (f"select r.*, concat_ws(',', {reasons}) as reasons, "
            f"concat_ws(',', {reasons}) = '' as valid from ({rows}) r")


_FEATURES = """carrier_code, origin_iata, dest_iata, distance_miles,
    cast(hour(scheduled_dep_ts) as integer) as scheduled_dep_hour,
    cast(isodow(scheduled_dep_ts) - 1 as integer) as day_of_week,
    cast(month(scheduled_dep_ts) as integer) as month, coalesce(dep_delay_min, 0) as dep_delay_min"""


def _hydrate_sql() -> str:
    from tarmac.registry.oracle import _carrier

    return sql(f"""
        select a.*, f.origin_iata, f.dest_iata, f.distance_miles, f.scheduled_dep_hour, f.day_of_week,
          f.month, f.dep_delay_min, f.carrier_code is not null as found
        from (select o_orderkey, {_carrier('o_custkey')} as carrier_code,
                case when o_orderstatus = 'P' then 'x' else '' end || cast(o_custkey % 150 as varchar) as flight_number,
                timestamp '2024-01-01 01:00:00' + to_days(cast(o_orderkey % 30 as integer)) as scheduled_dep_ts,
                date '2024-01-01' + cast(o_orderkey % 30 as int) as flight_date
              from orders) a
        left join (select {_FEATURES}, flight_number, flight_date from silver
              qualify row_number() over (partition by carrier_code, flight_number, flight_date
                order by scheduled_dep_ts, flight_event_natural_key) = 1) f
          on a.carrier_code = f.carrier_code and a.flight_number = f.flight_number
          and a.flight_date = f.flight_date""")


ORACLES = {
    "stg_flights": sql("select * from stg_flights"),
    "stg_states": sql("select * from stg_states"),
    "stg_airports": sql("select * from stg_airports"),
    "stg_airlines": sql("select * from stg_airlines"),
    "column_or_null": sql(
        "select flightdate as flight_date_raw, tail_number, cast(null as varchar) as wheels_off, "
        "bronze_loaded_at from flights_raw"),
    "coalesce_renamed": sql(
        "select coalesce(div_new, div_old) as div_airport_landings, bronze_loaded_at from flights_raw"),
    "callsign_parse": sql("select * from callsigns"),
    "dedupe_latest": sql(_LATEST_TRACK),
    "hhmm_to_minutes": sql(
        "select bronze_loaded_at, cast(crs_dep_time_hhmm % 100 + 60 * (crs_dep_time_hhmm // 100) as integer) "
        "as dep_minutes, cast(arr_time_hhmm % 100 + 60 * (arr_time_hhmm // 100) as integer) as arr_minutes "
        "from stg_flights"),
    "local_to_utc": sql(
        "select z.flight_event_natural_key, cast(z.flight_date as timestamp) + to_minutes(cast("
        "z.crs_dep_time_hhmm % 100 + 60 * (z.crs_dep_time_hhmm // 100) as bigint)) as local_ts, "
        "f.scheduled_dep_ts as utc_ts from zoned z join int_flights f using (flight_event_natural_key)"),
    "minute_boundary_diff":
        f"select event_id, {minutes('ts', 'ts + to_seconds(event_id % 200)')} as minutes from events",
    "natural_key": sql(
        "select flight_date, carrier_code, flight_number, origin_iata, crs_dep_time_hhmm, "
        "flight_event_natural_key from stg_flights"),
    "record_hash": sql(
        "select flight_event_natural_key, sha256(concat_ws('|', flight_event_natural_key, "
        f"{stamp('actual_dep_ts')}, {stamp('actual_arr_ts')}, cast(cancelled_flag as varchar), "
        "coalesce(cancellation_code, ''))) as record_hash from int_flights"),
    "join_role_dims": sql(
        "select flight_event_natural_key, origin_iata, dest_iata, origin_timezone, dest_timezone from zoned"),
    "int_flights": sql("select * from int_flights"),
    "latest_aircraft": sql("select * from aircraft"),
    "flight_to_aircraft": sql(
        "select flight_event_natural_key, carrier_code, flight_number, icao24 from with_icao"),
    "landing_events": sql("select * from landings"),
    "landing_candidates": sql("select * from candidates"),
    "nearest_landing": sql("select * from nearest"),
    "reconcile": sql(f"{_SILVER} from reconciled"),
    "silver_aircraft_state": sql(
        "select icao24, callsign, origin_country, event_ts, longitude, latitude, baro_altitude_m, "
        "geo_altitude_m, on_ground, velocity_mps, true_track_deg, vertical_rate_mps, squawk, "
        "position_source, bronze_loaded_at, timestamp '2024-02-01 00:00:00' as ingested_at from uniq_states"),
    "silver_flight_event": sql(f"{_SILVER}, ingested_at from silver"),
    "silver_point_lookup": sql(
        "select distance_miles, scheduled_dep_ts, origin_iata, dest_iata, dep_delay_min from silver "
        "where carrier_code = 'AA' and flight_number = '25' and flight_date = date '2024-01-12' "
        "order by scheduled_dep_ts, flight_event_natural_key limit 1"),
    "dim_airport": sql("select * from dim_airport"),
    "dim_carrier": sql("select * from dim_carrier"),
    "dim_aircraft": sql("select * from aircraft_dim"),
    "date_spine": sql("select date_key from days"),
    "dim_date": sql("""
        select date_key, cast(year(date_key) as integer) as year, cast(quarter(date_key) as integer) as quarter,
          cast(month(date_key) as integer) as month, cast(day(date_key) as integer) as day,
          cast(isodow(date_key) as integer) as day_of_week, strftime(date_key, '%a') as day_name,
          isodow(date_key) in (6, 7) as is_weekend,
          strftime(date_key, '%Y-%m-%d') in ('2024-01-01','2024-01-15','2024-02-19','2024-05-27','2024-06-19',
            '2024-07-04','2024-09-02','2024-10-14','2024-11-11','2024-11-28','2024-12-25') as is_us_federal_holiday,
          cast(case when month(date_key) >= 10 then year(date_key) + 1 else year(date_key) end as integer) as fiscal_year,
          cast(case when month(date_key) in (10,11,12) then 1 when month(date_key) in (1,2,3) then 2
            when month(date_key) in (4,5,6) then 3 else 4 end as integer) as fiscal_quarter,
          cast(week(date_key) as integer) as iso_week
        from days"""),
    "fct_flight_event": sql("select * from fact"),
    "agg_carrier_otp_daily": sql("select * from daily"),
    "distinct_tails": sql("select distinct tail_number from stg_flights"),
    "carrier_options": sql(
        "select carrier_key, carrier_name from dim_carrier c where exists (select 1 from daily a "
        "where a.carrier_key = c.carrier_key and a.flight_date >= date '2024-01-31' - 90)"),
    "otp_overview": sql(
        "select a.flight_date, a.carrier_key, c.carrier_name, a.flights_scheduled, a.flights_completed, "
        "a.flights_cancelled, a.on_time_pct, a.avg_arr_delay_min, a.total_delay_min from daily a "
        f"join dim_carrier c on c.carrier_key = a.carrier_key where {_DAILY_RANGE} "
        "and a.carrier_key in ('AA', 'DL', 'UA')"),
    "otp_pivot": sql(
        "select a.flight_date, " + ", ".join(
            f"avg(a.on_time_pct) filter (a.carrier_key = '{c}') as \"{c}\"" for c in ("AA", "B6", "DL", "UA", "WN"))
        + f" from daily a join dim_carrier c on c.carrier_key = a.carrier_key where {_DAILY_RANGE} group by 1"),
    "top_delay_routes": sql(
        "select origin_airport_key as origin_iata, dest_airport_key as dest_iata, count(*) as flights, "
        "avg(arr_delay_min) as avg_arr_delay_min, count(*) filter (arr_delay_min > 14) as flights_late, "
        "100.0::double * count(*) filter (arr_delay_min <= 14) / count(*) as on_time_pct from fact "
        "where flight_date_key between date '2024-01-01' and date '2024-01-31' and not cancelled_flag "
        "group by 1, 2 having count(*) >= 30 "
        "order by avg_arr_delay_min desc nulls last, origin_iata, dest_iata limit 25"),
    "recent_flights": sql(
        "select flight_date_key as flight_date, carrier_key, flight_number, origin_airport_key as origin_iata, "
        "dest_airport_key as dest_iata, scheduled_dep_ts, actual_dep_ts, scheduled_arr_ts, actual_arr_ts, "
        "dep_delay_min, arr_delay_min, cancelled_flag, cancellation_code, diverted_flag, distance_miles, "
        "reconciliation_status from fact where flight_date_key = date '2024-01-20' and carrier_key = 'WN' "
        "order by scheduled_dep_ts, flight_event_sk limit 200"),
    "kpi_summary": sql(
        "select coalesce(cast(sum(flights_scheduled) as double), 0) as flights_scheduled, "
        "coalesce(cast(sum(flights_completed) as double), 0) as flights_completed, "
        "coalesce(cast(sum(flights_cancelled) as double), 0) as flights_cancelled, "
        "round(coalesce(avg(on_time_pct), 0), 6) as on_time_pct, "
        f"coalesce(cast(sum(coalesce(total_delay_min, 0)) as double), 0) as total_delay_min from daily where {_DAILY_RANGE}"),
    "validate_requests": _request_sql(),
    "hydrate_features": _hydrate_sql(),
    "feature_matrix": sql(f"select flight_event_natural_key, {_FEATURES} from silver"),
}
