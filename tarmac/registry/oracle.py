"""Reference SQL, as named common table expressions over the test tables.

``sql(body)`` prefixes a statement with the expressions it mentions, directly or not.
"""

from __future__ import annotations

import re

RUN_TS = "timestamp '2024-02-01 00:00:00'"


def _carrier(n: str) -> str:
    return (f"case cast({n} % 5 as int) when 0 then 'AA' when 1 then 'DL' when 2 then 'UA' "
            "when 3 then 'WN' else 'B6' end")


def _airport(n: str) -> str:
    return f"'N' || chr(cast(65 + floor(({n}) / 5) as int)) || chr(cast(65 + ({n}) % 5 as int))"


def _number(c: str) -> str:
    return f"cast(try_cast({c} as decimal(38,0)) as integer)"


def _at(hhmm: str, zone: str) -> str:
    wall = f"(cast(flight_date as timestamp) + to_minutes(cast({hhmm} % 100 + 60 * ({hhmm} // 100) as bigint)))"
    return f"(({wall} at time zone coalesce({zone}, 'UTC')) at time zone 'UTC')"


def stamp(c: str) -> str:
    return f"coalesce(strftime({c}, '%Y-%m-%d %H:%M:%S'), '')"


def minutes(a: str, b: str) -> str:
    return f"date_diff('minute', {a}, {b})"


_EPOCH = "cast(floor(epoch(ts)) as bigint)"

CTES = {
    "flights_raw": f"""
        select cast(date '2024-01-01' + cast(o_orderkey % 30 as int) as varchar) as flightdate,
          {_carrier('o_custkey')} as reporting_airline,
          cast(o_custkey % 150 as varchar) as flight_number_reporting_airline,
          case when o_orderkey % 97 = 0 then '' else 'N' || cast(o_custkey as varchar) end as tail_number,
          {_airport('(o_custkey % 25)')} as origin, {_airport('((o_orderkey * 7) % 10)')} as dest,
          cast(((o_orderkey*7) % 24)*100 + (o_orderkey*13) % 60 as varchar) as crsdeptime,
          case when o_orderkey % 50 = 0 then null else cast(((o_orderkey*7) % 24)*100 + (o_orderkey*17) % 60 as varchar) end as deptime,
          case when o_orderkey % 50 = 0 then null else cast((o_orderkey*17) % 60 - (o_orderkey*13) % 60 as varchar) || '.00' end as depdelay,
          cast(((o_orderkey*7+2) % 24)*100 + (o_orderkey*11) % 60 as varchar) as crsarrtime,
          case when o_orderkey % 50 = 0 then null else cast(((o_orderkey*7+2) % 24)*100 + (o_orderkey*19) % 60 as varchar) end as arrtime,
          case when o_orderkey % 50 = 0 then null else cast((o_orderkey*19) % 60 - (o_orderkey*11) % 60 as varchar) || '.00' end as arrdelay,
          case when o_orderkey % 50 = 0 then '1.00' else '0.00' end as cancelled,
          case when o_orderkey % 50 = 0 then 'B' else '' end as cancellationcode,
          '0.00' as diverted,
          cast(150 + o_custkey % 2500 as varchar) || '.00' as distance,
          case when o_orderkey % 2 = 0 then cast(o_orderkey % 3 as varchar) || '.00' end as div_new,
          case when o_orderkey % 2 = 1 then cast(o_orderkey % 3 as varchar) || '.00' end as div_old,
          date '2024-01-01' as ds,
          timestamp '2024-02-01 00:00:00' + to_seconds(o_orderkey) as bronze_loaded_at
        from orders""",
    "stg_flights": f"""
        select t.*, md5(concat_ws('|', cast(flight_date as varchar), coalesce(carrier_code, ''),
            coalesce(flight_number, ''), coalesce(origin_iata, ''),
            coalesce(cast(crs_dep_time_hhmm as varchar), ''))) as flight_event_natural_key
        from (select try_cast(flightdate as date) as flight_date,
            upper(trim(reporting_airline)) as carrier_code,
            nullif(trim(flight_number_reporting_airline), '') as flight_number,
            nullif(upper(trim(tail_number)), '') as tail_number,
            upper(trim(origin)) as origin_iata, upper(trim(dest)) as dest_iata,
            {_number('crsdeptime')} as crs_dep_time_hhmm, {_number('deptime')} as dep_time_hhmm,
            {_number('depdelay')} as dep_delay_min, {_number('crsarrtime')} as crs_arr_time_hhmm,
            {_number('arrtime')} as arr_time_hhmm, {_number('arrdelay')} as arr_delay_min,
            coalesce({_number('cancelled')}, 0) = 1 as cancelled_flag,
            nullif(upper(trim(cancellationcode)), '') as cancellation_code,
            coalesce({_number('diverted')}, 0) = 1 as diverted_flag,
            {_number('distance')} as distance_miles,
            coalesce({_number('coalesce(div_new, div_old)')}, 0) as div_airport_landings,
            ds as flight_date_partition, bronze_loaded_at
          from flights_raw) t
        where flight_date is not null and carrier_code is not null and flight_number is not null""",
    "uniq_flights": """
        select * from stg_flights
        qualify row_number() over (partition by flight_event_natural_key order by bronze_loaded_at desc) = 1""",
    "states_raw": f"""
        select lower(lpad(hex(user_id), 6, '0')) as icao24,
          {_carrier('user_id')} || (case when user_id % 2 = 0 then '' else 'X' end) || cast(user_id as varchar) as callsign,
          case when user_id % 3 = 0 then 'United States' else 'Canada' end as origin_country,
          {_EPOCH} as event_ts, {_EPOCH} as time_position, {_EPOCH} + 1 as last_contact,
          -(7000 + (event_id * 11) % 5000) / 100.0::double as longitude,
          (2500 + (event_id * 7) % 2400) / 100.0::double as latitude,
          cast(event_id % 12000 as double) as baro_altitude,
          event_type in ('purchase', 'error') as on_ground,
          value as velocity,
          cast((event_id * 7) % 360 as double) as true_track,
          cast(event_id % 21 - 10 as double) as vertical_rate,
          cast(event_id % 12000 + 50 as double) as geo_altitude,
          case when event_id % 10 = 3 then '' else lpad(cast(event_id % 7777 as varchar), 4, '0') end as squawk,
          event_id % 4 as position_source,
          cast(ts as date) as ds, cast(hour(ts) as integer) as hr,
          timestamp '2024-02-01 00:00:00' + to_seconds(event_id) as bronze_loaded_at,
          event_id
        from events""",
    "stg_states": """
        select icao24, callsign, origin_country,
          timestamp '1970-01-01 00:00:00' + to_seconds(event_ts) as event_ts,
          timestamp '1970-01-01 00:00:00' + to_seconds(time_position) as time_position_ts,
          timestamp '1970-01-01 00:00:00' + to_seconds(last_contact) as last_contact_ts,
          longitude, latitude, baro_altitude as baro_altitude_m, on_ground, velocity as velocity_mps,
          true_track as true_track_deg, vertical_rate as vertical_rate_mps,
          geo_altitude as geo_altitude_m, nullif(squawk, '') as squawk,
          cast(position_source as integer) as position_source,
          ds as event_date, hr as event_hour, bronze_loaded_at
        from states_raw""",
    "replayed": """
        select * from stg_states
        union all
        select s.* replace (359.0::double as true_track_deg,
                            s.bronze_loaded_at + interval 1 day as bronze_loaded_at)
        from stg_states s join states_raw r on r.bronze_loaded_at = s.bronze_loaded_at
        where r.event_id % 10 = 0""",
    "uniq_states": """
        select * from stg_states
        qualify row_number() over (partition by icao24, event_ts order by bronze_loaded_at desc) = 1""",
    "airports_raw": f"""
        select cast(n_nationkey as varchar) as openflights_id, n_name as name,
          'City ' || cast(n_nationkey as varchar) as city, cast(n_regionkey as varchar) as country,
          {_airport('n_nationkey')} as iata, 'K' || {_airport('n_nationkey')} as icao,
          cast(25 + n_nationkey as varchar) || '.5' as latitude,
          cast(-70 - n_nationkey as varchar) || '.25' as longitude,
          cast(n_nationkey * 100 as varchar) as altitude,
          cast(-5 - n_nationkey % 4 as varchar) as timezone_offset, 'A' as dst,
          case n_nationkey % 4 when 0 then 'America/New_York' when 1 then 'America/Chicago'
            when 2 then 'America/Denver' else 'America/Los_Angeles' end as tz_database,
          'airport' as type, '\\N' as source
        from nation""",
    "stg_airports": f"""
        select cast(openflights_id as integer) as openflights_id, name, city, country, iata, icao,
          cast(latitude as double) as latitude, cast(longitude as double) as longitude,
          cast(altitude as integer) as elevation_ft, cast(timezone_offset as double) as utc_offset_hours,
          dst, tz_database as timezone, type as airport_type, nullif(source, '\\N') as source_system,
          {RUN_TS} as ingested_at
        from airports_raw where length(trim(iata)) = 3""",
    "airlines_raw": f"""
        select cast(s_suppkey as varchar) as openflights_id, s_name as name, '\\N' as alias,
          case when s_suppkey % 6 = 5 then '\\N' when s_suppkey % 7 = 6 then 'XYZ'
            else ' ' || lower({_carrier('s_suppkey')}) end as iata,
          case when s_suppkey % 3 = 0 then '\\N' else 'S' || lpad(cast(s_suppkey % 100 as varchar), 2, '0') end as icao,
          'CALL' || cast(s_suppkey as varchar) as callsign,
          case when s_nationkey = 7 then '' else 'Nation ' || cast(s_nationkey as varchar) end as country,
          case s_suppkey % 4 when 0 then 'y' when 1 then 'N' when 2 then 'Y' else '?' end as active
        from supplier""",
    "stg_airlines": f"""
        select cast(openflights_id as integer) as openflights_id, name as carrier_name,
          cast(null as varchar) as alias, upper(trim(iata)) as carrier_key,
          nullif(upper(trim(icao)), '\\N') as icao_code, callsign, nullif(country, '') as country,
          case upper(active) when 'Y' then true when 'N' then false end as is_active,
          {RUN_TS} as ingested_at
        from airlines_raw where trim(iata) <> '\\N' and length(trim(iata)) = 2""",
    "zoned": """
        select f.*, o.timezone as origin_timezone, d.timezone as dest_timezone
        from uniq_flights f
        left join stg_airports o on f.origin_iata = o.iata
        left join stg_airports d on f.dest_iata = d.iata""",
    "int_flights": f"""
        select flight_event_natural_key, flight_date, carrier_code, flight_number, tail_number,
          origin_iata, dest_iata,
          case when crs_dep_time_hhmm is not null then {_at('crs_dep_time_hhmm', 'origin_timezone')} end as scheduled_dep_ts,
          case when dep_time_hhmm is not null and not cancelled_flag then {_at('dep_time_hhmm', 'origin_timezone')} end as actual_dep_ts,
          case when crs_arr_time_hhmm is not null then {_at('crs_arr_time_hhmm', 'dest_timezone')} end as scheduled_arr_ts,
          case when arr_time_hhmm is not null and not cancelled_flag then {_at('arr_time_hhmm', 'dest_timezone')} end as actual_arr_ts,
          dep_delay_min, arr_delay_min, cancelled_flag, cancellation_code, diverted_flag,
          distance_miles, bronze_loaded_at
        from zoned""",
    "callsigns": """
        select icao24, callsign, regexp_extract(callsign, '^[A-Z]{2,3}') as cs_carrier,
          cast(cast(regexp_extract(callsign, '[0-9]+$') as bigint) as varchar) as cs_flight_num, event_ts
        from stg_states where regexp_matches(callsign, '^[A-Z]{2,3}[0-9]+$')""",
    "aircraft": """
        select cs_carrier as carrier_code, cs_flight_num as flight_number, icao24 from callsigns
        qualify row_number() over (partition by cs_carrier, cs_flight_num order by event_ts desc, icao24 desc) = 1""",
    "landings": """
        select icao24, callsign, event_ts as live_landing_ts, latitude, longitude,
          prev_velocity as approach_velocity_mps, bronze_loaded_at
        from (select *, lag(on_ground) over w as prev_ground, lag(velocity_mps) over w as prev_velocity
              from uniq_states window w as (partition by icao24 order by event_ts))
        where on_ground and prev_ground = false and coalesce(prev_velocity, 0) > 30""",
    "with_icao": """
        select f.*, a.icao24 from int_flights f
        left join aircraft a on f.carrier_code = a.carrier_code and f.flight_number = a.flight_number""",
    "candidates": """
        select f.flight_event_natural_key, l.live_landing_ts,
          abs(date_diff('second', l.live_landing_ts, f.scheduled_arr_ts)) as ts_diff_s
        from with_icao f join landings l on f.icao24 = l.icao24
          and l.live_landing_ts between f.scheduled_arr_ts - interval 2 hour and f.scheduled_arr_ts + interval 2 hour""",
    "nearest": """
        select flight_event_natural_key, live_landing_ts as live_actual_arr_ts, ts_diff_s from candidates
        qualify row_number() over (partition by flight_event_natural_key order by ts_diff_s, live_landing_ts) = 1""",
    "reconciled": """
        select f.* exclude (icao24), n.live_actual_arr_ts,
          case when actual_arr_ts is not null and live_actual_arr_ts is not null
                 and abs(date_diff('minute', actual_arr_ts, live_actual_arr_ts)) <= 15 then 'matched'
               when actual_arr_ts is not null and live_actual_arr_ts is not null then 'mismatch'
               when actual_arr_ts is not null then 'bts_only'
               when live_actual_arr_ts is not null then 'live_only' else 'bts_only' end as reconciliation_status,
          case when live_actual_arr_ts is not null and actual_arr_ts is null then 'opensky_reconciled' else 'bts' end as source_system
        from with_icao f left join nearest n using (flight_event_natural_key)""",
    "silver": f"select * exclude (bronze_loaded_at), bronze_loaded_at, {RUN_TS} as ingested_at from reconciled",
    "dim_airport": f"""
        select md5(concat_ws('|', iata, '2024-01-01 00:00:00')) as airport_sk, iata as airport_key,
          icao as icao_code, name, city, country, cast(null as varchar) as state, latitude, longitude,
          elevation_ft, timezone, date '2024-01-01' as valid_from, cast(null as date) as valid_to,
          true as is_current, {RUN_TS} as ingested_at
        from stg_airports""",
    "dim_carrier": f"""
        select carrier_key, carrier_name, icao_code, country, coalesce(is_active, true) as is_active,
          date '1987-01-01' as valid_from, cast(null as date) as valid_to, {RUN_TS} as ingested_at
        from stg_airlines
        qualify row_number() over (partition by carrier_key
          order by case when icao_code is not null then 0 else 1 end, openflights_id) = 1""",
    "fact": f"""
        select md5(s.flight_event_natural_key) as flight_event_sk, s.flight_date as flight_date_key,
          s.carrier_code as carrier_key, s.origin_iata as origin_airport_key, s.dest_iata as dest_airport_key,
          o.airport_sk as origin_airport_sk, d.airport_sk as dest_airport_sk, s.tail_number as aircraft_key,
          s.flight_number, s.scheduled_dep_ts, s.actual_dep_ts, s.scheduled_arr_ts, s.actual_arr_ts,
          s.dep_delay_min, s.arr_delay_min, s.cancelled_flag, s.cancellation_code, s.diverted_flag,
          s.distance_miles, s.live_actual_arr_ts, s.reconciliation_status, s.source_system,
          {RUN_TS} as ingested_at,
          sha256(concat_ws('|', s.flight_event_natural_key, {stamp('s.actual_dep_ts')}, {stamp('s.actual_arr_ts')},
            cast(s.cancelled_flag as varchar), coalesce(s.cancellation_code, ''))) as record_hash
        from silver s left join dim_airport o on s.origin_iata = o.airport_key
        left join dim_airport d on s.dest_iata = d.airport_key""",
    "daily": f"""
        select flight_date_key as flight_date, carrier_key, count(*) as flights_scheduled,
          count(*) filter (not cancelled_flag) as flights_completed,
          count(*) filter (cancelled_flag) as flights_cancelled,
          100.0::double * count(*) filter (arr_delay_min <= 14) / nullif(count(*) filter (not cancelled_flag), 0) as on_time_pct,
          avg(arr_delay_min) as avg_arr_delay_min,
          cast(sum(coalesce(arr_delay_min, 0)) as bigint) as total_delay_min, {RUN_TS} as ingested_at
        from fact group by 1, 2""",
    "aircraft_dim": f"""
        select tail_number as aircraft_key, cast(null as varchar) as icao24, cast(null as varchar) as manufacturer,
          cast(null as varchar) as model, max(carrier_code) as operator_carrier_key,
          cast(null as integer) as year_built, cast(null as integer) as seat_capacity, {RUN_TS} as ingested_at
        from stg_flights where tail_number is not null group by 1""",
    "days": """
        select cast(d as date) as date_key from (
          select unnest(generate_series(timestamp '1987-01-01',
            cast(max(flight_date) as timestamp) + interval 2 year - interval 1 day, interval 1 day)) as d
          from stg_flights)""",
    "log": """
        select ts as detected_at, 'bronze' as source_name, 'bts_raw' as table_name,
          case event_type when 'view' then 'added' when 'click' then 'removed' else 'run_marker' end as kind,
          'column_' || cast(user_id as varchar) as column_name,
          case when value > 10 then ts + interval 1 day end as reviewed_at
        from events""",
    "points": """
        select event_type as metric_name, value, case when user_id % 2 = 0 then 'producer' else 'consumer' end as component, ts
        from events""",
    "alerts": """
        select lpad(cast(event_id as varchar), 12, '0') as alert_id, ts as detected_at,
          case event_type when 'view' then 'test' when 'click' then 'model_error' else 'source_freshness' end as alert_class,
          'model.' || cast(user_id as varchar) as model_unique_id, event_type as test_name, 'fail' as status,
          props as alert_description,
          case when user_id % 3 = 0 then '["Critical", "gold"]' when user_id % 3 = 1 then '["silver"]' end as tags
        from events""",
    "versions": """
        select c_custkey as code, c_name as name, c_mktsegment as segment, c_nationkey as nation,
          timestamp '1996-01-01' as valid_from,
          case when c_acctbal < 0 then timestamp '1998-01-01'
               when c_mktsegment = 'BUILDING' then timestamp '1998-01-01' end as valid_to
        from customer
        union all
        select c_custkey, c_name, 'CONSTRUCTION', c_nationkey, timestamp '1998-01-01', null
        from customer where c_mktsegment = 'BUILDING' and c_acctbal >= 0
        union all
        select -1 - s_suppkey, s_name, 'SUPPLIER', s_nationkey, timestamp '1998-01-01', null from supplier""",
}

_ORDER = list(CTES)


def sql(body: str) -> str:
    needed: set[str] = set()
    pending = [body]
    while pending:
        text = pending.pop()
        for name in _ORDER:
            if name not in needed and re.search(rf"\b(?:from|join)\s+{name}\b", text):
                needed.add(name)
                pending.append(CTES[name])
    parts = [f"{name} as ({CTES[name]})" for name in _ORDER if name in needed]
    return (f"with {', '.join(parts)} " if parts else "") + body
