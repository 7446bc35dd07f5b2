"""Bronze-shaped inputs made from the test tables, which have no flights.

Orders stand in for flights, nations for airports, suppliers for airlines and events
for aircraft reports. All are projections of whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CARRIER = (
    "case cast({n} % 5 as int) when 0 then 'AA' when 1 then 'DL' when 2 then 'UA' "
    "when 3 then 'WN' else 'B6' end"
)
_AIRPORT = "'N' || chr(cast(65 + floor(({n}) / 5) as int)) || chr(cast(65 + ({n}) % 5 as int))"


def carrier_of(n: str) -> str:
    return _CARRIER.format(n=n)


def airport_of(n: str) -> str:
    return _AIRPORT.format(n=n)


def flights_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly on-time rows, all text, with headers as the source spells them.

    The load time differs by row, so the latest copy of a flight is well defined. The
    count of diverted landings stands under its old name in odd rows, its new in even.
    """
    o = table(spark, sf_dir, "orders")
    flown = "case when o_orderkey % 50 = 0 then null else {} end"

    def clock(hour: str, minute: str) -> str:
        return f"cast(((o_orderkey * 7 {hour}) % 24) * 100 + (o_orderkey * {minute}) % 60 as string)"

    def delay(actual: int, planned: int) -> str:
        return f"cast((o_orderkey * {actual}) % 60 - (o_orderkey * {planned}) % 60 as string) || '.00'"

    day = "date_add(date '2024-01-01', cast(o_orderkey % 30 as int))"
    return o.selectExpr(
        f"cast({day} as string) as FlightDate",
        f"{carrier_of('o_custkey')} as Reporting_Airline",
        "cast(o_custkey % 150 as string) as Flight_Number_Reporting_Airline",
        "case when o_orderkey % 97 = 0 then '' else 'N' || cast(o_custkey as string) end as Tail_Number",
        f"{airport_of('(o_custkey % 25)')} as Origin",
        f"{airport_of('((o_orderkey * 7) % 10)')} as Dest",
        f"{clock('', '13')} as CRSDepTime",
        f"{flown.format(clock('', '17'))} as DepTime",
        f"{flown.format(delay(17, 13))} as DepDelay",
        f"{clock('+ 2', '11')} as CRSArrTime",
        f"{flown.format(clock('+ 2', '19'))} as ArrTime",
        f"{flown.format(delay(19, 11))} as ArrDelay",
        "case when o_orderkey % 50 = 0 then '1.00' else '0.00' end as Cancelled",
        "case when o_orderkey % 50 = 0 then 'B' else '' end as CancellationCode",
        "'0.00' as Diverted",
        "cast(150 + o_custkey % 2500 as string) || '.00' as Distance",
        "case when o_orderkey % 2 = 0 then cast(o_orderkey % 3 as string) || '.00' end as Div_Airport_Landings",
        "case when o_orderkey % 2 = 1 then cast(o_orderkey % 3 as string) || '.00' end as DivAirportLandings",
        "date '2024-01-01' as ds",
        "timestamp_seconds(1706745600 + o_orderkey) as bronze_loaded_at",
    )


def states_of(events: DataFrame) -> DataFrame:
    """Aircraft reports, all text, from an events frame (batch or stream)."""
    epoch = "unix_seconds(cast(ts as timestamp))"
    return events.selectExpr(
        "lower(lpad(hex(user_id), 6, '0')) as icao24",
        f"{carrier_of('user_id')} || (case when user_id % 2 = 0 then '' else 'X' end) "
        "|| cast(user_id as string) as callsign",
        "case when user_id % 3 = 0 then 'United States' else 'Canada' end as origin_country",
        f"cast({epoch} as string) as event_ts",
        f"cast({epoch} as string) as time_position",
        f"cast({epoch} + 1 as string) as last_contact",
        "cast(-(7000 + (event_id * 11) % 5000) / 100.0D as string) as longitude",
        "cast((2500 + (event_id * 7) % 2400) / 100.0D as string) as latitude",
        "cast(event_id % 12000 as string) as baro_altitude",
        "cast(event_type in ('purchase', 'error') as string) as on_ground",
        "cast(value as string) as velocity",
        "cast((event_id * 7) % 360 as string) as true_track",
        "cast(event_id % 21 - 10 as string) as vertical_rate",
        "cast(event_id % 12000 + 50 as string) as geo_altitude",
        "case when event_id % 10 = 3 then '' else lpad(cast(event_id % 7777 as string), 4, '0') end as squawk",
        "cast(event_id % 4 as string) as position_source",
        f"cast(timestamp_seconds({epoch}) as date) as ds",
        f"cast(hour(timestamp_seconds({epoch})) as string) as hr",
        "timestamp_seconds(1706745600 + event_id) as bronze_loaded_at",
        "event_id",
    )


def states_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return states_of(table(spark, sf_dir, "events"))


def replayed(states: DataFrame) -> DataFrame:
    """Every tenth report is sent again a day later, with another track."""
    again = states.withColumn(
        "copy", F.explode(F.when(F.col("event_id") % 10 == 0, F.array(F.lit(0), F.lit(1)))
                          .otherwise(F.array(F.lit(0)))))
    return again.withColumn(
        "bronze_loaded_at", F.timestamp_add("DAY", F.col("copy"), F.col("bronze_loaded_at"))
    ).withColumn(
        "true_track", F.when(F.col("copy") == 1, F.lit("359")).otherwise(F.col("true_track"))
    ).drop("copy")


def airports_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    code = airport_of("n_nationkey")
    return n.selectExpr(
        "cast(n_nationkey as string) as openflights_id", "n_name as name",
        "'City ' || cast(n_nationkey as string) as city", "cast(n_regionkey as string) as country",
        f"{code} as iata", f"'K' || {code} as icao",
        "cast(25 + n_nationkey as string) || '.5' as latitude",
        "cast(-70 - n_nationkey as string) || '.25' as longitude",
        "cast(n_nationkey * 100 as string) as altitude",
        "cast(-5 - n_nationkey % 4 as string) as timezone_offset", "'A' as dst",
        "case n_nationkey % 4 when 0 then 'America/New_York' when 1 then 'America/Chicago' "
        "when 2 then 'America/Denver' else 'America/Los_Angeles' end as tz_database",
        "'airport' as type", r"'\\N' as source",
    )


def airlines_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many suppliers share a carrier code; every sixth has none, every seventh a long one."""
    s = table(spark, sf_dir, "supplier")
    return s.selectExpr(
        "cast(s_suppkey as string) as openflights_id", "s_name as name", r"'\\N' as alias",
        r"case when s_suppkey % 6 = 5 then '\\N' when s_suppkey % 7 = 6 then 'XYZ' "
        f"else ' ' || lower({carrier_of('s_suppkey')}) end as iata",
        r"case when s_suppkey % 3 = 0 then '\\N' else 'S' || lpad(cast(s_suppkey % 100 as string), 2, '0') "
        "end as icao",
        "'CALL' || cast(s_suppkey as string) as callsign",
        "case when s_nationkey = 7 then '' else 'Nation ' || cast(s_nationkey as string) end as country",
        "case s_suppkey % 4 when 0 then 'y' when 1 then 'N' when 2 then 'Y' else '?' end as active",
    )


def state_events(states: DataFrame, *keep: str) -> DataFrame:
    """Reports with the types of the stream schema."""
    return states.selectExpr(
        *keep,
        "icao24", "callsign", "origin_country", "cast(event_ts as bigint) as event_ts",
        "cast(event_ts as bigint) + 5 as polled_at", "cast(time_position as bigint) as time_position",
        "cast(last_contact as bigint) as last_contact", "cast(longitude as double) as longitude",
        "cast(latitude as double) as latitude", "cast(baro_altitude as double) as baro_altitude",
        "cast(on_ground as boolean) as on_ground", "cast(velocity as double) as velocity",
        "cast(true_track as double) as true_track", "cast(vertical_rate as double) as vertical_rate",
        "cast(geo_altitude as double) as geo_altitude", "squawk", "false as spi",
        "cast(position_source as bigint) as position_source",
    )
