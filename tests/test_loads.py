"""Incremental loads of the silver and gold tables equal one load of everything."""

import datetime as dt

import pytest
from comparing import rows
from pyspark.sql import functions as F

from tarmac import standins
from tarmac.operators.dedupe import latest_aircraft
from tarmac.operators.landings import landing_events
from tarmac.operators.tables import read_table
from tarmac.operators.windows import month_of, since_last_load
from tarmac.plans import gold, serving, silver
from tarmac.plans.flights import mapped_callsigns
from tarmac.registry import frames
from tarmac.schemas import SILVER_FLIGHT_COLUMNS

SF = "/root/testdata/sf0.001"
RUN = frames.RUN_TS


@pytest.fixture(scope="module")
def staged(spark):
    return frames.flights(spark, SF).cache(), frames.airports(spark, SF).cache(), frames.states(spark, SF).cache()


def test_states_then_flights_in_steps(spark, tmp_path, staged):
    flights, airports, states = staged
    tables, path = silver.StateTables.below(str(tmp_path)), str(tmp_path / "flights")
    cuts = [dt.date(2024, 1, 10), dt.date(2024, 1, 20), dt.date(2024, 2, 1)]
    for cut in cuts:
        # Each step brings everything up to its day, old rows included.
        silver.load_states(spark, tables, states.filter(F.col("event_ts") < F.lit(cut)), RUN)
        silver.load_silver_flights(
            spark, path, flights.filter(F.col("flight_date") < F.lit(cut)), airports, tables, RUN)
    names = ["icao24", "event_ts", "on_ground", "velocity_mps", "callsign"]
    assert rows(read_table(spark, tables.states), *names) == rows(silver.unique_states(states), *names)
    whole = silver.silver_flight_event(flights, airports, states, RUN)
    assert rows(read_table(spark, path), *SILVER_FLIGHT_COLUMNS) == rows(whole)
    assert whole.filter("live_actual_arr_ts is not null").count() > 0


def test_sightings_see_what_copies_replace(spark, tmp_path, staged):
    """A report sent again without its callsign, or with another, has still been seen under the first."""
    _, _, states = staged
    tables = silver.StateTables.below(str(tmp_path))
    day = F.col("event_ts") < F.lit(dt.date(2024, 1, 5))
    first = states.filter(day)
    later = F.col("bronze_loaded_at") + F.expr("interval 1 hour")
    again = first.withColumn("bronze_loaded_at", later).withColumn(
        "callsign", F.when(F.crc32(F.col("icao24").cast("binary")) % 2 == 0, "UAL9"))
    for part in (first, first.unionByName(again)):
        silver.load_states(spark, tables, part, RUN)
    plan = latest_aircraft(mapped_callsigns(first.unionByName(again), None))
    assert rows(spark.read.parquet(tables.sightings).drop("event_ts")) == rows(plan)


def test_loads_and_serving_read_only_their_months(spark, tmp_path):
    path, target = str(tmp_path / "fact"), str(tmp_path / "daily")
    days = spark.sql("select explode(sequence(date'2023-11-01', date'2024-03-31')) as flight_date_key").withColumns({
        "flight_month": F.year("flight_date_key") * 100 + F.month("flight_date_key"), "carrier_key": F.lit("AA"),
        "origin_airport_key": F.lit("A"), "dest_airport_key": F.lit("B"), "arr_delay_min": F.lit(1),
        "cancelled_flag": F.lit(False)})
    days.write.partitionBy("flight_month").parquet(path)
    fact = spark.read.parquet(path)

    def months(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return [line for line in plan.split(chr(10)) if "PartitionFilters" in line and "flight_month" in line.split("PartitionFilters")[1]]

    assert months(serving.top_delay_routes(fact, dt.date(2024, 1, 5), dt.date(2024, 2, 3)))
    gold.load_daily(spark, target, fact, RUN)
    late = since_last_load(
        spark, fact, target, "flight_date_key", "flight_month", 35, target_column="flight_date",
        folder=("flight_month", month_of), folder_end=month_of)
    assert months(late) and {f.split("flight_month=")[1][:6] for f in late.inputFiles()} >= {"202402", "202403"}
    backfill = since_last_load(
        spark, fact, target, "flight_date_key", "flight_month", 35, (dt.date(2023, 12, 1), dt.date(2023, 12, 9)),
        target_column="flight_date", folder=("flight_month", month_of), folder_end=month_of)
    assert months(backfill) and backfill.count() == 9
    daily = spark.read.parquet(target)
    assert months(serving.kpi_summary(daily, dt.date(2024, 1, 5), dt.date(2024, 1, 6)))
    assert daily.count() == days.count()


def test_landings_from_a_day_see_reports_before_it(spark, tmp_path, staged):
    _, _, states = staged
    tables = silver.StateTables.below(str(tmp_path))
    silver.load_states(spark, tables, states, RUN)
    everything = landing_events(silver.unique_states(states), passed_on=())
    start = dt.date(2024, 1, 15)
    wanted = everything.filter(F.col("live_landing_ts") >= F.lit(start).cast("timestamp"))
    assert rows(silver.landings_from(spark, tables, start)) == rows(wanted)
    assert rows(silver.landings_from(spark, tables, None)) == rows(everything)


def test_window_prunes_folders(spark, tmp_path, staged):
    flights, *_ = staged
    bronze, target = str(tmp_path / "bronze"), str(tmp_path / "target")
    months = flights.withColumn("flight_date_partition", F.trunc("flight_date", "month"))
    old = months.withColumn("flight_date", F.lit(dt.date(2023, 5, 5))).withColumn(
        "flight_date_partition", F.lit(dt.date(2023, 5, 1)))
    months.unionByName(old).write.partitionBy("flight_date_partition").parquet(bronze)
    flights.withColumn("flight_month", F.lit(202401)).write.partitionBy("flight_month").parquet(target)
    recent = since_last_load(
        spark, spark.read.parquet(bronze), target, "flight_date", "flight_month", 35,
        folder=("flight_date_partition", lambda day: day.replace(day=1)))
    assert recent.count() == flights.count()
    plan = recent._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "flight_date_partition" in filters and ">= 2023-12-01" in filters


def test_gold_loads_and_backfill(spark, tmp_path, staged):
    flights, airports, states = staged
    whole = silver.silver_flight_event(flights, airports, states, RUN).cache()
    dim = gold.dim_airport(gold.airport_snapshot(airports, dt.datetime(2024, 1, 1)), RUN).cache()
    fact, daily = str(tmp_path / "fact"), str(tmp_path / "daily")
    early = whole.filter(F.col("flight_date") <= F.lit(dt.date(2024, 1, 15)))
    for source in (early, whole, whole):
        gold.load_fact(spark, fact, source, dim, RUN)
        gold.load_daily(spark, daily, read_table(spark, fact), RUN)
    expected = gold.fct_flight_event(whole, dim, RUN)
    assert rows(read_table(spark, fact), *expected.columns) == rows(expected)
    aggregate = gold.agg_carrier_otp_daily(expected, RUN)
    assert rows(read_table(spark, daily), *aggregate.columns) == rows(aggregate)

    bounds = (dt.date(2024, 1, 3), dt.date(2024, 1, 4))
    later = RUN + dt.timedelta(days=1)
    gold.load_fact(spark, fact, whole, dim, later, backfill=bounds)
    redone = read_table(spark, fact).filter(F.col("ingested_at") == F.lit(later))
    assert rows(redone.select("flight_date_key").distinct()) == [(bounds[0],), (bounds[1],)]
    assert read_table(spark, fact).count() == expected.count()


def test_standin_states_are_whole(spark):
    assert standins.states_raw(spark, SF).count() == standins.table(spark, SF, "events").count()
