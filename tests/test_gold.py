import datetime as dt

from comparing import rows
from pyspark.sql import functions as F

from tarmac.plans import gold, serving

RUN = dt.datetime(2024, 2, 1)
DAY = dt.date(2024, 1, 10)


def fact(spark, data):
    return spark.createDataFrame(
        data, "flight_date_key date, carrier_key string, origin_airport_key string, dest_airport_key string, "
        "arr_delay_min int, cancelled_flag boolean")


def test_daily_counts_and_shares(spark):
    data = [(DAY, "AA", "A", "B", d, False) for d in (14, 15, None, -3)] + [
        (DAY, "AA", "A", "B", None, True), (DAY, "ZZ", "A", "B", None, True),
        (DAY, "DL", "A", "B", 3, True), (DAY, "DL", "A", "B", 30, False)]
    got = {r.carrier_key: r for r in gold.agg_carrier_otp_daily(fact(spark, data), RUN).collect()}
    aa = got["AA"]
    assert (aa.flights_scheduled, aa.flights_completed, aa.flights_cancelled) == (5, 4, 1)
    assert (aa.on_time_pct, aa.total_delay_min) == (50.0, 26)
    assert abs(aa.avg_arr_delay_min - 26 / 3) < 1e-12
    assert got["ZZ"].on_time_pct is None and got["ZZ"].total_delay_min == 0
    assert got["DL"].on_time_pct == 100.0  # the numerator also counts a cancelled row


def test_dim_carrier_prefers_icao_then_lowest_id(spark):
    airlines = spark.createDataFrame(
        [(1, "one", "AA", None, "US", None), (9, "nine", "AA", "AAL", "US", False), (5, "five", "AA", "AAX", "US", None),
         (2, "two", None, "X", "US", True)],
        "openflights_id int, carrier_name string, carrier_key string, icao_code string, country string, is_active boolean")
    assert rows(gold.dim_carrier(airlines, RUN), "carrier_key", "carrier_name", "is_active") == [("AA", "five", True)]


def test_dim_date(spark):
    bounds = spark.createDataFrame([(dt.date(2023, 12, 31), dt.date(2024, 10, 2))], "start date, end date")
    days = {r.date_key: r for r in gold.dim_date(gold.date_spine(bounds), gold.holiday_frame(spark)).collect()}
    assert min(days) == dt.date(2023, 12, 31) and max(days) == dt.date(2024, 10, 1)
    sunday = days[dt.date(2023, 12, 31)]
    assert (sunday.day_of_week, sunday.is_weekend, sunday.day_name, sunday.iso_week) == (7, True, "Sun", 52)
    assert (sunday.fiscal_year, sunday.fiscal_quarter) == (2024, 1)
    assert days[dt.date(2024, 7, 4)].is_us_federal_holiday and not days[dt.date(2024, 7, 5)].is_us_federal_holiday
    assert (days[dt.date(2024, 9, 30)].fiscal_year, days[dt.date(2024, 9, 30)].fiscal_quarter) == (2024, 4)
    assert (days[dt.date(2024, 10, 1)].fiscal_year, days[dt.date(2024, 10, 1)].fiscal_quarter) == (2025, 1)


def test_fact_uses_current_airport_versions(spark):
    silver = spark.createDataFrame(
        [("k1", DAY, "AA", "1", "N1", "DEN", "JFK", False, None)],
        "flight_event_natural_key string, flight_date date, carrier_code string, flight_number string, tail_number string, "
        "origin_iata string, dest_iata string, cancelled_flag boolean, cancellation_code string")
    stamps = ["scheduled_dep_ts", "actual_dep_ts", "scheduled_arr_ts", "actual_arr_ts", "live_actual_arr_ts"]
    silver = silver.select("*", *[F.lit(None).cast("timestamp").alias(c) for c in stamps],
                           *[F.lit(None).cast("int").alias(c) for c in ("dep_delay_min", "arr_delay_min", "distance_miles")],
                           F.lit(False).alias("diverted_flag"), F.lit("bts_only").alias("reconciliation_status"),
                           F.lit("bts").alias("source_system"))
    airports = spark.createDataFrame(
        [("DEN", "old", False), ("DEN", "new", True), ("SFO", "x", True)],
        "airport_key string, airport_sk string, is_current boolean")
    got = gold.fct_flight_event(silver, airports, RUN).collect()
    assert [(r.origin_airport_sk, r.dest_airport_sk, r.ingested_at) for r in got] == [("new", None, RUN)]
    assert len(got[0].record_hash) == 64


def test_top_routes_having_and_order(spark):
    data = [(DAY, "AA", "A", "B", 20, False)] * 30 + [(DAY, "AA", "A", "C", 90, False)] * 29 + [
        (DAY, "AA", "D", "E", None, False)] * 30 + [(DAY, "AA", "F", "G", 40, False)] * 31 + [
        (DAY, "AA", "F", "G", 900, True)] * 5
    got = serving.top_delay_routes(fact(spark, data), DAY, DAY).collect()
    assert [(r.origin_iata, r.flights, r.avg_arr_delay_min, r.on_time_pct) for r in got] == [
        ("F", 31, 40.0, 0.0), ("A", 30, 20.0, 0.0), ("D", 30, None, 0.0)]
    assert serving.top_delay_routes(fact(spark, data), DAY, DAY, limit=1).count() == 1


def daily(spark, data):
    return spark.createDataFrame(
        data, "flight_date date, carrier_key string, flights_scheduled bigint, flights_completed bigint, "
        "flights_cancelled bigint, on_time_pct double, avg_arr_delay_min double, total_delay_min bigint")


def test_serving_over_daily(spark):
    d = daily(spark, [(DAY, "WN", 100, 95, 5, 88.0, 6.5, 800), (DAY, "DL", 10, 10, 0, 50.0, 1.0, 10),
                      (dt.date(2023, 1, 1), "B6", 1, 1, 0, 1.0, 1.0, 1)])
    carriers = spark.createDataFrame([("WN", "Southwest"), ("DL", "Delta"), ("B6", "Blue")],
                                     "carrier_key string, carrier_name string")
    assert [tuple(r) for r in serving.carrier_options(carriers, d, DAY).collect()] == [
        ("DL", "Delta"), ("WN", "Southwest")]
    everything = serving.otp_overview(d, carriers, DAY, DAY)
    assert [r.carrier_key for r in everything.collect()] == ["DL", "WN"] and len(everything.columns) == 9
    assert [r.carrier_key for r in serving.otp_overview(d, carriers, DAY, DAY, ["WN"]).collect()] == ["WN"]
    assert [tuple(r) for r in serving.otp_pivot(everything, ["WN", "AA"]).collect()] == [(DAY, 88.0, None)]
    assert tuple(serving.kpi_summary(d, DAY, DAY).first()) == (110.0, 105.0, 5.0, 69.0, 810.0)
    assert tuple(serving.kpi_summary(d, RUN.date(), RUN.date()).first()) == (0.0,) * 5
