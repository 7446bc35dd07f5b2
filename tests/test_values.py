import datetime as dt

import pytest
from pyspark.sql import functions as F

from tarmac.functions import keys, values
from tarmac.functions.columns import column_or_null, first_present


def one(spark, value, dtype, *exprs):
    df = spark.createDataFrame([(value,)], f"c {dtype}")
    found = df.select(*exprs).first()
    return found[0] if len(exprs) == 1 else tuple(found)


@pytest.mark.parametrize("text,expected", [
    ("12.00", 12), ("-4.00", -4), ("12.5", 13), ("-12.5", -13), ("", None), (" 7 ", 7), ("abc", None),
    (None, None), ("99999999999", None),
])
def test_safe_int(spark, text, expected):
    assert one(spark, text, "string", values.safe_int(F.col("c"))) == expected


@pytest.mark.parametrize("text,expected", [
    ("true", True), ("T", True), ("yes", True), ("1", True), ("ON", True), ("off", False), ("no", False),
    ("2", None), ("", None), (None, None),
])
def test_safe_boolean(spark, text, expected):
    assert one(spark, text, "string", values.safe_boolean(F.col("c"))) is expected


@pytest.mark.parametrize("text,expected", [
    ("2024-02-29", dt.date(2024, 2, 29)), ("2024-02-30", None), ("", None), (None, None), ("2024", None),
    (" 2024-01-05 ", dt.date(2024, 1, 5)), ("2024-1-5", dt.date(2024, 1, 5)), ("2024-01", None),
    ("2024-01-05 12:30:00", dt.date(2024, 1, 5)), ("2024-01-05T01:00Z", dt.date(2024, 1, 5)), ("2024-01-05x", None),
])
def test_safe_date(spark, text, expected):
    assert one(spark, text, "string", values.safe_date(F.col("c"))) == expected


@pytest.mark.parametrize("hhmm,expected", [(0, 0), (5, 5), (59, 59), (2359, 1439), (2400, 1440), (None, None)])
def test_hhmm(spark, hhmm, expected):
    assert one(spark, hhmm, "int", values.hhmm_to_minutes(F.col("c"))) == expected


def test_midnight_is_next_day(spark):
    at = values.at_clock(F.lit(dt.date(2024, 1, 31)), F.col("c"))
    assert one(spark, 2400, "int", at) == dt.datetime(2024, 2, 1)


@pytest.mark.parametrize("wall,zone,expected", [
    ("2024-01-10 08:00:00", "America/Denver", "2024-01-10 15:00:00"),
    ("2024-03-10 02:30:00", "America/Denver", "2024-03-10 09:30:00"),   # hour that does not exist
    ("2024-11-03 01:30:00", "America/Denver", "2024-11-03 07:30:00"),   # hour that comes twice
    ("2024-01-10 08:00:00", None, "2024-01-10 08:00:00"),
    ("2024-01-10 08:00:00", "Mars/Base", "2024-01-10 08:00:00"),
    ("2024-01-10 08:00:00", "a,b", "2024-01-10 08:00:00"),
])
def test_local_to_utc(spark, wall, zone, expected):
    found = one(spark, zone, "string", values.local_to_utc(
        F.lit(wall).cast("timestamp"), values.valid_zone(F.col("c"))))
    assert found == dt.datetime.fromisoformat(expected)


@pytest.mark.parametrize("start,end,expected", [
    ("00:00:59", "00:01:00", 1), ("00:01:00", "00:01:59", 0), ("00:10:00", "00:00:30", -10),
])
def test_minute_boundaries(spark, start, end, expected):
    day = "2024-01-01 "
    assert one(spark, day + start, "string", values.minute_boundaries(
        F.col("c").cast("timestamp"), F.lit(day + end).cast("timestamp"))) == expected


def test_column_or_null_ignores_case(spark):
    df = spark.createDataFrame([("x",)], "TailNumber string")
    got = df.select(column_or_null(df, "tailnumber").alias("a"), column_or_null(df, "gone").alias("b"))
    assert tuple(got.first()) == ("x", None)
    assert dict(got.dtypes) == {"a": "string", "b": "string"}


def test_first_present_works_inside_expressions(spark):
    df = spark.createDataFrame([(None, "5")], "New string, Old string")
    assert df.select(first_present(df, "missing", "new", "old")).first()[0] == "5"


def test_flight_key_treats_missing_as_blank(spark):
    import hashlib

    df = spark.createDataFrame([(dt.date(2024, 1, 5), "AA", "12", None, None)],
                               "d date, c string, n string, o string, h int")
    got = df.select(keys.flight_key(*[F.col(x) for x in "dcnoh"])).first()[0]
    assert got == hashlib.md5(b"2024-01-05|AA|12||").hexdigest()


def test_change_marker_reacts_to_each_part(spark):
    rows = [("k", "2024-01-01 10:00:00", None, False, None), ("k", None, None, False, None),
            ("k", None, None, True, None), ("k", None, None, True, "B")]
    df = spark.createDataFrame(rows, "k string, d string, a string, c boolean, code string")
    marks = df.select(keys.change_marker(
        F.col("k"), F.col("d").cast("timestamp"), F.col("a").cast("timestamp"), F.col("c"), F.col("code")))
    assert len({r[0] for r in marks.collect()}) == 4
