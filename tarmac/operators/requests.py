"""Request rows of the delay service: validation and feature hydration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.values import month_number

# Code patterns and accepted ranges of a request.
CARRIER_PATTERN = r"^[A-Z0-9]{2,3}\z"
AIRPORT_PATTERN = r"^[A-Z]{3}\z"
RANGES = {
    "distance_miles": (1, 15000),
    "scheduled_dep_hour": (0, 23),
    "day_of_week": (0, 6),
    "month": (1, 12),
    "dep_delay_min": (-60, 720),
}

CATEGORICAL_FEATURES = ["carrier_code", "origin_iata", "dest_iata"]
NUMERIC_FEATURES = ["distance_miles", "scheduled_dep_hour", "day_of_week", "month", "dep_delay_min"]
FEATURE_ORDER = CATEGORICAL_FEATURES + NUMERIC_FEATURES
TARGET = "arr_delay_min"


def _violates(ok: Column) -> Column:
    return ~F.coalesce(ok, F.lit(False))


def validate_requests(requests: DataFrame) -> DataFrame:
    """Codes in upper case, a list of the fields in violation, and ``valid``."""
    codes = {c: F.upper(c) for c in CATEGORICAL_FEATURES}
    rows = requests.withColumns(codes)
    if "dep_delay_min" in requests.columns:
        rows = rows.withColumn("dep_delay_min", F.coalesce("dep_delay_min", F.lit(0)))
    else:
        rows = rows.withColumn("dep_delay_min", F.lit(0))
    rules = {
        "carrier_code": F.col("carrier_code").rlike(CARRIER_PATTERN),
        "origin_iata": F.col("origin_iata").rlike(AIRPORT_PATTERN),
        "dest_iata": F.col("dest_iata").rlike(AIRPORT_PATTERN),
        **{c: F.col(c).between(low, high) for c, (low, high) in RANGES.items()},
    }
    reasons = F.array_compact(F.array(*[F.when(_violates(ok), F.lit(c)) for c, ok in rules.items()]))
    return rows.withColumn("reasons", reasons).withColumn("valid", F.size("reasons") == 0)


def feature_matrix(silver: DataFrame, *keep: str) -> DataFrame:
    """The features in their fixed order; a missing departure delay counts as none."""
    departure = F.col("scheduled_dep_ts")
    derived = {
        "scheduled_dep_hour": F.hour(departure),
        "day_of_week": F.weekday(departure),
        "month": F.month(departure),
        "dep_delay_min": F.coalesce("dep_delay_min", F.lit(0)),
    }
    return silver.select(
        *keep, *[derived.get(c, F.col(c)).alias(c) for c in FEATURE_ORDER])


def hydrate(requests: DataFrame, silver: DataFrame) -> DataFrame:
    """Requests (carrier_code, flight_number, scheduled_dep_ts) with silver features.

    One silver row per carrier, number and date is enough; which one is settled by
    departure time. ``found`` is false where silver has none.
    """
    key = ["carrier_code", "flight_number", "flight_date"]
    asked = requests.withColumns({
        "carrier_code": F.upper("carrier_code"),
        "flight_number": F.col("flight_number").cast("string"),
        "flight_date": F.to_date("scheduled_dep_ts"),
    })
    if "flight_month" in silver.columns:  # the months asked for prune the folders at run time
        months = asked.select(month_number(F.col("flight_date")).alias("flight_month")).distinct()
        silver = silver.join(months, "flight_month", "left_semi")
    features = feature_matrix(silver, "flight_number", "flight_date", "scheduled_dep_ts",
                              "flight_event_natural_key")
    values = [c for c in FEATURE_ORDER if c not in key]
    # Only rows somebody asked for are grouped; a short request list is broadcast here.
    wanted = features.join(asked.select(*key).distinct(), key, "left_semi")
    chosen = wanted.groupBy(*key).agg(
        F.min_by(F.struct(*values), F.struct("scheduled_dep_ts", "flight_event_natural_key"))
        .alias("features")
    )
    return asked.join(chosen, key, "left").select(
        *asked.columns, *[F.col(f"features.{c}").alias(c) for c in values],
        F.col("features").isNotNull().alias("found"))
