"""Data-quality checks. Each gives the rows that violate it; a runner counts them.

The runner evaluates all row, uniqueness and reference checks of a table in one scan, and those
of all tables in one shuffle. Other checks run as one plan each.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac import files
from tarmac.functions.values import minute_boundaries
from tarmac.operators.drift import unreviewed_drift

# Accepted codes.
CANCELLATION_CODES = ["A", "B", "C", "D"]
RECONCILIATION_STATUSES = ["live_only", "bts_only", "matched", "mismatch"]


# --- row conditions --------------------------------------------------------------------

def is_null(column: str) -> Column:
    return F.col(column).isNull()


def not_in(column: str, values: Sequence[str]) -> Column:
    """True for values outside the list; NULL is not a violation."""
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def length_differs(column: str, length: int) -> Column:
    return F.col(column).isNotNull() & (F.length(column) != length)


def untrue(expression: Column) -> Column:
    """An expression that is false or unknown."""
    return ~F.coalesce(expression, F.lit(False))


def violated(expression: Column, unknown: bool = False) -> Column:
    """A rule that is false; one that is unknown is a violation only if asked for."""
    return F.coalesce(~expression, F.lit(unknown))


def delay_matches_times() -> Column:
    """Arrival delay equals the minutes between scheduled and actual arrival."""
    return (
        F.col("arr_delay_min").isNull() | F.col("cancelled_flag")
        | (F.col("arr_delay_min") == minute_boundaries(F.col("scheduled_arr_ts"), F.col("actual_arr_ts")))
    )


def cancelled_never_departed() -> Column:
    return ~F.col("cancelled_flag") | F.col("actual_dep_ts").isNull()


def arrives_after(as_of: dt.datetime) -> Column:
    return F.col("actual_arr_ts") > F.lit(as_of).cast("timestamp")


# --- violating rows --------------------------------------------------------------------

def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; NULL keys are left to the NULL check."""
    present = F.lit(True)
    for k in keys:
        present &= F.col(k).isNotNull()
    return (
        df.filter(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Values of ``column`` that no parent row has, with the rows they stand in.

    Children are counted by value before the join, so a frequent value costs one row.
    """
    values = (
        child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return values.join(parent.select(F.col(key).alias("value")), "value", "left_anti")


def quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """Exact quantile of a whole-number column: values are counted first, then ranked."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.percentile(column, F.lit(q), F.col("n")).alias("quantile"))


def quantile_between(df: DataFrame, column: str, q: float, low: float, high: float) -> DataFrame:
    return quantile(df, column, q).withColumn("passed", F.col("quantile").between(low, high))


def recency(df: DataFrame, column: str, as_of: dt.datetime, hours: int) -> DataFrame:
    latest = F.max(F.col(column).cast("timestamp"))
    stale = untrue(
        F.col("latest") >= F.timestamp_add("HOUR", F.lit(-hours), F.lit(as_of).cast("timestamp"))
    )
    return df.agg(latest.alias("latest")).withColumn("stale", stale)


def counts_differ(detail: DataFrame, daily: DataFrame) -> DataFrame:
    """Carrier-days whose aggregate does not match a recount of the fact."""
    recount = detail.groupBy(F.col("flight_date_key").alias("flight_date"), "carrier_key").agg(
        F.count(F.lit(1)).alias("detail_count")
    )
    both = recount.join(
        daily.select("flight_date", "carrier_key", "flights_scheduled"),
        ["flight_date", "carrier_key"], "full",
    )
    return both.filter(~F.col("detail_count").eqNullSafe(F.col("flights_scheduled")))


# --- freshness -------------------------------------------------------------------------

@dataclass(frozen=True)
class Freshness:
    """Lag limits of a source in seconds."""

    warn: int
    error: int


# Lag limits of the sources, and target lags of the tables in minutes.
SOURCE_FRESHNESS = {
    "default": Freshness(24 * 3600, 48 * 3600),
    "bts_raw": Freshness(35 * 86400, 45 * 86400),
    "opensky_raw": Freshness(15 * 60, 60 * 60),
}
TABLE_SLA_MINUTES = {
    "silver_aircraft_state": 30,
    "silver_flight_event": 1440,
    "fct_flight_event": 60,
    "agg_carrier_otp_daily": 120,
    "dim_carrier": 360,
    "dim_airport": 360,
    "dim_aircraft": 360,
    "dim_date": 360,
}


def _latest_by_table(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    found = None
    for name, (df, column) in tables.items():
        one = df.agg(F.max(F.col(column).cast("timestamp")).alias("latest")).select(
            F.lit(name).alias("table_name"), "latest"
        )
        found = one if found is None else found.unionByName(one)
    return found


def _lag(as_of: dt.datetime) -> Column:
    return F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds("latest")


def source_freshness(
    tables: Mapping[str, tuple[DataFrame, str]], as_of: dt.datetime,
    limits: Mapping[str, Freshness] = SOURCE_FRESHNESS,
) -> DataFrame:
    """Lag of each source's load time, judged by its own or the default limits."""
    warn, error = F.lit(limits["default"].warn), F.lit(limits["default"].error)
    for name, limit in limits.items():
        this = F.col("table_name") == name
        warn, error = F.when(this, limit.warn).otherwise(warn), F.when(this, limit.error).otherwise(error)
    lag = F.col("lag_seconds")
    return _latest_by_table(tables).withColumn("lag_seconds", _lag(as_of)).withColumn(
        "status",
        F.when(lag.isNull() | (lag > error), "error").when(lag > warn, "warn").otherwise("pass"),
    )


def sla_status(
    tables: Mapping[str, tuple[DataFrame, str]], as_of: dt.datetime,
    sla_minutes: Mapping[str, int] = TABLE_SLA_MINUTES,
) -> DataFrame:
    limit = F.lit(None).cast("int")
    for name in tables:
        limit = F.when(F.col("table_name") == name, F.lit(sla_minutes[name])).otherwise(limit)
    return (
        _latest_by_table(tables)
        .withColumn("lag_minutes", F.floor(_lag(as_of) / 60))
        .withColumn("sla_minutes", limit)
        .withColumn("breached", untrue(F.col("lag_minutes") <= F.col("sla_minutes")))
    )


# --- volume ----------------------------------------------------------------------------

def trailing_volume(
    df: DataFrame, day: str, months: int = 6, floor: float = 0.8, value: Column | None = None
) -> DataFrame:
    """Monthly volume (or mean of ``value``) against the average of the months before.

    The window runs over one row per month, whatever the size of the table.
    """
    measure = F.count(F.lit(1)).cast("double") if value is None else F.avg(value)
    monthly = df.filter(F.col(day).isNotNull()).groupBy(
        F.trunc(day, "month").alias("month")
    ).agg(measure.alias("volume"))
    # One task orders the months: some hundreds of rows, however long the table.
    before = Window.partitionBy(F.lit(0)).orderBy("month").rowsBetween(-months, -1)
    return monthly.withColumn("trailing_avg", F.avg("volume").over(before)).withColumn(
        "low", F.coalesce(F.col("volume") < F.col("trailing_avg") * floor, F.lit(False))
    )


# --- runner ----------------------------------------------------------------------------

@dataclass(frozen=True)
class RowCheck:
    """A condition on single rows of one table, true where a row is wrong."""

    name: str
    table: str
    wrong: Column
    severity: str = "error"
    tags: frozenset[str] = field(default_factory=frozenset)


@dataclass(frozen=True)
class TableCheck:
    """A check that gives its violating rows from all tables."""

    name: str
    violations: Callable[[Mapping[str, DataFrame]], DataFrame]
    severity: str = "error"
    tags: frozenset[str] = field(default_factory=frozenset)


@dataclass(frozen=True)
class UniqueCheck:
    """No two rows of a table have the same keys; rows with a NULL key are left to the NULL check."""

    name: str
    table: str
    keys: tuple[str, ...]
    severity: str = "error"
    tags: frozenset[str] = field(default_factory=frozenset)

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return duplicates(tables[self.table], self.keys)


@dataclass(frozen=True)
class ReferenceCheck:
    """Every value of a column is a key of another table; both are of one type."""

    name: str
    table: str
    column: str
    parent: str
    key: str
    severity: str = "error"
    tags: frozenset[str] = field(default_factory=frozenset)

    def violations(self, tables: Mapping[str, DataFrame]) -> DataFrame:
        return orphans(tables[self.table], self.column, tables[self.parent], self.key)


Check = RowCheck | UniqueCheck | ReferenceCheck | TableCheck
CRITICAL = frozenset({"critical"})


def _required(table: str, *columns: str) -> list[Check]:
    return [RowCheck(f"{table}.{c}.not_null", table, is_null(c), tags=CRITICAL) for c in columns]


def _unique(table: str, *keys: str) -> Check:
    return UniqueCheck(f"{table}.{'_'.join(keys)}.unique", table, keys, tags=CRITICAL)


def _refers(table: str, column: str, parent: str, key: str) -> Check:
    return ReferenceCheck(f"{table}.{column}.relationships", table, column, parent, key, tags=CRITICAL)


def _accepted(table: str, column: str, values: Sequence[str], severity: str = "error") -> Check:
    return RowCheck(f"{table}.{column}.accepted_values", table, not_in(column, values), severity,
                    CRITICAL if severity == "error" else frozenset())


def staging_checks() -> list[Check]:
    """The checks declared on the staged tables."""
    return [
        *_required("stg_flights", "flight_event_natural_key", "flight_date", "carrier_code", "origin_iata", "dest_iata"),
        RowCheck("stg_flights.carrier_code.length", "stg_flights", length_differs("carrier_code", 2), "warn"),
        _accepted("stg_flights", "cancellation_code", CANCELLATION_CODES, "warn"),
        *_required("stg_states", "icao24", "event_ts"),
        *_required("stg_airports", "iata"), _unique("stg_airports", "iata"),
        *_required("stg_airlines", "carrier_key"), _unique("stg_airlines", "carrier_key"),
    ]


def silver_checks() -> list[Check]:
    """The checks declared on the silver tables; the status is that of the reconciled flights."""
    return [
        *_required("silver_flight_event", "flight_event_natural_key", "flight_date", "carrier_code"),
        _unique("silver_flight_event", "flight_event_natural_key"),
        _accepted("silver_flight_event", "reconciliation_status", RECONCILIATION_STATUSES),
        *_required("silver_aircraft_state", "icao24", "event_ts"),
    ]


def drift_checks(as_of: dt.datetime) -> list[Check]:
    """No change of a source's columns waits for review beyond its time."""
    return [TableCheck("schema_drift.unreviewed", lambda t: unreviewed_drift(t["schema_drift"], as_of), tags=CRITICAL)]


def all_checks(as_of: dt.datetime) -> list[Check]:
    return [*staging_checks(), *silver_checks(), *gold_checks(as_of), *drift_checks(as_of)]


def gold_checks(as_of: dt.datetime) -> list[Check]:
    """The checks declared on the gold tables."""
    fact, daily = "fct_flight_event", "agg_carrier_otp_daily"
    return [
        *_required(fact, "flight_event_sk", "flight_date_key", "carrier_key", "origin_airport_key",
                  "dest_airport_key"),
        *_required("dim_carrier", "carrier_key"),
        *_required("dim_airport", "airport_sk", "airport_key"),
        *_required("dim_aircraft", "aircraft_key"),
        *_required("dim_date", "date_key"),
        *_required(daily, "flight_date", "carrier_key"),
        _unique(fact, "flight_event_sk"),
        _unique("dim_carrier", "carrier_key"),
        _unique("dim_airport", "airport_sk"),
        _unique("dim_aircraft", "aircraft_key"),
        _unique("dim_date", "date_key"),
        _unique(daily, "flight_date", "carrier_key"),
        _refers(fact, "flight_date_key", "dim_date", "date_key"),
        _refers(fact, "carrier_key", "dim_carrier", "carrier_key"),
        _refers(fact, "origin_airport_key", "dim_airport", "airport_key"),
        _refers(fact, "dest_airport_key", "dim_airport", "airport_key"),
        _refers(daily, "carrier_key", "dim_carrier", "carrier_key"),
        _accepted(fact, "cancellation_code", CANCELLATION_CODES, "warn"),
        _accepted(fact, "reconciliation_status", RECONCILIATION_STATUSES),
        RowCheck(f"{fact}.arr_delay_matches_timestamps", fact, violated(delay_matches_times()), tags=CRITICAL),
        RowCheck(f"{fact}.cancelled_means_no_actual_dep", fact, violated(cancelled_never_departed()),
                 tags=CRITICAL),
        RowCheck(f"{fact}.no_future_actual_arrivals", fact, arrives_after(as_of), tags=CRITICAL),
        TableCheck(
            f"{fact}.arr_delay_min.p95",
            lambda t: quantile_between(
                t[fact].filter("not cancelled_flag"), "arr_delay_min", 0.95, -30, 240
            ).filter(untrue(F.col("passed"))), "warn"),
        TableCheck(f"{fact}.ingested_at.recency",
                   lambda t: recency(t[fact], "ingested_at", as_of, 25).filter("stale"), tags=CRITICAL),
        TableCheck(f"{daily}.matches_detail", lambda t: counts_differ(t[fact], t[daily]), tags=CRITICAL),
    ]


def select_checks(
    checks: Iterable[Check], tags: Iterable[str] = (), severity: str | None = None
) -> list[Check]:
    wanted = set(tags)
    return [
        c for c in checks
        if wanted <= c.tags and (severity is None or c.severity == severity)
    ]


def _entry(check: int, role: int, wrong: Column, *keys: str) -> Column:
    """What a row says to a check, if anything: the check's number, the row's part in it, its keys."""
    text = F.array(*[F.col(k).cast("string") for k in keys]) if keys else F.array().cast("array<string>")
    return F.when(wrong, F.struct(F.lit(check).alias("check"), F.lit(role).alias("role"), text.alias("keys")))


def _entries(checks: Sequence[Check]) -> dict[str, list[Column]]:
    """By table: what its rows say. Roles: 0 a wrong row or a key, 1 a key that is referred to."""
    said: dict[str, list[Column]] = {}
    for i, c in enumerate(checks):
        if isinstance(c, RowCheck):
            said.setdefault(c.table, []).append(_entry(i, 0, c.wrong))
        elif isinstance(c, UniqueCheck):
            present = F.lit(True)
            for k in c.keys:
                present &= F.col(k).isNotNull()
            said.setdefault(c.table, []).append(_entry(i, 0, present, *c.keys))
        elif isinstance(c, ReferenceCheck):
            said.setdefault(c.table, []).append(_entry(i, 0, F.col(c.column).isNotNull(), c.column))
            said.setdefault(c.parent, []).append(_entry(i, 1, F.col(c.key).isNotNull(), c.key))
    return said


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """(check_name, severity, failures): rows, or keys, that violate each check.

    A table is scanned once for its row, uniqueness and reference checks. Its rows give an entry for
    each key and each wrong value; entries are counted by check and key, on the map side first, so
    wrong rows and values that many rows share are few in the shuffle.
    """
    checks = list(checks)
    said = None
    for table, entries in _entries(checks).items():
        part = tables[table].select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
        said = part if said is None else said.unionByName(part)
    report = None
    if said is not None:
        by_key = said.groupBy("check", "keys").agg(
            F.count_if(F.col("role") == 0).alias("rows"), F.count_if(F.col("role") == 1).alias("parents"))
        counted = []
        for i, c in enumerate(checks):
            mine = F.col("check") == i
            if isinstance(c, RowCheck):
                counted.append((c, F.coalesce(F.sum(F.when(mine, F.col("rows"))), F.lit(0))))
            elif isinstance(c, UniqueCheck):
                counted.append((c, F.count_if(mine & (F.col("rows") > 1))))
            elif isinstance(c, ReferenceCheck):
                counted.append((c, F.count_if(mine & (F.col("rows") > 0) & (F.col("parents") == 0))))
        # One row of counts becomes a line for each check.
        counts = by_key.agg(*[n.alias(f"c{i}") for i, (_, n) in enumerate(counted)])
        lines = F.array(*[
            F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.col(f"c{i}").alias("failures"))
            for i, (c, _) in enumerate(counted)])
        report = counts.select(F.explode(lines).alias("line")).select("line.*")
    for c in checks:
        if isinstance(c, TableCheck):
            part = c.violations(tables).agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), "failures")
            report = part if report is None else report.unionByName(part)
    return report


def gate(report: DataFrame) -> DataFrame:
    """The failed checks that must stop a release."""
    return report.filter((F.col("severity") == "error") & (F.col("failures") > 0))


def record_report(report: DataFrame, path: str, run_ts: dt.datetime) -> None:
    """Append a run's results to the check history."""
    report.withColumn("run_ts", F.lit(run_ts).cast("timestamp")).write.mode("append").parquet(path)


def store_failures(
    tables: Mapping[str, DataFrame], checks: Iterable[Check], root: str
) -> dict[str, str]:
    """Write the violating rows below ``root``; returns the folder of each check.

    Row checks of a table share one scan: a row is written once for each check it fails.
    """
    folders, by_table = {}, {}
    for c in checks:
        if isinstance(c, RowCheck):
            by_table.setdefault(c.table, []).append(c)
            folders[c.name] = f"{root}/{c.table}/check_name={c.name}"
        else:
            folders[c.name] = f"{root}/{c.name}"
            c.violations(tables).write.mode("overwrite").parquet(folders[c.name])
    for table, group in by_table.items():
        failed = F.array_compact(F.array(*[F.when(c.wrong, F.lit(c.name)) for c in group]))
        rows = tables[table].withColumn("check_name", F.explode(failed))
        rows.write.mode("overwrite").partitionBy("check_name").parquet(f"{root}/{table}")
    return folders


def read_failures(spark: SparkSession, folder: str) -> DataFrame | None:
    """Rows a check has kept; None where no row failed."""
    return spark.read.parquet(folder) if files.holds_data(spark, folder) else None
