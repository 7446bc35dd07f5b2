"""Metric windows, alarms, lag and alert rules over operational tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Producer lag limits in seconds, usage look-back in minutes, alert page
# size, and materializations per hour that are still normal.
LAG_WARN_SECONDS = 120
LAG_FATAL_SECONDS = 600
USAGE_MINUTES = 75
ALERT_PAGE = 100
MATERIALIZATIONS_PER_HOUR = 10
CRITICAL_CLASSES = ("test", "model_error")


@dataclass(frozen=True)
class Alarm:
    """``periods`` windows in a row with the statistic beyond the threshold."""

    name: str
    metric: str
    component: str | None
    period_seconds: int
    periods: int
    threshold: float
    statistic: str = "sum"           # or "max"
    comparison: str = "greater"      # or "less"
    missing_breaches: bool = False


# The alarms in service.
ALARMS = [
    Alarm("consumer-dlq-rate", "MessagesDLQ", "consumer", 300, 2, 50),
    Alarm("consumer-error-rate", "ConsumerError", "consumer", 60, 3, 5),
    Alarm("producer-heartbeat-stale-5m", "MessagesPublished", "producer", 300, 1, 1,
          comparison="less", missing_breaches=True),
    Alarm("producer-fetch-fatal", "FetchFatal", "producer", 60, 1, 0),
    Alarm("producer-silent-60s", "MessagesPublished", None, 60, 2, 1,
          comparison="less", missing_breaches=True),
    Alarm("credit-burn", "SnowflakeCreditsLastHour", None, 1800, 2, 6, statistic="max"),
    Alarm("unreviewed-schema-drift", "UnreviewedDriftRows", None, 3600, 1, 0, statistic="max"),
    Alarm("consumer-lag-high", "EstimatedMaxTimeLag", None, 300, 1, 30, statistic="max"),
]


def metric_windows(points: DataFrame, period_seconds: int, *groups: str) -> DataFrame:
    """Sum, maximum and count of metric values in tumbling windows."""
    return (
        points.groupBy(F.window("ts", f"{period_seconds} seconds").alias("w"), *groups)
        .agg(F.sum("value").alias("sum_value"), F.max("value").alias("max_value"),
             F.count(F.lit(1)).alias("points"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                *groups, "sum_value", "max_value", "points")
    )


def evaluate_alarm(
    points: DataFrame, alarm: Alarm, start: dt.datetime, end: dt.datetime, *groups: str
) -> DataFrame:
    """Alarm state per window over [start, end), windows without data included.

    Points become one row per window before any ordering takes place, so the spine and
    the look-back run over windows, not points. Any columns in ``groups`` get an alarm
    of their own; the groups are those seen in the points.
    """
    chosen = points.filter(
        (F.col("metric_name") == alarm.metric)
        & (F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < F.lit(end).cast("timestamp"))
    )
    if alarm.component is not None:
        chosen = chosen.filter(F.col("component") == alarm.component)
    return alarm_states(chosen, alarm, start, end, *groups)


def alarm_states(
    points: DataFrame, alarm: Alarm, start: dt.datetime, end: dt.datetime, *groups: str
) -> DataFrame:
    windows = metric_windows(points, alarm.period_seconds, *groups)
    statistic = F.col(f"{alarm.statistic}_value")
    if groups:
        members = windows.select(*groups).distinct()
    else:
        members = points.sparkSession.range(1).drop("id")
    step = F.expr(f"interval {alarm.period_seconds} seconds")
    spine = members.withColumn(
        "window_start",
        F.explode(F.sequence(
            F.lit(start).cast("timestamp"),
            F.lit(end - dt.timedelta(seconds=alarm.period_seconds)).cast("timestamp"), step)),
    )
    filled = spine.join(
        windows.select(*groups, "window_start", statistic.alias("value")),
        [*groups, "window_start"], "left",
    )
    crossed = (
        F.col("value") < alarm.threshold if alarm.comparison == "less"
        else F.col("value") > alarm.threshold
    )
    breach = F.coalesce(crossed, F.lit(alarm.missing_breaches))
    # Without groups one task orders the windows of the span: rows of time, not of data.
    back = Window.partitionBy(*groups or [F.lit(0)]).orderBy("window_start").rowsBetween(
        -(alarm.periods - 1), 0)
    in_row = F.sum(breach.cast("int")).over(back)
    return filled.select(
        *groups, "window_start", "value", breach.alias("breach"),
        F.when(in_row == alarm.periods, "ALARM").otherwise("OK").alias("state"),
    )


def lag_status(latest: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Producer lag from the latest arrival (column ``latest``)."""
    lag = F.unix_seconds(F.lit(as_of).cast("timestamp")) - F.unix_seconds("latest")
    return latest.withColumn("lag_seconds", lag).withColumn(
        "status",
        F.when(F.col("lag_seconds").isNull(), "no_data")
        .when(F.col("lag_seconds") > LAG_FATAL_SECONDS, "fatal")
        .when(F.col("lag_seconds") > LAG_WARN_SECONDS, "warn")
        .otherwise("ok"),
    )


def usage_last_window(usage: DataFrame, as_of: dt.datetime, minutes: int = USAGE_MINUTES) -> DataFrame:
    since = F.lit(as_of - dt.timedelta(minutes=minutes)).cast("timestamp")
    return (
        usage.filter(F.col("end_time") > since).groupBy("warehouse_name")
        .agg(F.sum("credits_used").alias("credits"))
    )


def alert_severity() -> Column:
    critical = F.col("alert_class").isin(*CRITICAL_CLASSES) & F.lower("tags").contains("critical")
    return F.when(critical, "critical").otherwise("warning")


def alerts_after(
    alerts: DataFrame, cursor: dt.datetime, cursor_id: str | None = None, limit: int = ALERT_PAGE
) -> DataFrame:
    """The next page of alerts, oldest first, ties by id.

    The cursor is the time and id of the last alert shown, so alerts of the same time as
    the end of a page come with the next; without an id all of that time have been shown.
    """
    at = F.lit(cursor).cast("timestamp")
    later = F.col("detected_at") > at
    if cursor_id is not None:
        later |= (F.col("detected_at") == at) & (F.col("alert_id") > F.lit(cursor_id))
    return alerts.filter(later).orderBy("detected_at", "alert_id").limit(limit)


def next_cursor(page: DataFrame, cursor: dt.datetime, cursor_id: str | None = None) -> DataFrame:
    """Where the page after this one starts: (cursor, cursor_id)."""
    last = F.coalesce(
        F.max(F.struct("detected_at", F.col("alert_id").cast("string").alias("alert_id"))),
        F.struct(F.lit(cursor).cast("timestamp").alias("detected_at"), F.lit(cursor_id).cast("string").alias("alert_id")))
    return page.agg(last.alias("last")).select(
        F.col("last.detected_at").alias("cursor"), F.col("last.alert_id").alias("cursor_id"))


def materialization_rate(
    runs: DataFrame, limit: int = MATERIALIZATIONS_PER_HOUR
) -> DataFrame:
    """Assets materialized more often than the limit within a clock hour."""
    return (
        runs.groupBy("asset", F.window("ts", "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("runs")).filter(F.col("runs") > limit)
        .select("asset", F.col("w.start").alias("hour_start"), "runs")
    )
