"""Alarms evaluated while metric points flow, silence included."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tarmac.operators.monitoring import ALARMS, Alarm

# How late a point may come before its window is judged without it.
LATE = "2 minutes"
STATES = "alarm string, window_start timestamp, value double, breach boolean, state string, changed boolean"
_EPOCH = dt.datetime(1970, 1, 1)


def clock(spark: SparkSession, every_seconds: int = 30) -> DataFrame:
    """Rows (ts) that prove time passes when no producer says anything."""
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option(
        "numPartitions", 1).option("advanceMillisPerBatch", every_seconds * 1000)
    begin = int(dt.datetime.now(dt.timezone.utc).timestamp() * 1000)
    return ticks.option("startTimestamp", begin).load().select(F.col("timestamp").alias("ts"))


class AlarmProcessor(StatefulProcessor):
    """Judges the windows of one alarm in order, each when the watermark has passed its end.

    State: the statistic of windows not judged yet, the next window due, the breaches of the last
    ``periods`` windows (a ring) and the state shown last. A timer stands at the end of the next
    window, so a window nobody wrote to is judged too. State does not grow: what is judged goes.
    """

    def __init__(self, alarms: Sequence[Alarm], start_seconds: int) -> None:
        self.alarms = {a.name: a for a in alarms}
        self.start_seconds = start_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "window bigint", "total double, highest double")
        self.judged = handle.getValueState("judged", "due bigint, ring array<boolean>, state string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        alarm = self.alarms[key[0]]
        if self.judged.exists():
            due = self.judged.get()[0]
        else:
            due = self.start_seconds
            self.judged.update((due, [], "OK"))
            self.handle.registerTimer((due + alarm.period_seconds) * 1000)
        for minutes in rows:
            known = minutes.dropna(subset=["sum_value"])  # a tick alone has no value
            seconds = known["slot_start"].astype("datetime64[s]").astype("int64")
            window = seconds - seconds % alarm.period_seconds
            for at, part in known[window >= due].groupby(window[window >= due]):
                total, highest = float(part["sum_value"].sum()), float(part["max_value"].max())
                if self.open.containsKey((at,)):
                    before = self.open.getValue((at,))
                    total, highest = total + before[0], max(highest, before[1])
                self.open.updateValue((at,), (total, highest))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        alarm = self.alarms[key[0]]
        watermark = timerValues.getCurrentWatermarkInMs()
        due, ring, shown = self.judged.get()
        ring, out = list(ring), []
        while (due + alarm.period_seconds) * 1000 <= watermark:
            value = None
            if self.open.containsKey((due,)):
                total, highest = self.open.getValue((due,))
                value = total if alarm.statistic == "sum" else highest
                self.open.removeKey((due,))
            if value is None:
                breach = alarm.missing_breaches
            else:
                breach = value < alarm.threshold if alarm.comparison == "less" else value > alarm.threshold
            ring = [*ring, breach][-alarm.periods:]
            state = "ALARM" if len(ring) == alarm.periods and all(ring) else "OK"
            out.append((_EPOCH + dt.timedelta(seconds=due), value, breach, state, state != shown))
            shown, due = state, due + alarm.period_seconds
        self.judged.update((due, ring, shown))
        self.handle.registerTimer((due + alarm.period_seconds) * 1000)
        if out:
            start, value, breach, state, changed = zip(*out, strict=True)
            yield pd.DataFrame({
                "alarm": [alarm.name] * len(out), "window_start": start, "value": pd.array(value, "Float64").astype(object),
                "breach": breach, "state": state, "changed": changed})

    def close(self) -> None:
        pass


def alarms_stream(
    points: DataFrame, ticks: DataFrame, start: dt.datetime, alarms: Sequence[Alarm] = ALARMS, late: str = LATE,
) -> DataFrame:
    """State of each alarm for every window from ``start`` on, as windows close; ``changed`` marks raises and all-clears.

    ``points`` are (metric_name, component, value, ts). ``ticks`` are rows (ts), from ``clock`` in
    service; they belong to every alarm and carry no value. They move the watermark when all producers
    are silent, and because they are part of the input, a run repeated after a failure judges the
    same windows. Points are summed up by alarm and slot (the largest period all alarms share)
    before they reach the state, on the map side first: an alarm sees a row a slot, however many
    points there are. A null value or time is no point. Windows are those of ``evaluate_alarm``;
    ``start`` must be a border of every alarm's windows. Needs the RocksDB state store.
    """
    begin = round((start - _EPOCH).total_seconds())
    if off := [a.name for a in alarms if begin % a.period_seconds]:
        raise ValueError(f"{start} is no window border of {', '.join(off)}")
    slot = math.gcd(*(a.period_seconds for a in alarms))
    fits = F.array_compact(F.array(*[
        F.when((F.col("metric_name") == a.metric) & (
            F.lit(True) if a.component is None else F.col("component") == a.component), F.lit(a.name))
        for a in alarms]))
    told = points.filter(F.col("value").isNotNull()).select("ts", F.col("value").cast("double").alias("value"), fits.alias("names"))
    passed = ticks.select(
        "ts", F.lit(None).cast("double").alias("value"), F.array(*[F.lit(a.name) for a in alarms]).alias("names"))
    slots = (
        told.unionByName(passed).filter(F.col("ts").isNotNull()).withWatermark("ts", late)
        .select("ts", "value", F.explode("names").alias("alarm"))
        .groupBy(F.window("ts", f"{slot} seconds").alias("slot"), "alarm")
        .agg(F.sum("value").alias("sum_value"), F.max("value").alias("max_value"))
        .select("alarm", "slot", F.col("slot.start").alias("slot_start"), "sum_value", "max_value"))
    return slots.groupBy("alarm").transformWithStateInPandas(
        AlarmProcessor(alarms, begin), outputStructType=STATES, outputMode="Append", timeMode="EventTime")
