"""Nearest observation in time of the same station and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_SECONDS = 300


def nearest_observation(
    events: DataFrame,
    observations: DataFrame,
    *,
    station: str,
    at: str,
    observed_station: str,
    observed_at: str,
    measures: Sequence[str],
    name: str = "observation",
    mode: str = "nearest",
    how: str = "inner",
    slice_seconds: int = SLICE_SECONDS,
) -> DataFrame:
    """Add to each event the observation of its station and UTC day that is closest in time.

    Equally close: the earlier one. ``mode="last"`` takes the day's last observation instead.
    ``how="left"`` keeps events on days without observations. The added column is a struct of
    ``observed_at`` and the measures.

    The work is split by (station, time slice), so a station with a large part of all rows is
    spread over its slices. Observations from beyond a slice enter as at most two rows: the last
    one before it and the first one after it on the same day.
    """
    seen = _one_per_instant(observations, observed_station, observed_at, measures)
    if mode == "last":
        return _last_of_day(events, seen, station, at, name, how)
    if mode != "nearest":
        raise ValueError("mode is 'nearest' or 'last'")
    probes = events.select(
        F.col(station).alias("_station"), F.to_date(at).alias("_day"),
        F.col(at).alias("_at"), F.struct("*").alias("_event"),
    )
    probes, seen = _sliced(probes, slice_seconds), _sliced(seen, slice_seconds)
    group = ["_station", "_day", "_slice"]
    found = seen.select(*group, "_at", "_obs", F.lit(0).alias("_is_event"), _nothing(probes, "_event"))
    asked = probes.select(*group, "_at", _nothing(seen, "_obs"), F.lit(1).alias("_is_event"), "_event")
    timeline = found.unionByName(_neighbours(seen, probes, group)).unionByName(asked)
    forward = Window.partitionBy(*group).orderBy("_at", "_is_event")
    backward = Window.partitionBy(*group).orderBy(F.desc("_at"), "_is_event")
    rows = (Window.unboundedPreceding, Window.currentRow)
    before = F.last("_obs", ignorenulls=True).over(forward.rowsBetween(*rows))
    after = F.last("_obs", ignorenulls=True).over(backward.rowsBetween(*rows))
    placed = timeline.withColumn("_before", before).withColumn("_after", after)
    placed = placed.where("_is_event = 1")
    gap_before = _micros(F.col("_at")) - _micros(F.col("_before.at"))
    gap_after = _micros(F.col("_after.at")) - _micros(F.col("_at"))
    take_before = F.col("_before").isNotNull() & (F.col("_after").isNull() | (gap_before <= gap_after))
    chosen = placed.select("_event.*", F.when(take_before, F.col("_before")).otherwise(F.col("_after")).alias(name))
    return chosen if how == "left" else chosen.where(F.col(name).isNotNull())


def _one_per_instant(
    observations: DataFrame, station: str, at: str, measures: Sequence[str]
) -> DataFrame:
    """Observations of a station at the same instant reduced to the least one."""
    item = F.struct(F.col(at).alias("at"), *measures)
    return (
        observations.where(F.col(at).isNotNull() & F.col(station).isNotNull())
        .groupBy(F.col(station).alias("_station"), F.col(at).alias("_at"))
        .agg(F.min(item).alias("_obs"))
        .withColumn("_day", F.to_date("_at"))
    )


def _last_of_day(
    events: DataFrame, seen: DataFrame, station: str, at: str, name: str, how: str
) -> DataFrame:
    last = seen.groupBy("_station", "_day").agg(F.max_by("_obs", "_at").alias(name))
    on = (F.col(station) == F.col("_station")) & (F.to_date(at) == F.col("_day"))
    return events.join(last, on, how).select(*events.columns, name)


def _sliced(df: DataFrame, seconds: int) -> DataFrame:
    return df.withColumn("_slice", F.expr(f"unix_micros(cast(_at as timestamp)) div {seconds * 1_000_000}"))


def _neighbours(seen: DataFrame, probes: DataFrame, group: list[str]) -> DataFrame:
    """For each slice with events: the closest observations before and after it on that day.

    Works on one row per slice, of which a station has a bounded number per day.
    """
    held = seen.groupBy(*group).agg(
        F.min_by("_obs", "_at").alias("_first"), F.max_by("_obs", "_at").alias("_last"),
        F.lit(False).alias("_asked"),
    )
    asked = probes.select(*group).distinct().select(
        *group, _nothing(held, "_first"), _nothing(held, "_last"), F.lit(True).alias("_asked")
    )
    slices = held.unionByName(asked).groupBy(*group).agg(
        F.max("_first").alias("_first"), F.max("_last").alias("_last"), F.max("_asked").alias("_asked")
    )
    day = Window.partitionBy("_station", "_day")
    others = (Window.unboundedPreceding, -1)
    around = slices.select(
        *group, "_asked",
        F.last("_last", ignorenulls=True).over(day.orderBy("_slice").rowsBetween(*others)).alias("_a"),
        F.last("_first", ignorenulls=True).over(day.orderBy(F.desc("_slice")).rowsBetween(*others)).alias("_b"),
    )
    return (
        around.where("_asked").select(*group, F.explode(F.array("_a", "_b")).alias("_obs"))
        .where(F.col("_obs").isNotNull())
        .select(
            *group, F.col("_obs.at").alias("_at"), "_obs", F.lit(0).alias("_is_event"),
            _nothing(probes, "_event"),
        )
    )


def _nothing(df: DataFrame, column: str) -> Column:
    """A NULL of the type that ``column`` has in ``df``."""
    return F.lit(None).cast(df.schema[column].dataType).alias(column)


def _micros(instant: Column) -> Column:
    return F.unix_micros(instant.cast("timestamp"))
