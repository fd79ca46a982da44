"""Training features of flights and of prediction requests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.functions import clock
from delaylens.operators.joins import enrich

AIRPLANE_ATTRIBUTES = (
    "EngineManufacturer", "EngineModel", "Manufacturer", "ManufacturerYear", "OwnerState",
)
FEATURE_ORDER = ("DayOfYear", "Carrier", "Origin", "Dest", "FlightNum", "CRSDepTime", "CRSArrTime")


def route(df: DataFrame, origin: str = "Origin", dest: str = "Dest", name: str = "Route") -> DataFrame:
    return df.withColumn(name, F.concat(F.col(origin), F.lit("-"), F.col(dest)))


def base_features(
    flights: DataFrame, extra: Sequence[str] = (), ordered: bool = False
) -> DataFrame:
    """Features of flights with known delays: scheduled instants, calendar, distance, targets.

    An arrival before its departure is moved to the next day. ``ordered`` adds a total sort;
    training does not need it.
    """
    scheduled = flights.dropna(subset=["ArrDelay", "DepDelay"]).withColumns({
        "_dep": clock.scheduled_at(F.col("FlightDate"), F.col("CRSDepTime")),
        "_arr": clock.scheduled_at(F.col("FlightDate"), F.col("CRSArrTime")),
    })
    out = scheduled.select(
        "ArrDelay",
        clock.after_departure(F.col("_dep"), F.col("_arr")).alias("CRSArrTime"),
        F.col("_dep").alias("CRSDepTime"),
        "Carrier",
        F.dayofmonth("FlightDate").alias("DayOfMonth"),
        clock.day_of_week(F.col("FlightDate")).alias("DayOfWeek"),
        F.dayofyear("FlightDate").alias("DayOfYear"),
        "DepDelay", "Dest", "Distance", "FlightDate", "FlightNum", "Origin", *extra,
    )
    return out.orderBy(*FEATURE_ORDER) if ordered else out


def with_airplane(
    features: DataFrame, airplanes: DataFrame, attributes: Sequence[str] = AIRPLANE_ATTRIBUTES
) -> DataFrame:
    """Features with the route and the airplane's attributes, ``Empty`` where it is unknown."""
    routed = route(features)
    joined = enrich(routed, airplanes, "TailNum", attributes)
    return joined.withColumn("TailNum", F.when(F.col("TailNum") != "", F.col("TailNum")).otherwise("Empty"))


def with_times(features: DataFrame) -> DataFrame:
    """Features with the scheduled flight time in seconds and the hours of both ends."""
    return features.withColumns({
        "FlightTime": clock.seconds_between(F.col("CRSDepTime"), F.col("CRSArrTime")),
        "CRSDepHourOfDay": F.hour("CRSDepTime"),
        "CRSArrHourOfDay": F.hour("CRSArrTime"),
    })


def with_history(train: DataFrame, test: DataFrame, key: str, value: Column, name: str) -> tuple[DataFrame, DataFrame]:
    """Both tables with the mean ``value`` of the training rows of the same key, 0 where there are none.

    A training row does not count in its own mean. A null key has no history.
    """
    own = train.select("*", value.alias("_own"))
    known = own.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(
        F.sum("_own").alias("_sum"), F.count("_own").alias("_n")
    )
    counted = F.col("_own").isNotNull().cast("int")
    others = F.try_divide(F.col("_sum") - F.coalesce("_own", F.lit(0)), F.col("_n") - counted)
    same = F.col(key) == F.col("_key")
    return (
        own.join(known, same, "left").select(*train.columns, F.coalesce(others, F.lit(0.0)).alias(name)),
        test.join(known, same, "left").select(
            *test.columns, F.coalesce(F.try_divide("_sum", "_n"), F.lit(0.0)).alias(name)
        ),
    )


def calendar(df: DataFrame, date: str, monday: int = 1) -> DataFrame:
    """Day of year, month and week. ``monday`` is the number of Monday: 1 (ISO) or 0."""
    return df.withColumns({
        "DayOfYear": F.dayofyear(date),
        "DayOfMonth": F.dayofmonth(date),
        "DayOfWeek": clock.day_of_week(F.col(date), monday),
    })


def complete_requests(requests: DataFrame, distances: DataFrame, date: str = "FlightDate") -> DataFrame:
    """Requests with the mean distance of their route and calendar features."""
    known = distances.select("Origin", "Dest", "Distance")
    return calendar(requests.join(known, ["Origin", "Dest"], "left"), date)


def stamped(requests: DataFrame) -> DataFrame:
    """Requests with a new unique id and the time of arrival."""
    return requests.withColumns({"UUID": F.uuid(), "Timestamp": F.current_timestamp()})
