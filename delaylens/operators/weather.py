"""Station observations: clean-up of raw hourly records and the weather at both ends of a flight."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.functions import clock
from delaylens.operators.joins import both_ends
from delaylens.operators.nearest_time import nearest_observation
from delaylens.session import workspace
from delaylens.sources.writers import materialize

# The measures kept of an hourly record.
KEPT_MEASURES = (
    "SkyCondition", "Visibility", "WeatherType", "DryBulbCelsius", "WetBulbCelsius",
    "DewPointCelsius", "RelativeHumidity", "WindSpeed", "WindDirection",
    "ValueForWindCharacter", "StationPressure", "SeaLevelPressure", "HourlyPrecip", "Altimeter",
)


def normalize(
    raw: DataFrame, station: str = "WBAN", date: str = "Date", time: str = "Time",
    measures: Sequence[str] = KEPT_MEASURES,
) -> DataFrame:
    """Compact dates and clock texts as ISO texts, the listed measures kept."""
    day = clock.compact_date(F.col(date))
    instant = F.concat(day, F.lit("T"), clock.clock_text(F.col(time), fold_midnight=False))
    return raw.select(station, day.alias("Date"), instant.alias("Datetime"), *measures)


def scheduled_ends(flights: DataFrame) -> DataFrame:
    """Scheduled instants of both ends; arrivals earlier in the day than departures are next-day."""
    at = flights.withColumns({
        "_dep": clock.scheduled_at(F.col("FlightDate"), F.col("CRSDepTime")),
        "_arr": clock.scheduled_at(F.col("FlightDate"), F.col("CRSArrTime")),
    })
    return at.select(
        "FlightNum", F.col("_dep").alias("CRSDepDatetime"),
        clock.after_departure_clock(F.col("_dep"), F.col("_arr")).alias("CRSArrDatetime"),
        "FlightDate", "Origin", "Dest",
    )


def flight_weather(
    flights: DataFrame, stations: DataFrame, observations: DataFrame, measures: Sequence[str],
    *, place: str = "Airport", station: str = "WBAN_ID", observed_station: str = "WBAN",
    observed_at: str = "Datetime", mode: str = "nearest", how: str = "inner",
) -> DataFrame:
    """Flights with the observation nearest to departure and the one nearest to arrival.

    Flights share few instants: the distinct pairs of station and instant of both ends are
    matched once, and their observations joined back to either end. The flights with their
    instants are stored, since they are read once for the pairs and once for the joins.
    """
    out = both_ends(
        scheduled_ends(flights), stations, place, station,
        {"Origin": "Origin_Station", "Dest": "Dest_Station"},
    )
    out = materialize(out, workspace(out.sparkSession, "flight-ends"))
    ends = (
        ("Origin_Station", "CRSDepDatetime", "DepObservation"),
        ("Dest_Station", "CRSArrDatetime", "ArrObservation"),
    )
    asked = out.select(F.explode(F.array(*(
        F.struct(F.col(end).alias("_end"), F.col(at).alias("_instant")) for end, at, _ in ends
    ))).alias("p")).select("p.*").where("_end IS NOT NULL AND _instant IS NOT NULL").distinct()
    matched = nearest_observation(
        asked, observations, station="_end", at="_instant", observed_station=observed_station,
        observed_at=observed_at, measures=measures, name="_observation", mode=mode,
    )
    columns = list(out.columns)
    for end, at, name in ends:
        side = matched.select(F.col("_end").alias(f"_{end}"), F.col("_instant").alias(f"_{at}"), F.col("_observation").alias(name))
        out = out.join(side, (F.col(end) == F.col(f"_{end}")) & (F.col(at) == F.col(f"_{at}")), how)
        columns.append(name)
    return out.select(*columns)
