"""Readers for delimited, JSON, text and Parquet inputs, and day partitions."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Column layouts of the published input files.
AIRLINES = T.StructType(
    [T.StructField("ID", T.IntegerType())]
    + _strings("Name", "Alias", "IATA", "ICAO", "CallSign", "Country", "Active").fields
)
AIRPORTS = T.StructType(
    _strings("AirportID", "Name", "City", "Country", "FAA", "ICAO").fields
    + [
        T.StructField("Latitude", T.DoubleType()),
        T.StructField("Longitude", T.DoubleType()),
        T.StructField("Altitude", T.IntegerType()),
    ]
    + _strings("Timezone", "DST", "TimezoneOlson").fields
)
STATIONS = _strings(
    "REGION", "WBAN_ID", "STATION_NAME", "STATE_PROVINCE", "COUNTY", "COUNTRY",
    "EXTENDED_NAME", "CALL_SIGN", "STATION_TYPE", "DATE_ASSIGNED", "BEGIN_DATE", "COMMENTS",
    "LOCATION", "ELEV_OTHER", "ELEV_GROUND", "ELEV_RUNWAY", "ELEV_BAROMETRIC", "ELEV_STATION",
    "ELEV_UPPER_AIR",
)
# The hourly measures. Each is followed by its quality flag.
HOURLY_MEASURES = (
    "SkyCondition", "Visibility", "WeatherType", "DryBulbFarenheit", "DryBulbCelsius",
    "WetBulbFarenheit", "WetBulbCelsius", "DewPointFarenheit", "DewPointCelsius",
    "RelativeHumidity", "WindSpeed", "WindDirection", "ValueForWindCharacter",
    "StationPressure", "PressureTendency", "PressureChange", "SeaLevelPressure", "RecordType",
    "HourlyPrecip", "Altimeter",
)
HOURLY_OBSERVATIONS = _strings(
    "WBAN", "Date", "Time", "StationType",
    *[name for m in HOURLY_MEASURES for name in (m, m + "Flag")],
)
# The daily observations, in the order of the published file.
DAILY_OBSERVATIONS = _strings(
    "WBAN", "YearMonthDay", "Tmax", "TmaxFlag", "Tmin", "TminFlag", "Tavg", "TavgFlag", "Depart", "DepartFlag",
    "DewPoint", "DewPointFlag", "WetBulb", "WetBulbFlag", "Heat", "HeatFlag", "Cool", "CoolFlag", "Sunrise",
    "SunriseFlag", "Sunset", "SunsetFlag", "CodeSum", "CodeSumFlag", "Depth", "DepthFlag", "Water1", "Water1Flag",
    "SnowFall", "SnowFallFlag", "PrecipTotal", "PrecipTotalFlag", "StnPressure", "StnPressureFlag", "SeaLevel",
    "SeaLevelFlag", "ResultSpeed", "ResultSpeedFlag", "ResultDir", "ResultDirFlag", "AvgSpeed", "AvgSpeedFlag",
    "Max5Speed", "Max5SpeedFlag", "Max5Dir", "Max5DirFlag", "Max2Speed", "Max2SpeedFlag", "Max2Dir", "Max2DirFlag",
)
FEATURES = T.StructType([
    T.StructField("ArrDelay", T.DoubleType()),
    T.StructField("CRSArrTime", T.TimestampType()),
    T.StructField("CRSDepTime", T.TimestampType()),
    T.StructField("Carrier", T.StringType()),
    T.StructField("DayOfMonth", T.IntegerType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("DayOfYear", T.IntegerType()),
    T.StructField("DepDelay", T.DoubleType()),
    T.StructField("Dest", T.StringType()),
    T.StructField("Distance", T.DoubleType()),
    T.StructField("FlightDate", T.DateType()),
    T.StructField("FlightNum", T.StringType()),
    T.StructField("Origin", T.StringType()),
])
REQUESTS = T.StructType([
    T.StructField("Carrier", T.StringType()),
    T.StructField("DayOfMonth", T.IntegerType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("DayOfYear", T.IntegerType()),
    T.StructField("DepDelay", T.DoubleType()),
    T.StructField("Dest", T.StringType()),
    T.StructField("Distance", T.DoubleType()),
    T.StructField("FlightDate", T.DateType()),
    T.StructField("FlightNum", T.StringType()),
    T.StructField("Origin", T.StringType()),
    T.StructField("Timestamp", T.TimestampType()),
])
STREAM_REQUESTS = T.StructType(REQUESTS.fields + [T.StructField("UUID", T.StringType())])
# Requests as ``write_days`` stores them: the day is the partition.
STORED_REQUESTS = T.StructType(STREAM_REQUESTS.fields + [T.StructField("ds", T.DateType())])
STORED_RESULTS = T.StructType(
    STREAM_REQUESTS.fields + [T.StructField("Prediction", T.DoubleType()), T.StructField("ds", T.DateType())]
)
# The on-time table, its text columns and those that are numbers once cast.
ON_TIME_TEXTS = (
    "Year", "Quarter", "Month", "DayofMonth", "DayOfWeek", "FlightDate", "Carrier", "TailNum", "FlightNum",
    "Origin", "OriginCityName", "OriginState", "Dest", "DestCityName", "DestState", "DepTime", "WheelsOff",
    "WheelsOn", "ArrTime", "CRSDepTime", "CRSArrTime",
)
ON_TIME_FLOATS = (
    "DepDelay", "TaxiOut", "TaxiIn", "ArrDelay", "ArrDelayMinutes", "ActualElapsedTime", "AirTime", "Distance",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
)
ON_TIME_WHOLE = ("DepDelayMinutes", "Cancelled", "Diverted", "Flights")
ON_TIME = _strings(*ON_TIME_TEXTS, *ON_TIME_FLOATS, *ON_TIME_WHOLE)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    *,
    schema: T.StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    null_token: str = "",
    infer: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Delimited text, plain or compressed, one file or a glob.

    Without a schema every column is text unless ``infer`` is set. Gzip files cannot be split:
    one task reads each, so ask for ``partitions`` when a few large ones feed a long job.
    """
    reader = spark.read.options(header=header, sep=sep, nullValue=null_token)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)
    df = reader.csv(path)
    return df.repartition(partitions) if partitions else df


def read_json_lines(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """One JSON object per line; with a schema, unreadable lines are kept in ``_corrupt_record``."""
    if schema is None:
        return spark.read.json(path)
    kept = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(kept)
        .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.text(path)


def split_fields(df: DataFrame, text: str, sep: str, fields: str = "fields") -> DataFrame:
    """Each line cut at a literal separator into an array of fields."""
    return df.withColumn(fields, F.split(F.col(text), _literal(sep), -1))


def flatten_fields(df: DataFrame, text: str, sep: str, field: str = "field") -> DataFrame:
    """One row per field of each line."""
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.explode(F.split(F.col(text), _literal(sep), -1)).alias(field))


def parse_json(df: DataFrame, text: str, schema: T.StructType | str) -> DataFrame:
    """Replace a JSON text column by the columns of ``schema``."""
    others = [c for c in df.columns if c != text]
    parsed = df.select(*others, F.from_json(text, schema).alias("_json"))
    return parsed.select(*others, "_json.*")


def run_sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Run one SQL text over the given tables, each a view under its name for this statement only."""
    names = {name: f"{name}_{uuid.uuid4().hex}" for name in tables}
    for name, df in tables.items():
        df.createOrReplaceTempView(names[name])
    views = ", ".join(f"{name} AS (SELECT * FROM {view})" for name, view in names.items())
    try:
        return spark.sql(f"WITH {views} {text}")
    finally:
        for view in names.values():
            spark.catalog.dropTempView(view)


def cast_on_time(df: DataFrame) -> DataFrame:
    """The on-time table with its 17 numeric columns cast; a text that is no number becomes NULL.

    A whole number may be written with decimals ("1.00").
    """
    floats = {c: F.expr(f"try_cast({c} AS FLOAT)") for c in ON_TIME_FLOATS}
    whole = {c: F.expr(f"cast(try_cast({c} AS DOUBLE) AS INT)") for c in ON_TIME_WHOLE}
    return df.withColumns({**floats, **whole})


def day_slice(df: DataFrame, at: str, day: str | dt.date) -> DataFrame:
    """Rows of one UTC day by a half-open range on the instant, which reaches the scan."""
    start = day if isinstance(day, dt.date) else dt.date.fromisoformat(day)
    end = start + dt.timedelta(days=1)
    return df.where(
        (F.col(at) >= _midnight(df, at, start)) & (F.col(at) < _midnight(df, at, end))
    )


def iso_day_slice(df: DataFrame, iso_text: str, day: str, at: str | None = None) -> DataFrame:
    """Rows whose ISO text lies between a day and the next, both bounds included.

    The comparison is between texts: the bare text of the next day belongs to the slice, an
    instant within the next day does not. ``at`` names the instant that the text stands for; a
    range on it, which the texts imply, then reaches the scan.
    """
    tomorrow = (dt.date.fromisoformat(day) + dt.timedelta(days=1)).isoformat()
    if at is not None:
        end = dt.date.fromisoformat(tomorrow)
        df = df.where((F.col(at) >= _midnight(df, at, dt.date.fromisoformat(day))) & (F.col(at) <= _midnight(df, at, end)))
    return df.where(F.col(iso_text).between(day, tomorrow))


def read_day(spark: SparkSession, root: str, day: str, schema: T.StructType | None = None) -> DataFrame:
    """One day of a table written by ``write_days``; other days are pruned before the scan.

    With a schema, a store without a single day gives no rows.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(root).where(F.col("ds") == F.lit(day).cast("date"))


def _midnight(df: DataFrame, at: str, day: dt.date) -> Column:
    return F.lit(day.isoformat()).cast(df.schema[at].dataType)


def _literal(sep: str) -> str:
    """The separator as a pattern that matches just this text."""
    return re.sub(r"([\\.\[\]{}()*+?^$|])", r"\\\1", sep)
