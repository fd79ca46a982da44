"""Lenient casts of text columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; text that does not parse becomes NULL instead of failing."""
    return df.select(
        *[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns]
    )


def lat_lon(text: Column) -> tuple[Column, Column]:
    """Latitude and longitude of a ``"lat,lon"`` text; NULL where a part is missing."""
    parts = F.split(text, ",")
    return F.get(parts, F.lit(0)).try_cast("float"), F.get(parts, F.lit(1)).try_cast("float")


def present(column: Column) -> Column:
    """True for a text that is neither NULL nor empty."""
    return column.isNotNull() & (column != "")
