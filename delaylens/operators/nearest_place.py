"""Nearest place on the earth for every site, exact and without comparing all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylens.functions.geodesy import (
    OUTER_RADIUS, UNKNOWN_MILES, miles_to_cell, rounded_miles, sphere_miles,
)

# Cell sizes of the search, as multiples of the finest cell. Each divides the one before it.
FINEST_DEGREES = 0.1
LEVELS = (300, 100, 25, 5, 1)
_ROWS = round(180 / FINEST_DEGREES) // LEVELS[0]
_COLUMNS = round(360 / FINEST_DEGREES) // LEVELS[0]
# Beyond this a computed distance may be replaced by UNKNOWN_MILES, so it bounds nothing.
_NEARLY_ANTIPODAL = 12_000.0


def nearest_place(
    sites: DataFrame, places: DataFrame, site: str, place: str,
    lat: str = "lat", lon: str = "lon", distance: str = "distance",
) -> DataFrame:
    """For each site the place with the least rounded distance; ties go to the smaller id.

    A coarse-to-fine search on a latitude/longitude grid. At each level a site keeps the cells
    that may still hold its nearest place: those whose least possible distance does not exceed
    the distance to the best place seen so far, every cell contributing one of its places as a
    sample. Survivors are replaced by the non-empty cells inside them, and only the places of
    the last cells are measured. All joins are equi-joins on cell numbers. Places at the same position are reduced
    to the least id before the search.

    Sites or places without coordinates count as ``UNKNOWN_MILES`` away from everything.
    """
    site_rows = sites.select(
        F.col(site).alias("site"), F.col(lat).cast("double").alias("s_lat"),
        F.col(lon).cast("double").alias("s_lon"),
    )
    place_rows = places.select(
        F.col(place).alias("place"), F.col(lat).cast("double").alias("lat"),
        F.col(lon).cast("double").alias("lon"),
    )
    known = place_rows.where(_located("lat", "lon"))
    spots = known.groupBy("lat", "lon").agg(F.min("place").alias("place"))
    spots = spots.withColumns({
        "fy": _cell(F.col("lat"), 90.0, 180.0), "fx": _cell(F.col("lon"), 180.0, 360.0),
    })
    coarse = F.explode(F.sequence(F.lit(0), F.lit(_ROWS * _COLUMNS - 1)))
    candidates = (
        site_rows.where(_located("s_lat", "s_lon")).withColumn("cell", coarse)
        .selectExpr("site", "s_lat", "s_lon", f"cell div {_COLUMNS} AS cy", f"cell % {_COLUMNS} AS cx")
    )
    for level, units in enumerate(LEVELS):
        samples = _samples(spots, units, LEVELS[level - 1] if level else None)
        candidates = _keep_reachable(candidates, samples, units)
    measured = (
        candidates.join(
            spots.select(F.col("fy").alias("cy"), F.col("fx").alias("cx"), "place", "lat", "lon"),
            ["cy", "cx"],
        )
        .withColumn("miles", rounded_miles("s_lat", "s_lon", "lat", "lon"))
        .groupBy("site").agg(F.min(F.struct("miles", "place")).alias("best"))
    )
    # Sites that cannot be measured share the least id of all places.
    anywhere = place_rows.agg(F.min("place").alias("place")).scalar()
    return (
        site_rows.select("site").join(measured, "site", "left")
        .withColumn("_any", anywhere)
        .select(
            F.col("site").alias(site),
            F.coalesce("best.place", "_any").alias(place),
            F.coalesce("best.miles", F.lit(UNKNOWN_MILES).cast("bigint")).alias(distance),
        )
        .where(F.col(place).isNotNull())
    )


def best_and_worst(pairs: DataFrame, distance: str, tie: str, k: int) -> DataFrame:
    """The ``k`` closest and the ``k`` farthest pairs."""
    best = pairs.orderBy(distance, tie).limit(k).withColumn("side", F.lit("best"))
    worst = pairs.orderBy(F.desc(distance), tie).limit(k).withColumn("side", F.lit("worst"))
    return best.unionByName(worst)


def _located(lat: str, lon: str) -> Column:
    return F.col(lat).isNotNull() & F.col(lon).isNotNull()


def _cell(degrees: Column, shift: float, span: float) -> Column:
    """Finest cell number; the far edge belongs to the last cell."""
    cells = round(span / FINEST_DEGREES)
    return F.least(
        F.floor((degrees + shift) * round(1 / FINEST_DEGREES)), F.lit(cells - 1)
    ).cast("int")


def _samples(spots: DataFrame, units: int, parent: int | None) -> DataFrame:
    """One place of every non-empty cell of a level, with the number of the cell around it."""
    cells = spots.groupBy(
        F.expr(f"fy div {units}").alias("y"), F.expr(f"fx div {units}").alias("x")
    ).agg(F.min(F.struct("lat", "lon")).alias("sample"))
    if parent is None:
        # The coarsest grid has 72 cells: this side can always be broadcast.
        return F.broadcast(cells.withColumns({"cy": F.col("y"), "cx": F.col("x")}))
    ratio = parent // units
    return cells.withColumns({"cy": F.expr(f"y div {ratio}"), "cx": F.expr(f"x div {ratio}")})


def _keep_reachable(candidates: DataFrame, samples: DataFrame, units: int) -> DataFrame:
    """Replace each site's cells by the cells inside them that its nearest place may lie in."""
    size = units * FINEST_DEGREES
    at_least = miles_to_cell("s_lat", "s_lon", f"(y * {size}D - 90D)", f"(x * {size}D - 180D)", size)
    to_sample = sphere_miles("s_lat", "s_lon", "sample.lat", "sample.lon", OUTER_RADIUS)
    seen = F.min("to_sample").over(Window.partitionBy("site"))
    bound = F.when(seen < _NEARLY_ANTIPODAL, seen).otherwise(float(UNKNOWN_MILES))
    kept = ("site", "s_lat", "s_lon", F.col("y").alias("cy"), F.col("x").alias("cx"))
    return (
        candidates.join(samples, ["cy", "cx"])
        .select(*kept, at_least.alias("at_least"), to_sample.alias("to_sample"))
        .withColumn("bound", bound)
        # Distances are compared in whole miles, so a mile more may still be a tie.
        .where(F.col("at_least") <= F.col("bound") + 1)
        .select("site", "s_lat", "s_lon", "cy", "cx")
    )
