"""Histograms over equal-width bins or explicit edges; empty bins are kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.functions.buckets import edge_bin


def by_edges(df: DataFrame, value: str, edges: Sequence[float]) -> DataFrame:
    """Counts per bin; bins are left-closed, the last closed, other values and NULL ignored."""
    marks = F.array(*[F.lit(float(e)) for e in edges])
    at = F.col("id").cast("int")
    bins = df.sparkSession.range(len(edges) - 1).select(
        at.alias("bin"), F.get(marks, at).alias("lo"), F.get(marks, at + 1).alias("hi")
    )
    counted = (
        df.select(edge_bin(value, edges).alias("bin"))
        .groupBy("bin").agg(F.count("*").alias("n"))
    )
    return bins.join(counted, "bin", "left").na.fill(0, ["n"]).select("bin", "lo", "hi", "n")


def even(df: DataFrame, value: str, n: int) -> DataFrame:
    """``n`` equal bins between the smallest and the largest value, or one if they are equal."""
    spark = df.sparkSession
    low = df.agg(F.min(value).alias("low")).scalar()
    high = df.agg(F.max(value).alias("high")).scalar()
    # The last bin is closed: the largest value would fall into bin n.
    position = F.floor((F.col(value) - F.col("low")) / ((F.col("high") - F.col("low")) / n))
    counted = (
        df.where(F.col(value).isNotNull()).select(value)
        .withColumns({"low": low, "high": high})
        .select(
            F.when(F.col("high") == F.col("low"), F.lit(0))
            .otherwise(F.least(position, F.lit(n - 1))).cast("int").alias("bin")
        )
        .groupBy("bin").agg(F.count("*").alias("n"))
    )
    bins = (
        spark.range(n).select(F.col("id").cast("int").alias("bin"))
        .withColumns({"low": low, "high": high})
        .where((F.col("bin") == 0) | (F.col("high") > F.col("low")))
    )
    width = (F.col("high") - F.col("low")) / n
    return (
        bins.join(counted, "bin", "left").na.fill(0, ["n"])
        .select(
            "bin",
            (F.col("low") + F.col("bin") * width).alias("lo"),
            F.when(F.col("bin") == n - 1, F.col("high"))
            .otherwise(F.col("low") + (F.col("bin") + 1) * width).alias("hi"),
            "n",
        )
    )


def document(histogram: DataFrame, key: str) -> DataFrame:
    """A histogram as one chart record: left edges with their counts, in order."""
    item = F.struct(F.col("lo").alias("label"), F.col("n").alias("value"))
    return histogram.agg(F.sort_array(F.collect_list(item)).alias("data")).select(
        F.lit(key).alias("key"), "data"
    )
