"""Experiment log: metrics of repeated runs, kept between runs and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def summarize(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of each metric over the splits of a run."""
    return scores.groupBy("metric").agg(
        F.avg("score").alias("average"), F.stddev_pop("score").alias("std")
    )


def run_deltas(runs: DataFrame, metric: str = "metric", run: str = "run", score: str = "score") -> DataFrame:
    """Change of each metric against its previous run; zero for the first.

    ``run`` must be of a type whose order is that of time: a number, a date or an instant; texts
    are refused ("10" comes before "9"). ``runs`` holds one row per run and metric, so a window
    per metric stays small.
    """
    if isinstance(runs.schema[run].dataType, StringType):
        raise TypeError(f"{run} is a text; runs are ordered by number or time")
    previous = F.lag(score).over(Window.partitionBy(metric).orderBy(run))
    return runs.withColumn("delta", F.col(score) - F.coalesce(previous, F.col(score)))


def append_run(scores: DataFrame, path: str, run: int) -> None:
    """Add one run's summary to the log; a run of the same number is replaced."""
    (
        scores.withColumn("run", F.lit(run).cast("bigint"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)
    )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("run", F.col("run").cast("bigint"))
