"""Intermediate tables in the folder that all executors share, and size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.session import workspace

#: A side of a join is broadcast up to so many rows of a few numbers each, and shuffled beyond.
BROADCAST_ROWS = 200_000


#: Shuffle files go as soon as the query that wrote them ends.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """A folder of intermediate Parquet tables.

    With ``tidy`` the shuffle files of a stored table are removed once it is written, rather than
    when the driver happens to collect garbage.
    """

    def __init__(self, spark: SparkSession, name: str, tidy: bool = False) -> None:
        self.spark, self.folder, self.used, self.tidy = spark, workspace(spark, name), 0, tidy

    def store(self, df: DataFrame) -> DataFrame:
        """``df`` written once and read back: later uses see the same rows and a short lineage."""
        self.used += 1
        path = f"{self.folder}/{self.used}"
        given = self.spark.conf.get(TIDY, None)
        if self.tidy:
            self.spark.conf.set(TIDY, "true")
        try:
            df.write.parquet(path)
        finally:
            if self.tidy:
                self.spark.conf.unset(TIDY) if given is None else self.spark.conf.set(TIDY, given)
        return self.spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast only if it has at most ``rows`` rows; ``df`` must be stored."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
