"""Joins of facts and dimensions.

No join here asks for a broadcast: Spark broadcasts a side once its size, from statistics or
measured at run time, is under ``spark.sql.autoBroadcastJoinThreshold``, and splits skewed
partitions of the other joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING = "Empty"


def coverage(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many rows of ``left`` find their key in ``right``: hits, total, percentage."""
    known = right.select(key).where(F.col(key).isNotNull()).distinct()
    marked = left.join(known.withColumn("_hit", F.lit(1)), key, "left")
    hits = F.count("_hit")
    return marked.agg(
        hits.alias("hits"), F.count("*").alias("total"),
        F.round(hits / F.count("*") * 100, 2).alias("pct_hits"),
    )


def enrich(
    facts: DataFrame, dimension: DataFrame, key: str, columns: Sequence[str], default: str = MISSING
) -> DataFrame:
    """Left join with a default text in place of missing attributes.

    Facts without a key cannot match. They are joined by a hash of the row instead, so that they do
    not pile up in the one partition a NULL or empty key hashes to, and the facts are read once.
    The hash is part of the one join column: a second column that is constant on the side of the
    dimension would become a filter, and no longer spread the rows.
    """
    keyed = F.coalesce(F.col(key) != "", F.lit(False))
    spread = F.when(keyed, F.col(key).cast("string")).otherwise(F.xxhash64(*facts.columns).cast("string"))
    known = dimension.where(F.coalesce(F.col(key) != "", F.lit(False))).select(
        F.col(key).cast("string").alias("_key"), *[F.col(c).alias(f"_{c}") for c in columns]
    )
    # The hash of a row may be the text of a key, so a match also needs a key of its own.
    joined = facts.withColumn("_spread", spread).join(known, (F.col("_spread") == F.col("_key")) & keyed, "left")
    return joined.select(*facts.columns, *[F.coalesce(f"_{c}", F.lit(default)).alias(c) for c in columns])


def both_ends(
    facts: DataFrame, places: DataFrame, place: str, value: str, ends: Mapping[str, str]
) -> DataFrame:
    """Join one dimension once per role: ``{"Origin": "Origin_Station", "Dest": …}``."""
    out = facts
    for column, name in ends.items():
        out = out.join(places.select(F.col(place).alias(column), F.col(value).alias(name)), column)
    return out.select(*facts.columns, *ends.values())


def with_status(requests: DataFrame, responses: DataFrame, key: str, answer: Sequence[str]) -> DataFrame:
    """Requests with ``OK`` and the answer where a response exists, else ``WAIT``."""
    # A response may have been delivered twice: the least one stands for all.
    one = responses.groupBy(key).agg(F.min(F.struct(*answer)).alias("_answer"))
    joined = requests.join(one, key, "left")
    status = F.when(F.col("_answer").isNull(), F.lit("WAIT")).otherwise(F.lit("OK"))
    return joined.select(
        *requests.columns, status.alias("status"), *[F.col(f"_answer.{a}").alias(a) for a in answer]
    )


def located(df: DataFrame, gazetteer: DataFrame, address: str, columns: Sequence[str | Column]) -> DataFrame:
    """Left join of addresses to a gazetteer; places it does not list keep NULL coordinates."""
    return df.join(gazetteer.select(address, *columns), address, "left")
