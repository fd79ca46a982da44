"""Figures kept per day, replaced day by day and merged for any period without the rows.

A part holds what one day adds to each key: counts, sums and two mergeable sketches. Parts are
made with partial aggregation, so a key with a large part of the rows is no hot spot, and a
period of any length reads its days' parts only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylens.sources.writers import write_days


@dataclass(frozen=True)
class Figures:
    """What is kept: ``keys`` per day, ``sums`` and null counts of numbers, ``distinct`` values
    of ids, quantiles of ``spread``.

    ``bits``: a distinct count is off by about 1.04 / sqrt(2 ** bits) (one standard deviation).
    ``size``: a quantile's rank is off by about 2.3 / size ** 0.9 of the rows (99 of 100 times).
    """

    keys: tuple[str, ...] = ()
    sums: tuple[str, ...] = ()
    distinct: tuple[str, ...] = ()
    spread: tuple[str, ...] = ()
    bits: int = 12
    size: int = 400


def day_parts(rows: DataFrame, day: str, figures: Figures) -> DataFrame:
    """One row per day (``ds``) and key with counts, sums and sketches.

    Rows without a day have a part without one. Null keys are a key; null values count as rows
    only.
    """
    parts = [F.count("*").alias("n")]
    for c in figures.sums:
        parts += [F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"values_{c}")]
    for c in figures.distinct:
        parts.append(F.hll_sketch_agg(F.col(c).cast("string"), figures.bits).alias(f"ids_{c}"))
    for c in figures.spread:
        parts += [F.kll_sketch_agg_double(F.col(c).cast("double"), figures.size).alias(f"ranks_{c}"), F.count(c).alias(f"ranked_{c}")]
    return rows.groupBy(F.col(day).cast("date").alias("ds"), *figures.keys).agg(*parts)


def replace_parts(parts: DataFrame, root: str, days: Sequence[str] = ()) -> T.StructType:
    """Store ``parts`` in place of their days and of ``days``; returns the schema to read them with.

    A day of ``days`` that has lost all its rows is replaced by an empty part, which adds nothing.
    """
    spark = parts.sparkSession
    if days:
        empty = spark.createDataFrame([(d,) for d in days], "ds string").select(F.col("ds").cast("date"), F.lit(0).cast("long").alias("n"))
        parts = parts.unionByName(empty, allowMissingColumns=True)
    write_days(parts, root, "ds")
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in parts.schema])


def read_parts(spark: SparkSession, root: str, schema: T.StructType, first: str | None = None, last: str | None = None) -> DataFrame:
    """Parts of a period, both ends included; other days are pruned before the scan."""
    parts = spark.read.schema(schema).parquet(root)
    if first is not None:
        parts = parts.where(F.col("ds") >= F.lit(first).cast("date"))
    if last is not None:
        parts = parts.where(F.col("ds") <= F.lit(last).cast("date"))
    return parts


def merged(parts: DataFrame, figures: Figures, by: Sequence[str] | None = None, quantiles: Sequence[float] = (0.5,)) -> DataFrame:
    """Figures of all given parts per key, or per ``by``, some of the keys.

    n, and per column: sum_, nulls_ and mean_ (exact), distinct_ (estimate), quantiles_ (an array,
    estimates; null without a value). Keys without rows are left out.
    """
    added = [F.sum("n").alias("n")]
    for c in figures.sums:
        added += [F.sum(f"sum_{c}").alias(f"sum_{c}"), F.sum(f"values_{c}").alias(f"values_{c}")]
    for c in figures.distinct:
        added.append(F.hll_union_agg(f"ids_{c}").alias(f"ids_{c}"))
    for c in figures.spread:
        added += [F.kll_merge_agg_double(f"ranks_{c}").alias(f"ranks_{c}"), F.sum(f"ranked_{c}").alias(f"ranked_{c}")]
    keys = figures.keys if by is None else tuple(by)
    out = parts.groupBy(*keys).agg(*added).where("n > 0")
    shown = [F.col(k) for k in keys] + [F.col("n")]
    for c in figures.sums:
        total, values = F.col(f"sum_{c}"), F.col(f"values_{c}")
        shown += [total, (F.col("n") - values).alias(f"nulls_{c}"), F.try_divide(total, values).alias(f"mean_{c}")]
    for c in figures.distinct:
        shown.append(F.hll_sketch_estimate(f"ids_{c}").alias(f"distinct_{c}"))
    for c in figures.spread:
        ranks = F.array(*[F.kll_sketch_get_quantile_double(F.col(f"ranks_{c}"), F.lit(float(q))) for q in quantiles])
        shown.append(F.when(F.col(f"ranked_{c}") > 0, ranks).alias(f"quantiles_{c}"))
    return out.select(*shown)
