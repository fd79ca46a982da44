"""Positions, pages and exact percentiles that no single task has to work out alone."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylens.session import checkpointed

# monotonically_increasing_id keeps the partition number above these bits, the row below.
_ROW_BITS = 33


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "position"
) -> DataFrame:
    """``row_number()`` per key, also where one key holds most of the rows.

    A window would send a whole key to one task. Here the rows are range-partitioned by key and
    order, so a large key spans many partitions; each row then knows its place within its
    partition, and the partition sizes (one small row each) turn that into a global place. The
    sorted rows are checkpointed because range boundaries are sampled: a second evaluation may
    cut elsewhere.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(k).asc_nulls_first() for k in keys]
    by += [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order]
    ordered = checkpointed(
        # The random last key spreads rows that tie in everything else.
        df.withColumn("_tie", F.rand(17))
        .repartitionByRange(n, *by, "_tie")
        .sortWithinPartitions(*by, "_tie")
        .withColumn("_id", F.monotonically_increasing_id())
        .drop("_tie")
    )
    part = F.shiftright("_id", _ROW_BITS)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    # One row per partition at most: a window over these and a broadcast are both bounded.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    placed = (
        ordered.withColumn("_part", part)
        .join(F.broadcast(earlier), "_part")
        .withColumn("_place", F.col("_offset") + F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1))
        .drop("_part", "_offset", "_id")
    )
    if not keys:
        return placed.withColumn(name, F.col("_place") + 1).drop("_place")
    renamed = [F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]
    starts = placed.groupBy(*renamed).agg(F.min("_place").alias("_start"))
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    )
    return placed.join(starts, same).select(
        *df.columns, (F.col("_place") - F.col("_start") + 1).alias(name)
    )


def page(df: DataFrame, order: Sequence[str | Column], start: int, end: int) -> DataFrame:
    """Rows ``start`` to ``end`` of an ordered result; ``order`` must settle every tie."""
    return df.orderBy(*order).offset(start).limit(max(end - start, 0))


def page_after(df: DataFrame, order: Sequence[str], last: Sequence, size: int) -> DataFrame:
    """The page behind the row ``last``: deep pages without walking over the earlier ones.

    ``last`` holds the last row's order values (not NULL); NULLs sort first.
    """
    beyond = F.lit(False)
    for i, (column, value) in enumerate(zip(order, last)):
        same = [F.col(c) == F.lit(v) for c, v in zip(order[:i], last[:i])]
        beyond = beyond | reduce(lambda a, b: a & b, same, F.col(column) > F.lit(value))
    return df.where(beyond).orderBy(*order).limit(size)


def offsets(start: int, end: int, size: int) -> dict[str, tuple[int, int]]:
    """Bounds of the next and the previous page, none below zero."""
    return {
        "next": (start + size, end + size),
        "previous": (max(start - size, 0), max(end - size, 0)),
    }


def exact_percentile(df: DataFrame, value: str, q: float) -> float | None:
    """Interpolated percentile, exact whatever the number of rows; None without values.

    The values are range-partitioned once and numbered; the two wanted ranks are looked up.
    ``percentile_approx`` is the cheaper choice where a bounded error in rank will do.
    """
    x = F.col(value).cast("double")
    numbered = number_rows(df.where(x.isNotNull()).select(x.alias("x")), [], ["x"], "i")
    n = numbered.count()
    if n == 0:
        return None
    wanted = (n - 1) * q
    first, last = math.floor(wanted) + 1, math.ceil(wanted) + 1
    pair = numbered.where(F.col("i").isin(first, last)).agg(F.min("x").alias("a"), F.max("x").alias("b")).first()
    return pair["a"] + (pair["b"] - pair["a"]) * (wanted + 1 - first)


def index_by_frequency(df: DataFrame, column: str) -> DataFrame:
    """Index of every value by falling frequency, ties in value order."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    numbered = number_rows(counts, [], [F.desc("n"), F.asc(column)], "_i")
    return numbered.select(
        column, (F.col("_i") - 1).cast(T.DoubleType()).alias("index"), "n"
    )
