"""Counts, averages, shares and punctuality figures, each in one pass over its input."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def sample_top(df: DataFrame, share: float, order: Sequence[str], k: int, seed: int) -> DataFrame:
    """The first ``k`` rows, by ``order``, of a sample that depends on the rows and the seed alone."""
    draw = F.pmod(F.xxhash64(F.lit(seed), *df.columns), F.lit(1_000_000))
    return df.where(draw < round(share * 1_000_000)).orderBy(*order).limit(k)


def top_by_count(df: DataFrame, keys: Sequence[str], k: int, name: str = "n") -> DataFrame:
    """The ``k`` most frequent keys; ties go to the smaller key."""
    return count_by(df, keys, name).orderBy(F.desc(name), *keys).limit(k)


def totals_in_order(df: DataFrame, keys: Sequence[str], name: str = "total") -> DataFrame:
    return count_by(df, keys, name).orderBy(*keys)


def punctuality(
    df: DataFrame, dep_late: str = "DepDelayMinutes", arr_late: str = "ArrDelayMinutes",
    dep: str = "DepDelay", arr: str = "ArrDelay",
) -> DataFrame:
    """Totals of late departures, late arrivals and recoveries, with the late arrivals in %."""
    late = F.count_if(F.col(arr_late) > 0)
    return df.agg(
        F.count("*").alias("total_flights"),
        F.count_if(F.col(dep_late) > 0).alias("late_departures"),
        late.alias("late_arrivals"),
        F.count_if((F.col(dep) > 0) & (F.col(arr) <= 0)).alias("recoveries"),
        F.round(late / F.count("*") * 100, 1).alias("pct_late"),
    )


def recovered(df: DataFrame, dep: str = "DepDelay", arr: str = "ArrDelay") -> DataFrame:
    """Rows that left late and yet arrived on time."""
    return df.where((F.col(dep) > 0) & (F.col(arr) <= 0))


def with_any(df: DataFrame, columns: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Rows where at least one of the columns is known."""
    kept = df.where(F.coalesce(*columns).isNotNull())
    return kept.orderBy(*order) if order else kept


def averages(df: DataFrame, columns: Mapping[str, str], digits: int = 1) -> DataFrame:
    return df.agg(*[F.round(F.avg(c), digits).alias(name) for c, name in columns.items()])


def sums(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.sum(c).alias(f"sum_{c}") for c in columns])


def shares_of_sum(
    df: DataFrame, parts: Mapping[str, str], whole: str, digits: int = 1
) -> DataFrame:
    """Sum of each part as a percentage of the sum of ``whole``."""
    return df.agg(
        *[F.round(F.sum(c) / F.sum(whole) * 100, digits).alias(n) for c, n in parts.items()]
    )


def mean_by(
    df: DataFrame, keys: Sequence[str], value: str, name: str, ordered: bool = True
) -> DataFrame:
    out = df.groupBy(*keys).agg(F.avg(value).alias(name))
    return out.orderBy(*keys) if ordered else out


def spread_by_hour(df: DataFrame, at: str, value: str, shift: int = 1) -> DataFrame:
    """Mean and sample deviation per hour of the day; hours are shown from 1."""
    return (
        df.groupBy((F.hour(at) + shift).alias("hour"))
        .agg(
            F.round(F.avg(value), 4).alias("avg_value"),
            F.round(F.stddev_samp(value), 4).alias("std_value"),
        )
        .orderBy("hour")
    )


def distinct_count(df: DataFrame, column: str, name: str, *, error: float | None = None) -> DataFrame:
    """Number of distinct texts, NULL and empty left out; a sketch when an error is allowed."""
    kept = df.where(F.col(column).isNotNull() & (F.col(column) != ""))
    if error is None:
        # Distinct first: the values are spread over the cluster instead of held by one task.
        return kept.select(column).distinct().agg(F.count("*").alias(name))
    return kept.agg(F.approx_count_distinct(column, error).alias(name))


def distinct_rows(df: DataFrame, columns: Sequence[str], ordered: bool = True) -> DataFrame:
    out = df.select(*columns).distinct()
    return out.orderBy(*columns) if ordered else out


def distinct_ends(df: DataFrame, first: str, second: str, name: str) -> DataFrame:
    """Every value of either column once, as for the airports at both ends of a route."""
    ends = [df.select(F.col(c).alias(name)).distinct() for c in (first, second)]
    return ends[0].unionByName(ends[1]).distinct()


def extremes(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Number of NULLs per column, all columns counted in the same scan."""
    names = list(columns or df.columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in names])
    return counted.unpivot([], names, "column_name", "nulls")


def share_of_total(
    df: DataFrame, keys: Sequence[str], *, k: int | None = None, digits: int = 2
) -> DataFrame:
    """Count per key, the overall count and the percentage, most frequent first.

    The overall count is an uncorrelated scalar subquery: it is computed once and needs neither
    a join nor a window over all groups.
    """
    overall = df.agg(F.count("*").alias("n")).scalar()
    counted = count_by(df, keys, "total").withColumn("overall_total", overall)
    shared = counted.withColumn(
        "percentage", F.round(F.col("total") * 100.0 / F.col("overall_total"), digits)
    ).orderBy(F.desc("total"), *keys)
    return shared.limit(k) if k is not None else shared


def compare_counts(left: DataFrame, right: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """Counts per value in two columns side by side, zero where a value is absent."""
    a, b = count_by(left, [key], names[0]), count_by(right, [key], names[1])
    return a.join(b, key, "full").na.fill(0, list(names))


def chart_document(df: DataFrame, key: str, label: str, value: str, k: int) -> DataFrame:
    """One row with the ``k`` largest values and their labels as an ordered array."""
    item = F.struct((-F.col(value)).alias("rank"), F.col(label).alias("label"), F.col(value).alias("value"))
    ranked = df.orderBy(F.desc(value), label).limit(k).agg(F.sort_array(F.collect_list(item)).alias("data"))
    shown = F.transform("data", lambda x: F.struct(x["label"].alias("label"), x["value"].alias("value")))
    return ranked.select(F.lit(key).alias("key"), shown.alias("data"))
