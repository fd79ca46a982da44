"""Entity documents: the rows of a key gathered into ordered arrays of bounded length."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.operators.ranking import number_rows
from delaylens.operators.summary import distinct_rows

PART_SIZE = 50_000


def gather(
    df: DataFrame,
    keys: Sequence[str],
    items: Sequence[str],
    name: str = "items",
    part_size: int = PART_SIZE,
) -> DataFrame:
    """One document per key: its rows as an array of structs sorted by ``items``.

    A key with more than ``part_size`` rows becomes several documents, ``part`` 0, 1, …, which
    together hold all its rows in order: neither a task nor a row ever takes in an unbounded
    group. Keys are counted first (partial counts, so hot keys shuffle little); ordinary keys
    are gathered at once, and only the heavy ones take the numbered way. NULL is a key too.
    """
    sizes = df.groupBy(*keys).agg(F.count("*").alias("_size"))
    heavy = sizes.where(F.col("_size") > part_size).select(
        *[F.col(k).alias(f"_h{i}") for i, k in enumerate(keys)]
    )
    rows = df.select(*keys, *[c for c in items if c not in keys])
    same = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_h{i}")) for i, k in enumerate(keys)]
    )
    light = rows.join(heavy, same, "left_anti").withColumn("part", F.lit(0).cast("bigint"))
    numbered = number_rows(rows.join(heavy, same, "left_semi"), keys, items, "_n")
    split = numbered.withColumn("part", F.expr(f"(_n - 1) div {part_size}")).drop("_n")
    return _collect(light.unionByName(split), keys, items, name)


def _collect(df: DataFrame, keys: Sequence[str], items: Sequence[str], name: str) -> DataFrame:
    item = F.struct(*items)
    return df.groupBy(*keys, "part").agg(F.sort_array(F.collect_list(item)).alias(name))


def unfold(
    documents: DataFrame, keys: Sequence[str], name: str = "items", part_size: int = PART_SIZE
) -> DataFrame:
    """The rows of the documents with their position in the key, counted from 1."""
    rows = documents.select(*keys, "part", F.posexplode(name).alias("_at", "_item"))
    position = F.col("part") * part_size + F.col("_at") + 1
    fields = [f for f in documents.schema[name].dataType.elementType.names if f not in keys]
    return rows.select(
        *keys, position.alias("position"), *[F.col(f"_item.{f}").alias(f) for f in fields]
    )


def joined_texts(
    df: DataFrame, key: str, text: str, name: str, sep: str = ", ", part_size: int = PART_SIZE
) -> DataFrame:
    """The sorted texts of each key in one string; repeats are kept.

    A key with more than ``part_size`` texts comes as several numbered parts.
    """
    docs = gather(df, [key], [text], "texts", part_size)
    return docs.select(
        key, "part", F.array_join(F.transform("texts", lambda t: t[text]), sep).alias(name)
    )


def fleets(
    df: DataFrame, owner: str = "Carrier", member: str = "TailNum", part_size: int = PART_SIZE
) -> DataFrame:
    """Members per owner: sorted list without NULL and empty, its size, and the raw number.

    ``raw_count`` also counts the NULL and empty members that the list leaves out.
    """
    pairs = distinct_rows(df, [owner, member], ordered=False)
    known = F.col(member).isNotNull() & (F.col(member) != "")
    counts = pairs.groupBy(owner).agg(
        F.count_if(known).alias("fleet_count"), F.count("*").alias("raw_count")
    )
    lists = gather(pairs.where(known), [owner], [member], "members", part_size)
    members = F.transform("members", lambda m: m[member]).alias("members")
    return (
        counts.join(lists, owner, "left")
        .select(owner, F.coalesce("part", F.lit(0)).alias("part"), members, "fleet_count", "raw_count")
    )


def observations_by_day(
    df: DataFrame, station: str, at: str, measures: Sequence[str], part_size: int = PART_SIZE
) -> DataFrame:
    """Observations of each station and UTC day, ordered by time."""
    dated = df.withColumn("date", F.to_date(at))
    return gather(dated, [station, "date"], [at, *measures], "observations", part_size)


def with_profile(
    documents: DataFrame, profiles: DataFrame, key: str, fields: Sequence[str | Column]
) -> DataFrame:
    """Documents joined to the profile of their key, the profile as one struct."""
    profile = profiles.select(key, F.struct(*fields).alias("profile"))
    return documents.join(profile, key)
