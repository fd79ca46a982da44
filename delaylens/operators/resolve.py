"""Name resolution: spellings that share a long beginning are mapped to it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.functions.text import stripped

MIN_SHARED = 6


def shared_beginnings(df: DataFrame, name: str, min_length: int = MIN_SHARED) -> DataFrame:
    """Pairs (name, beginning): the longest beginnings a name shares with some other name.

    Comparing all pairs is not needed. A text is the longest common beginning of two names
    exactly if the names that start with it go on in at least two ways (ending there counts as
    one), and then it is so for each of these names. So the beginnings of every distinct name
    are grouped, and those whose smallest and largest continuation differ are kept: work grows
    with the total length of the names. White space at the ends is stripped from a beginning,
    which must then have ``min_length`` characters.
    """
    names = df.select(F.col(name).alias("name")).where(F.col(name).isNotNull()).distinct()
    lengths = F.when(
        F.length("name") >= min_length, F.sequence(F.lit(min_length), F.length("name"))
    )
    cuts = names.select("name", F.explode(lengths).alias("at")).select(
        "name",
        F.col("name").substr(F.lit(1), F.col("at")).alias("start"),
        F.col("name").substr(F.col("at") + 1, F.lit(1)).alias("following"),
    )
    branching = (
        cuts.groupBy("start")
        .agg(F.min("following").alias("least"), F.max("following").alias("most"))
        .where(F.col("least") < F.col("most"))
        .select("start")
    )
    return (
        cuts.join(branching, "start", "left_semi")
        .select("name", stripped(F.col("start")).alias("beginning"))
        .where(F.length("beginning") >= min_length)
        .distinct()
    )


def name_mapping(df: DataFrame, name: str, mode: str = "one", min_length: int = MIN_SHARED) -> DataFrame:
    """Raw name → resolved name: the shortest beginning, or all of them with ``mode="all"``."""
    pairs = shared_beginnings(df, name, min_length)
    if mode == "all":
        return pairs.select(F.col("name").alias("raw"), F.col("beginning").alias("resolved"))
    shortest = F.min(F.struct(F.length("beginning").alias("n"), F.col("beginning").alias("b")))
    return pairs.groupBy(F.col("name").alias("raw")).agg(shortest.alias("_s")).select(
        "raw", F.col("_s.b").alias("resolved")
    )


def resolve_names(df: DataFrame, name: str, mode: str = "one", min_length: int = MIN_SHARED) -> DataFrame:
    """``df`` with mapped names replaced. ``mode="all"`` repeats a row for each of its mappings."""
    mapping = name_mapping(df, name, mode, min_length)
    joined = df.join(mapping, F.col(name) == F.col("raw"), "left")
    return joined.select(
        *[F.coalesce("resolved", name).alias(name) if c == name else F.col(c) for c in df.columns]
    )
