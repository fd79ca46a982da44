"""Look-ups and paged searches over flights, airplanes and documents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.functions.text import tokens
from delaylens.operators.ranking import page

SEARCH_ORDER = ("FlightDate", "CRSDepTime", "Carrier", "FlightNum")


def matching(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Rows equal to every given value; a value of None or "" asks for nothing."""
    wanted = [F.col(c) == F.lit(v) for c, v in values.items() if v not in (None, "")]
    return df.where(reduce(lambda a, b: a & b, wanted, F.lit(True)))


def one(df: DataFrame, values: Mapping[str, object], order: Sequence[str]) -> DataFrame:
    """The first matching row in a fixed order."""
    return matching(df, values).orderBy(*order).limit(1)


def paged(df: DataFrame, order: Sequence[str | Column], start: int, end: int) -> DataFrame:
    """A page of an ordered result, each row with the number of all results."""
    total = df.agg(F.count("*").alias("n")).scalar()
    return page(df, order, start, end).withColumn("total", total)


def search(
    df: DataFrame, values: Mapping[str, object], order: Sequence[str] = SEARCH_ORDER,
    start: int = 0, end: int = 20,
) -> DataFrame:
    """Search by any combination of exact fields, ordered and paged."""
    return paged(matching(df, values), order, start, end)


def token_matches(column: str, query: str, prepared: bool = False) -> Column:
    """True where the text shares a word with the query; ``prepared`` for stored token arrays."""
    words = tokens(F.lit(query))
    return F.arrays_overlap(F.col(f"{column}_tokens") if prepared else tokens(F.col(column)), words)


def search_words(
    df: DataFrame, words: Mapping[str, str | None], order: Sequence[str | Column],
    start: int = 0, end: int = 20, prepared: bool = False,
) -> DataFrame:
    """Search where every given field shares a word with its query."""
    wanted = [token_matches(c, q, prepared) for c, q in words.items() if q]
    return paged(df.where(reduce(lambda a, b: a & b, wanted, F.lit(True))), order, start, end)


def carrier_page(fleets: DataFrame, names: DataFrame, code: str = "Carrier") -> DataFrame:
    """Fleets with the names of their carriers where these are known."""
    return fleets.join(names, code, "left")


#: Values of one filter that Spark still tests against Bloom filters one by one.
PUSHED = 10


def by_ids(table: DataFrame, column: str, ids: Sequence[object]) -> DataFrame:
    """Rows of a table of ``publish_by_id`` that hold one of a few ids, each row once.

    Up to ten ids make one pass that tests the Bloom filters of every row group; more make one
    pass per ten, each over the row groups that may hold its own. Null is no id. Many ids are a
    table of their own: use a semi-join.
    """
    wanted = sorted({i for i in ids if i is not None})
    if not wanted:
        return table.where("false")
    passes = [wanted[i : i + PUSHED] for i in range(0, len(wanted), PUSHED)]
    return reduce(DataFrame.unionByName, [table.where(reduce(lambda a, b: a | b, [F.col(column) == F.lit(v) for v in p])) for p in passes])
