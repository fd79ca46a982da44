"""Search by posting lists: for each word of a field, the sorted numbers of the rows that hold it.

Rows are numbered in the order in which results are listed, so a page of results is the smallest
numbers that all lists share, and nothing is sorted when a search is answered. Lists are cut into
blocks of rows, so a word that most rows hold spans many short lists. A search reads the lists of
its own words (the table is clustered by field and word), shares them out by block from the rarest
word on, and then reads the rows of the page by number, which file and row-group statistics find.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaylens.functions.text import tokens
from delaylens.operators.ranking import number_rows
from delaylens.session import workspace
from delaylens.sources.writers import materialize, write_table

#: Rows of a block of a list; rows of a rarest word up to which only their blocks are read of others.
BLOCK, RARE = 1 << 16, 1_000
#: Row numbers in a range of lists that one task writes.
RANGE = 4_000_000
ROW = "_row"
_POSTINGS = "field string, token string, block bigint, rows array<bigint>"
_TERMS = "field string, token string, frequency bigint"


@dataclass(frozen=True)
class Index:
    """Rows by number, posting lists, and how many rows hold each word."""

    rows: DataFrame
    postings: DataFrame
    terms: DataFrame
    words: tuple[str, ...]


def build(
    df: DataFrame, path: str, order: Sequence[str], words: Sequence[str] = (), values: Sequence[str] = (), block: int = BLOCK
) -> Index:
    """Write the index of ``df`` to ``path``: ``words`` fields by token, ``values`` fields as a whole.

    ``order`` is that of results, null first; rows that tie in all of it come in any order.
    """
    numbered = number_rows(df, [], order, ROW)
    # The partitions of numbered rows are ranges of the order already.
    write_table(numbered.withColumn(ROW, F.col(ROW) - 1), f"{path}/rows")
    spark = df.sparkSession
    rows = _read(spark, f"{path}/rows", _rows(df.schema))
    listed = [F.transform(F.array_distinct(tokens(F.col(c))), partial(_term, c)) for c in words]
    whole = [F.when(F.col(c).cast("string") != "", F.array(_term(c, F.col(c).cast("string")))) for c in values]
    none = F.array().cast("array<struct<field: string, token: string>>")
    terms = F.concat(*[F.coalesce(x, none) for x in listed + whole])
    held = rows.select(ROW, F.explode(terms).alias("_t")).select(ROW, "_t.field", "_t.token")
    lists = held.groupBy("field", "token", F.expr(f"{ROW} div {block}").alias("block")).agg(F.array_sort(F.collect_list(ROW)).alias("rows"))
    _write_lists(lists, f"{path}/postings")
    postings = _read(spark, f"{path}/postings", _POSTINGS)
    frequency = postings.groupBy("field", "token").agg(F.sum(F.size("rows")).alias("frequency"))
    write_table(frequency.repartitionByRange("field", "token").sortWithinPartitions("field", "token"), f"{path}/terms")
    return opened(spark, path, df.schema, words)


def _write_lists(lists: DataFrame, path: str) -> None:
    """Write the lists in ranges of field, word and block, of much the same size in bytes.

    Ranges hold much the same number of lists, and a word of half of all rows has lists thousands
    of times as long as those of a rare one. So lists are ranged apart by the power of four of
    their length.
    """
    by = ["field", "token", "block"]
    sized = lists.withColumn("_class", F.floor(F.log(4.0, F.size("rows").cast("double"))).cast("int"))
    held = materialize(sized, workspace(lists.sparkSession, "lists"))
    write_table(held.drop("_class").limit(0), path)
    for found in held.groupBy("_class").agg(F.sum(F.size("rows")).alias("n")).orderBy("_class").collect():
        parts = -(-found.n // RANGE)
        ranged = held.where(F.col("_class") == found["_class"]).drop("_class").repartitionByRange(parts, *by)
        write_table(ranged.sortWithinPartitions(*by), path, "append")


def opened(spark: SparkSession, path: str, schema: T.StructType, words: Sequence[str] = ()) -> Index:
    """The index at ``path`` of rows of ``schema``."""
    kinds = {"rows": _rows(schema), "postings": _POSTINGS, "terms": _TERMS}
    return Index(*(_read(spark, f"{path}/{name}", kind) for name, kind in kinds.items()), tuple(words))


def _rows(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(ROW, T.LongType())])


def _read(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """With a declared schema, no file is opened before a search."""
    return spark.read.schema(schema).parquet(path)


def _term(field: str, token: Column) -> Column:
    return F.struct(F.lit(field).alias("field"), token.alias("token"))


def _asked(index: Index, wanted: Mapping[str, object], every: bool) -> list[tuple[str, list[str]]]:
    """Conditions that must all hold, each a field and words of which it has one."""
    given = {f: v for f, v in wanted.items() if v not in (None, "")}
    texts = [f for f in given if f in index.words]
    split = []
    if texts:
        one = index.terms.sparkSession.range(1).select(*[F.array_distinct(tokens(F.lit(given[f]))).alias(f) for f in texts])
        split = [(f, list(found)) for f, found in zip(texts, one.first())]
    if every:
        split = [(f, [t]) for f, found in split for t in found]
    return split + [(f, [str(v)]) for f, v in given.items() if f not in index.words]


def matches(index: Index, wanted: Mapping[str, object], every: bool = False) -> DataFrame:
    """(block, rows): the numbers of the rows that meet all conditions.

    A words field shares a word with its query, or has all of its words if ``every`` is set; any
    other field equals its value. None and "" ask for nothing.
    """
    asked = _asked(index, wanted, every)
    if not asked:
        everything = index.rows.groupBy(F.expr(f"{ROW} div {BLOCK}").alias("block"))
        return everything.agg(F.array_sort(F.collect_list(ROW)).alias("rows"))
    holds = lambda f, found: (F.col("field") == f) & F.col("token").isin(found)
    known = index.terms.where(reduce(lambda a, b: a | b, [holds(*a) for a in asked])).collect()
    frequency = {(r.field, r.token): r.frequency for r in known}
    costs = [(sum(frequency.get((f, t), 0) for t in found), f, found) for f, found in asked]
    costs.sort(key=lambda c: c[0])
    out, blocks = None, None
    for _, field, found in costs:
        lists = index.postings.where(holds(field, found))
        if blocks is not None:
            lists = lists.where(F.col("block").isin(blocks))
        if len(found) > 1:
            lists = lists.groupBy("block").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("rows")))).alias("rows"))
        lists = lists.select("block", F.col("rows").alias("_next"))
        if out is None:
            out = lists.withColumnRenamed("_next", "rows")
            if len(costs) > 1 and costs[0][0] <= RARE:
                blocks = [r.block for r in out.select("block").collect()]
        else:
            out = out.join(lists, "block").select("block", F.array_intersect("rows", "_next").alias("rows"))
    return out.where(F.size("rows") > 0)


def search(index: Index, wanted: Mapping[str, object], start: int = 0, end: int = 20, every: bool = False) -> DataFrame:
    """A page of the rows that meet all conditions (see ``matches``), with the number of all.

    The numbers of the page come to the driver, so a page is meant to be small.
    """
    found = matches(index, wanted, every)
    first = found.orderBy("block").limit(max(end, 0)).select(F.explode("rows").alias(ROW))
    listed = first.orderBy(ROW).offset(start).limit(max(end - start, 0)).select(ROW, F.lit(None).cast("long").alias("n"))
    counted = found.agg(F.sum(F.size("rows")).alias("n")).select(F.lit(None).cast("long").alias(ROW), "n")
    # Both in one query, which reads the lists once.
    answer = listed.unionByName(counted).collect()
    page = [r[ROW] for r in answer if r[ROW] is not None]
    total = next(r.n for r in answer if r[ROW] is None) or 0
    rows = index.rows.where(F.col(ROW).isin(page)) if page else index.rows.where(F.lit(False))
    ordered = rows.orderBy(ROW).limit(max(len(page), 1))
    return ordered.drop(ROW).withColumn("total", F.lit(total).cast("long"))
