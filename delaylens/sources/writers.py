"""Writers: tables, JSON lines, replaced days, published collections, stored intermediates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.functions.text import tokens


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    # Whole-table replacement, whatever the session says about partition overwrites.
    df.write.mode(mode).option("partitionOverwriteMode", "static").parquet(path)


def write_json_lines(
    df: DataFrame, path: str, *, compression: str = "none", single_file: bool = False
) -> None:
    """One JSON object per line. A single file is for small results only: one task writes it."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("compression", compression).json(path)


def to_json_rows(df: DataFrame, name: str = "value") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.to_json(F.struct("*")).alias(name))


def write_text(df: DataFrame, path: str, compression: str = "none") -> None:
    df.write.mode("overwrite").option("compression", compression).text(path)


def write_days(df: DataFrame, root: str, day: str | Column) -> None:
    """Replace exactly the days present in ``df``; a rerun of a day leaves the others alone.

    ``rebalance`` sizes the files: a heavy day is split over several tasks and thin ones are
    gathered, so no task holds a day on its own.
    """
    column = F.col(day) if isinstance(day, str) else day
    (
        df.withColumn("ds", column.cast("date"))
        .hint("rebalance", "ds")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ds")
        .parquet(root)
    )


def publish(
    df: DataFrame, path: str, key: Sequence[str], mode: str = "append", search: Sequence[str] = (),
    columns: Mapping[str, Column] | None = None,
) -> None:
    """Write a table for look-ups by ``key``.

    Rows are range-partitioned and sorted by the key, so file and row-group statistics let a
    key filter skip nearly everything. Rows of one key are told apart by a hash of all columns,
    so a key with a large part of the rows, or none, still spans several tasks. Columns in
    ``search`` also get a token array.

    The bounds of the ranges take ``df`` a time of their own. Stored columns that take work are
    better given as ``columns``, by name: they are worked out once, from rows that are dealt out.
    ``df`` then has just what they read.
    """
    made = dict(columns) if columns else {c: F.col(f"`{c}`") for c in df.columns}
    tie = F.xxhash64(*df.columns)
    out = df.repartitionByRange(*[made[c] for c in key], tie).select(*[e.alias(c) for c, e in made.items()])
    if search:
        out = out.withColumns({f"{c}_tokens": tokens(F.col(c)) for c in search})
    write_table(out.sortWithinPartitions(*key), path, mode)


def replace_record(df: DataFrame, path: str) -> None:
    """Replace a collection that holds one record."""
    write_table(df.coalesce(1), path)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Store an expensive intermediate and go on from the stored table."""
    write_table(df, path)
    spark: SparkSession = df.sparkSession
    return spark.read.schema(df.schema).parquet(path)


def publish_by_id(
    df: DataFrame, path: str, ids: Sequence[str], order: Sequence[str] = (), *,
    per_group: int = 1_000_000, group_bytes: int = 128 << 20, mode: str = "append",
) -> None:
    """Write a table for look-ups by ids of which nearly every row has its own.

    Statistics of smallest and largest values can't serve several ids at once, nor ids that are
    random in the ``order`` of the table. Each row group therefore gets a Bloom filter of each
    id, made for ``per_group`` different ids; a filter on an id then reads row groups that hold
    it, and about one in a hundred of the others. Rows are range-partitioned by ``order``, told
    apart by a hash of all columns, so no value of it has to fit one task.
    """
    if order:
        df = df.repartitionByRange(*order, F.xxhash64(*df.columns)).sortWithinPartitions(*order)
    out = df.write.mode(mode).option("partitionOverwriteMode", "static").option("parquet.block.size", group_bytes)
    for name in ids:
        out = out.option(f"parquet.bloom.filter.enabled#{name}", "true")
        out = out.option(f"parquet.bloom.filter.expected.ndv#{name}", per_group)
        # Row groups whose pages all have a dictionary would be tested by that, which is larger.
        out = out.option(f"parquet.enable.dictionary#{name}", "false")
    out.parquet(path)


def write_delimited(
    df: DataFrame, path: str, *, header: bool = True, sep: str = ",", null_token: str = "", compression: str = "none"
) -> None:
    """Delimited text. Empty texts are written as nothing, so with an empty ``null_token`` they read back as NULL."""
    df.write.mode("overwrite").options(header=header, sep=sep, nullValue=null_token, emptyValue="", compression=compression).csv(path)
