"""JSON documents whose fields differ by row: which fields they hold, and typed columns of them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of values by the first word of their variant type.
KINDS = {
    "OBJECT": "object", "ARRAY": "list", "STRING": "text", "BOOLEAN": "truth", "VOID": "nothing",
    "BIGINT": "whole", "DECIMAL": "fraction", "DOUBLE": "fraction", "FLOAT": "fraction",
}


def kind_of(value: Column) -> Column:
    """``object``, ``list``, ``text``, ``truth``, ``nothing``, ``whole`` or ``fraction``; other types are ``other``.

    A decimal without digits behind the point is whole, so a number's kind does not hang on its size.
    """
    whole = F.schema_of_variant(value)
    kind = F.coalesce(*[F.when(whole.startswith(t), F.lit(k)) for t, k in KINDS.items()], F.lit("other"))
    return F.when(whole.rlike(r"^DECIMAL\(\d+,0\)"), F.lit("whole")).otherwise(kind)


def fields(df: DataFrame, text: str, *by: str, depth: int = 3) -> DataFrame:
    """How often each field of the documents in ``text`` holds a value of each kind.

    One row per ``by``, ``path`` and ``kind`` with ``n``. The path of a field in an object within
    ``depth`` levels is ``a.b``, items of a list are ``a[]``, and the document itself is ``$``;
    what lies deeper is counted as part of its object or list only. A text that is no JSON counts
    as kind ``unreadable`` of ``$``, a null as ``missing``. Fields are found in all rows.

    The documents are read once: a row is exploded level by level, and an object or list that
    gives several rows is counted with its first item.
    """
    level = df.select(*[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)], F.col(text).cast("string").alias("_text"))
    level = level.withColumn("_v0", F.try_parse_json("_text")).withColumns({"_p0": F.lit("$"), "_n0": F.lit(0)})
    for i in range(depth):
        items = df.sparkSession.tvf.variant_explode_outer(F.col(f"_v{i}").outer())
        level = level.lateralJoin(items.toDF("_pos", "_key", "_value"))
        held = F.when(F.col("_key").isNotNull(), F.concat(f"_p{i}", F.lit("."), "_key")).otherwise(F.concat(f"_p{i}", F.lit("[]")))
        level = level.withColumns({f"_p{i + 1}": held, f"_n{i + 1}": F.col("_pos"), f"_v{i + 1}": F.col("_value")})
        level = level.drop("_pos", "_key", "_value")
    parsed = F.col("_v0").isNotNull()
    root = F.when(parsed, kind_of(F.col("_v0"))).otherwise(F.when(F.col("_text").isNull(), "missing").otherwise("unreadable"))
    entries = []
    for i in range(depth + 1):
        first = F.lit(True)
        for j in range(i + 1, depth + 1):
            first = first & (F.coalesce(f"_n{j}", F.lit(0)) == 0)
        here = F.lit(True) if i == 0 else F.col(f"_n{i}").isNotNull()
        kind = root if i == 0 else kind_of(F.col(f"_v{i}"))
        entries.append(F.when(first & here, F.struct(F.col(f"_p{i}").alias("path"), kind.alias("kind"))))
    keys = [f"_by{i}" for i in range(len(by))]
    flat = level.select(*keys, F.explode(F.array_compact(F.array(*entries))).alias("_e"))
    path = F.when(F.col("_e.path") == "$", "$").otherwise(F.regexp_replace("_e.path", r"^\$\.?", ""))
    counted = flat.groupBy(*keys, path.alias("path"), F.col("_e.kind").alias("kind")).agg(F.count("*").alias("n"))
    return counted.select(*[F.col(k).alias(c) for k, c in zip(keys, by)], "path", "kind", "n")


def schema_of(df: DataFrame, text: str) -> str:
    """The least schema, as a type in SQL, that holds the documents of all rows."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(text).cast("string")))).first()[0]


def typed(df: DataFrame, text: str, columns: Mapping[str, tuple[str, str]], problems: str = "problems") -> DataFrame:
    """``df`` with a column of each (path, type) in the documents of ``text``.

    A field that a document lacks, or holds as null, is null. So is one that does not fit its
    type, and ``problems`` lists the columns where that happened, in the order of ``columns``;
    it is null where the text is no JSON, and empty for a null text. Added columns replace those
    of the same name. Paths are like ``$.a.b`` or ``$.a[0]``.
    """
    kept = [c for c in df.columns if c not in columns and c != problems]
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"), F.col(text).cast("string").alias("_text"))
    rows = rows.withColumn("_doc", F.try_parse_json("_text"))
    values = {name: F.try_variant_get("_doc", path, kind) for name, (path, kind) in columns.items()}
    told = []
    for name, (path, _) in columns.items():
        inner = F.try_variant_get("_doc", path, "variant")
        there = inner.isNotNull() & ~F.coalesce(F.is_variant_null(inner), F.lit(False))
        told.append(F.when(there & values[name].isNull(), F.lit(name)))
    listed = F.array_compact(F.array(*told)) if told else F.expr("CAST(array() AS array<string>)")
    readable = F.col("_doc").isNotNull() | F.col("_text").isNull()
    return rows.select(
        *[F.col(f"_row.`{c}`") for c in kept],
        *[v.alias(n) for n, v in values.items()], F.when(readable, listed).alias(problems),
    )
