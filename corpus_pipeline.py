"""A corpus from ``documents``: scored, deduplicated, decontaminated, mixed and sharded.

Each stage takes the documents that its predecessor left and returns those that it keeps, with
the columns of ``documents``; the last one adds the place of every document in the shards.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from delaylens.llm import decontaminate, mixing, ngramjoin, sharding, toxicity
from delaylens.llm.queries import low_quality, table, toxic_model
from delaylens.llm.scratch import Scratch


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is 0.5 or more go."""
    return toxicity.reject(docs, toxic_model(docs, spark, sf_dir))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays; see ``one_of_each_group``."""
    return ngramjoin.one_of_each_group(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs, quality=low_quality(spark, sf_dir))


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and slot."""
    text = F.coalesce("text", F.lit(""))
    return sharding.shard(docs, F.octet_length(text) + 16, (F.xxhash64(text), F.col("doc_id")))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", leaks),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: The first stage is a trained model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.store(stage(spark, docs, sf_dir))
    return docs
