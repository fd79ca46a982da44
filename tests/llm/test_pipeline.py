"""The pipeline's stages on the smallest tables."""

from pyspark.sql import functions as F

import corpus_pipeline
from delaylens.llm import decontaminate, toxicity
from delaylens.llm.queries import QUERIES, toxic_model
from delaylens.llm.ngramjoin import jaccard_groups


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, docs
    by_name = dict(corpus_pipeline.STAGES)
    assert list(by_name) == ["toxicity", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "sharding"]

    kept = by_name["toxicity"](spark, docs, folder)
    bad = toxicity.score(docs, toxic_model(docs, spark, folder)).where("score >= 0.5").select("doc_id")
    assert kept.columns == columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.join(bad, "doc_id", "left_anti").collect()}

    seen = by_name["ngram_jaccard_join"](spark, kept, folder)
    groups = jaccard_groups(kept)
    assert seen.columns == columns and seen.count() == groups.where("n_shingles = 0").count() + groups.where("n_shingles > 0").select("component_id").distinct().count()
    assert seen.join(groups.where("doc_id = component_id"), "doc_id", "left_anti").count() == 0

    clean = by_name["benchmark_decontamination"](spark, seen, folder)
    leaks = decontaminate.find_leaks(seen, spark.read.parquet(f"{folder}/benchmark.parquet"))
    assert clean.columns == columns and clean.count() == seen.count() - leaks.select("doc_id").distinct().count()

    mixed = by_name["mixing"](spark, clean, folder)
    assert mixed.columns == columns and mixed.groupBy("doc_id").count().where("count > 3").isEmpty()
    sizes = [d.agg(F.sum(F.size(F.split(F.trim("text"), r"\s+")))).first()[0] for d in (clean, mixed)]
    assert abs(sizes[1] - sizes[0]) < 0.1 * sizes[0]

    placed = by_name["sharding"](spark, mixed, folder)
    assert placed.count() == mixed.count() and set(columns) < set(placed.columns)


def test_every_operator_is_registered():
    assert {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 14))
