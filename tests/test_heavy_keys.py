"""Operators that must stay right when one key holds most of the rows."""

import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from delaylens.operators import documents, joins
from delaylens.operators.ranking import (
    exact_percentile, index_by_frequency, number_rows, offsets, page, page_after,
)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(5)
    data = [("hot" if rng.random() < 0.6 else rng.choice(["a", "b", None, ""]), rng.randrange(50), i % 7)
            for i in range(3000)]
    return spark.createDataFrame(data, "k string, v int, w int").repartition(5).cache()


def test_positions_equal_a_window(skewed):
    exact = F.row_number().over(Window.partitionBy("k").orderBy("v", "w"))
    expected = skewed.withColumn("position", exact.cast("bigint"))
    found = number_rows(skewed, ["k"], ["v", "w"])
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_positions_without_key(skewed):
    found = number_rows(skewed, [], [F.desc("v"), "w"], "i").orderBy("i").collect()
    assert [r.i for r in found] == list(range(1, 3001))
    assert [(-r.v, r.w) for r in found] == sorted((-r.v, r.w) for r in found)


def test_large_documents_come_in_parts(skewed):
    whole = documents.unfold(documents.gather(skewed, ["k"], ["v", "w"]), ["k"])
    docs = documents.gather(skewed, ["k"], ["v", "w"], part_size=100)
    assert docs.agg(F.max(F.size("items")).alias("m")).first().m <= 100
    parts = documents.unfold(docs, ["k"], part_size=100)
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))
    assert parts.count() == 3000


def test_joined_texts_keep_repeats(spark):
    df = spark.createDataFrame([("x", "b"), ("x", "a"), ("x", "b"), ("y", "c")], "k string, t string")
    found = {r.k: r.out for r in documents.joined_texts(df, "k", "t", "out").collect()}
    assert found == {"x": "a, b, b", "y": "c"}


def test_fleets_count_missing_members_apart(spark):
    df = spark.createDataFrame([("AA", "N2"), ("AA", "N1"), ("AA", ""), ("AA", None), ("AA", "N1"), ("BB", "")], "Carrier string, TailNum string")
    found = {r.Carrier: (r.members, r.fleet_count, r.raw_count) for r in documents.fleets(df).collect()}
    assert found == {"AA": (["N1", "N2"], 2, 4), "BB": (None, 0, 1)}


@pytest.mark.parametrize("q", [0.0, 0.5, 0.37, 1.0])
def test_exact_percentile(spark, q):
    rng = random.Random(2)
    values = [rng.choice([7.0, rng.gauss(0, 9)]) for _ in range(5001)]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(4)
    expected = df.agg(F.percentile("v", q).alias("p")).first().p
    assert exact_percentile(df, "v", q) == pytest.approx(expected)
    if q == 0.5:
        assert expected == pytest.approx(statistics.median(values))


def test_exact_percentile_of_few_values(spark):
    df = spark.createDataFrame([(float(i % 2),) for i in range(1000)] + [(None,)], "v double")
    assert exact_percentile(df, "v", 0.5) == 0.5
    assert exact_percentile(df.where("v > 5"), "v", 0.5) is None


def test_index_by_frequency_matches_the_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.createDataFrame([(c,) for c in "bbbaacczzzd"], "c string")
    fitted = StringIndexer(inputCol="c", outputCol="i").fit(df)
    found = {r.c: r["index"] for r in index_by_frequency(df, "c").collect()}
    assert found == {label: float(i) for i, label in enumerate(fitted.labels)}


def test_pages(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("a"), "id")
    first = page(df, ["a", "id"], 0, 20).collect()
    second = page(df, ["a", "id"], 20, 40).collect()
    assert page_after(df, ["a", "id"], [first[-1].a, first[-1].id], 20).collect() == second
    assert len({r.id for r in first + second}) == 40
    assert offsets(0, 20, 20) == {"next": (20, 40), "previous": (0, 0)}


def test_enrich_keeps_rows_without_key(spark):
    facts = spark.createDataFrame([("N1", 1), ("", 2), (None, 3), ("N9", 4)], "TailNum string, i int")
    planes = spark.createDataFrame([("N1", "Boeing")], "TailNum string, Maker string")
    found = {r.i: r.Maker for r in joins.enrich(facts, planes, "TailNum", ["Maker"]).collect()}
    assert found == {1: "Boeing", 2: "Empty", 3: "Empty", 4: "Empty"}


def test_enrich_spreads_rows_without_key(spark):
    facts = spark.range(8000).selectExpr("id i", "CASE id % 4 WHEN 0 THEN '' WHEN 1 THEN concat('N', id) END AS TailNum")
    planes = spark.range(1, 8000, 8).selectExpr("concat('N', id) TailNum", "concat('M', id) Maker")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        joined = joins.enrich(facts, planes, "TailNum", ["Maker"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 8000 and max(sizes) < 2 * 8000 / int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert joined.where("Maker <> 'Empty'").count() == 1000
        assert joined.where("Maker <> 'Empty' AND substring(Maker, 2) <> substring(TailNum, 2)").isEmpty()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_enrich_never_takes_a_hash_for_a_key(spark):
    facts = spark.createDataFrame([(None, 1), ("", 2)], "TailNum string, i int")
    hashes = [r[0] for r in facts.select(F.xxhash64("TailNum", "i").cast("string")).collect()]
    planes = spark.createDataFrame([(h, "Wrong") for h in hashes], "TailNum string, Maker string")
    assert {r.Maker for r in joins.enrich(facts, planes, "TailNum", ["Maker"]).collect()} == {"Empty"}


def test_status_of_repeated_answers(spark):
    asked = spark.createDataFrame([("u1",), ("u2",)], "UUID string")
    answers = spark.createDataFrame([("u1", 2.0), ("u1", 2.0)], "UUID string, Prediction double")
    found = {r.UUID: (r.status, r.Prediction) for r in joins.with_status(asked, answers, "UUID", ["Prediction"]).collect()}
    assert found == {"u1": ("OK", 2.0), "u2": ("WAIT", None)}
