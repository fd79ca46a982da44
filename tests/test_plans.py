"""Plans must keep what makes the operators scale."""

import re

import pytest
from pyspark.sql import functions as F

from delaylens.plans import QUERIES

# Bound queries that fit or apply models, or run a stream.
RUN_ON_BUILD = {
    "train_score_rf", "cv_metrics", "feature_importances", "train_score_regression", "batch_score_day",
    "train_score_boosted", "stream_score", "stream_parse", "stream_dedupe", "regression_metrics",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - RUN_ON_BUILD))
def test_no_python_and_no_cross_join(name, spark, folder):
    text = plan(QUERIES[name](spark, folder))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonRDD", text)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_unused_tables_are_not_read(spark, folder):
    text = plan(QUERIES["punctuality_kpis"](spark, folder))
    assert text.count("FileScan") == 1
    assert "l_extendedprice" not in text.split("ReadSchema")[1]


@pytest.mark.parametrize("name, reads", [("flight_weather", 2), ("features_with_airplane", 1), ("features_full", 1)])
def test_how_often_the_fact_is_read(name, reads, spark, folder):
    frame = QUERIES[name](spark, folder)
    frame.collect()
    final = plan(frame).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[[^\]]*l_orderkey", final)) <= reads


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01", "sf0.1"])
def test_foreign_keys_match(scale, spark):
    folder = f"/root/testdata/{scale}"
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select("l_orderkey", "l_suppkey")
    orders = spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_custkey")
    customers = spark.read.parquet(f"{folder}/customer.parquet").select("c_custkey", "c_nationkey")
    suppliers = spark.read.parquet(f"{folder}/supplier.parquet").select("s_suppkey", "s_nationkey")
    nations = spark.read.parquet(f"{folder}/nation.parquet").select("n_nationkey")
    full = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    assert full.count() == lines.count()


def test_name_matching_joins_on_beginnings(spark, folder):
    assert "LeftSemi" in plan(QUERIES["lcp_pairs"](spark, folder))


def test_page_is_a_top_k(spark, folder):
    assert "TakeOrderedAndProject" in plan(QUERIES["search_flights"](spark, folder))


def test_filter_reaches_the_scan(spark, folder):
    text = plan(QUERIES["nearest_observation"](spark, folder))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)" in text
