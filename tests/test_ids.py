"""Look-ups by ids that have Bloom filters."""

import hashlib
import uuid

import pytest
from pyspark.sql import functions as F

from delaylens.operators.lookup import by_ids
from delaylens.sources.writers import publish_by_id


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ids") / "t")
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 1000 != 7, F.md5(F.col("id").cast("string"))).alias("uid"),
        F.concat(F.lit("N"), F.col("id") % 50_000).alias("tail"), (F.col("id") % 30).alias("day"), "id",
    )
    publish_by_id(rows, path, ["uid", "tail"], ["day"], per_group=20_000, group_bytes=1 << 20)
    return rows, spark.read.parquet(path)


def scanned(df):
    """Rows that the scans of a collected query read from their row groups."""
    df.collect()
    total, nodes = 0, [df._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        if node.nodeName().startswith("Scan parquet"):
            total += node.metrics().get("numOutputRows").get().value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def md5(*numbers):
    return [hashlib.md5(str(n).encode()).hexdigest() for n in numbers]


def test_finds_the_rows_of_ids(spark, published):
    rows, table = published
    assert sorted(r.id for r in by_ids(table, "uid", [*md5(5, 199_999, 5), None, "none"]).collect()) == [5, 199_999]
    assert sorted(r.id for r in by_ids(table, "tail", ["N3"]).collect()) == [3, 50_003, 100_003, 150_003]
    assert by_ids(table, "uid", []).count() == by_ids(table, "uid", [None]).count() == 0
    many = [n for n in range(0, 200_000, 7001)]
    assert sorted(r.id for r in by_ids(table, "uid", md5(*many)).collect()) == [n for n in many if n % 1000 != 7]
    assert table.exceptAll(rows).count() == rows.exceptAll(table).count() == 0


def test_row_groups_without_the_id_are_not_read(spark, published):
    _, table = published
    missing = uuid.UUID(int=1 << 127).hex
    low, high = table.agg(F.min("uid"), F.max("uid")).first()
    assert low < missing < high
    assert scanned(by_ids(table, "uid", [missing])) < 200_000 / 10
    assert scanned(by_ids(table, "uid", md5(77_777))) < 200_000 / 4
    assert scanned(table.where(F.lower("uid") == missing)) == 200_000


def test_empty_table(spark, published, tmp_path):
    publish_by_id(published[0].where("false"), str(tmp_path / "e"), ["uid"])
    assert by_ids(spark.read.parquet(str(tmp_path / "e")), "uid", ["x"]).count() == 0
