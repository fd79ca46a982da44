"""Figures kept per day against figures of all rows."""

import random

import pytest
from pyspark.sql import functions as F

from delaylens.operators.daily import Figures, day_parts, merged, read_parts, replace_parts

FIGURES = Figures(keys=("k", "g"), sums=("x",), distinct=("u",), spread=("x",))


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(8)
    rows = []
    for i in range(3000):
        day = rng.choice(["2024-03-01", "2024-03-02", "2024-03-03", None])
        key = None if i % 11 == 0 else "hot" if i % 3 else rng.choice("abc")
        rows.append((day, key, i % 2, rng.choice([None, *range(50)]), f"u{rng.randrange(400)}"))
    text = "day string, k string, g int, x long, u string"
    return spark.createDataFrame(rows, text).withColumn("day", F.col("day").cast("date")).repartition(4).cache()


def exact(rows, *keys):
    return {
        tuple(r[k] for k in keys): (r.n, r.s, r.e)
        for r in rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("x").alias("s"), F.expr("count_if(x IS NULL)").alias("e")).collect()
    }


def kept(found, *keys):
    return {tuple(r[k] for k in keys): (r.n, r.sum_x, r.nulls_x) for r in found.collect()}


def test_parts_add_up_by_all_or_some_keys(spark, table, tmp_path):
    schema = replace_parts(day_parts(table, "day", FIGURES), str(tmp_path))
    parts = read_parts(spark, str(tmp_path), schema)
    assert kept(merged(parts, FIGURES), "k", "g") == exact(table, "k", "g")
    assert kept(merged(parts, FIGURES, by=("k",)), "k") == exact(table, "k")
    assert kept(merged(parts, FIGURES, by=())) == exact(table)


def test_a_day_is_replaced_alone_and_may_become_empty(spark, table, tmp_path):
    root = str(tmp_path)
    schema = replace_parts(day_parts(table, "day", FIGURES), root)
    second = table.where("day = '2024-03-02'")
    for _ in range(2):
        replace_parts(day_parts(second.where("x > 20"), "day", FIGURES), root, ["2024-03-02"])
    now = table.where("NOT (day <=> date'2024-03-02') OR x > 20")
    assert kept(merged(read_parts(spark, root, schema), FIGURES), "k", "g") == exact(now, "k", "g")
    replace_parts(day_parts(second.where("false"), "day", FIGURES), root, ["2024-03-02"])
    rest = table.where("NOT (day <=> date'2024-03-02')")
    assert kept(merged(read_parts(spark, root, schema), FIGURES), "k", "g") == exact(rest, "k", "g")
    assert merged(read_parts(spark, root, schema, "2024-03-02", "2024-03-02"), FIGURES).count() == 0


def test_a_period_reads_its_days_only(spark, table, tmp_path):
    schema = replace_parts(day_parts(table, "day", FIGURES), str(tmp_path))
    parts = read_parts(spark, str(tmp_path), schema, "2024-03-02", "2024-03-03")
    assert "PartitionFilters: [isnotnull(ds" in parts._jdf.queryExecution().executedPlan().toString()
    assert kept(merged(parts, FIGURES), "k", "g") == exact(table.where("day >= '2024-03-02'"), "k", "g")


def test_estimates_keep_their_bounds(spark, table, tmp_path):
    schema = replace_parts(day_parts(table, "day", FIGURES), str(tmp_path))
    found = merged(read_parts(spark, str(tmp_path), schema), FIGURES, by=(), quantiles=(0.1, 0.5)).first()
    assert abs(found.distinct_u - 400) <= 20
    values = sorted(r.x for r in table.where("x IS NOT NULL").select("x").collect())
    for q, at in zip((0.1, 0.5), found.quantiles_x):
        assert sum(v < at for v in values) / len(values) <= q + 0.02
        assert sum(v <= at for v in values) / len(values) >= q - 0.02


def test_no_values_and_no_rows(spark, tmp_path):
    rows = spark.createDataFrame([("2024-03-01", None, None, None, None)], "day string, k string, g int, x long, u string")
    schema = replace_parts(day_parts(rows, "day", FIGURES), str(tmp_path / "one"))
    row = merged(read_parts(spark, str(tmp_path / "one"), schema), FIGURES).first()
    assert (row.n, row.sum_x, row.nulls_x, row.mean_x, row.distinct_u, row.quantiles_x) == (1, None, 1, None, 0, None)
    none = day_parts(rows.where("false"), "day", FIGURES)
    assert merged(none, FIGURES).count() == 0
