"""Posting lists against plain filters; what a search reads."""

import random

import pytest
from pyspark.sql import functions as F

from delaylens.operators import lookup, search_index
from delaylens.plans import bindings as b

ROWS = 3000


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(6)
    words = [f"w{i}" for i in range(30)] + ["Blue", "straße"]
    text = lambda: rng.choice([None, "", " - ", *[" ".join(rng.choices(words, k=rng.randint(1, 5))) for _ in range(9)]])
    return spark.createDataFrame(
        [(i, text(), text(), rng.choice(["x", "y", "", None, *"z" * 30]), i % 7) for i in range(ROWS)],
        "id int, title string, body string, kind string, day int",
    ).repartition(5)


@pytest.fixture(scope="module")
def index(rows, tmp_path_factory):
    return search_index.build(rows, str(tmp_path_factory.mktemp("index")), ["day", "id"], words=["title", "body"], values=["kind", "day"], block=100)


@pytest.mark.parametrize("every", [False, True])
@pytest.mark.parametrize("wanted", [
    {"title": "w1 W2"}, {"title": "blue", "body": "w3, w4 w5"}, {"kind": "y", "title": "w1 w2 w3"}, {"kind": "z", "day": 3},
    {"title": "none such"}, {"title": "w1", "body": ""}, {"title": "STRASSE straße"}, {"kind": "x", "day": 2, "title": "w7", "body": "w8"}, {},
])
def test_same_rows_as_filters(index, rows, wanted, every):
    plain = rows
    for field, value in wanted.items():
        if value in (None, ""):
            continue
        if field in ("title", "body") and every:
            for word in str(value).replace(",", "").split():
                plain = plain.where(lookup.token_matches(field, word))
        else:
            plain = plain.where(lookup.token_matches(field, value) if field in ("title", "body") else F.col(field) == value)
    for start, end in ((0, 20), (15, 40), (0, 0), (2990, 3100)):
        want = [tuple(r) for r in plain.orderBy("day", "id").offset(start).limit(end - start).collect()]
        total = plain.count()
        got = search_index.search(index, wanted, start, end, every)
        assert list(map(tuple, got.collect())) == [(*r, total) for r in want]


def test_lists_are_bounded_and_counted(index):
    assert index.postings.agg(F.max(F.size("rows"))).first()[0] <= 100
    counts = {(r.field, r.token): r.frequency for r in index.terms.collect()}
    held = index.postings.groupBy("field", "token").agg(F.sum(F.size("rows")).alias("n")).collect()
    assert counts == {(r.field, r.token): r.n for r in held}
    assert index.postings.where("field = 'kind' AND token = 'z'").count() > 5


def test_search_reads_rows_by_number_only(spark, folder):
    found = search_index.search(b.indexed_flights(spark, folder), {"Carrier": "1-URGENT", "Origin": "NATION_3"})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PushedFilters: [In(_row" in plan and "Exchange" not in plan


def test_empty_table(spark, tmp_path):
    index = search_index.build(spark.createDataFrame([], "id int, title string"), str(tmp_path), ["id"], words=["title"])
    assert search_index.search(index, {"title": "w1"}).count() == 0
    assert search_index.search(index, {}).count() == 0


def test_long_lists_are_spread_over_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search_index, "RANGE", 400, raising=False)
    df = spark.range(4000).selectExpr("id", "cast(id as string) name", "'same' word")
    found = search_index.build(df, str(tmp_path / "index"), ["id"], values=["name", "word"], block=100)
    files = found.postings.groupBy(F.input_file_name()).agg(F.sum(F.size("rows")).alias("n")).collect()
    # Each of the lists of "word" is as long as a hundred of "name".
    assert sum(r.n for r in files) == 8000 and max(r.n for r in files) <= 1000
    assert [r.id for r in search_index.search(found, {"name": "1234", "word": "same"}).collect()] == [1234]
