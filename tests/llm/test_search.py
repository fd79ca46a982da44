"""Nearest neighbours and decontamination against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from reference_words import spaced

from delaylens.llm import decontaminate, neighbours
from delaylens.llm.queries import QUERIES
from delaylens.llm.words import blanks, split


def exact(rows, is_query, k=10):
    usable = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            usable[i] = np.array(v, float)
    out = []
    for q in usable:
        if is_query(q):
            near = sorted((float(np.sqrt(((usable[q] - v) ** 2).sum())), i) for i, v in usable.items() if i != q)[:k]
            out += [(q, r, i, d) for r, (d, i) in enumerate(near, 1)]
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", 1) for i, v in rows], "vec_id long, embedding array<float>, id string, vector string, cid int").repartition(3)


def test_few_vectors_are_searched_fully(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [2.0, 2.0]), (4, None), (5, [0.0, 0.0])]
    rows += [(6, [nan, 1.0]), (7, [None, 1.0]), (8, []), (None, [1.0, 1.0]), (9, [float("inf"), 0.0]), (3, [2.0, 2.0]), (10, [-0.0, 1.0])]
    found = neighbours.nearest(vectors(spark, rows), F.col("id") % 100 == 0).collect()
    got = sorted((r.query_id, r.rank, r.vec_id, round(r.score, 9)) for r in found)
    assert got == [(q, r, i, round(d, 9)) for q, r, i, d in sorted(exact(dict(rows).items(), lambda i: i % 100 == 0))]


def test_many_equal_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).round(3).tolist()) for i in range(400)] + [(i, [1.0] * 8) for i in range(400, 800)]
    found = neighbours.nearest(vectors(spark, rows), F.col("id") % 100 == 0).collect()
    got = {(r.query_id, r.vec_id) for r in found}
    want = exact([(i, np.float32(v).tolist()) for i, v in rows], lambda i: i % 100 == 0)
    assert len(got & {(q, i) for q, _, i, _ in want}) >= 0.9 * len(want)
    assert [r.vec_id for r in sorted(found, key=lambda r: r.rank) if r.query_id == 500] == [400, 401, 402, 403, 404, 405, 406, 407, 408, 409]


def test_outliers_of_clusters_find_their_neighbours(spark):
    rng = np.random.default_rng(3)
    middles = 20 * rng.normal(size=(20, 8))
    inner = [(i, (middles[i % 20] + rng.normal(size=8)).tolist()) for i in range(5900)]
    rows = [(i, np.float32(v).tolist()) for i, v in inner + [(i, (120 * rng.normal(size=8)).tolist()) for i in range(5900, 6000)]]
    asked = {*range(0, 5900, 100), *range(5900, 6000, 5)}
    found = neighbours.nearest(vectors(spark, rows), F.col("id").isin(*asked)).collect()
    want = {(q, i) for q, _, i, _ in exact(rows, asked.__contains__)}
    got = {(r.query_id, r.vec_id) for r in found}
    assert len(found) == len(want)
    for low, high in ((0, 5900), (5900, 6000)):
        part = {(q, i) for q, i in want if low <= q < high}
        assert len(got & part) >= 0.95 * len(part)


def test_no_vectors(spark):
    assert neighbours.nearest(vectors(spark, []), F.col("id") % 100 == 0).count() == 0
    assert neighbours.nearest(vectors(spark, [(0, None)]), F.col("id") % 100 == 0).count() == 0
    assert neighbours.nearest(vectors(spark, [(0, [1.0])]), F.col("id") % 100 == 0).count() == 0


def test_recall_on_the_tables(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    found = {(r.query_id, r.vec_id) for r in QUERIES["op3_nearest_neighbours"](spark, folder).collect()}
    want = exact(rows, lambda i: i % 100 == 0)
    assert len(found & {(q, i) for q, _, i, _ in want}) >= 0.9 * len(want)


def test_probes_come_in_order_of_success():
    rng = np.random.default_rng(0)
    index = neighbours.fit(rng.normal(size=(300, 6)), 300)
    place = index.places(rng.normal(size=(5, 6)))[0]
    visits = index.visits(place, len(index.templates))
    assert (visits[:, 0] == np.floor(place)).all()
    inside = place - np.floor(place)
    step = visits - np.floor(place)[:, None, :]
    cost = np.where(step < 0, inside[:, None, :], np.where(step > 0, 1 - inside[:, None, :], 0)) ** 2
    assert (np.diff(cost.sum(-1), axis=1) >= -1e-9).all()


def table_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def test_edit_distance_of_parts():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = (rng.integers(0, 4, n).astype(np.uint64) for n in rng.integers(1, 90, 2))
        assert decontaminate.edits(a, b)[0] == table_distance(a.tolist(), b.tolist())


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdefg", k=4)) for _ in range(500)]
    text = lambda n: rng.choices(vocabulary, k=n)
    items = [(i, text(rng.randint(12, 60))) for i in range(40)]
    rows, truth = [], set()
    for d in range(200):
        body = text(rng.randint(0, 80))
        if d % 2:
            i, words = rng.choice(items)
            words = list(words)
            for _ in range(rng.randint(0, int(0.2 * len(words)))):
                at = rng.randrange(len(words))
                words[at : at + rng.randint(0, 1)] = ["edit"] * rng.randint(0, 1)
            at = rng.randint(0, len(body))
            body[at:at] = words
            truth.add((d, i))
        rows.append((d, " ".join(body)))
    return rows, [(i, " ".join(w).upper()) for i, w in items], truth


def brute(rows, items, rate=0.2):
    found = set()
    for d, t in rows:
        w = spaced(t, True)
        for i, x in items:
            p = spaced(x, True)
            if len(p) >= 8 and table_distance(p, w) <= int(rate * len(p)):
                found.add((d, i))
    return found


def test_leaks_are_those_of_the_full_search(documents, spark, planted):
    rows, items, truth = planted
    table = spark.createDataFrame([*items, (98, None), (99, "too short"), (None, items[0][1])], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(documents(rows), table).collect()}
    every = brute(rows, items)
    assert truth <= every and found <= every and len(found) >= 0.95 * len(every)
    kept = decontaminate.clean(documents(rows), table)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {d for d, _ in found}


def every_edit(pattern, words, rate=0.2):
    return table_distance(pattern, words) <= int(rate * len(pattern))


def test_short_items_are_found_without_exception(documents, spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)]
    items = [(i, rng.choices(vocabulary, k=1 + i % 7)) for i in range(60)]
    rows = [(d, rng.choices(vocabulary, k=rng.randint(0, 25))) for d in range(120)]
    for d in range(0, 120, 3):
        words = list(rng.choice(items)[1])
        if len(words) >= 5:
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = ["edit"] * rng.randint(0, 1)
        at = rng.randint(0, len(rows[d][1]))
        rows[d][1][at:at] = words
    table = spark.createDataFrame([(i, " ".join(w).upper()) for i, w in items] + [(98, ""), (99, None)], "item_id long, text string")
    docs = documents([(d, " ".join(w)) for d, w in rows] + [(500, None), (501, "")])
    want = {(d, i): table_distance(p, w) for d, w in rows for i, p in items if every_edit(p, w)}
    assert {(r.doc_id, r.item_id): r.edits for r in decontaminate.find_leaks(docs, table).collect()} == want
    kept = {r.doc_id for r in decontaminate.clean(docs, table).collect()}
    assert kept == {*range(120), 500, 501} - {d for d, _ in want}


def test_items_that_walks_miss_are_found_exactly(documents, spark, planted):
    rows, items, _ = planted
    rng = random.Random(6)
    long = [f"long{rng.randrange(90)}" for _ in range(150)]
    edited = list(long)
    for at in rng.sample(range(150), 29):
        edited[at] = "edit"
    rows = rows + [(300, " ".join(["x"] * 9 + edited + ["y"])), (301, " ".join(long[:110]))]
    items = [*items, (70, " ".join(long))]
    table = spark.createDataFrame(items, "item_id long, text string")
    few = decontaminate.Settings(repetitions=2)
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(documents(rows), table, s=few).collect()}
    assert found == brute(rows, items) and (300, 70) in found


def test_blocks_of_items_find_the_same(documents, spark, planted, monkeypatch):
    rows, items, _ = planted
    table = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK", 15)
    found = set()
    for search in decontaminate.searches(table, block=15):
        words = split(pa.array([t for _, t in rows]), blanks(), True)
        found |= {(rows[t][0], search.ids[k]) for t, k, *_ in decontaminate.leaks(search, words)}
    assert len(found) >= 0.95 * len(brute(rows, items))


def test_odd_documents_and_items(documents, spark, odd_rows):
    items = spark.createDataFrame([(1, " ".join(odd_rows[7][1].split()[20:50]))], "item_id long, text string")
    found = decontaminate.find_leaks(documents(odd_rows), items).collect()
    assert {r.doc_id for r in found} >= {10, 11, 12, None} and len([r for r in found if r.doc_id == 12]) == 2
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(documents(odd_rows), none).count() == 0
    assert decontaminate.find_leaks(documents([]), items).count() == 0
    assert decontaminate.clean(documents(odd_rows), none).count() == len(odd_rows)
