"""Hard negatives against inner products by the plain definition."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from delaylens.llm import hardnegatives as h

SCHEMA = "vec_id long, embedding array<float>, label int, _id string, _cell string, rank string, key string"


@pytest.mark.parametrize("largest, dims, kind", [(300, 13, np.int32), (1, 8, np.int32), (h.LARGEST, 64, np.int64), (5, 0, np.int32)])
def test_scores_are_inner_products(largest, dims, kind):
    rng = np.random.default_rng(dims)
    a, b = rng.integers(-largest, largest, (70, dims)), rng.integers(-largest, largest, (90, dims))
    assert (h.scores(h.tables(a, kind), h.planes(b)) == b @ a.T).all()


def expected(rows, every, positives=5, negatives=10, share=(30, 90)):
    good = []
    for key, vector, label in {(k, None if v is None else tuple(v), x) for k, v, x in rows}:
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            good.append((key, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    first = lambda found: sorted(found, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    out = []
    for key, vector, label in good:
        if key is None or key % every:
            continue
        scored = [(sum(x * y for x, y in zip(vector, v)), k, x) for k, v, x in good]
        for score, positive, _ in first(s for s in scored if s[2] == label and s[1] != key)[:positives]:
            band = [s for s in scored if s[2] != label and share[0] * score <= 100 * s[0] <= share[1] * score]
            for rank, (value, negative, _) in enumerate(first(band)[:negatives], 1):
                out.append((key, positive, rank, negative, score, value))
    return out


def found(spark, rows, every, **options):
    frame = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)
    return [tuple(r) for r in h.hard_negatives(frame, F.col("vec_id") % every == 0, **options).collect()]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


def test_same_as_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    vector = lambda: [rng.gauss(0.2, 0.4) for _ in range(11)]
    rows = [(i, vector(), rng.choice([1, 1, 1, 2, 3])) for i in range(150)]
    same = vector()
    rows += [(i, same, rng.choice([1, 2])) for i in range(200, 260)]  # one vector in two labels
    rows += rows[:20]  # repeated rows
    rows += [(300, None, 1), (301, vector(), None), (302, [math.nan] * 11, 1), (303, [math.inf, *vector()[1:]], 1), (304, [None, *vector()[1:]], 2)]
    rows += [(None, vector(), 1), (310, [], 1), (311, [0.0] * 11, 2), (312, [1000.0] * 11, 2), (313, vector()[:5], 1), (320, vector(), 77)]
    monkeypatch.setattr(h, "ANCHORS", 7)
    assert order(found(spark, rows, 10)) == order(expected(rows, 10))
    assert order(found(spark, rows, 10, positives=2, negatives=3, share=(10, 200))) == order(expected(rows, 10, 2, 3, (10, 200)))


def test_few_or_no_rows(spark):
    assert found(spark, [], 10) == []
    assert found(spark, [(0, [1.0], 1), (1, [0.5], 2)], 10) == []  # no other row of the label
    rows = [(0, [1.0], 1), (1, [1.0], 1), (2, [0.5], 2)]
    assert found(spark, rows, 10) == [(0, 1, 1, 2, 65536, 32768)]


def test_answers_hold_no_more_than_asked(spark):
    """Ties beyond counting: a third of all rows are one vector."""
    rows = [(i, [1.0, 0.0], i % 2) for i in range(3000)]
    got = found(spark, rows, 1000, share=(30, 100))
    assert order(got) == order(expected(rows, 1000, share=(30, 100)))
