"""Name resolution and nearest neighbours against brute force."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from delaylens.functions.geodesy import rounded_miles
from delaylens.operators import resolve
from delaylens.operators.nearest_place import nearest_place
from delaylens.operators.nearest_time import nearest_observation
from delaylens.plans import entities

NAMES = [
    "BOEING", "BOEING CO", "BOEING COMPANY", " BOEING", "AIRBUS INDUSTRIE", "AIRBUS", "AIRBUS ", "CESSNA",
    "CESSNA 172", "CESSNA 182", "small ring", "small bolt", None, "", "BOMBARDIER INC", "BOMBARDIER LTD",
]


def brute_pairs(names):
    names = {n for n in names if n is not None}
    found = set()
    for a in names:
        for b in names - {a}:
            shared = os.path.commonprefix([a, b]).strip()
            if len(shared) > 5:
                found.add((a, shared))
    return found


def test_shared_beginnings(spark):
    df = spark.createDataFrame([(n,) for n in NAMES], "m string")
    found = {tuple(r) for r in resolve.shared_beginnings(df, "m").collect()}
    assert found == brute_pairs(NAMES)


def test_shared_beginnings_of_random_names(spark):
    rng = random.Random(3)
    names = ["".join(rng.choice("ab ") for _ in range(rng.randrange(4, 13))) for _ in range(150)]
    df = spark.createDataFrame([(n,) for n in names], "m string")
    assert {tuple(r) for r in resolve.shared_beginnings(df, "m").collect()} == brute_pairs(names)


def test_resolution_has_one_name_per_row_and_settles(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate(NAMES)], "i int, m string")
    once = resolve.resolve_names(df, "m")
    assert once.count() == len(NAMES)
    assert {r.i: r.m for r in once.collect()}[2] == "BOEING"
    twice = resolve.resolve_names(once, "m")
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))
    assert resolve.resolve_names(df, "m", mode="all").count() > len(NAMES)


@pytest.mark.parametrize("seed, spread", [(1, 1.0), (2, 0.02), (3, 1.0)])
def test_nearest_place(spark, seed, spread):
    rng = random.Random(seed)

    def point():
        return rng.uniform(-90, 90) * spread, rng.uniform(-180, 180) * (spread if seed == 2 else 1)

    sites = [(f"s{i}", *point()) for i in range(30)] + [("none", None, 1.0), ("pole", 90.0, 0.0), ("line", 0.0, 180.0)]
    places = [(i, *point()) for i in range(200)] + [(-5, None, None), (900, 0.0, -179.95), (901, 0.0, -179.95)]
    if seed == 3:
        places = places[:3]
    s = spark.createDataFrame(sites, "site string, lat double, lon double")
    p = spark.createDataFrame(places, "place int, lat double, lon double")
    pairs = s.crossJoin(p.select("place", F.col("lat").alias("lat2"), F.col("lon").alias("lon2")))
    measured = pairs.withColumn("miles", rounded_miles("lat", "lon", "lat2", "lon2"))
    expected = measured.groupBy("site").agg(F.min(F.struct("miles", "place")).alias("b"))
    wanted = {r.site: (r.b.place, r.b.miles) for r in expected.collect()}
    found = {r.site: (r.place, r.distance) for r in nearest_place(s, p, "site", "place").collect()}
    assert found == wanted
    assert len(found) == len(sites)


def at(day, seconds):
    return dt.datetime(2024, 1, day) + dt.timedelta(seconds=seconds)


@pytest.mark.parametrize("mode", ["nearest", "last"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_nearest_observation(spark, mode, how):
    rng = random.Random(11)
    pick = lambda: "hot" if rng.random() < 0.6 else rng.choice(["a", "b", "c"])
    seen = [(pick(), at(rng.randrange(1, 5), rng.randrange(0, 86400, 30)), i) for i in range(150)]
    asked = [(i, pick(), at(rng.randrange(1, 7), rng.randrange(0, 86400, 30))) for i in range(200)]
    asked += [(500, "a", at(2, 100)), (500, "a", at(2, 100))]
    expected = []
    for i, place, when in asked:
        same = [(t, n) for s, t, n in seen if s == place and t.date() == when.date()]
        if mode == "last":
            latest = max((t for t, _ in same), default=None)
            best = min(((t, n) for t, n in same if t == latest), default=None)
        else:
            best = min(same, key=lambda o: (abs(when - o[0]), o[0], o[1]), default=None)
        if best or how == "left":
            expected.append((i, place, when, best))
    e = spark.createDataFrame(asked, "i int, place string, `when` timestamp_ntz")
    o = spark.createDataFrame(seen, "station string, at timestamp_ntz, n int")
    found = nearest_observation(
        e, o, station="place", at="when", observed_station="station", observed_at="at",
        measures=["n"], name="o", mode=mode, how=how,
    )
    rows = [(r.i, r.place, r.when, tuple(r.o) if r.o else None) for r in found.collect()]
    assert sorted(rows, key=str) == sorted(expected, key=str)


def test_tie_goes_to_the_earlier_observation(spark):
    e = spark.createDataFrame([(1, "x", at(1, 600))], "i int, place string, `when` timestamp_ntz")
    o = spark.createDataFrame([("x", at(1, 300), 1), ("x", at(1, 900), 2)], "station string, at timestamp_ntz, n int")
    found = nearest_observation(
        e, o, station="place", at="when", observed_station="station", observed_at="at", measures=["n"], name="o"
    )
    assert found.first().o.n == 1


def test_flights_are_joined_once_for_both_ends(spark, folder):
    # The pairs and both joins read the stored flights, not the orders behind them.
    assert "o_orderdate" not in entities.flight_weather(spark, folder)._jdf.queryExecution().toString()
