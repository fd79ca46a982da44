"""Mixing and sharding against their definitions."""

import zlib

import pytest
from pyspark.sql import functions as F
from reference_words import spaced

from delaylens.llm import mixing, sharding


def targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in full]
        rest = total - sum(cap * sizes[s] for s in full)
        share = {s: rest * weight[s] / sum(weight[f] for f in free) for s in free}
        above = {s for s in free if share[s] > cap * sizes[s]}
        if not above:
            return {s: share.get(s, cap * sizes[s]) for s in names}
        full |= above


@pytest.fixture
def many(documents):
    rows = [(i, "w " * (i % 37), "en", f"s{i % 7 if i % 3 else 0}") for i in range(600)]
    return documents(rows + [(900, None, "en", None), (901, "a b c", "en", None), (902, "", "en", "empty"), (None, "x y", "en", "s1"), (5, "w w w", "en", "s1")])


def test_mix_meets_its_targets(many):
    found = mixing.mix_counts(many).collect()
    rows = many.select("doc_id", "text", "source").collect()
    assert len(found) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + len(spaced(r.text))
    wanted = targets(sizes)
    assert {(r.source_size, round(r.target, 6)) for r in found} == {(sizes[s], round(t, 6)) for s, t in wanted.items()}
    assert all(r.taken <= 3 * r.size and r.taken == r.times * r.size for r in found)
    by_target = {}
    for r in found:
        place = r.target, r.source_size
        by_target[place] = by_target.get(place, 0) + r.taken
    for s, t in wanted.items():
        if sizes[s] > 100:
            assert abs(by_target[t, sizes[s]] - t) <= 0.02 * t + 1


def test_one_dominating_document_leaves_no_gap(documents):
    rows = [(i, "w " * (10 + 10 * (i % 7)), "en", "a") for i in range(100)] + [(500, "w " * 9000, "en", "a")]
    rows += [(1000 + i, "w " * 10, "en", "b") for i in range(716)]
    found = mixing.mix_counts(documents(rows), weights=(1, 3)).collect()
    part = [r for r in found if r.doc_id <= 500]
    assert all(0 <= r.times <= 3 and r.taken == r.times * r.size for r in found)
    assert part[0].target - 10 < sum(r.taken for r in part) <= part[0].target
    assert len(mixing.mix(documents(rows), weights=(1, 3)).where("doc_id <= 500").collect()) == sum(r.times for r in part)


def test_mix_reruns_agree_and_returns_rows(many):
    one, two = (sorted(map(str, mixing.mix_counts(many.repartition(n)).collect())) for n in (2, 5))
    assert one == two
    rows = mixing.mix(many)
    assert rows.columns == many.columns
    assert rows.count() == sum(r.times for r in mixing.mix_counts(many).collect())


def test_better_documents_come_first(documents, spark):
    docs = documents([(i, "w " * 10, "en", "a" if i < 400 else "b") for i in range(4000)])
    quality = spark.range(0, 4000, 2).select(F.col("id").alias("key"), F.lit(9.0).alias("weight"))
    taken = mixing.mix_counts(docs, weights=(1, 1), quality=quality)
    good, bad = (taken.where(f"doc_id >= 400 AND doc_id % 2 = {k}").agg(F.avg("times")).first()[0] for k in (0, 1))
    assert good > bad + 0.2


def test_mix_plan_has_no_python(many):
    plan = mixing.mix_counts(many)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def split_into(docs, shards, **options):
    text = F.coalesce("text", F.lit(""))
    return sharding.shard(docs, F.octet_length(text) + 16, (F.xxhash64(text), F.col("doc_id")), shards, **options)


@pytest.mark.parametrize("part_rows", [10, 100_000])
def test_shards_are_even_and_slots_gapless(documents, part_rows):
    rows = [(i, f"text {i} " * (i % 9)) for i in range(900)] + [(i, "copy " * 20) for i in range(900, 1500)]
    docs = documents(rows + [(None, None), (None, "a"), (7, "again"), (7, "again")])
    found = split_into(docs, 10, part_rows=part_rows)
    assert set(docs.columns) < set(found.columns)
    sizes, slots, seen = {}, {}, []
    for r in found.collect():
        seen.append((r.doc_id, r.text))
        sizes[r.shard] = sizes.get(r.shard, 0) + len((r.text or "").encode()) + 16
        slots.setdefault(r.shard, []).append(r.slot)
    key = lambda x: tuple((y is None, y) for y in x)
    assert sorted(seen, key=key) == sorted([(r.doc_id, r.text) for r in docs.collect()], key=key)
    assert sorted(sizes) == list(range(10))
    assert max(sizes.values()) - min(sizes.values()) <= 2 * 130
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_take_one_python_worker_a_task(spark, documents):
    docs = documents([(i, f"word {i}", "en", "a") for i in range(300)])
    docs = spark.createDataFrame(docs.toArrow())
    plan = split_into(docs, 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1, plan
    # Rows of a Python list come through workers of their own.
    assert "ExistingRDD" not in plan, plan


def test_shards_do_not_depend_on_partitions(documents):
    docs = documents([(i, f"text {i} " * (i % 9)) for i in range(300)])
    one, two = (sorted((r.doc_id, r.shard, r.slot) for r in split_into(docs.repartition(n), 7).collect()) for n in (2, 9))
    assert one == two


def test_few_rows_and_none(documents):
    assert split_into(documents([(1, "a"), (2, "b")]), 40).count() == 2
    assert split_into(documents([]), 40).count() == 0
    assert mixing.mix_counts(documents([])).count() == 0
    assert mixing.mix(documents([(1, None, None, None)])).count() <= 3


def test_checksum_is_the_usual_one(documents):
    docs = documents([(1, "é text")]).select(F.crc32(F.col("text").cast("binary")).alias("c"))
    assert docs.first().c == zlib.crc32("é text".encode())


def greedy(docs, spark, **options):
    """Times of every row by going through each source row by row, in the order that the mix draws."""
    rows, plan, _, _ = mixing.mixture(docs, **options)
    cap, out = options.get("cap", 3), {}
    sources = {r._source: r for r in plan.collect()}
    groups = {}
    for r in rows.collect():
        groups.setdefault((r._source, r._range, r._key, r._id is not None, r._id), []).append(r._size)
    order = sorted(groups, key=lambda g: g[1:4] + (g[4] or 0,))
    for name, s in sources.items():
        own = [g for g in order if g[0] == name]
        times, rest = {g: s.epochs for g in own}, s.target - s.epochs * s.source_size
        for _ in range(cap - s.epochs):
            for g in own:
                if 0 < sum(groups[g]) <= rest:
                    times[g], rest = times[g] + 1, rest - sum(groups[g])
        for g in own:
            for size in groups[g]:
                out.setdefault((g[4], size, name), []).append(times[g] if size else None)
    return out


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_repeated_rows_are_taken_as_one_and_never_too_often(documents, spark, seed):
    rows = [(i, "a", "en", "A") for i in range(100)] + [(200 + i, "b", "en", "B") for i in range(60)]
    rows += [(300 + i, "b b b b", "en", "B") for i in range(60) for _ in range(3)] + [(None, "b b", "en", "B")] * 5
    docs = documents(rows)
    quality = spark.createDataFrame([(r[0], 0.001 if r[0] % 5 else 2.0) for r in rows if r[0]], "key long, weight double")
    options = {"weights": (5, 3), "quality": quality, "seed": seed}
    found = mixing.mix_counts(docs, **options).collect()
    got = {}
    for r in found:
        name = {100: "A"}.get(r.source_size, "B")
        assert 0 <= r.times <= 3 and r.taken == r.times * r.size
        got.setdefault((r.doc_id, r.size, name), []).append(r.times)
    assert got == greedy(docs, spark, **options)
    assert mixing.mix(docs, **options).count() == sum(r.times for r in found)


def test_rows_are_taken_as_by_one_walk(many, spark):
    want = greedy(many, spark)
    got = {}
    names = {(r.doc_id, r.text): r.source for r in many.select("doc_id", "text", "source").collect()}
    by_size = {}
    for r in mixing.mix_counts(many).collect():
        if r.size:
            by_size.setdefault((r.doc_id, r.size), []).append(r.times)
    for (key, size, _), times in want.items():
        if size:
            got.setdefault((key, size), []).extend(times)
    assert {k: sorted(v) for k, v in by_size.items()} == {k: sorted(v) for k, v in got.items()} and names


def test_ranges_divide_every_weight(spark):
    ranges = mixing.Ranges(4096, (0.01, 0.04, 0.16, 0.64))
    for weight in (0.01, 0.25, 1.0):
        keys = spark.range(20_000).select((-F.log((F.col("id") + 0.5) / 20_000) / weight).alias("k"))
        placed = keys.select("k", ranges.place(F.col("k")).alias("r"))
        assert placed.groupBy("r").count().agg(F.max("count")).first()[0] < 20_000 * 16 / 4096 + 5
        ordered = [r.r for r in placed.orderBy("k").collect()]
        assert ordered == sorted(ordered)
