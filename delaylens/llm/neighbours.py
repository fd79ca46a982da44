"""Nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector to the cell of ``hashes`` random projections, each cut into steps of one
width. A query visits its own cell and, in the order of their estimated success, cells that
differ by one step in some projections: the nearer a projection lies to a step's edge, the more
likely a neighbour is beyond it. Every row looks up which queries visit its cells; the candidates
of all tables are merged and ranked by their exact distance.

The number of projections, the width and the number of probes are fitted on a bounded sample, so
that its neighbours are found with the wanted recall; every row is indexed. Equal vectors are one
entry of the index, with as many of their smallest ids as any result can need.

That recall is a mean, and an outlier lies in cells that hold few of its neighbours or none. The
chance to find a row depends on its distance alone, so the fit also tells up to which distance
rows are found with the wanted recall. A query that meets too few rows within it is measured
against all rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from delaylens.llm.scratch import Scratch
from delaylens.llm.words import constants, mixed

#: Rows and queries that the fit looks at, the recall it must reach there, and queries in a block.
SAMPLE_ROWS, SAMPLE_QUERIES, RECALL, BLOCK = 4000, 300, 0.95, 2000


@dataclass(frozen=True)
class Index:
    """``projections`` (tables, hashes, dimensions), ``shifts`` (tables, hashes), the step
    ``width`` and, as rows of steps, the ``probes`` templates of which a query takes the best.
    Rows up to the distance ``reach`` are found with the wanted recall."""

    projections: np.ndarray
    shifts: np.ndarray
    width: float
    templates: np.ndarray
    probes: int
    reach: float = 0.0

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """Where vectors lie in units of a step: (table, row, projection)."""
        return np.einsum("thd,nd->tnh", self.projections, vectors) / self.width + self.shifts[:, None, :]

    def cells(self, table: int, steps: np.ndarray) -> np.ndarray:
        """One number for each row of steps; the last axis holds the projections."""
        factors = constants(steps.shape[-1], seed=70 + table)
        return mixed((steps.astype(np.int64).view(np.uint64) * factors).sum(-1, dtype=np.uint64)).view(np.int64)

    def visits(self, place: np.ndarray, count: int) -> np.ndarray:
        """Per query the first ``count`` cells in the order of estimated success, as steps."""
        base = np.floor(place)
        below = place - base
        # The squared distance that a neighbour has to cover to be a step lower or higher.
        cost = below**2 @ (self.templates == -1).T + (1 - below) ** 2 @ (self.templates == 1).T
        best = np.argsort(cost, axis=1, kind="stable")[:, :count]
        return base[:, None, :] + self.templates[best]


def templates(hashes: int) -> np.ndarray:
    """All changes by one step in up to four projections, none first."""
    out = [np.zeros(hashes, np.int8)]
    for many in range(1, min(hashes, 4) + 1):
        for which in combinations(range(hashes), many):
            for signs in product((-1, 1), repeat=many):
                row = np.zeros(hashes, np.int8)
                row[list(which)] = signs
                out.append(row)
    return np.array(out)


def fit(sample: np.ndarray, rows: int, *, k: int = 10, tables: int = 12, seed: int = 13) -> Index:
    """An index for ``rows`` vectors like those of ``sample``.

    Among fewer rows neighbours are farther away: the k nearest of all rows are as near as the
    k * len(sample) / rows nearest of the sample, so these are what the fit must find. For each
    number of projections it takes the fewest probes with the wanted recall, and of these the
    index with the fewest candidates. If none reaches it, every cell is one and the search exact.
    """
    rng = np.random.default_rng(seed)
    dims = sample.shape[1]
    exact = Index(np.zeros((1, 1, dims)), np.zeros((1, 1)), 1.0, np.zeros((1, 1), np.int8), 1, np.inf)
    queries = sample[:SAMPLE_QUERIES]
    apart = np.stack([((q - sample) ** 2).sum(-1) for q in queries]) if len(sample) else np.zeros((0, 0))
    apart[apart == 0] = np.inf
    count = max(1, round(k * len(sample) / max(rows, 1)))
    if len(sample) <= count + 1:
        return exact
    near = np.argsort(apart, axis=1)[:, :count]
    best, least = exact, 0.9 * rows
    most = int(np.clip(round(np.log(max(rows, 2) / 30) / np.log(2)), 2, 12))
    for hashes in range(2, most + 1, 2):
        lines = rng.normal(size=(tables, hashes, dims))
        width = 1.25 * float(np.std(sample @ lines.reshape(-1, dims).T)) or 1.0
        index = Index(lines, rng.uniform(0, 1, (tables, hashes)), width, templates(hashes), 0)
        limit = min(len(index.templates), 600)
        places = index.places(sample)
        rank = np.full(apart.shape, limit)
        for t in range(tables):
            cells = index.cells(t, np.floor(places[t]))
            visits = index.cells(t, index.visits(places[t, : len(queries)], limit))
            for q, visit in enumerate(visits):
                order = np.argsort(visit, kind="stable")
                at = np.minimum(np.searchsorted(visit[order], cells), limit - 1)
                rank[q] = np.minimum(rank[q], np.where(visit[order][at] == cells, order[at], limit))
        found = np.take_along_axis(rank, near, 1)
        reached = [p for p in range(1, limit + 1) if (found < p).mean() >= RECALL]
        if reached:
            candidates = (rank < reached[0]).mean() * rows + tables * reached[0]
            if candidates < least:
                best, least = Index(lines, index.shifts, width, index.templates, reached[0]), candidates
    return best if best is exact else replace(best, reach=_reach(best, queries, float(np.sqrt(apart[np.isfinite(apart)].max())), rng))


def _reach(index: Index, queries: np.ndarray, most: float, rng: np.random.Generator, tries: int = 2000) -> float:
    """The largest distance up to ``most`` at which a row in any direction is found with ``RECALL``."""
    queries = queries[np.arange(tries) % len(queries)]
    ways = rng.normal(size=queries.shape)
    ways /= np.sqrt((ways**2).sum(1, keepdims=True))
    # Other shifts for each try: a query may lie anywhere in a step.
    own = index.places(queries) + rng.uniform(0, 1, (len(index.projections), tries, 1))
    moved = np.einsum("thd,nd->tnh", index.projections, ways) / index.width
    visits = [np.sort(index.cells(t, index.visits(place, index.probes)), axis=1) for t, place in enumerate(own)]
    low, high = 0.0, most
    for _ in range(12):
        far = (low + high) / 2
        found = np.zeros(tries, bool)
        for t, visit in enumerate(visits):
            found |= (visit == index.cells(t, np.floor(own[t] + far * moved[t]))[:, None]).any(1)
        low, high = (far, high) if found.mean() >= RECALL else (low, far)
    return low


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy()
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _search(index: Index, names: np.ndarray, queries: np.ndarray, k: int, rows: int = 1024) -> Callable:
    """The best ``k`` candidates of each query among the rows of a task, ties to the smaller low.

    A row is a candidate of the queries that visit its cell in any table. Candidates of all tables
    are merged as marks of (query, row), and only marked pairs are measured.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probes = []
        for t, place in enumerate(index.places(queries)):
            cells = index.cells(t, index.visits(place, index.probes))
            order = np.argsort(cells, axis=None, kind="stable")
            probes.append((cells.reshape(-1)[order], order // cells.shape[1]))
        score = np.full((len(names), k), np.inf)
        low, cid = np.full(score.shape, np.iinfo(np.int64).max), np.zeros(score.shape, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                vectors = _matrix(part.column("vector"))
                own_cid, own_low = (np.tile(part.column(c).to_numpy(), (len(names), 1)) for c in ("cid", "low"))
                marks = np.zeros((len(names), len(vectors)), bool)
                for t, place in enumerate(index.places(vectors)):
                    cells, (visited, who) = index.cells(t, np.floor(place)), probes[t]
                    first, last = np.searchsorted(visited, cells, "left"), np.searchsorted(visited, cells, "right")
                    many = last - first
                    spot = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                    marks[who[spot], np.repeat(np.arange(len(cells)), many)] = True
                found = np.full(marks.shape, np.inf)
                for q, hits in enumerate(marks):
                    gap = vectors[hits] - queries[q]
                    found[q, hits] = np.sqrt((gap * gap).sum(1))
                score, low, cid = (np.concatenate(x, 1) for x in ((score, found), (low, own_low), (cid, own_cid)))
                order = np.lexsort((low, score), axis=1)[:, :k]
                score, low, cid = (np.take_along_axis(x, order, 1) for x in (score, low, cid))
        q, at = np.nonzero(np.isfinite(score))
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[q]), pa.array(cid[q, at]), pa.array(low[q, at]), pa.array(score[q, at])],
            names=["qid", "cid", "low", "score"],
        )

    return run


def _first_ids(most: int) -> Callable:
    """The smallest ids of equal vectors in a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, list[int]] = {}
            vectors = _matrix(batch.column("vector"))
            for raw, one in zip(vectors, batch.column("id").to_pylist()):
                held.setdefault(raw.tobytes(), []).append(one)
            keys = list(held)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.binary()),
                    pa.array([np.frombuffer(k, np.float64) for k in keys], pa.list_(pa.float64())),
                    pa.array([sorted(set(held[k]))[:most] for k in keys], pa.list_(pa.int64())),
                ],
                names=["raw", "vector", "ids"],
            )

    return run


def usable(rows: DataFrame, vector: str, key: str) -> DataFrame:
    """(id, vector) of rows with a key and a vector of finite numbers that is not zero.

    Vectors of another length than the most frequent one take no part.
    """
    clean = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("vector", lambda x: x != 0)
    )
    lengths = clean.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    # Adding 0 makes -0.0 equal to 0.0.
    return clean.where(F.size("vector") == (lengths["n"] if lengths else 0)).withColumn(
        "vector", F.transform("vector", lambda x: x + F.lit(0.0))
    )


def _looked_up(index: Index, active: DataFrame, entries: DataFrame, k: int) -> DataFrame:
    """(qid, cid, score): the best ``k`` + 1 entries found for each stored row of ``active``.

    Queries come in blocks of bounded size; each block meets all entries where they are stored.
    """
    blocks = max(1, -(-active.count() // BLOCK))
    measured = None
    for b in range(blocks):
        block = active.where(F.pmod(F.xxhash64("cid"), F.lit(blocks)) == b).select("cid", "vector").toArrow()
        if not block.num_rows:
            continue
        search = _search(index, block.column("cid").to_numpy(), _matrix(block.column("vector").combine_chunks()), k + 1)
        found = entries.mapInArrow(search, "qid long, cid long, low long, score double")
        measured = found if measured is None else measured.unionByName(found)
    if measured is None:
        measured = entries.sparkSession.createDataFrame([], "qid long, cid long, low long, score double")
    # A class has at least one row, so k classes beside the query's own suffice.
    rank = F.row_number().over(Window.partitionBy("qid").orderBy("score", "low"))
    return measured.withColumn("place", rank).where(F.col("place") <= k + 1).select("qid", "cid", "score")


def nearest(rows: DataFrame, is_query, vector: str = "embedding", key: str = "vec_id", k: int = 10, index: Index | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query, nearest first.

    ``is_query`` is a condition on the column ``id``. The score is the Euclidean distance on the
    original vectors in double precision; ties go to the smaller id. A query is no neighbour of
    itself; other rows with an equal vector are. Rows with a null key or an unusable vector (see
    ``usable``) take no part; of rows that repeat a key with equal vectors one counts, with
    different vectors the nearest. If fewer than ``k`` other rows exist, all of them are ranked.
    Queries without ``k`` other rows within the index's reach meet all rows. Other columns are not
    read. An empty table gives none.
    """
    scratch = Scratch(rows.sparkSession, "neighbours")
    clean = scratch.store(usable(rows, vector, key))
    classes = scratch.store(
        clean.mapInArrow(_first_ids(k + 1), "raw binary, vector array<double>, ids array<long>")
        .groupBy("raw").agg(F.first("vector").alias("vector"), F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1).alias("ids"))
        .select(F.xxhash64("raw").alias("cid"), "vector", "ids")
    )
    asked = clean.where(is_query).select("id", F.xxhash64("vector").alias("print"))
    queries = scratch.store(
        asked.join(classes.select("cid", F.xxhash64("vector").alias("print")), "print").select("id", "cid").distinct()
    )
    count = classes.count()
    if index is None:
        sample = classes.orderBy(F.xxhash64("cid")).limit(SAMPLE_ROWS).select("vector").toArrow().column("vector").combine_chunks()
        index = fit(_matrix(sample), count, k=k)
    active = scratch.store(classes.join(queries.select("cid").distinct(), "cid").select("cid", "vector"))
    entries = classes.select("cid", F.col("ids")[0].alias("low"), "vector")
    best = scratch.store(_looked_up(index, active, entries, k))
    if index.reach < np.inf:
        # A query is settled if k rows beside itself lie where rows are found with the wanted recall.
        within = best.where(F.col("score") <= index.reach).join(classes.select("cid", F.size("ids").alias("many")), "cid")
        settled = within.groupBy(F.col("qid").alias("cid")).agg(F.sum("many").alias("many")).where(F.col("many") > k)
        left = scratch.store(active.join(settled, "cid", "left_anti"))
        exact = Index(np.zeros_like(index.projections[:1, :1]), np.zeros((1, 1)), 1.0, np.zeros((1, 1), np.int8), 1, np.inf)
        measured = scratch.store(_looked_up(exact, left, entries, k))
        best = best.join(left.select(F.col("cid").alias("qid")), "qid", "left_anti").unionByName(measured)
    named = best.join(classes.select("cid", F.explode("ids").alias("vec_id")), "cid")
    expanded = queries.withColumnRenamed("cid", "qid").join(named, "qid").where("id <> vec_id")
    once = expanded.groupBy("id", "vec_id").agg(F.min("score").alias("score"))
    order = F.row_number().over(Window.partitionBy("id").orderBy("score", "vec_id"))
    return once.withColumn("rank", order).where(F.col("rank") <= k).select(F.col("id").alias("query_id"), "rank", "vec_id", "score")
