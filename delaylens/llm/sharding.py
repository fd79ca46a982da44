"""Shards of equal size by histogram sort.

Rows are ordered by the fingerprint of their text and their key, so equal texts stay together
and a group of copies of any size can still be divided. Splitters are found before anything is
moved: a round samples keys between the bounds known so far, counts exactly how many bytes and
rows lie below each of them in all partitions, and keeps the tightest bounds; it ends when every
splitter is within the tolerance or no key is left between its bounds. Then rows are exchanged
once. Shards are cut into parts, whose exact row counts make slots gapless without sorting a
shard in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylens.llm.scratch import Scratch, small
from delaylens.llm.words import mixed

#: Rows of a part, keys sampled for a splitter and round, and the share of a shard's bytes by
#: which a splitter may miss its place.
PART_ROWS, SAMPLE, TOLERANCE = 500_000, 32, 0.002


def encoded(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs of 64-bit numbers as byte strings of the same order."""
    out = np.empty((len(a), 2), ">u8")
    for i, x in enumerate((a, b)):
        out[:, i] = x.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return np.ascontiguousarray(out).view("S16").reshape(-1)


def _full(probes: list[bytes]) -> np.ndarray:
    return np.array(probes, "S16") if probes else np.zeros(0, "S16")


def _counting(probes: list[bytes]) -> Callable:
    """Bytes and rows from each probe up to the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = _full(probes)
        size, rows = np.zeros(len(bounds) + 1, np.int64), np.zeros(len(bounds) + 1, np.int64)
        for batch in batches:
            place = np.searchsorted(bounds, encoded(*(batch.column(c).to_numpy() for c in "ab")), "right")
            np.add.at(size, place, batch.column("size").to_numpy())
            rows += np.bincount(place, minlength=len(rows))
        at = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(size[at]), pa.array(rows[at])], names=["at", "size", "rows"])

    return run


def _sampling(edges: list[tuple[bytes, bytes, float]], round_: int) -> Callable:
    """Keys strictly between the bounds of each open splitter, each with its interval's chance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = _full([e[0] for e in edges]), _full([e[1] for e in edges])
        chance = np.array([e[2] for e in edges])
        for batch in batches:
            a, b = (batch.column(c).to_numpy() for c in "ab")
            keys = encoded(a, b)
            at = np.searchsorted(low, keys, "left") - 1
            inside = (at >= 0) & (keys < high[at])
            salt = mixed(a.view(np.uint64) ^ mixed(b.view(np.uint64) + np.uint64(round_)))
            inside &= salt / 2.0**64 < chance[at]
            yield pa.RecordBatch.from_arrays([pa.array(a[inside]), pa.array(b[inside])], names=["a", "b"])

    return run


def splitters(keys: DataFrame, wanted: list[float], slack: list[float], total: tuple[int, int]):
    """For each wanted number of bytes a probe near it, with exact bytes and rows below.

    ``keys`` (a, b, size) must be stored. Only probes and their counts reach the driver: at most
    ``SAMPLE`` times the number of splitters, on average, per round.
    """
    first, last = b"\0" * 16, b"\xff" * 16
    # Per splitter: the bounds (key, bytes below, rows below) that enclose it.
    bounds = [((first, 0, 0), (last, *total)) for _ in wanted]
    for round_ in range(1, 200):
        open_ = {}
        for (low, high), want, near in zip(bounds, wanted, slack):
            if min(abs(low[1] - want), abs(high[1] - want)) > near and high[2] - low[2] > 0:
                open_[low[0], high[0]] = (high[2] - low[2], open_.get((low[0], high[0]), (0, 0))[1] + 1)
        if not open_:
            break
        edges = sorted((a, b, min(1.0, SAMPLE * n / rows)) for (a, b), (rows, n) in open_.items())
        found = keys.mapInArrow(_sampling(edges, round_), "a long, b long").distinct().toPandas()
        probes = sorted({x.ljust(16, b"\0") for x in encoded(found["a"].to_numpy(), found["b"].to_numpy()).tolist()})
        probes = [p for p in probes if p != first]
        closed = all(c == 1.0 for *_, c in edges)
        if not probes and closed:
            break
        below = keys.mapInArrow(_counting(probes), "at long, size long, rows long").groupBy("at").agg(
            F.sum("size").alias("size"), F.sum("rows").alias("rows")
        ).toPandas().set_index("at").reindex(range(len(probes) + 1), fill_value=0).cumsum()
        points = list(zip(probes, below["size"].tolist(), below["rows"].tolist()))
        new = []
        for (low, high), want in zip(bounds, wanted):
            inside = [p for p in points if low[0] < p[0] < high[0]]
            low = max([low, *(p for p in inside if p[1] <= want)])
            high = min([high, *(p for p in inside if p[1] > want)])
            new.append((low, high))
        if new == bounds and closed:
            break
        bounds = new
    return [min(pair, key=lambda p: abs(p[1] - want)) for pair, want in zip(bounds, wanted)]


def shard(docs: DataFrame, size: Column, order: tuple[Column, Column], shards: int = 40, *, part_rows: int = PART_ROWS, tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with shard (0 to ``shards`` - 1) and slot (gapless from 0 in each shard).

    Shards have nearly equal sums of ``size``: each boundary lies within ``tolerance`` of a
    shard's share of its exact place, or at the nearest boundary between two rows. ``order`` gives
    two whole numbers that the rows are sorted by; null sorts as the smallest number. Rows equal
    in both count as one and stay together; their slots are in no particular order. With fewer
    rows than shards some shards are empty; an empty table gives none. All columns are kept;
    columns of ``docs`` named shard, slot or beginning with ``_sort`` are replaced.
    """
    scratch = Scratch(docs.sparkSession, "sharding")
    lowest = F.lit(-(2**63))
    a, b = (F.coalesce(c.cast("long"), lowest) for c in order)
    keys = scratch.store(docs.select(a.alias("a"), b.alias("b"), size.cast("long").alias("size")))
    total, rows = keys.agg(F.sum("size"), F.count("*")).first()
    total = total or 0
    parts = max(1, -(-rows // (shards * part_rows)))
    share = total / (shards * parts)
    wanted = [share * i for i in range(1, shards * parts)]
    # Inside a shard, parts need only be of about equal size.
    slack = [tolerance * share * parts if i % parts == 0 else max(tolerance * parts, 0.1) * share for i in range(1, shards * parts)]
    found = splitters(keys, wanted, slack, (total, rows))
    bounds = [p[0] for p in found]
    starts = [0, *(p[2] for p in found)]
    offsets = [n - starts[i - i % parts] for i, n in enumerate(starts)]

    @F.pandas_udf("int")
    def part_of(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(_full(bounds), encoded(x.to_numpy(), y.to_numpy()), "right").astype(np.int32))

    # From Arrow and not from a list, which would start a second set of Python workers on each executor.
    table = docs.sparkSession.createDataFrame(
        pa.table({"_sort_part": pa.array(range(len(offsets)), pa.int32()), "_sort_offset": pa.array(offsets, pa.int64())})
    )
    place = Window.partitionBy("_sort_part").orderBy("_sort_a", "_sort_b")
    return (
        docs.drop("shard", "slot").withColumns({"_sort_a": a, "_sort_b": b})
        # Else the join's test for null goes down to the rows with a copy of the function: two workers for each task.
        .withColumn("_sort_part", part_of.asNondeterministic()("_sort_a", "_sort_b"))
        .withColumn("_sort_row", F.row_number().over(place))
        .join(small(table), "_sort_part")
        .withColumn("shard", F.floor(F.col("_sort_part") / parts).cast("int"))
        .withColumn("slot", F.col("_sort_offset") + F.col("_sort_row") - 1)
        .drop("_sort_part", "_sort_row", "_sort_a", "_sort_b", "_sort_offset")
    )
