"""Hard negatives: rows of other labels that score a stated share of what a positive scores.

Four-Russians scoring: the whole numbers of a row are cut into bit planes, and each plane into
bytes of eight dimensions. For an anchor and eight dimensions, the sums of all 256 subsets of its
numbers are a table; a row's score is found by looking its bytes up there, plane by plane from
the highest, doubling in between. No score is estimated and none is left out.

Anchors come in blocks of a bounded size, which are dealt out together with the rows that they
meet: a task holds one block at a time, streams rows past it and keeps only the best of each
anchor. Rows equal in label and numbers score alike, so of each class of them only as many as an
answer can hold take part. Positives are found first, then negatives in the bands they give.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from delaylens.llm.scratch import Scratch

#: Anchors of a block; rows packed into one record; rows and anchors scored at a time.
ANCHORS, PACKED, ROWS, COLUMNS = 512, 64, 1024, 256
#: Largest number of a component (262,144 times the scale of 256): up to 1,024 dimensions of it fit a score.
LARGEST = 1 << 26
_NONE, _NOBODY = np.iinfo(np.int64).min, np.iinfo(np.int64).max

_VALID = "_id long, _label string, _anchor boolean, _numbers binary"
_BLOCKS = "_ids array<long>, _labels array<string>, _planes binary, _bits int, _groups int"


def _whole(scale: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows whose vector has only finite components, these as 32-bit floor(scale * x)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("_vector")
            edges = lists.offsets.to_numpy()
            flat = lists.flatten()
            values = flat.to_numpy(zero_copy_only=False).astype(np.float64)
            base = edges[0]
            bad = np.append(0, np.cumsum(~np.isfinite(values)))
            good = np.flatnonzero(bad[edges[1:] - base] == bad[edges[:-1] - base])
            numbers = np.clip(np.floor(np.where(np.isfinite(values), values, 0.0) * scale), -LARGEST, LARGEST).astype("<i4")
            data = [numbers[edges[i] - base : edges[i + 1] - base].tobytes() for i in good]
            rest = batch.select(["_id", "_label", "_anchor"]).take(pa.array(good))
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(data, pa.binary())], ["_id", "_label", "_anchor", "_numbers"])

    return run


def planes(numbers: np.ndarray) -> np.ndarray:
    """Bit planes of rows of whole numbers as bytes: (plane, eight dimensions, row), the last plane is the sign."""
    rows, dims = numbers.shape
    bits = int(max(numbers.max(initial=0), -1 - numbers.min(initial=0))).bit_length() + 1
    padded = np.zeros((rows, -(-dims // 8) * 8), np.int64)
    padded[:, :dims] = numbers
    ones = (padded[None] >> np.arange(bits)[:, None, None]) & 1
    return np.packbits(ones.astype(np.uint8), axis=2, bitorder="little").transpose(0, 2, 1)


def tables(numbers: np.ndarray, kind: type) -> np.ndarray:
    """Sums of all subsets of each eight dimensions: (eight dimensions, subset, anchor)."""
    anchors, dims = numbers.shape
    groups = -(-dims // 8)
    padded = np.zeros((groups * 8, anchors), kind)
    padded[:dims] = numbers.T
    out = np.zeros((groups, 256, anchors), kind)
    for j in range(8):
        out[:, 1 << j : 2 << j] = out[:, : 1 << j] + padded[j::8][:, None]
    return out


def scores(sums: np.ndarray, bytes_: np.ndarray) -> np.ndarray:
    """Inner products (row, anchor) of rows given by ``planes`` with anchors given by ``tables``."""
    bits, groups, rows = bytes_.shape
    total = np.zeros((rows, sums.shape[2]), sums.dtype)
    found = np.empty_like(total)
    for plane in range(bits - 1, -1, -1):
        total += total
        for g in range(min(groups, len(sums))):
            np.take(sums[g], bytes_[plane, g], axis=0, out=found, mode="clip")
            if plane == bits - 1:
                total -= found
            else:
                total += found
    return total


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in records of at most ``PACKED``, with their bit planes."""
    for batch in batches:
        data = batch.column("_numbers").to_pylist()
        sizes = np.array([len(x) for x in data])
        cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1), len(data)] if len(data) else [0]
        parts = [(i, min(i + PACKED, b)) for a, b in zip(cuts, cuts[1:]) for i in range(a, b, PACKED)]
        ids, labels = batch.column("_id"), batch.column("_label")
        out: list[list] = [[], [], [], [], []]
        for a, b in parts:
            packed = planes(np.frombuffer(b"".join(data[a:b]), "<i4").reshape(b - a, sizes[a] // 4))
            values = (ids[a:b].to_pylist(), labels[a:b].to_pylist(), packed.tobytes(), packed.shape[0], packed.shape[1])
            for column, value in zip(out, values):
                column.append(value)
        kinds = (pa.list_(pa.int64()), pa.list_(pa.string()), pa.binary(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["_ids", "_labels", "_planes", "_bits", "_groups"])


class Best:
    """The ``k`` best rows of each slot so far: highest score first, then smallest id."""

    def __init__(self, slots: int, k: int) -> None:
        self.scores = np.full((slots, k), _NONE)
        self.ids = np.full((slots, k), _NOBODY)
        self.k = k

    def add(self, slots: np.ndarray, score: np.ndarray, wanted: np.ndarray, ids: np.ndarray) -> None:
        """``score`` and ``wanted`` are (row, slot)."""
        wanted = wanted & (score >= self.scores[slots, -1])
        if wanted.sum() > 2 * self.k * len(slots) and len(score) > self.k:
            seen = np.where(wanted, score, np.iinfo(score.dtype).min)
            wanted &= seen >= np.partition(seen, len(score) - self.k, axis=0)[len(score) - self.k]
        row, column = np.nonzero(wanted)
        if not len(row):
            return
        met = np.unique(column)
        slot = np.concatenate([slots[column], np.repeat(slots[met], self.k)])
        value = np.concatenate([score[row, column].astype(np.int64), self.scores[slots[met]].ravel()])
        who = np.concatenate([ids[row], self.ids[slots[met]].ravel()])
        # Scores are never the least number, so all but empty places may be negated.
        order = np.lexsort((who, -np.maximum(value, _NONE + 1), slot))
        slot, value, who = slot[order], value[order], who[order]
        first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        kept = place < self.k
        self.scores[slot[kept], place[kept]] = value[kept]
        self.ids[slot[kept], place[kept]] = who[kept]

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        """Slots and places that hold a row."""
        return np.nonzero(self.scores > _NONE)


def _columns(batch: pa.RecordBatch, names: str) -> list[np.ndarray]:
    """Columns of whole numbers; null is ``_NOBODY``."""
    return [batch.column(c).fill_null(_NOBODY).to_numpy(zero_copy_only=False) for c in names.split()]


class _Cell:
    """A block of anchors and the best rows that they have met."""

    def __init__(self, anchors: pa.Table, k: int, share: tuple[int, int] | None) -> None:
        batch = anchors.combine_chunks().to_batches()[0] if len(anchors) else anchors
        self.number = batch.column("_a").to_numpy()
        self.ids = _columns(batch, "_id")[0]
        self.labels = np.array(batch.column("_label").to_pylist(), object)
        data = [np.frombuffer(x, "<i4") for x in batch.column("_numbers").to_pylist()]
        self.numbers = np.zeros((len(data), max(map(len, data))), np.int64)
        for i, x in enumerate(data):
            self.numbers[i, : len(x)] = x
        self.share, self.kept = share, None
        if share is None:
            self.best = Best(len(data), k)
            return
        low, high = share
        offsets = batch.column("_positives").offsets.to_numpy()
        flat = batch.column("_positives").flatten()
        self.width = int(np.diff(offsets).max(initial=0))
        at = np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], np.diff(offsets))
        owner = np.repeat(np.arange(len(data)), np.diff(offsets))
        self.positive = np.full((len(data), self.width), _NOBODY)
        self.score = np.full((len(data), self.width), -1)
        self.positive[owner, at] = flat.field("_id").fill_null(_NOBODY).to_numpy(zero_copy_only=False)
        self.score[owner, at] = flat.field("_score").to_numpy()
        hundreds, rest = self.score // 100, self.score % 100
        # Bounds of whole scores; a positive below zero, or none, has an empty band.
        self.low = low * hundreds + -(-low * rest // 100)
        self.high = np.where(self.score >= 0, high * hundreds + high * rest // 100, _NONE)
        self.best = Best(len(data) * self.width, k)

    def _tables(self, columns: np.ndarray, bits: int) -> np.ndarray:
        numbers = self.numbers[columns]
        bound = int(np.abs(numbers).max(initial=0)) * numbers.shape[1] << bits
        return tables(numbers, np.int32 if bound < 1 << 31 else np.int64)

    def meet(self, ids: np.ndarray, labels: np.ndarray, packed: np.ndarray) -> None:
        if self.share is None:
            for label in set(labels.tolist()) & set(self.labels.tolist()):
                rows, columns = np.flatnonzero(labels == label), np.flatnonzero(self.labels == label)
                for part in np.split(columns, range(COLUMNS, len(columns), COLUMNS)):
                    score = scores(self._tables(part, len(packed)), packed[:, :, rows])
                    self.best.add(part, score, ids[rows][:, None] != self.ids[part], ids[rows])
            return
        if self.kept is None or self.kept[0] != len(packed):
            parts = np.split(np.arange(len(self.ids)), range(COLUMNS, len(self.ids), COLUMNS))
            self.kept = len(packed), [(p, self._tables(p, len(packed))) for p in parts]
        for part, sums in self.kept[1]:
            score = scores(sums, packed)
            other = labels[:, None] != self.labels[part]
            for j in range(self.width):
                wanted = other & (score >= self.low[part, j]) & (score <= self.high[part, j])
                self.best.add(part * self.width + j, score, wanted, ids)

    def answer(self) -> pa.RecordBatch:
        slot, place = self.best.found()
        ids = self.best.ids[slot, place]
        null = lambda x: pa.array(x, pa.int64(), mask=x == _NOBODY)
        if self.share is None:
            return pa.RecordBatch.from_arrays(
                [pa.array(self.number[slot]), null(ids), pa.array(self.best.scores[slot, place])], ["_a", "_id", "_score"]
            )
        anchor, j = slot // self.width, slot % self.width
        return pa.RecordBatch.from_arrays(
            [pa.array(self.number[anchor]), pa.array(j.astype(np.int32)), null(self.ids[anchor]), null(self.positive[anchor, j]), null(ids),
             pa.array(self.score[anchor, j]), pa.array(self.best.scores[slot, place])],
            ["_a", "_j", "_anchor_id", "_positive_id", "_negative_id", "_positive_score", "_negative_score"],
        )


def _met(k: int, share: tuple[int, int] | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by cell, its anchors first: the best rows of each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, cell, held, waiting, count = None, None, [], [], 0

        def scored() -> None:
            nonlocal waiting, count
            by_shape: dict[tuple[int, int], list] = {}
            for ids, labels, packed in waiting:
                by_shape.setdefault(packed.shape[:2], []).append((ids, labels, packed))
            for some in by_shape.values():
                ids, labels = (np.concatenate([x[i] for x in some]) for i in (0, 1))
                cell.meet(ids, labels, np.concatenate([x[2] for x in some], axis=2))
            waiting, count = [], 0

        for batch in batches:
            numbers = batch.column("_cell").to_numpy()
            edges = np.flatnonzero(np.append(True, numbers[1:] != numbers[:-1])) if len(numbers) else []
            for a, b in zip(edges, [*edges[1:], len(numbers)]):
                if numbers[a] != number:
                    if cell is not None:
                        scored()
                        yield cell.answer()
                    number, cell, held = numbers[a], None, []
                part = batch.slice(a, b - a)
                anchors = part.filter(part.column("_ids").is_null())
                held += [anchors] if anchors.num_rows else []
                rows = part.filter(part.column("_ids").is_valid())
                if rows.num_rows and held and cell is None:
                    cell = _Cell(pa.Table.from_batches(held), k, share)
                if cell is None:
                    continue
                shape = zip(*(rows.column(c).to_pylist() for c in ("_ids", "_labels", "_planes", "_bits", "_groups")))
                for ids, labels, data, bits, groups in shape:
                    packed = np.frombuffer(data, np.uint8).reshape(bits, groups, len(ids))
                    who = np.array([_NOBODY if x is None else x for x in ids], np.int64)
                    waiting.append((who, np.array(labels, object), packed))
                    count += len(ids)
                    if count >= ROWS:
                        scored()
        if cell is not None:
            scored()
            yield cell.answer()

    return run


def hard_negatives(
    rows: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", *,
    positives: int = 5, negatives: int = 10, share: tuple[int, int] = (30, 90), scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    A component x counts as floor(``scale`` * x), at most ``LARGEST`` either way; a score is the
    inner product of these, dimensions that one of two rows lacks counting as zero. An anchor's
    positives are the ``positives`` best other rows of its label. For each, the ``negatives`` best
    rows of other labels between the two percentages of its score are returned by rank from 1.
    Equal scores go by smaller key, null last.

    Rows without label or vector, or with a null or non-finite component, take no part; an empty
    vector scores zero. Rows repeated whole count once. Rows that share a key are one row as far
    as an anchor's own positives go, and otherwise rows of their own. An anchor without positives
    or negatives has no rows. An empty table gives none. Columns beyond the three named are read
    only by ``anchors``, a condition on ``rows``.
    """
    scratch = Scratch(rows.sparkSession, "hardnegatives")
    plain = rows.select(
        F.col(key).cast("long").alias("_id"), F.col(label).cast("string").alias("_label"),
        F.coalesce(anchors, F.lit(False)).alias("_anchor"), F.col(vector).cast("array<double>").alias("_vector"),
    ).where("_label IS NOT NULL AND _vector IS NOT NULL")
    known = plain.mapInArrow(_whole(scale), _VALID).groupBy("_id", "_label", "_numbers").agg(F.max("_anchor").alias("_anchor"))
    known = scratch.store(known)

    alike = Window.partitionBy("_label", "_numbers").orderBy(F.col("_id").asc_nulls_last())
    few = known.withColumn("_again", F.row_number().over(alike)).where(F.col("_again") <= max(positives + 1, negatives))
    blocks = scratch.store(few.select("_id", "_label", "_numbers").mapInArrow(_packed, _BLOCKS))

    asked = scratch.store(known.where("_anchor").select(F.monotonically_increasing_id().alias("_a"), "_id", "_label", "_numbers"))
    groups = max(1, -(-asked.count() // ANCHORS))
    slices = max(1, -(-4 * rows.sparkSession.sparkContext.defaultParallelism // groups))

    def dealt(anchors: DataFrame, function: Callable, schema: str) -> DataFrame:
        """Each block of anchors past all rows, in as many slices as keep the cluster busy."""
        left = anchors.withColumn("_block", F.pmod(F.xxhash64("_id", "_numbers"), F.lit(groups)) * slices)
        left = left.withColumn("_cell", F.explode(F.sequence("_block", F.col("_block") + slices - 1)))
        right = blocks.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
        right = right.withColumn("_cell", F.col("_block").cast("long") * slices + F.pmod(F.xxhash64("_planes", "_ids"), F.lit(slices)))
        both = left.drop("_block").unionByName(right.drop("_block"), allowMissingColumns=True)
        spread = both.repartition(groups * slices, "_cell")
        return spread.sortWithinPartitions("_cell", F.col("_ids").isNotNull()).mapInArrow(function, schema)

    ranked = Window.partitionBy("_a").orderBy(F.col("_score").desc(), F.col("_id").asc_nulls_last())
    near = dealt(asked, _met(positives, None), "_a long, _id long, _score long")
    near = near.withColumn("_place", F.row_number().over(ranked)).where(F.col("_place") <= positives)
    lists = near.groupBy("_a").agg(F.array_sort(F.collect_list(F.struct("_place", "_id", "_score"))).alias("_positives"))
    armed = scratch.store(asked.join(lists, "_a"))

    schema = "_a long, _j int, _anchor_id long, _positive_id long, _negative_id long, _positive_score long, _negative_score long"
    hard = dealt(armed, _met(negatives, share), schema)
    ranked = Window.partitionBy("_a", "_j").orderBy(F.col("_negative_score").desc(), F.col("_negative_id").asc_nulls_last())
    hard = hard.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives)
    return hard.select(
        F.col("_anchor_id").alias("anchor_id"), F.col("_positive_id").alias("positive_id"), "rank",
        F.col("_negative_id").alias("negative_id"), F.col("_positive_score").alias("positive_score"),
        F.col("_negative_score").alias("negative_score"),
    )
