"""Words and word n-grams of whole Arrow text columns, as 64-bit fingerprints.

A fingerprint of a word is a polynomial over its bytes, found for all words at once from running
sums; one of an n-gram combines those of its words. Two different words or n-grams share one with
a chance near 2**-61, which the callers accept.
"""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked through in pieces of about so many bytes, cut between words.
PIECE = 1 << 16
#: Text bytes that a task works on at once; about 20 bytes of numbers come with each.
BATCH = 3 << 20
_STEP = 0x9E3779B97F4A7C15
_ODD = 0xD1342543DE82EF95


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int = 0) -> np.ndarray:
    """n odd 64-bit numbers, the same on every machine."""
    steps = np.arange(1 + seed * 1000, 1 + seed * 1000 + n, dtype=np.uint64)
    return mixed(steps * np.uint64(_STEP)) | np.uint64(1)


def blanks() -> np.ndarray:
    """Which bytes separate words: the blank and the control characters 9 to 13."""
    table = np.zeros(256, dtype=bool)
    table[[9, 10, 11, 12, 13, 32]] = True
    return table


def marks() -> np.ndarray:
    """Which bytes separate words: all of ASCII but digits and letters."""
    table = np.arange(256) < 128
    for first, last in ("09", "AZ", "az"):
        table[ord(first) : ord(last) + 1] = False
    return table


@dataclass
class Words:
    """The words of several texts in order. Text i has those from bounds[i] to bounds[i + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    prints: np.ndarray
    bounds: np.ndarray
    data: np.ndarray

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each text begins and ends; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(edges) or edges[-1] == edges[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[edges[0] : edges[-1]], edges - edges[0]


def split(column: pa.Array, separators: np.ndarray, fold: bool) -> Words:
    """Words of every text; ``fold`` makes A to Z equal to a to z in the fingerprints."""
    data, edges = text_bytes(column)
    values = constants(256)
    if fold:
        values[65:91] = values[97:123]
    begins, ends, prints = [], [], []
    powers = inverse = np.zeros(0, np.uint64)
    at = 0
    while at < len(data):
        upto = _cut(data, separators, edges, at)
        part = data[at:upto]
        if len(part) > len(powers):
            powers = np.cumprod(np.full(len(part) + 1, _ODD, np.uint64))
            inverse = np.cumprod(np.full(len(part) + 1, pow(_ODD, -1, 2**64), np.uint64))
        blank = separators[part]
        new = np.zeros(len(part) + 1, dtype=bool)
        inner = edges[np.searchsorted(edges, at) : np.searchsorted(edges, upto, "right")] - at
        new[inner] = True
        new[0] = new[-1] = True
        gap = np.append(blank, True)
        start = np.flatnonzero(~blank & (np.append(True, blank[:-1]) | new[:-1]))
        end = np.flatnonzero(~blank & (gap[1:] | new[1:])) + 1
        sums = np.append(np.uint64(0), np.cumsum(values[part] * powers[: len(part)]))
        prints.append((sums[end] - sums[start]) * inverse[start])
        begins.append(start + at)
        ends.append(end + at)
        at = upto
    empty = np.zeros(0, np.int64)
    starts = np.concatenate(begins) if begins else empty
    return Words(
        starts,
        np.concatenate(ends) if ends else empty,
        mixed(np.concatenate(prints)) if prints else np.zeros(0, np.uint64),
        np.searchsorted(starts, edges),
        data,
    )


def _cut(data: np.ndarray, separators: np.ndarray, edges: np.ndarray, at: int) -> int:
    """Where the piece that begins at ``at`` ends: never inside a word."""
    upto = at + PIECE
    if upto >= len(data):
        return len(data)
    edge = int(edges[np.searchsorted(edges, upto, "right") - 1])
    blank = np.flatnonzero(separators[data[at:upto]])
    best = max(edge, at + int(blank[-1]) + 1 if len(blank) else at)
    while best <= at:
        blank = np.flatnonzero(separators[data[upto : upto + PIECE]])
        after = int(edges[np.searchsorted(edges, at, "right")])
        best = min(after, upto + int(blank[0]) + 1 if len(blank) else after)
        if len(blank) or after <= upto + PIECE:
            return best
        upto, best = upto + PIECE, at
    return best


def grams(words: Words, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprints of all n consecutive words of one text, their texts and first words."""
    count = len(words.prints) - n + 1
    if count <= 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none
    total = np.zeros(count, np.uint64)
    for j, factor in enumerate(constants(n, seed=n)):
        total += words.prints[j : j + count] * factor
    owner = words.owners()[:count]
    first = np.flatnonzero(np.arange(count) + n <= words.bounds[owner + 1])
    return mixed(total[first]), owner[first], first


def pooled(batches: Iterator[pa.RecordBatch], text: str, size: int = BATCH) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts (or lists of numbers) have about ``size`` bytes."""
    held, weight = [], 0
    whole = lambda: pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    for batch in batches:
        column = batch.column(text)
        lengths = pc.list_value_length(column) if pa.types.is_list(column.type) else pc.binary_length(column)
        lengths = lengths.fill_null(0).to_numpy().astype(np.int64) * (8 if pa.types.is_list(column.type) else 1)
        upto = np.append(0, np.cumsum(lengths))
        at = 0
        while at < len(column):
            end = max(at + 1, int(np.searchsorted(upto, upto[at] + size - weight, "right")) - 1)
            held.append(batch.slice(at, end - at))
            weight += int(upto[end] - upto[at])
            at = end
            if weight >= size or at < len(column):
                yield whole()
                held, weight = [], 0
    if held:
        yield whole()


def released() -> None:
    """Give memory that is no longer used back to the machine: workers live on between stages."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        getattr(ctypes.CDLL(None), "malloc_trim", lambda _: None)(0)


def tidy(run: Callable) -> Callable:
    """``run`` (batches to batches), giving memory back once a task is through."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        released()

    return tidied


def tidy_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for a function of one group."""

    def tidied(table: pa.Table) -> pa.Table:
        out = run(table)
        released()
        return out

    return tidied
