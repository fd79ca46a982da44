"""Spelling variants: words one edit apart, grouped under their most frequent form.

Sorted-list dynamic programming: words are matched with a sorted vocabulary, of which adjacent
words share prefixes. A row of the edit matrix belongs to a prefix, so it is worked out once for
all adjacent words that share it (their longest common prefixes tell where the next one begins),
and a range of words whose prefix is already more than one edit away is skipped. Of a row only
the three cells within one edit of the diagonal are kept. The ranges of one length of prefix are
scanned together, for all words that ask.

The vocabulary is dealt out in cells. One edit leaves the first or the last half of the shorter
of two words whole, so words meet in the sorted list of those that begin alike or, read
backwards, of those that end alike. A large cell is cut into tiles of words that ask by words
that are asked, so that no task holds more than a bounded number of words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.llm.scratch import Scratch, partitions, small

#: Words of a cell before it is cut into tiles; words and matrix rows worked on at a time.
CELL, BATCH, ROWS = 20_000, 20_000, 500_000
#: Above this, an edit distance is just too large.
_FAR = 2


def _lengths_in_common(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each sorted word the length of the prefix that it shares with the one before; -1 where ``first``."""
    out = np.full(len(codes), -1)
    if len(codes) > 1:
        out[1:] = (codes[1:] != codes[:-1]).argmax(axis=1)
    out[first] = -1
    return out


def near_pairs(codes: np.ndarray, lengths: np.ndarray, cells: np.ndarray, depths: np.ndarray, asks: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (asking, asked) of words in the same cell that differ by exactly one edit.

    ``codes`` has the code points of the words, sorted within each cell and padded with at least
    two zeros; all words of a cell share their first ``depths`` code points.
    """
    sorted_ = np.flatnonzero(asked)
    queries = np.flatnonzero(asks)
    if not len(sorted_) or not len(queries):
        return queries[:0], queries[:0]
    size = lengths[sorted_]
    cell = cells[sorted_]
    common = _lengths_in_common(codes[sorted_], np.append(True, cell[1:] != cell[:-1]))
    framed = np.zeros((len(codes), codes.shape[1] + 2), codes.dtype)
    framed[:, 1:-1] = codes
    # By length of prefix: where its ranges begin, and where those long enough do.
    ranges: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def at(depth: int) -> tuple[np.ndarray, np.ndarray]:
        if depth not in ranges:
            new = common < depth
            ranges[depth] = np.append(np.flatnonzero(new), len(new)), np.flatnonzero(new & (size >= depth))
        return ranges[depth]

    found: list[tuple[np.ndarray, np.ndarray]] = []
    stack = []
    root = np.searchsorted(cell, cells[queries])
    present = (root < len(cell)) & (cell[np.minimum(root, len(cell) - 1)] == cells[queries])
    queries, root = queries[present], root[present]
    for depth in np.unique(depths[queries]):
        own = depths[queries] == depth
        nodes = np.searchsorted(at(depth)[1], root[own])
        row = np.array([1 if depth else _FAR, 0, 1], np.int8)
        stack.append((int(depth), queries[own], nodes, *(np.full(own.sum(), x, np.int8) for x in row)))
    while stack:
        depth, query, node, left, middle, right = stack.pop()
        if len(query) > ROWS:
            half = len(query) // 2
            stack += [(depth, *(x[:half] for x in (query, node, left, middle, right))), (depth, *(x[half:] for x in (query, node, left, middle, right)))]
            continue
        edges, starts = at(depth)
        low = starts[node]
        ends = size[low] == depth
        if ends.any():
            off = lengths[query] - depth
            exact = (off == -1) & (left == 1) | (off == 0) & (middle == 1) | (off == 1) & (right == 1)
            hit = ends & exact
            found.append((query[hit], sorted_[low[hit]]))
        high = edges[np.searchsorted(edges, low, "right")]
        following = at(depth + 1)[1]
        begin, end = np.searchsorted(following, low), np.searchsorted(following, high)
        count = end - begin
        total = int(count.sum())
        if not total:
            continue
        parent = np.repeat(np.arange(len(query)), count)
        node = np.arange(total) - np.repeat(np.cumsum(count) - count, count) + begin[parent]
        query, left, middle, right = query[parent], left[parent], middle[parent], right[parent]
        letter = codes[sorted_[following[node]], depth]
        inner = framed.shape[1] - 1
        differs = [(framed[query, min(depth + j, inner)] != letter).astype(np.int8) for j in range(3)]
        left = np.minimum(left + differs[0], middle + 1)
        middle = np.minimum(np.minimum(middle + differs[1], right + 1), left + 1)
        right = np.minimum(np.minimum(right + differs[2], middle + 1), _FAR)
        left, middle = np.minimum(left, _FAR), np.minimum(middle, _FAR)
        near = np.minimum(np.minimum(left, middle), right) < _FAR
        if near.any():
            stack.append((depth + 1, *(x[near] for x in (query, node, left, middle, right))))
    if not found:
        return queries[:0], queries[:0]
    return tuple(np.concatenate([x[i] for x in found]) for i in (0, 1))


def _matched(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Words of whole cells: each with the number of near words there and the most frequent one."""
    texts = batch.column("_word").to_pylist()
    lengths = np.array([len(t) for t in texts])
    width = int(lengths.max(initial=0)) + 2
    codes = np.zeros((len(texts), width), np.uint32)
    flat = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
    offset = np.cumsum(lengths) - lengths
    codes[np.repeat(np.arange(len(texts)), lengths), np.arange(len(flat)) - np.repeat(offset, lengths)] = flat
    cells = _cells(batch)
    short = batch.column("_short").to_numpy()
    back = batch.column("_back").to_numpy(zero_copy_only=False)
    half = short // 2
    asks, asked = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_asks", "_asked"))
    a, b = near_pairs(codes, lengths, cells, np.where(back, short - half, half), asks, asked)
    # Each pair counts in one cell: that of its shorter word, and of its beginning if that will do.
    keep = np.minimum(lengths[a], lengths[b]) == short[a]
    alike = back[a].copy()
    for i in range(int(half.max(initial=0))):
        x, y = lengths[a] - 1 - i, lengths[b] - 1 - i
        alike &= (i >= half[a]) | (codes[a, np.maximum(x, 0)] == codes[b, np.maximum(y, 0)])
    a, b = a[keep & ~alike], b[keep & ~alike]
    plain = np.array([t[::-1] if r else t for t, r in zip(texts, back.tolist())], object)
    n = batch.column("_n").to_numpy()
    rank = np.unique(plain[b].astype(str), return_inverse=True)[1] if len(b) else b
    order = np.lexsort((rank, -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else a
    count = np.diff(np.append(first, len(a)))
    return pa.RecordBatch.from_arrays(
        [pa.array(plain[a[first]], pa.string()), pa.array(count.astype(np.int64)), pa.array(n[b[first]].astype(np.int64)), pa.array(plain[b[first]], pa.string())],
        ["_word", "_near", "_best_n", "_best"],
    )


def _cells(batch: pa.RecordBatch) -> np.ndarray:
    """Rising numbers of the cells of sorted rows."""
    new = np.zeros(batch.num_rows, bool)
    for name in ("_back", "_short", "_half", "_tile"):
        values = np.array(batch.column(name).to_pylist(), object)
        new[1:] |= values[1:] != values[:-1]
    return np.cumsum(new)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            held.append(batch.slice(at, BATCH))
            if sum(x.num_rows for x in held) < BATCH:
                continue
            whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            cells = _cells(whole)
            begun = int(np.searchsorted(cells, cells[-1]))
            if begun:
                yield _matched(whole.slice(0, begun))
            held = [whole.slice(begun)]
    if held:
        yield _matched(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def _dealt(words: DataFrame, cell: int, scratch: Scratch) -> DataFrame:
    """``words`` (_word, _n) in their cells: from the front and backwards, as the shorter and the longer of two."""
    length = F.length("_word")
    kinds = []
    for less in (0, 1):
        short = length - less
        half = F.floor(short / 2).cast("int")
        kinds.append(F.struct(F.lit(False).alias("_back"), short.alias("_short"), F.substring(F.col("_word"), F.lit(1), half).alias("_half"), F.col("_word").alias("_word")))
        turned = F.reverse("_word")
        kinds.append(F.struct(F.lit(True).alias("_back"), short.alias("_short"), F.substring(turned, F.lit(1), short - half).alias("_half"), turned.alias("_word")))
    keyed = words.select("_n", F.explode(F.array(*kinds)).alias("_c")).select("_n", "_c.*").where("_short > 0")
    keys = ["_back", "_short", "_half"]
    large = scratch.store(keyed.groupBy(*keys).count().where(F.col("count") > cell))
    large = large.select(*keys, F.ceil(F.col("count") / cell).cast("int").alias("_cuts"))
    spread = keyed.join(small(large), keys, "left").withColumn("_cuts", F.coalesce("_cuts", F.lit(1)))
    own = F.pmod(F.xxhash64("_word"), F.col("_cuts")).cast("int")
    upto = F.sequence(F.lit(0), F.col("_cuts") - 1)
    tile = lambda i, j, asks, asked: F.struct((i * F.col("_cuts") + j).cast("int").alias("_tile"), asks.alias("_asks"), asked.alias("_asked"))
    asking = F.transform(upto, lambda j: tile(F.col("_own"), j, F.lit(True), j == F.col("_own")))
    others = F.transform(F.filter(upto, lambda i: i != F.col("_own")), lambda i: tile(i, F.col("_own"), F.lit(False), F.lit(True)))
    tiled = spread.withColumn("_own", own).withColumn("_t", F.explode(F.concat(asking, others)))
    return tiled.select(*keys, "_word", "_n", "_t.*")


def near_words(words: DataFrame, word: str = "word", n: str = "n", cell: int = CELL) -> DataFrame:
    """(word, n_near, best_n, best) of all words that have a word one edit from them.

    ``best`` is the near word of largest ``n``, the smallest in code point order of several.
    ``words`` has distinct words with counts; null and empty words take no part.
    """
    scratch = Scratch(words.sparkSession, "spelling")
    plain = words.select(F.col(word).cast("string").alias("_word"), F.col(n).cast("long").alias("_n")).where("_word <> ''")
    dealt = _dealt(plain, cell, scratch)
    keys = ["_back", "_short", "_half", "_tile"]
    sorted_ = dealt.repartition(partitions(dealt), *keys).sortWithinPartitions(*keys, "_word")
    found = sorted_.mapInArrow(_near, "_word string, _near long, _best_n long, _best string")
    best = F.min(F.struct((-F.col("_best_n")).alias("n"), F.col("_best").alias("word")))
    merged = found.groupBy("_word").agg(F.sum("_near").alias("_near"), best.alias("_b"))
    return merged.select(F.col("_word").alias(word), F.col("_near").alias("n_near"), (-F.col("_b.n")).alias("best_n"), F.col("_b.word").alias("best"))


def word_counts(occurrences: DataFrame, word: str = "word", shortest: int = 6, least: int = 5) -> DataFrame:
    """(word, n): words of at least ``shortest`` code points that occur at least ``least`` times."""
    long = occurrences.where(F.length(word) >= shortest)
    return long.groupBy(word).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _roots(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(_word, _root): where the links (_word, _root) end; each pass doubles the steps taken."""
    while True:
        onward = links.select(F.col("_word").alias("_from"), F.col("_root").alias("_to"))
        moved = scratch.store(links.join(onward, F.col("_root") == F.col("_from"), "left").select(
            "_word", F.coalesce("_to", "_root").alias("_root"), F.col("_to").isNotNull().alias("_moved")
        ))
        if moved.where("_moved").isEmpty():
            return moved.drop("_moved")
        links = moved.drop("_moved")


def variants(words: DataFrame, word: str = "word", n: str = "n", ratio: int = 5, cell: int = CELL) -> DataFrame:
    """(word, form, root, n, n_near, form_n), a row per word of ``words`` (distinct, with counts).

    Near words differ by exactly one inserted, deleted or replaced code point. A word's form is
    its near word of largest ``n`` (ties: smallest in code point order) if that is at least
    ``ratio`` times its own; form_n is the form's ``n``. Forms lead to larger counts, so following
    them ends: there is the root, the word itself if it has no form. Words that are null or empty
    have no near words. An empty table gives none. Columns beyond the two named are not read.
    """
    scratch = Scratch(words.sparkSession, "spelling")
    known = scratch.store(words.select(F.col(word).cast("string").alias("_own"), F.col(n).cast("long").alias("_count")))
    near = near_words(known, "_own", "_count", cell).withColumnRenamed("_own", "_word")
    joined = known.join(near, F.col("_own") == F.col("_word"), "left").drop("_word")
    # A word that never occurs counts as once, so that forms always lead to larger counts.
    formed = F.col("best_n") >= ratio * F.greatest("_count", F.lit(1))
    judged = scratch.store(joined.select(
        "_own", "_count", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(formed, F.col("best")).alias("form"), F.when(formed, F.col("best_n")).alias("form_n"),
    ))
    links = judged.where("form IS NOT NULL").select(F.col("_own").alias("_word"), F.col("form").alias("_root"))
    ends = _roots(links, scratch)
    return judged.join(ends, F.col("_own") == F.col("_word"), "left").select(
        F.col("_own").alias("word"), "form", F.coalesce("_root", "_own").alias("root"), F.col("_count").alias("n"), "n_near", "form_n"
    )
