"""Removal of passages that earlier documents hold, after the manner of relative Lempel-Ziv parsing.

It is no parse in the strict sense: factors are made of windows that the smallest earlier document
holds, and nothing checks that they follow each other there, nor is a longest match sought. The
words removed are those of the longest factors.

The reference of a document is every document with a smaller key. Its index lists all windows of
``size`` words and is cut into blocks by fingerprint. Every document probes every block that can
hold one of its windows, so each factor boundary is checked as well. The answers come back as one
bit per window and the earlier document that holds it. The document is then factored greedily:
from left to right a factor runs on as long as its windows continue in one reference document.
Factors of ``size`` words or more are duplicate spans; shorter ones are literals.

What documents of one batch settle among each other is not sent: of a window that several of
them hold, only the smallest key's travels to its block. A passage that a third of all documents
share therefore adds one entry per batch to a block, not one per document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.words import blanks, grams, pooled, split

#: Windows in one block of the index, and documents whose answers travel in one row.
BLOCK, BUCKET = 2_000_000, 1000
_LAST = np.iinfo(np.int64).max

_PROBES = pa.schema([
    ("block", pa.int32()), ("rows", pa.binary()), ("ids", pa.binary()), ("counts", pa.binary()),
    ("known", pa.binary()), ("sources", pa.binary()), ("windows", pa.binary()),
])
_ANSWERS = "bucket long, block int, rows binary, counts binary, hits binary, sources binary"


def block_of(prints: np.ndarray, blocks: int) -> np.ndarray:
    return ((prints >> np.uint64(40)) * np.uint64(blocks) >> np.uint64(24)).astype(np.int32)


def _probing(size: int, blocks: int) -> Callable:
    """The windows of every document, dealt to the blocks of the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in pooled(batches, "_text"):
            row, pick = np.unique(table.column("_row").to_numpy(), return_index=True)
            table = table.take(pa.array(pick))
            prints, owner, _ = grams(split(table.column("_text"), blanks(), False), size)
            if not len(prints):
                continue
            ids = table.column("_id").fill_null(_LAST).to_numpy()
            held = ids[owner]
            order = np.argsort(prints)
            fresh = np.flatnonzero(np.append(True, prints[order][1:] != prints[order][:-1]))
            earliest = np.empty(len(prints), np.int64)
            earliest[order] = np.repeat(np.minimum.reduceat(held[order], fresh), np.diff(np.append(fresh, len(order))))
            known = earliest < held
            place = block_of(prints, blocks)
            order = np.argsort(place, kind="stable")
            cuts = np.searchsorted(place[order], np.arange(blocks + 1))
            for b in range(blocks):
                at = order[cuts[b] : cuts[b + 1]]
                if not len(at):
                    continue
                docs = owner[at]
                new = np.flatnonzero(np.append(True, docs[1:] != docs[:-1]))
                own, told = docs[new], known[at]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([x], t)
                        for x, t in zip(
                            (
                                b, row[own].tobytes(), ids[own].tobytes(),
                                np.diff(np.append(new, len(at))).astype(np.int32).tobytes(),
                                np.packbits(told).tobytes(), earliest[at[told]].tobytes(), prints[at[~told]].tobytes(),
                            ),
                            _PROBES.types,
                        )
                    ],
                    schema=_PROBES,
                )

    return run


def _answered(buckets: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        return _packed(*_answers(table), table.column("block")[0].as_py(), buckets)

    return run


def _packed(rows: np.ndarray, counts: np.ndarray, hit: np.ndarray, source: np.ndarray, block: int, buckets: int) -> pa.Table:
    """The answers of a block for documents with a hit, many documents to a row."""
    edges = np.append(0, np.cumsum(counts))
    some = np.flatnonzero(np.add.reduceat(hit, edges[:-1])) if len(counts) else np.zeros(0, np.int64)
    # Equal documents get equal answers from every batch.
    _, once = np.unique(rows[some], return_index=True)
    some = some[once]
    place = (rows[some].view(np.uint64) % np.uint64(buckets)).astype(np.int64)
    out = []
    for bucket in np.unique(place):
        docs = some[place == bucket]
        at = np.concatenate([np.arange(edges[d], edges[d + 1]) for d in docs])
        out.append((
            int(bucket), block, rows[docs].tobytes(), counts[docs].astype(np.int32).tobytes(),
            np.packbits(hit[at]).tobytes(), source[at[hit[at]]].tobytes(),
        ))
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    columns = zip(*out) if out else ((),) * 6
    names = ["bucket", "block", "rows", "counts", "hits", "sources"]
    return pa.table([pa.array(list(x), t) for x, t in zip(columns, kinds)], names=names)


def _gathered(table: pa.Table) -> pa.Table:
    """All answers for each document of a bucket: one row per document with a hit."""
    found: dict[int, list] = {}
    for cell in table.to_pylist():
        rows, counts = np.frombuffer(cell["rows"], np.int64), np.frombuffer(cell["counts"], np.int32)
        edges = np.append(0, np.cumsum(counts))
        hit = np.unpackbits(np.frombuffer(cell["hits"], np.uint8), count=int(edges[-1])).astype(bool)
        source = np.frombuffer(cell["sources"], np.int64)
        used = np.append(0, np.cumsum(hit))
        for row, a, b in zip(rows.tolist(), edges[:-1].tolist(), edges[1:].tolist()):
            answer = {"block": cell["block"], "hits": np.packbits(hit[a:b]).tobytes(), "sources": source[used[a] : used[b]].tobytes()}
            found.setdefault(row, []).append(answer)
    struct = pa.struct([("block", pa.int32()), ("hits", pa.binary()), ("sources", pa.binary())])
    return pa.table({"_row": pa.array(list(found), pa.int64()), "answers": pa.array(list(found.values()), pa.list_(struct))})


def _answers(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every document with windows in this block, which of them an earlier document holds.

    Its rows, the number of windows of each, whether each window is held, and by which document.
    """
    cells = {c: [x.as_py() for x in table.column(c)] for c in table.column_names[1:]}
    join = lambda name, kind: np.frombuffer(b"".join(cells[name]), kind)
    rows, ids, counts = join("rows", np.int64), join("ids", np.int64), join("counts", np.int32)
    totals = [int(np.frombuffer(x, np.int32).sum()) for x in cells["counts"]]
    known = np.concatenate(
        [np.unpackbits(np.frombuffer(x, np.uint8), count=n) for x, n in zip(cells["known"], totals)]
    ).astype(bool)
    source = np.full(len(known), _LAST, np.int64)
    source[known] = join("sources", np.int64)
    held = np.repeat(ids, counts)
    windows, mine = join("windows", np.uint64), held[~known]
    if len(windows):
        order = np.argsort(windows)
        ordered = windows[order]
        fresh = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        first = np.repeat(np.minimum.reduceat(mine[order], fresh), np.diff(np.append(fresh, len(order))))
        found = np.empty(len(windows), np.int64)
        found[order] = first
        source[~known] = np.where(found < mine, found, _LAST)
    return rows, counts, source < _LAST, source


def factored(hit: np.ndarray, source: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """Factors (first word, end, reference) of a text from its windows' answers, left to right."""
    if not hit.any():
        return []
    source = np.where(hit, source, _LAST)
    new = np.flatnonzero(np.append(True, source[1:] != source[:-1]))
    last = np.append(new[1:], len(source)) - 1
    return [(int(a), int(b) + size, int(source[a])) for a, b in zip(new, last) if hit[a]]


def _parsed(size: int, blocks: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pooled(batches, "_text"):
            answers = batch.column("answers").to_pylist()
            some = np.flatnonzero([bool(a) for a in answers])
            spans: list[list] = [[] for _ in answers]
            if len(some):
                words = split(batch.column("_text").take(pa.array(some)), blanks(), False)
                prints, owner, _ = grams(words, size)
                edges = np.searchsorted(owner, np.arange(len(some) + 1))
                for k, i in enumerate(some):
                    part = prints[edges[k] : edges[k + 1]]
                    place = block_of(part, blocks)
                    order = np.argsort(place, kind="stable")
                    hit, source = np.zeros(len(part), bool), np.zeros(len(part), np.int64)
                    for answer in answers[i]:
                        at = order[slice(*np.searchsorted(place[order], [answer["block"], answer["block"] + 1]))]
                        at = at[np.unpackbits(np.frombuffer(answer["hits"], np.uint8), count=len(at)).astype(bool)]
                        hit[at], source[at] = True, np.frombuffer(answer["sources"], np.int64)
                    spans[i] = factored(hit, source, size)
            n_words, n_removed, kept = [], [], []
            for text, factors in zip(batch.column("_text").cast(pa.binary()).to_pylist(), spans):
                words_ = (text or b"").split()
                keep = np.ones(len(words_), bool)
                for first, end, _ in factors:
                    keep[first:end] = False
                n_words.append(len(words_))
                n_removed.append(int(len(words_) - keep.sum()))
                kept.append(b" ".join(compress(words_, keep.tolist()) if factors else words_))
            struct = pa.struct([("first_word", pa.int64()), ("end_word", pa.int64()), ("reference", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()), pa.array(spans, pa.list_(struct)),
                ],
                names=["_id", "n_words", "n_removed", "kept", "spans"],
            )

    return run


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", *, size: int = 13) -> DataFrame:
    """Per row of ``docs``: its key, n_words, n_removed, kept (the words left) and spans.

    A word goes if a window of ``size`` words that covers it also starts in a row with a smaller
    key; all windows are judged on the texts as given. spans lists the factors that were removed
    (first_word, end_word, reference: the smallest key with these windows that was met), which
    may overlap where the reference changes. Words are separated by ASCII white space and kept
    as they are, joined by one blank. ``key`` must be a whole number; rows with a null key count
    as later than all others, and rows with equal keys do not remove words from each other.
    Null and blank texts have no words; texts shorter than a window stay. Other columns of
    ``docs`` are not read. An empty table gives none. Windows are compared by 64-bit fingerprint.
    """
    base = docs.select(F.col(key).cast("long").alias("_id"), F.col(text).cast("string").alias("_text")).withColumn(
        "_row", F.xxhash64("_id", "_text")
    )
    # Words are about six bytes long; blocks need only be of about equal, bounded size.
    volume, count = base.agg(F.sum(F.octet_length("_text")), F.count("*")).first()
    blocks = max(1, min(-(-(volume or 0) // (6 * BLOCK)), 1 << 24))
    probes = base.mapInArrow(_probing(size, blocks), ", ".join(f"{f.name} {'int' if f.name == 'block' else 'binary'}" for f in _PROBES))
    gathered = (
        probes.groupBy("block").applyInArrow(_answered(max(1, count // BUCKET)), _ANSWERS)
        .groupBy("bucket").applyInArrow(_gathered, "_row long, answers array<struct<block: int, hits: binary, sources: binary>>")
    )
    struct = "array<struct<first_word: long, end_word: long, reference: long>>"
    return (
        base.join(gathered, "_row", "left").select("_id", "_text", "answers")
        .mapInArrow(_parsed(size, blocks), f"_id long, n_words long, n_removed long, kept string, spans {struct}")
        .withColumnRenamed("_id", key)
    )
