"""Documents that hold benchmark items, edited or not.

The embedding of Chakraborty, Goldenberg and Koucky walks over a sequence and, at each step,
writes the word it stands on and moves on or not by a random bit of that word. Two sequences
within a small edit distance soon walk in step again, so their outputs differ in few places:
edit distance becomes Hamming distance. A repetition samples a few steps of one such walk as the
key of an item; every window of a document with the same words at these steps is a candidate.
Items of about one length share their repetitions, whose number is set so that items edited at
the full rate are found with the wanted recall. Candidates whose walks agree often enough are
verified by the exact edit distance in words.

The walk from all windows of a batch is one array that moves step by step, and windows leave it
as soon as a sampled step fits no item.

Short items have too few words for a walk, and of long ones walks may not find enough within the
repetitions allowed. Both are searched for exactly: of one more pieces than
an item may have edits, one must occur unchanged. Pieces are looked up among the n-grams of a
text, and the places where they occur are verified together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.words import Words, blanks, grams, pooled, released, split

#: Benchmark items that are searched for in one pass over the documents.
BLOCK = 20_000
#: Words of a piece that are looked up, numbers that places are verified in at once, and words of
#: an item from which on a place must hold enough of its words to be verified.
PIECE, CELLS, LONG = 8, 1 << 20, 64


@dataclass(frozen=True)
class Settings:
    """``rate``: edits per word of an item that still count as the item; ``words``: shorter items
    are searched for exactly; ``recall``: share of other items edited at the full rate to be found;
    ``repetitions``: items that need more of them for it are searched for exactly as well."""

    rate: float = 0.2
    words: int = 8
    recall: float = 0.95
    samples: int = 3
    agreement: float = 0.3
    repetitions: int = 60
    seed: int = 17


@dataclass
class Repetition:
    """One walk: the bit of a word's fingerprint that moves it at each step, the sampled steps,
    the items' keys up to each sample (sorted) and the items of the whole keys."""

    bits: np.ndarray
    steps: list[int]
    prefixes: list[np.ndarray]
    keys: np.ndarray
    items: np.ndarray
    walks: np.ndarray


@dataclass
class Pieces:
    """Sorted fingerprints of pieces of one length, their items and their first words there."""

    length: int
    keys: np.ndarray
    items: np.ndarray
    offsets: np.ndarray


@dataclass
class Search:
    """Items as fingerprints, their ids, the sorted vocabulary of those that walk, the repetitions
    of all lengths, and the pieces of items that are searched for exactly."""

    ids: list
    items: list[np.ndarray]
    vocabulary: np.ndarray
    repetitions: list[Repetition]
    settings: Settings
    pieces: list[Pieces]


def _walk(prints: np.ndarray, bits: np.ndarray, count: int) -> np.ndarray:
    """Positions of a walk after 0 to ``count`` - 1 steps; at the end it stays."""
    at, out = 0, []
    for j in range(count):
        out.append(at)
        if at < len(prints):
            at += int(prints[at] >> np.uint64(bits[j % 64])) & 1
    return np.array(out)


def _edited(item: np.ndarray, edits: int, rng: np.random.Generator) -> np.ndarray:
    words = item.tolist()
    for _ in range(edits):
        at, kind = int(rng.integers(len(words))), int(rng.integers(3))
        new = int(rng.integers(1, 2**63))
        if kind == 0:
            words[at] = new
        elif kind == 1:
            words.insert(at, new)
        elif len(words) > 1:
            del words[at]
    return np.array(words, np.uint64)


def prepare(ids: list, items: list[np.ndarray], s: Settings = Settings()) -> Search:
    """Choose the repetitions for items given as word fingerprints."""
    kept = [(i, x) for i, x in zip(ids, items) if len(x)]
    ids, items = [i for i, _ in kept], [x for _, x in kept]
    walking = [k for k, x in enumerate(items) if len(x) >= s.words]
    vocabulary = np.unique(np.concatenate([items[k] for k in walking])) if walking else np.zeros(0, np.uint64)
    rng = np.random.default_rng(s.seed)
    search = Search(ids, items, vocabulary, [], s, [])
    exact = [k for k, x in enumerate(items) if len(x) < s.words]
    classes: dict[int, list[int]] = {}
    for k in walking:
        item = items[k]
        classes.setdefault(len(item).bit_length(), []).append(k)
    for bits_, members in sorted(classes.items()):
        length = 1 << (bits_ - 1)
        count = length + length // 2
        # Recall falls with length, so the longest items of a class must reach it as well.
        ranked = sorted(members, key=lambda k: len(items[k]))
        tests = [group[int(rng.integers(len(group)))] for group, many in ((members, 200), (ranked[-max(1, len(ranked) // 10) :], 100)) for _ in range(many)]
        pairs = [(items[k], _edited(items[k], int(s.rate * len(items[k])), rng)) for k in tests]
        found, walks = np.zeros(len(pairs), bool), []
        while len(walks) < s.repetitions and min(found[:200].mean(), found[200:].mean()) < s.recall:
            moves = rng.permutation(64)
            first = int(rng.integers(min(4, length)))
            rest = rng.choice(np.arange(first + 1, count), s.samples - 1, replace=False)
            steps = [first, *sorted(int(x) for x in rest)]
            walks.append((moves, steps))
            for t, (a, b) in enumerate(pairs):
                if not found[t]:
                    pa_, pb = _walk(a, moves, count), _walk(b, moves, count)
                    inside = (pa_ < len(a)) & (pb < len(b))
                    same = inside & (a[np.minimum(pa_, len(a) - 1)] == b[np.minimum(pb, len(b) - 1)])
                    found[t] = same[steps].all() and same.mean() >= s.agreement
        if min(found[:200].mean(), found[200:].mean()) < s.recall:
            exact += members
        else:
            search.repetitions += [_repetition(search, members, moves, steps, count) for moves, steps in walks]
    search.pieces = _pieces(items, exact, s)
    return search


def _pieces(items: list[np.ndarray], members: list[int], s: Settings) -> list[Pieces]:
    """Each item cut into one more pieces than it may have edits."""
    cut: dict[int, list[tuple[int, int]]] = {}
    for k in members:
        many = min(int(s.rate * len(items[k])) + 1, len(items[k]))
        edges = [len(items[k]) * i // many for i in range(many + 1)]
        for a, b in zip(edges[:-1], edges[1:]):
            cut.setdefault(min(b - a, PIECE), []).append((k, a))
    out = []
    for length, places in sorted(cut.items()):
        prints = np.stack([items[k][a : a + length] for k, a in places])
        keys, _, _ = grams(Words(None, None, prints.reshape(-1), np.arange(len(places) + 1) * length, None), length)
        own, offsets = np.array(places, np.int64).T
        order = np.argsort(keys, kind="stable")
        out.append(Pieces(length, keys[order], own[order], offsets[order]))
    return out


def _repetition(search: Search, members: list[int], moves: np.ndarray, steps: list[int], count: int) -> Repetition:
    size = np.uint64(len(search.vocabulary) + 1)
    keys, own, walks = [], [], []
    for k in members:
        item = search.items[k]
        at = _walk(item, moves, count)
        words = np.where(at < len(item), np.searchsorted(search.vocabulary, item[np.minimum(at, len(item) - 1)]), len(search.vocabulary))
        if (at[steps] < len(item)).all():
            part, prefix = np.uint64(0), []
            for step in steps:
                part = part * size + np.uint64(words[step])
                prefix.append(part)
            keys.append(prefix)
            own.append(k)
            walks.append(words)
    table = np.array(keys, np.uint64).reshape(-1, len(steps))
    order = np.argsort(table[:, -1], kind="stable")
    return Repetition(
        moves, steps, [np.unique(table[:, i]) for i in range(len(steps))], table[order, -1],
        np.array(own, np.int64)[order], np.array(walks, np.int32).reshape(-1, count)[order],
    )


def candidates(search: Search, prints: np.ndarray, chunk: int = 1 << 18) -> np.ndarray:
    """Distinct (window, item) pairs of word positions whose walks meet, as rows."""
    found = []
    if not search.repetitions:
        return np.zeros((0, 2), np.int64)
    unknown = len(search.vocabulary)
    most = max((r.walks.shape[1] for r in search.repetitions), default=0) + 1
    for low in range(0, len(prints), chunk):
        part = prints[low : low + chunk + most]
        count = min(chunk, len(prints) - low)
        part = np.append(part, np.zeros(max(0, count + most - len(part)), np.uint64))
        place = np.searchsorted(search.vocabulary, part)
        place[place == unknown] = 0
        words = np.where(search.vocabulary[place] == part, place, unknown).astype(np.int64)
        for r in search.repetitions:
            known = np.zeros(unknown + 1, bool)
            known[r.prefixes[0].astype(np.int64)] = True
            at, done = np.arange(count), 0
            windows, key = None, None
            for i, step in enumerate(r.steps):
                for j in range(done, step):
                    at = at + ((part[at] >> np.uint64(r.bits[j % 64])) & np.uint64(1)).astype(np.int64)
                done = step
                here = words[at]
                if i == 0:
                    windows = np.flatnonzero(known[here])
                    at, key = at[windows], here[windows].astype(np.uint64)
                    continue
                key = key * np.uint64(unknown + 1) + here.astype(np.uint64)
                spot = np.searchsorted(r.prefixes[i], key)
                spot[spot == len(r.prefixes[i])] = 0
                live = (r.prefixes[i][spot] == key) & (here < unknown) if len(r.prefixes[i]) else np.zeros(len(key), bool)
                windows, at, key = windows[live], at[live], key[live]
            if not len(windows):
                continue
            first, last = np.searchsorted(r.keys, key, "left"), np.searchsorted(r.keys, key, "right")
            which = np.repeat(first, last - first) + np.arange((last - first).sum()) - np.repeat(np.cumsum(last - first) - (last - first), last - first)
            windows = np.repeat(windows, last - first)
            at, same = windows.copy(), np.zeros(len(windows), np.int64)
            for j in range(r.walks.shape[1]):
                same += (words[at] == r.walks[which, j]) & (words[at] < unknown)
                at = at + ((part[at] >> np.uint64(r.bits[j % 64])) & np.uint64(1)).astype(np.int64)
            live = same >= search.settings.agreement * r.walks.shape[1]
            found.append(np.stack([windows[live] + low, r.items[which[live]]], 1))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def edits(pattern: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to any part of ``text``, and where that part ends.

    Myers' algorithm: a column of the table is two long numbers, one bit per word.
    """
    places: dict[int, int] = {}
    for i, word in enumerate(pattern.tolist()):
        places[word] = places.get(word, 0) | 1 << i
    full, top = (1 << len(pattern)) - 1, 1 << (len(pattern) - 1)
    plus, minus, now = full, 0, len(pattern)
    best = (now, 0)
    for end, word in enumerate(text.tolist(), 1):
        equal = places.get(word, 0)
        vertical = equal | minus
        horizontal = (((equal & plus) + plus) ^ plus) | equal
        up, down = minus | ~(horizontal | plus) & full, plus & horizontal
        now += bool(up & top) - bool(down & top)
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | ~(vertical | up) & full, up & vertical
        best = min(best, (now, end))
    return best


def _nearest_parts(patterns: np.ndarray, regions: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``edits`` of each pattern to the region in the same row, all rows at once."""
    columns = np.arange(regions.shape[1] + 1, dtype=np.int32)
    row = np.zeros((len(regions), len(columns)), np.int32)
    for i in range(patterns.shape[1]):
        new = np.full_like(row, i + 1)
        new[:, 1:] = np.minimum(row[:, :-1] + ~((regions == patterns[:, i : i + 1]) & valid), row[:, 1:] + 1)
        row = np.minimum.accumulate(new - columns, axis=1) + columns
    ends = row.argmin(1)
    return row[np.arange(len(row)), ends], ends


def _places(search: Search, words: Words) -> Iterator[np.ndarray]:
    """(item, text, region) where pieces occur, as rows in sets of bounded size.

    Of an item with ``most`` edits, places that begin in the same ``most`` + 1 words share a region.
    """
    sizes = np.array([len(x) for x in search.items], np.int64)
    step = (search.settings.rate * sizes).astype(np.int64) + 1
    for p in search.pieces:
        prints, owner, first = grams(words, p.length)
        low, high = np.searchsorted(p.keys, prints, "left"), np.searchsorted(p.keys, prints, "right")
        hit = np.flatnonzero(high > low)
        low, many = low[hit], (high - low)[hit]
        upto = np.append(0, np.cumsum(many))
        at = 0
        while at < len(hit):
            end = max(at + 1, int(np.searchsorted(upto, upto[at] + CELLS, "right")) - 1)
            part = slice(at, end)
            which = np.repeat(low[part] - upto[at:end], many[part]) + np.arange(upto[at], upto[end])
            window, item = np.repeat(first[hit[part]], many[part]), p.items[which]
            yield np.unique(np.stack([item, np.repeat(owner[hit[part]], many[part]), (window - p.offsets[which]) // step[item]], 1), axis=0)
            at = end


def exact_leaks(search: Search, words: Words) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, end word, edits) of places of the items that are searched for exactly."""
    sizes = np.array([len(x) for x in search.items], np.int64)
    for places in _places(search, words):
        length = sizes[places[:, 0]]
        for n in np.unique(length):
            group, most = places[length == n], int(search.settings.rate * n)
            width = n + 3 * most
            rows = max(1, CELLS // int(width))
            for at in range(0, len(group), rows):
                k, text, region = group[at : at + rows].T
                begin = region * (most + 1) - most
                spots = begin[:, None] + np.arange(width)
                valid = (spots >= words.bounds[text][:, None]) & (spots < words.bounds[text + 1][:, None])
                if n >= LONG:
                    full = np.zeros(len(k), bool)
                    for i in np.unique(k):
                        own = np.flatnonzero(k == i)
                        here = np.isin(words.prints[np.where(valid[own], spots[own], 0)], search.items[i]) & valid[own]
                        full[own] = here.sum(1) >= n - most
                    k, text, begin, spots, valid = k[full], text[full], begin[full], spots[full], valid[full]
                    if not len(k):
                        continue
                patterns = np.stack([search.items[i] for i in k])
                counts, ends = _nearest_parts(patterns, words.prints[np.where(valid, spots, 0)], valid)
                good = np.flatnonzero(counts <= most)
                yield from zip(text[good].tolist(), k[good].tolist(), (begin + ends - words.bounds[text])[good].tolist(), counts[good].tolist())


def leaks(search: Search, words: Words) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, end word, edits) of every item found in a text, with the fewest edits."""
    best: dict[tuple[int, int], tuple[int, int]] = {}
    owners = words.owners()
    for window, k in candidates(search, words.prints).tolist():
        item = search.items[k]
        most = int(search.settings.rate * len(item))
        text = int(owners[window])
        low, high = int(words.bounds[text]), int(words.bounds[text + 1])
        first = max(low, window - most)
        # Windows around a place already settled without edits add nothing.
        if best.get((text, k), (1, 0))[0] == 0:
            continue
        count, end = edits(item, words.prints[first : min(high, window + len(item) + most)])
        if count <= most:
            best[text, k] = min(best.get((text, k), (count, first + end - low)), (count, first + end - low))
    for text, k, end, count in exact_leaks(search, words):
        best[text, k] = min(best.get((text, k), (count, end)), (count, end))
    for (text, k), (count, end) in sorted(best.items()):
        yield text, k, end, count


def searches(items: DataFrame, text: str = "text", key: str = "item_id", s: Settings = Settings(), block: int = BLOCK) -> Iterator[Search]:
    """The benchmark in blocks of about ``block`` items; items without key or text are left out."""
    rows = items.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where("key IS NOT NULL AND text IS NOT NULL")
    blocks = max(1, -(-rows.count() // block))
    for b in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).toArrow().sort_by([("key", "ascending"), ("text", "ascending")])
        column = part.column("text").combine_chunks()
        words = split(column, blanks(), True)
        yield prepare(part.column("key").to_pylist(), [words.prints[a:b] for a, b in zip(words.bounds[:-1], words.bounds[1:])], s)


def _reporting(search: Search) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pooled(batches, "_text"):
            out = list(leaks(search, split(batch.column("_text"), blanks(), True)))
            rows, items, ends, counts = zip(*out) if out else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id").take(pa.array(rows, pa.int64())), pa.array(items, pa.int64()),
                    pa.array(ends, pa.int64()), pa.array(counts, pa.int64()),
                ],
                names=["_id", "_item", "end_word", "edits"],
            )

    return run


def find_leaks(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id", s: Settings = Settings()) -> DataFrame:
    """(key, item, end_word, edits): documents that hold an item with at most ``rate`` edits a word.

    One row per document row and item, with the fewest edits and the word at which that place
    ends. Words are separated by ASCII white space, A-Z equal to a-z. Items shorter than
    ``words`` words or too long for the repetitions are found without exception. Null or empty items are not searched for; null and
    empty texts hold none.
    Of repeated items each is reported; repeated rows are judged one by one, null keys kept.
    Other columns are not read; an empty table on either side gives none.
    """
    base = docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text"))
    kind, item_kind = dict(base.dtypes)["_id"], dict(items.dtypes)[item]
    out = None
    for search in searches(items, "text", item, s):
        found = base.mapInArrow(_reporting(search), f"_id {kind}, _item long, end_word long, edits long")
        names = docs.sparkSession.createDataFrame(list(enumerate(search.ids)), f"_item long, _name {item_kind}")
        found = found.join(F.broadcast(names), "_item").select(F.col("_id").alias(key), F.col("_name").alias(item), "end_word", "edits")
        out = found if out is None else out.unionByName(found)
    return out


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item: str = "item_id", s: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no item. Cases as in ``find_leaks``."""
    for search in searches(items, "text", item, s):
        docs = docs.where(~_holding(search)(F.col(text).cast("string")))
    return docs


def _holding(search: Search):
    @F.arrow_udf("boolean")
    def holds(column: pa.Array) -> pa.Array:
        out, at = np.zeros(len(column), bool), 0
        for batch in pooled([pa.RecordBatch.from_arrays([column], names=["_text"])], "_text"):
            out[[at + t for t, *_ in leaks(search, split(batch.column("_text"), blanks(), True))]] = True
            at += batch.num_rows
        released()
        return pa.array(out)

    return holds
