"""Language of texts by unigram pieces, summed over all segmentations.

The vocabulary is that of a public tokenizer and fixed. A language is a distribution over its
pieces; the probability of a word is the sum, over all ways to cut it into pieces, of the product
of their probabilities, which a forward pass over its characters finds. Training fits the
distributions by expectation maximisation over the words of a bounded sample, with the matching
backward pass. A text's probability is the product over its words.

Words are worked through in numpy, all distinct words of a batch at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaylens.llm.words import Words, blanks, constants, marks, mixed, pooled, split

#: Longest piece and longest run of a word, in bytes, that are scored at once.
PIECE_BYTES, RUN_BYTES = 12, 32
#: Most numbers that a forward pass holds at once; more words are worked through in parts.
NUMBERS = 4_000_000
#: Languages whose rates are broadcast; beyond it the join is left to Spark.
BROADCAST = 20_000
_ODD = 0xD1342543DE82EF95


@dataclass(frozen=True)
class Settings:
    """``documents``: about so many documents per language are learned from. ``unknown``:
    probability of a character outside the vocabulary; ``smoothing``: count added to every piece."""

    documents: int = 500
    rounds: int = 4
    smoothing: float = 0.05
    unknown: float = 1e-7
    seed: int = 3


@dataclass
class Model:
    """Piece fingerprints in rising order, and per piece and language its probability.

    The last row is for no piece: probability 0.
    """

    languages: list[str]
    pieces: np.ndarray
    chances: np.ndarray
    unknown: float


def vocabulary(path: str) -> np.ndarray:
    """Fingerprints of the lower-case pieces of a tokenizer's vocabulary, in rising order."""
    tokens = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = set()
    for i in range(tokens.get_piece_size()):
        if not (tokens.is_control(i) or tokens.is_unknown(i) or tokens.is_byte(i)):
            piece = tokens.id_to_piece(i).replace("▁", " ")
            if piece == piece.lower() and 0 < len(piece.encode()) <= PIECE_BYTES:
                pieces.add(piece.encode())
    values = constants(256, seed=9)
    out = []
    for piece in pieces:
        total = 0
        for k, byte in enumerate(piece):
            total += int(values[byte]) * pow(_ODD, k, 2**64)
        out.append(total % 2**64)
    return np.unique(mixed(np.array(out, np.uint64)))


def _letters() -> np.ndarray:
    """Bytes that separate words here: all of ASCII but letters."""
    table = marks()
    table[ord("0") : ord("9") + 1] = True
    return table


def spelled(column: pa.Array) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of the texts: (all words, which distinct word each is, bytes, lengths).

    Texts are put in lower case. A word has a blank before it; of a longer one than ``RUN_BYTES``
    every further run counts as a word of its own.
    """
    words = split(pc.utf8_lower(column.cast(pa.large_string())), _letters(), False)
    if len(words.starts) and int((words.ends - words.starts).max()) > RUN_BYTES:
        words = _runs(words)
    _, first, which = np.unique(words.prints, return_index=True, return_inverse=True)
    lengths = (words.ends - words.starts)[first]
    at = words.starts[first][:, None] + np.arange(RUN_BYTES)
    inside = np.arange(RUN_BYTES) < lengths[:, None]
    table = np.zeros((len(first), RUN_BYTES + 1), np.uint8)
    table[:, 0] = 32
    if len(first):
        table[:, 1:] = np.where(inside, words.data[np.minimum(at, len(words.data) - 1)], 0)
    return words, which, table, lengths + 1


def _runs(words: Words) -> Words:
    """Words cut into runs of at most ``RUN_BYTES`` bytes, between characters."""
    starts, ends, prints, sizes = [], [], [], []
    for a, b, p in zip(words.starts.tolist(), words.ends.tolist(), words.prints.tolist()):
        cuts = [a]
        while b - cuts[-1] > RUN_BYTES:
            cut = cuts[-1] + RUN_BYTES
            while cut > cuts[-1] + 1 and words.data[cut] & 0xC0 == 0x80:
                cut -= 1
            cuts.append(cut)
        for k, (x, y) in enumerate(zip(cuts, [*cuts[1:], b])):
            starts.append(x)
            ends.append(y)
            prints.append(p if len(cuts) == 1 else hash(words.data[x:y].tobytes()) % 2**64)
        sizes.append(len(cuts))
    count = np.append(0, np.cumsum(sizes))
    return Words(np.array(starts), np.array(ends), np.array(prints, np.uint64), count[words.bounds], words.data)


def _lattice(table: np.ndarray, lengths: np.ndarray, pieces: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Steps (end, bytes, words, piece of each, whether it is none but one character), by end.

    A step leads over a piece, or over one whole character that is no piece.
    """
    values = constants(256, seed=9)
    powers = np.cumprod(np.append(np.uint64(1), np.full(RUN_BYTES + 1, _ODD, np.uint64)))
    inverse = np.cumprod(np.append(np.uint64(1), np.full(RUN_BYTES + 1, pow(_ODD, -1, 2**64), np.uint64)))
    sums = np.zeros((len(table), RUN_BYTES + 2), np.uint64)
    np.cumsum(values[table] * powers[: RUN_BYTES + 1], axis=1, out=sums[:, 1:])
    begins = np.append((table & 0xC0) != 0x80, np.ones((len(table), 1), bool), axis=1)
    chars = np.append(np.zeros((len(table), 1), np.int64), np.cumsum(begins[:, :-1], axis=1), axis=1)
    for end in range(1, int(lengths.max(initial=0)) + 1):
        long_ = np.flatnonzero((lengths >= end) & (begins[:, end] | (lengths == end)))
        for size in range(1, min(end, PIECE_BYTES) + 1):
            at = long_[begins[long_, end - size]]
            if not len(at):
                continue
            wanted = mixed((sums[at, end] - sums[at, end - size]) * inverse[end - size])
            place = np.searchsorted(pieces, wanted)
            place[place == len(pieces)] = 0
            found = pieces[place] == wanted
            single = chars[at, end] - chars[at, end - size] == 1
            use = found | single
            yield end, size, at[use], np.where(found, place, len(pieces))[use], ~found[use]


def forward(table: np.ndarray, lengths: np.ndarray, model: Model) -> np.ndarray:
    """Log probability of every word under every language."""
    part = max(1, NUMBERS // ((RUN_BYTES + 2) * max(1, len(model.languages))))
    out = np.zeros((len(table), len(model.languages)))
    for first in range(0, len(table), part):
        rows, long_ = table[first : first + part], lengths[first : first + part]
        reach = np.zeros((RUN_BYTES + 2, len(rows), len(model.languages)))
        reach[0] = 1
        for end, size, at, piece, none in _lattice(rows, long_, model.pieces):
            reach[end, at] += reach[end - size, at] * (model.chances[piece] + model.unknown * none[:, None])
        out[first : first + part] = np.log(np.maximum(reach[long_, np.arange(len(rows))], 1e-300))
    return out


def fitted(words: list[bytes], counts: np.ndarray, pieces: np.ndarray, s: Settings) -> np.ndarray:
    """Piece probabilities of one language, from its words and their counts; the last is for no piece."""
    chances = np.full(len(pieces) + 1, 1 / max(1, len(pieces)))
    chances[-1] = 0
    part = NUMBERS // (RUN_BYTES + 2)
    for _ in range(s.rounds if len(words) else 0):
        used = np.full(len(pieces) + 1, s.smoothing)
        for first in range(0, len(words), part):
            some, times = words[first : first + part], counts[first : first + part]
            table = np.zeros((len(some), RUN_BYTES + 1), np.uint8)
            for i, word in enumerate(some):
                table[i, : len(word)] = np.frombuffer(word, np.uint8)
            lengths = np.array([len(w) for w in some], np.int64)
            steps = list(_lattice(table, lengths, pieces))
            ahead = np.zeros((RUN_BYTES + 2, len(some)))
            ahead[0] = 1
            for end, size, at, piece, none in steps:
                ahead[end, at] += ahead[end - size, at] * (chances[piece] + s.unknown * none)
            behind = np.zeros_like(ahead)
            behind[lengths, np.arange(len(some))] = 1
            total = np.maximum(ahead[lengths, np.arange(len(some))], 1e-300)
            for end, size, at, piece, none in reversed(steps):
                step = behind[end, at] * (chances[piece] + s.unknown * none)
                behind[end - size, at] += step
                used += np.bincount(piece, ahead[end - size, at] * step / total[at] * times[at] * ~none, len(used))
        used[-1] = 0
        chances = used / used.sum()
    return chances


def train(words: dict[str, dict[bytes, int]], pieces: np.ndarray, s: Settings) -> Model:
    """Fit the piece probabilities of every language to its words and their counts.

    A language's fit depends on its own words only, so languages are fitted one after another.
    """
    languages = sorted(words)
    chances = np.zeros((len(pieces) + 1, len(languages)))
    for k, name in enumerate(languages):
        own = sorted(words[name])
        chances[:, k] = fitted(own, np.array([words[name][w] for w in own], float), pieces, s)
    return Model(languages, pieces, chances, s.unknown)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a batch's texts with their counts per language."""
    for batch in pooled(batches, "_text"):
        words, which, table, lengths = spelled(batch.column("_text"))
        names = pc.dictionary_encode(batch.column("_lang"))
        of_word = names.indices.to_numpy()[words.owners()]
        pairs, times = np.unique(of_word.astype(np.int64) * len(table) + which, return_counts=True)
        out = [(names.dictionary[int(p) // len(table)].as_py(), table[p % len(table), : lengths[p % len(table)]].tobytes()) for p in pairs]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.binary()), pa.array(times)],
            names=["lang", "word", "times"],
        )


def learned(docs: DataFrame, path: str, text: str = "text", lang: str = "lang", key: str = "doc_id", s: Settings = Settings()) -> Model:
    """Fit a model to a sample of the rows of ``docs`` that have a language.

    Rows are chosen by a hash of their key (of their text, if it is null), at a rate that leaves
    about ``documents`` per language; only words and their counts reach the driver. Every
    language is learned.
    """
    rows = docs.where(F.col(lang).isNotNull()).select(
        F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"), F.col(lang).cast("string").alias("_lang")
    )
    counts = rows.groupBy("_lang").count().collect()
    rates = docs.sparkSession.createDataFrame(
        [(r["_lang"], min(1.0, s.documents / r["count"])) for r in counts], "_lang string, _rate double"
    )
    if len(counts) <= BROADCAST:
        rates = F.broadcast(rates)
    row = F.when(F.col("_key").isNull(), F.xxhash64(F.lit(s.seed), "_text")).otherwise(F.xxhash64(F.lit(s.seed), "_key"))
    draw = F.shiftrightunsigned(row, 11) / float(1 << 53)
    sample = rows.join(rates, "_lang").where(draw < F.col("_rate")).select("_lang", "_text")
    found = (
        sample.mapInArrow(_counted, "lang string, word binary, times long")
        .groupBy("lang", "word").agg(F.sum("times").alias("times")).toArrow()
    )
    words: dict[str, dict[bytes, int]] = {r["_lang"]: {} for r in counts}
    for name, word, n in zip(*(found.column(c).to_pylist() for c in ("lang", "word", "times"))):
        words[name][word] = n
    return train(words, vocabulary(path), s)


def _predicting(model: Model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pooled(batches, "_text"):
            column = batch.column("_text")
            words, which, table, lengths = spelled(column)
            n = len(column)
            names, scores = np.full(n, None, object), np.zeros(n)
            if len(words.starts) and model.languages:
                logs, owners = forward(table, lengths, model), words.owners()
                text = np.stack([np.bincount(owners, logs[which, k], n) for k in range(len(model.languages))], axis=1)
                best = text.argmax(1)
                scores = 1 / np.exp(text - text.max(1, keepdims=True)).sum(1)
                names = np.array(model.languages, object)[best]
            ascii_ = np.add.reduceat(
                np.append(~_letters()[words.data] & (words.data < 128), False), np.minimum(_edges(column), len(words.data))
            )[:n] if len(words.data) else np.zeros(n, int)
            empty = np.diff(_edges(column)) == 0
            for i in np.flatnonzero((ascii_ == 0) | empty):
                if empty[i] or not any(map(str.isalpha, column[int(i)].as_py())):
                    names[i], scores[i] = "und", 0.0
            names = [x or "und" for x in names.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["_id", "lang_pred", "score"]
            )

    return run


def _edges(column: pa.Array) -> np.ndarray:
    """Where texts begin and end in the lower-case bytes."""
    lengths = pc.binary_length(pc.fill_null(pc.utf8_lower(column.cast(pa.large_string())), "")).to_numpy()
    return np.append(0, np.cumsum(lengths))


def predict(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row: its key, lang_pred and score, the share of that language among all (0 to 1).

    Languages are equally likely beforehand. A text that is null or has no letter is ``und`` with
    score 0, as is every text if nothing was learned. Rows are independent: repeated rows, null
    and repeated keys are kept. Other columns are not read. An empty table gives none.
    """
    base = docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text"))
    kind = dict(base.dtypes)["_id"]
    return base.mapInArrow(_predicting(model), f"_id {kind}, lang_pred string, score double").withColumnRenamed("_id", key)


def remainder(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts
