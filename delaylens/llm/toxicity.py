"""Toxicity of texts: averaged subword embeddings under a linear softmax.

A text is the bag of all character n-grams of its words, the word boundary included. Each n-gram
has a vector; the average of a text's vectors goes into a linear softmax over two classes. Both
are trained together by AdaGrad in numpy. Spellings that training has not seen share most of
their n-grams, and so their vectors, with those that it has.

Once trained, an n-gram acts on the score by one number, the product of its vector with the
difference of the classes' weights, so that scoring is a look-up and a mean.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.words import constants, mixed, pooled, released, text_bytes, tidy


@dataclass(frozen=True)
class Settings:
    """``toxic`` and ``clean``: at most so many labelled rows of each class are learned from;
    of a text, training sees all n-grams. ``texts``: an n-gram in fewer learned texts has no
    effect, since it would only name them. ``scale`` multiplies the average; ``decay`` draws the
    vectors that a batch uses towards zero."""

    toxic: int = 1500
    clean: int = 3000
    low: int = 3
    high: int = 5
    bits: int = 17
    width: int = 8
    texts: int = 4
    scale: float = 100.0
    decay: float = 1e-4
    epochs: int = 12
    rate: float = 0.1
    batch: int = 64
    seed: int = 5


def subwords(column: pa.Array, s: Settings, piece: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Buckets of all n-grams of the texts, with the text of each: (buckets, texts, number of texts).

    Texts are put in lower case. Words are separated by white space; n-grams lie in a word with
    a mark before and after it. Texts come in runs of about ``piece`` bytes.
    """
    column = pc.utf8_lower(column.cast(pa.large_string()))
    data, edges = text_bytes(column)
    at = 0
    while at < len(column):
        upto = max(at + 1, int(np.searchsorted(edges, edges[at] + piece, "right")) - 1)
        raw = data[edges[at] : edges[upto]]
        chars = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
        # Where texts begin, in characters: bytes that do not continue one.
        count = np.append(0, np.cumsum((raw & 0xC0) != 0x80))
        begins = count[edges[at : upto + 1] - edges[at]]
        blank = (chars == 32) | ((chars >= 9) & (chars <= 13)) | (chars == 0xA0)
        # One blank goes before each text, and one after the last.
        line = np.full(len(chars) + (upto - at) + 1, 32, np.uint32)
        place = np.arange(len(chars)) + np.repeat(np.arange(1, upto - at + 1), np.diff(begins))
        line[place] = np.where(blank, np.uint32(32), chars)
        owner = np.append(np.repeat(np.arange(upto - at), np.diff(begins) + 1), upto - at)
        apart = np.append(0, np.cumsum(line == 32))
        found, texts = [], []
        for n in range(s.low, s.high + 1):
            m = len(line) - n + 1
            if m <= 0:
                continue
            total = np.zeros(m, np.uint64)
            for j, factor in enumerate(constants(n, seed=50 + n)):
                total += line[j : j + m] * factor
            inner = apart[n - 1 : n - 1 + m] - apart[1 : 1 + m]
            ok = np.flatnonzero(inner == 0) if n > 2 else np.arange(m)
            found.append((mixed(total[ok]) >> np.uint64(64 - s.bits)).astype(np.int32))
            texts.append(owner[ok])
        yield np.concatenate(found or [np.zeros(0, np.int32)]), np.concatenate(texts or [np.zeros(0, np.int64)]), upto - at
        at = upto


def train(texts: list[str], labels: list[int], s: Settings) -> tuple[np.ndarray, float]:
    """The number of every n-gram bucket and the constant of the log odds of label 1; uses up ``texts``."""
    rng = np.random.default_rng(s.seed)
    size = 1 << s.bits
    vectors = rng.uniform(-1 / s.width, 1 / s.width, (size, s.width)).astype(np.float32)
    weights, bias = rng.uniform(-1 / s.width, 1 / s.width, (s.width, 2)).astype(np.float32), np.zeros(2, np.float32)
    if len(set(labels)) < 2:
        share = float(np.mean(labels)) if labels else 0.0
        return np.zeros(size, np.float32), float(np.log((share + 1e-3) / (1 - share + 1e-3)))
    y = np.array(labels)
    bags, seen = [], np.zeros(size, np.int32)
    # The bags are most of what the driver holds: a text goes when its bag is made, a bag when it is cut.
    for i, text in enumerate(texts):
        texts[i] = None
        buckets = np.concatenate([b for b, _, _ in subwords(pa.array([text], pa.string()), s)] or [np.zeros(0, np.int32)])
        ids, counts = np.unique(buckets, return_counts=True)
        seen[ids] += 1
        bags.append((ids.astype(np.int32), counts.astype(np.min_scalar_type(counts.max(initial=0))), s.scale / max(1, len(buckets))))
    for i, (ids, counts, factor) in enumerate(bags):
        kept = seen[ids] >= s.texts
        bags[i] = ids[kept], counts[kept], factor
    vectors[seen < s.texts] = 0
    grown_v, grown_w, grown_b = np.full((size, s.width), 1e-6, np.float32), np.full((s.width, 2), 1e-6), np.full(2, 1e-6)
    for _ in range(s.epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), s.batch):
            part = order[at : at + s.batch]
            ids = np.concatenate([bags[i][0] for i in part])
            share = np.concatenate([(bags[i][1] * bags[i][2]).astype(np.float32) for i in part])
            row = np.repeat(np.arange(len(part)), [len(bags[i][0]) for i in part])
            hidden = np.stack([np.bincount(row, share * vectors[ids, k], len(part)) for k in range(s.width)], 1)
            logits = hidden @ weights + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            gap = odds / odds.sum(1, keepdims=True)
            gap[np.arange(len(part)), y[part]] -= 1
            gap /= len(part)
            slope_w, slope_b, slope_h = hidden.T @ gap, gap.sum(0), gap @ weights.T
            used, back = np.unique(ids, return_inverse=True)
            slope_v = np.stack([np.bincount(back, share * slope_h[row, k], len(used)) for k in range(s.width)], 1)
            slope_v += s.decay * vectors[used]
            grown_v[used] += slope_v**2
            vectors[used] -= s.rate * slope_v / np.sqrt(grown_v[used])
            grown_w += slope_w**2
            weights -= (s.rate * slope_w / np.sqrt(grown_w)).astype(np.float32)
            grown_b += slope_b**2
            bias -= (s.rate * slope_b / np.sqrt(grown_b)).astype(np.float32)
    return (s.scale * vectors @ (weights[:, 1] - weights[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def learned(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", s: Settings = Settings()) -> tuple[np.ndarray, float]:
    """Train on rows of ``docs`` that ``labels`` (key, label 0 or 1) names; null labels count for nothing.

    Of each class those with the smallest hash of their key are taken, up to the settings' bounds.
    """
    named = labels.where("key IS NOT NULL AND label IN (0, 1)").groupBy("key").agg(F.max("label").cast("int").alias("label"))
    some = None
    for label, bound in ((1, s.toxic), (0, s.clean)):
        part = named.where(F.col("label") == label).orderBy(F.xxhash64("key"), "key").limit(bound)
        some = part if some is None else some.unionByName(part)
    # At most toxic + clean rows of two numbers.
    rows = (
        docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
        .join(F.broadcast(some), "key").select("key", "text", "label").toArrow().sort_by([("key", "ascending"), ("text", "ascending")])
    )
    texts, marks = rows.column("text").to_pylist(), rows.column("label").to_pylist()
    del rows
    released()
    model = train(texts, marks, s)
    released()
    return model


def _scored(model: tuple[np.ndarray, float], s: Settings) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        effect, constant = model
        for batch in batches:
            scores = []
            for buckets, texts, n in subwords(batch.column("_text"), s):
                total = np.bincount(texts, effect[buckets], n)
                odds = total / np.maximum(1, np.bincount(texts, minlength=n)) + constant
                scores.append(1 / (1 + np.exp(-np.clip(odds, -500, 500))))
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(np.concatenate(scores or [np.zeros(0)]))], names=["_id", "score"])

    return run


def score(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", key: str = "doc_id", s: Settings = Settings()) -> DataFrame:
    """Per row: its key and score, the probability of label 1 (0 to 1).

    A null or empty text has no n-grams and gets the constant of the model. Rows are independent:
    repeated rows, null and repeated keys are kept. Other columns are not read. An empty table
    gives none.
    """
    base = docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text"))
    kind = dict(base.dtypes)["_id"]
    return (
        base.mapInArrow(tidy(_scored(model, s)), f"_id {kind}, score double")
        .select(F.col("_id").alias(key), "score")
    )


def reject(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", threshold: float = 0.5, s: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose score is below ``threshold``."""

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        effect, constant = model
        out = []
        for batch in pooled([pa.RecordBatch.from_arrays([column], names=["_text"])], "_text"):
            for buckets, texts, n in subwords(batch.column("_text"), s):
                odds = np.bincount(texts, effect[buckets], n) / np.maximum(1, np.bincount(texts, minlength=n)) + constant
                out.append(1 / (1 + np.exp(-np.clip(odds, -500, 500))))
        released()
        return pa.array(np.concatenate(out or [np.zeros(0)]))

    return docs.where(scored(F.col(text).cast("string")) < threshold)
