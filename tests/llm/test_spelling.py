"""Near words and variant groups against all pairs."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from delaylens.llm import spelling as s
from delaylens.llm.queries import words_of


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def vocabulary(count, letters="abé", longest=9):
    rng = random.Random(count)
    return sorted({"".join(rng.choices(letters, k=rng.randint(1, longest))) for _ in range(count)})


@pytest.mark.parametrize("rows", [10, 500_000])
def test_scan_finds_every_pair(monkeypatch, rows):
    monkeypatch.setattr(s, "ROWS", rows)
    words = vocabulary(500)
    lengths = np.array([len(w) for w in words])
    codes = np.zeros((len(words), lengths.max() + 2), np.uint32)
    for i, w in enumerate(words):
        codes[i, : len(w)] = [ord(c) for c in w]
    none, every = np.zeros(len(words), int), np.ones(len(words), bool)
    asks = np.arange(len(words)) % 3 == 0
    a, b = s.near_pairs(codes, lengths, none, none, asks, every)
    want = sorted((i, j) for i in range(0, len(words), 3) for j in range(len(words)) if one_edit(words[i], words[j]))
    assert sorted(zip(a.tolist(), b.tolist())) == want


def expected(counts, ratio=5):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(out)


@pytest.mark.parametrize("cell", [4, s.CELL])
def test_groups_match_all_pairs(spark, cell):
    """Small cells are cut into tiles; no pair is lost or counted twice."""
    rng = random.Random(1)
    counts = {w: 5 ** rng.randint(0, 8) + rng.randint(0, 1) for w in vocabulary(600)}
    counts.update({"z" * k: 5**k for k in range(5, 12)})  # a chain of forms
    frame = spark.createDataFrame([(w, n, "x", "x") for w, n in counts.items()], "word string, n long, form string, _word string")
    got = s.variants(frame, cell=cell).select("word", "form", "root", "n", "n_near", "form_n")
    assert sorted(map(tuple, got.collect())) == expected(counts)


def test_null_empty_and_no_words(spark):
    frame = spark.createDataFrame([(None, 9), ("", 7), ("a", 1)], "word string, n long")
    got = sorted(map(tuple, s.variants(frame).collect()), key=str)
    assert got == sorted([(None, None, None, 9, 0, None), ("", None, "", 7, 0, None), ("a", None, "a", 1, 0, None)], key=str)
    assert s.variants(frame.limit(0)).count() == 0


def test_words_of_documents(spark, documents, odd_rows):
    import re

    rows = odd_rows + [(i, "É×÷ ÀÿZz-abcDEF " + " ".join(f"{chr(97 + i % 26)}word{chr(97 + j % 26)}ing" for j in range(60)), "en", "a") for i in range(80, 110)]
    want = Counter()
    for key, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    got = {r.word: r.n for r in s.word_counts(words_of(documents(rows)), shortest=0, least=1).collect()}
    assert got == dict(want)
    few = {r.word: r.n for r in s.word_counts(words_of(documents(rows))).collect()}
    assert few == {w: n for w, n in want.items() if len(w) >= 6 and n >= 5}
