"""Licences, languages and toxicity."""

import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from delaylens.llm import language, licenses, toxicity
from delaylens.llm.queries import QUERIES, VOCABULARY


def places(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at, labels = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        parts = phrase.split()
        for k in range(len(words) - len(parts) + 1):
            if words[k : k + len(parts)] == parts:
                at.append(k)
                labels.add(label)
    return len(words), len(at), min(at, default=None), max(at, default=None), sorted(labels)


TEXTS = [
    None, "", " .,", "MIT License", "the MIT\nLICENSE, mit-license mit license", "permit license", "mit licenses",
    "Licensed under the Apache License, Version 2.0.", "GNU General Public License version 3 or Apache License",
    "été MIT License é", "mitéé license", "SPDX-License-Identifier: GPL-3.0-only", "a general\t\tpublic_license",
    "word " * 50_000 + "apache license", "Creative Commons Attribution-ShareAlike 4.0 International", "BSD 3-Clause License",
]


def test_base_phrases_at_all_places(documents):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "mit license"), (3, "MIT License")]
    found = licenses.scan_licenses(documents(rows)).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base) for r in found), key=str)
    assert got == sorted(((i, *places(t)) for i, t in rows), key=str)
    assert all(0 <= r.score <= 1 for r in found)


@pytest.mark.parametrize("text, labels", [
    (TEXTS[7], {"apache", "apache-2.0"}), (TEXTS[11], {"gpl-3.0"}), (TEXTS[14], {"cc-by-sa-4.0"}), (TEXTS[15], {"bsd-3-clause"}),
    ("under the GNU Lesser General Public License v2.1", {"lgpl-2.1"}), ("Mozilla Public License 2.0", {"mpl-2.0"}),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", {"mit"}), ("nothing here", set()),
])
def test_detections(documents, text, labels):
    row = licenses.scan_licenses(documents([(1, text)])).first()
    assert {s.label for s in row.spans} == labels


def test_rules_and_suppression():
    table = licenses.rules()
    assert len(table) > 300 and all(re.compile(r.pattern) for r in table)
    assert [r.priority for r in table] == sorted((r.priority for r in table), reverse=True)
    assert licenses.resolved([(50, 0, 10, 1), (90, 0, 12, 2), (50, 11, 20, 3), (10, 12, 18, 4)]) == [(90, 0, 12, 2), (50, 11, 20, 3)]


@pytest.mark.parametrize("text, label", [
    ("Apache-2.0", "apache-2.0"), ("GPLv3", "gpl-3.0"), ("BSD 3-Clause", "bsd-3-clause"), ("LGPL-2.1-or-later", "lgpl-2.1-or-later"),
    ("see http://www.apache.org/licenses/LICENSE-2.0.", "apache-2.0"), ("GPL-2.0-only", "gpl-2.0"), ("GPL-2.0-or-later", "gpl-2.0-or-later"),
    ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2.0-or-later"), ("https://www.gnu.org/licenses/gpl-3.0.html", "gpl-3.0"),
    ("MIT OR Apache-2.0", "apache-2.0 or mit"), ("either version 2 of the License, or (at your option) any later version", "gpl-2.0-or-later"),
])
def test_short_forms_and_addresses(documents, text, label):
    row = licenses.scan_licenses(documents([(1, text)])).first()
    assert [s.label for s in row.spans] == [label]


def test_each_rule_waits_for_a_word_of_its_own():
    """A keyword is a part of every text that its rule finds, so no more rules than a tenth share one."""
    counts = {}
    for rule in licenses.rules():
        for keyword in rule.keyword.split("|"):
            counts[keyword] = counts.get(keyword, 0) + 1
    assert max(n for k, n in counts.items() if k != "spdx") < 0.1 * len(licenses.rules())


def test_suppression_is_that_of_its_definition():
    rng = random.Random(2)
    for _ in range(300):
        found = []
        for i in range(rng.randrange(25)):
            start = rng.randrange(30)
            found.append((rng.choice((10, 50, 90)), start, start + rng.randrange(1, 12), i))
        kept = []
        for one in sorted(found, key=lambda x: (-x[0], x[1] - x[2], x[1], x[3])):
            if not any(k[1] <= one[1] and one[2] <= k[2] for k in kept):
                kept.append(one)
        assert licenses.resolved(found) == sorted(kept, key=lambda x: (x[1], x[2], x[3]))


def test_many_detections_take_linear_time(documents):
    row = licenses.scan_licenses(documents([(1, "mit license apache license " * 20_000)])).first()
    assert row.n_base == 40_000 and row.last_word == 79_998
    assert {s.label for s in row.spans} == {"mit", "apache"}


def segmentations(word, chances, unknown):
    """Sum over all ways to cut a word, by recursion."""
    if not word:
        return 1.0
    total = 0.0
    for k in range(1, len(word) + 1):
        piece = word[:k]
        step = chances.get(piece, unknown if k == 1 else 0.0)
        if step:
            total += step * segmentations(word[k:], chances, unknown)
    return total


def fingerprints(pieces):
    values = language.constants(256, seed=9)
    raw = [sum(int(values[b]) * pow(language._ODD, k, 2**64) for k, b in enumerate(p.encode())) % 2**64 for p in pieces]
    return language.mixed(np.array(raw, np.uint64))


def test_every_language_is_learned(documents):
    """More languages than 200, each from one word of its own; rows without a key are drawn by text."""
    names = [f"l{i:03d}" for i in range(230)]
    code = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(3)) * 2
    rows = [(None if i % 3 else i, (code(i) + " ") * 4, n) for i, n in enumerate(names)]
    docs = documents(rows)
    model = language.learned(docs, VOCABULARY)
    assert model.languages == names
    found = {r.text: r.lang_pred for r in language.predict(docs, model, key="text").collect()}
    assert sum(found[t] == n for _, t, n in rows) > 0.9 * len(rows)


def test_words_in_parts_give_the_same(monkeypatch):
    pieces = fingerprints(["a", "b", "ab", " a", " b"])
    model = language.train({"x": {b" ab": 3, b" ba": 1}, "y": {b" bb": 2}}, np.sort(pieces), language.Settings())
    table = np.zeros((40, language.RUN_BYTES + 1), np.uint8)
    for i in range(40):
        word = " " + format(i, "06b").replace("0", "a").replace("1", "b")
        table[i, : len(word)] = np.frombuffer(word.encode(), np.uint8)
    whole = language.forward(table, np.full(40, 7), model)
    monkeypatch.setattr(language, "NUMBERS", 500)
    assert np.array_equal(whole, language.forward(table, np.full(40, 7), model))


def test_forward_sums_all_segmentations():
    rng = random.Random(1)
    pieces = [" ", " a", "a", "b", "ab", "ba", "é", "éa", " aé", "bab"]
    chance = {p: rng.random() / 5 for p in pieces}
    prints = fingerprints(pieces)
    order = np.argsort(prints)
    model = language.Model(["x"], prints[order], np.array([[chance[pieces[i]]] for i in order] + [[0.0]]), 1e-3)
    words = [" abab", " é", " aéab", " cab", " baaaab", " éccé"]
    table = np.zeros((len(words), language.RUN_BYTES + 1), np.uint8)
    for i, w in enumerate(words):
        table[i, : len(w.encode())] = np.frombuffer(w.encode(), np.uint8)
    logs = language.forward(table, np.array([len(w.encode()) for w in words]), model)
    for w, got in zip(words, logs[:, 0]):
        assert math.isclose(got, math.log(segmentations(w, chance, 1e-3)), rel_tol=1e-9)


def test_languages_of_odd_texts(documents):
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate([("the house is old and the man", "en"), ("das haus ist alt und der mann", "de")] * 30)]
    rows += [(100, None, "en", "s"), (101, "", None, "s"), (102, "12 ?! 3", "de", "s"), (103, "Das HAUS", None, "s"), (None, "the man", "en", "s")]
    rows += [(104, "и", None, "s"), (105, "the" * 100_000, None, "s"), (106, "the " * 100_000, None, "s")]
    docs = documents(rows)
    model = language.learned(docs, VOCABULARY)
    found = {r.doc_id: r for r in language.predict(docs, model).collect()}
    assert [found[i].lang_pred for i in (0, 1, 103, 106, None)] == ["en", "de", "de", "en", "en"]
    assert [(found[i].lang_pred, found[i].score) for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert found[104].lang_pred in ("en", "de") and all(0 <= r.score <= 1 for r in found.values())
    assert all(r.lang_pred in {"und", *model.languages} for r in found.values())
    nothing = language.learned(docs.where("lang IS NULL"), VOCABULARY)
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}
    assert language.predict(documents([]), model).count() == 0


def test_languages_held_out(spark, folder):
    found = QUERIES["op8_language_id"](spark, folder)
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in found.collect() if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.95


def test_subwords_are_those_of_each_text():
    s = toxicity.Settings()
    texts = ["Ab cde", None, "", "é", " abc ", "abcdefgh " * 300_000]
    count = lambda t: sum(max(0, len(w) + 2 - n + 1) for w in (t or "").split() for n in (3, 4, 5))
    got, bags = [], []
    for buckets, owners, n in toxicity.subwords(pa.array(texts), s):
        got += np.bincount(owners, minlength=n).tolist()
        bags += [set(buckets[owners == i].tolist()) for i in range(n)]
    assert got == [count(t) for t in texts]
    alone = [set(np.concatenate([b for b, _, _ in toxicity.subwords(pa.array([t], pa.string()), s)]).tolist()) for t in texts]
    assert bags == alone


def test_toxicity_learns_and_generalises(documents, spark):
    rng = random.Random(3)
    plain = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(200)]
    bad = ["stupidity", "moronic", "worthless"]
    text = lambda words: " ".join(rng.choices(plain, k=60) + words)
    rows = [(i, text([rng.choice(bad)] if i % 3 == 0 else [])) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)] + [(1, None), (None, 1), (9999, 1)], "key long, label int")
    model = toxicity.learned(documents(rows), labels)
    odd = [(1, text(["st0pidity", "worthles"])), (2, text([])), (3, None), (4, ""), (None, text(["moronic"] * 3)), (4, "")]
    found = toxicity.score(documents(odd), model)
    score = {r.doc_id: r.score for r in found.collect()}
    assert found.count() == len(odd) and all(0 <= x <= 1 for x in score.values())
    assert score[1] > 0.5 > score[2] and score[None] > 0.5
    kept = toxicity.reject(documents(odd), model)
    assert {2, 4} <= {r.doc_id for r in kept.collect()} and kept.columns == documents(odd).columns
    assert toxicity.score(documents([]), model).count() == 0


def test_toxicity_without_labels(documents, spark):
    model = toxicity.learned(documents([(1, "a")]), spark.createDataFrame([], "key long, label int"))
    assert toxicity.score(documents([(1, "a"), (2, None)]), model).where("score < 0.5").count() == 2
