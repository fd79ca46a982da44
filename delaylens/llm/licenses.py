"""Licence mentions in texts, found by ordered signature rules.

Rules are regular expressions over a text's words (lower case, one blank between words). A rule
is tried only if its keyword occurs in the text, which one keyword automaton decides for all
rules at once. Detections are resolved by priority: an interval that lies within one kept before
is suppressed, others stay.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaylens.llm.words import marks, pooled, split


@dataclass(frozen=True)
class Rule:
    """``keyword``: alternatives parted by "|", one of which must occur in a text."""

    label: str
    pattern: str
    keyword: str
    priority: int
    weight: float


# The phrases whose every place is counted, and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Families: label, pattern of the name, versions, keywords (one for each form of the name). A
#: version "2.0" is written "2 0" in words.
FAMILIES = (
    ("apache", "apache(?: software)?", ("1.0", "1.1", "2.0"), "apache"),
    ("gpl", "(?:gnu )?(?:general public|gpl)", ("1.0", "2.0", "3.0"), "general|gpl"),
    ("lgpl", "(?:gnu )?(?:lesser general public|library general public|lgpl)", ("2.0", "2.1", "3.0"), "lesser|library|lgpl"),
    ("agpl", "(?:gnu )?(?:affero general public|agpl)", ("1.0", "3.0"), "affero|agpl"),
    ("gfdl", "(?:gnu )?(?:free documentation|gfdl|fdl)", ("1.1", "1.2", "1.3"), "documentation|fdl"),
    ("mpl", "(?:mozilla public|mpl)", ("1.0", "1.1", "2.0"), "mozilla|mpl"),
    ("epl", "(?:eclipse public|epl)", ("1.0", "2.0"), "eclipse|epl"),
    ("edl", "eclipse distribution", ("1.0",), "eclipse"),
    ("eupl", "(?:european union public|eupl)", ("1.0", "1.1", "1.2"), "european|eupl"),
    ("cddl", "(?:common development and distribution|cddl)", ("1.0", "1.1"), "common development|cddl"),
    ("cpl", "common public", ("1.0",), "common public"),
    ("osl", "(?:open software|osl)", ("1.0", "1.1", "2.0", "2.1", "3.0"), "open software|osl"),
    ("afl", "(?:academic free|afl)", ("1.1", "1.2", "2.0", "2.1", "3.0"), "academic|afl"),
    ("artistic", "(?:perl )?artistic", ("1.0", "2.0"), "artistic"),
    ("bsl", "boost software", ("1.0",), "boost"),
    ("busl", "business source", ("1.1",), "business"),
    ("cecill", "cecill", ("1.0", "1.1", "2.0", "2.1"), "cecill"),
    ("ofl", "(?:(?:sil )?open font|ofl)", ("1.0", "1.1"), "open font|ofl"),
    ("odbl", "(?:open database|odbl)", ("1.0",), "open database|odbl"),
    ("psf", "(?:python software foundation|psf)", ("2.0",), "python|psf"),
    ("php", "php", ("3.0", "3.01"), "php"),
    ("zpl", "(?:zope public|zpl)", ("1.1", "2.0", "2.1"), "zope|zpl"),
    ("ecl", "educational community", ("1.0", "2.0"), "educational"),
    ("upl", "universal permissive", ("1.0",), "permissive"),
    ("lppl", "(?:latex project public|lppl)", ("1.0", "1.1", "1.2", "1.3"), "latex|lppl"),
    ("sspl", "(?:server side public|sspl)", ("1.0",), "server side|sspl"),
    ("ipl", "ibm public", ("1.0",), "ibm"),
    ("qpl", "(?:q public|qpl)", ("1.0",), "q public|qpl"),
    ("rpl", "reciprocal public", ("1.1", "1.5"), "reciprocal"),
    ("spl", "sun public", ("1.0",), "sun public"),
    ("nposl", "non profit open software", ("3.0",), "profit"),
    ("ms-pl", "microsoft (?:public|permissive)", (), "microsoft"),
    ("ms-rl", "microsoft reciprocal", (), "microsoft"),
    ("mit", "(?:the )?(?:mit|expat|x11)", (), "mit|expat|x11"),
    ("isc", "isc", (), "isc"),
    ("zlib", "zlib(?: libpng)?", (), "zlib"),
    ("bsd", "(?:new |modified |simplified |revised )?bsd", (), "bsd"),
    ("bsd-2-clause", "(?:2|two) clause bsd|bsd (?:2|two) clause", (), "clause"),
    ("bsd-3-clause", "(?:3|three) clause bsd|bsd (?:3|three) clause", (), "clause"),
    ("bsd-4-clause", "(?:4|four) clause bsd|bsd (?:4|four) clause", (), "clause"),
    ("0bsd", "(?:0|zero) clause bsd|bsd (?:0|zero) clause", (), "clause"),
    ("ncsa", "(?:university of illinois )?ncsa open source", (), "ncsa"),
    ("wtfpl", "wtfpl|do what the fuck you want to public", (), "fuck|wtfpl"),
    ("vim", "vim", (), "vim"),
    ("ruby", "ruby", (), "ruby"),
    ("openssl", "openssl", (), "openssl"),
    ("curl", "curl", (), "curl"),
    ("postgresql", "postgresql", (), "postgresql"),
    ("beerware", "beer ?ware", (), "beer"),
)

#: Sentences that stand for a licence without its name: label, pattern, keyword.
SENTENCES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "permission is hereby"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies", "permission notice"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("bsd-3-clause", "neither the name of(?: \\S+){1,12} nor the names of its contributors may be used", "contributors"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display", "advertising"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee", "permission to use"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "held liable"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("public-domain", "(?:released|placed|dedicated)(?: in)? ?(?:in|into|to) the public domain", "public domain"),
    ("gpl", "this program is free software you can redistribute it and or modify", "redistribute"),
    ("gpl", "you should have received a copy of the gnu general public license", "gnu"),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public license", "gnu"),
    ("cc0", "(?:creative commons zero|cc0)(?: 1 0)?(?: universal)?", "c"),
    ("wtfpl", "you just do what the fuck you want to", "want to"),
    ("proprietary", "all rights reserved", "all rights"),
    ("proprietary", "(?:proprietary|confidential) and (?:proprietary|confidential)", "confidential"),
    ("commercial", "(?:commercial|end user) license agreement", "agreement"),
)

#: Identifiers, short forms and addresses as they stand in package files and headers: label,
#: pattern, keyword. Marks between words are gone: "GPL-2.0+" is "gpl 2 0". A version alone and
#: with "only" are one label, "or later" is another.
SHORT = (
    ("apache-1.1", "apache 1 1(?! \\d)", "apache"),
    ("apache-2.0", "apache (?:version )?v?2 0(?! \\d)|apache v2|apachev2|asl 2 0", "apache|asl"),
    ("apache-2.0", "apache org licenses license 2 0(?: txt| html)?", "apache"),
    ("gpl-2.0-or-later", "gpl ?v?2(?: 0)? or (?:any )?(?:later|newer)(?: version)?", "gpl"),
    ("gpl-2.0", "gpl ?v?2(?: 0)?(?: only)?(?! \\d)", "gpl"),
    ("gpl-3.0-or-later", "gpl ?v?3(?: 0)? or (?:any )?(?:later|newer)(?: version)?", "gpl"),
    ("gpl-3.0", "gpl ?v?3(?: 0)?(?: only)?(?! \\d)", "gpl"),
    ("gpl-2.0", "gnu org licenses(?: old licenses)? gpl 2 0(?: txt| html)?", "gnu"),
    ("gpl-3.0", "gnu org licenses gpl 3 0(?: txt| html)?", "gnu"),
    ("gpl-2.0-or-later", "either version 2 of the license or (?:at your option )?any later version", "either version"),
    ("gpl-3.0-or-later", "either version 3 of the license or (?:at your option )?any later version", "either version"),
    ("lgpl-2.1-or-later", "lgpl ?v?2 1 or (?:any )?(?:later|newer)(?: version)?", "lgpl"),
    ("lgpl-2.1", "lgpl ?v?2 1(?: only)?(?! \\d)", "lgpl"),
    ("lgpl-3.0-or-later", "lgpl ?v?3(?: 0)? or (?:any )?(?:later|newer)(?: version)?", "lgpl"),
    ("lgpl-3.0", "lgpl ?v?3(?: 0)?(?: only)?(?! \\d)", "lgpl"),
    ("lgpl-2.1", "gnu org licenses(?: old licenses)? lgpl 2 1(?: txt| html)?", "gnu"),
    ("lgpl-3.0", "gnu org licenses lgpl 3 0(?: txt| html)?", "gnu"),
    ("agpl-3.0-or-later", "agpl ?v?3(?: 0)? or (?:any )?(?:later|newer)(?: version)?", "agpl"),
    ("agpl-3.0", "agpl ?v?3(?: 0)?(?: only)?(?! \\d)|gnu org licenses agpl 3 0(?: txt| html)?", "agpl"),
    ("bsd-2-clause", "bsd (?:2|two) clause(?: licen[cs]e)?|freebsd licen[cs]e", "bsd"),
    ("bsd-3-clause", "bsd (?:3|three) clause(?: licen[cs]e)?", "bsd"),
    ("bsd-4-clause", "bsd (?:4|four) clause(?: licen[cs]e)?", "bsd"),
    ("0bsd", "0bsd", "0bsd"),
    ("mpl-1.1", "mpl ?v?1 1(?! \\d)|mozilla org mpl 1 1", "mpl"),
    ("mpl-2.0", "mpl ?v?2(?: 0)?(?! \\d)|mozilla org mpl 2 0", "mpl"),
    ("epl-1.0", "epl ?v?1 0(?! \\d)|eclipse org legal epl v10(?: html)?", "epl"),
    ("epl-2.0", "epl ?v?2 0(?! \\d)|eclipse org legal epl 2 0", "epl"),
    ("cddl-1.0", "cddl ?v?1 0(?! \\d)", "cddl"),
    ("cddl-1.1", "cddl ?v?1 1(?! \\d)", "cddl"),
    ("cc0-1.0", "cc0 1 0|creativecommons org publicdomain zero 1 0", "cc0|publicdomain"),
    ("mit", "opensource org licen[cs]es? mit(?: licen[cs]e php)?", "opensource"),
    ("bsl-1.0", "bsl 1 0|boost org license 1 0(?: txt)?", "bsl|boost"),
    ("unlicense", "unlicense(?: org)?", "unlicense"),
    ("gpl or mit", "(?:dual licensed|licensed) under (?:the )?(?:mit (?:and|or) gpl|gpl (?:and|or) mit)(?: licen[cs]es?)?", "licensed"),
    ("apache-2.0 or mit", "(?:mit or apache 2 0|apache 2 0 or mit|mit apache 2 0)", "apache"),
)

#: Creative Commons: terms by their short names.
COMMONS = {
    "by": "attribution", "by-sa": "attribution share ?alike", "by-nd": "attribution no ?deriv(?:ative)?s(?: works)?",
    "by-nc": "attribution non ?commercial", "by-nc-sa": "attribution non ?commercial share ?alike",
    "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s(?: works)?",
}
COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


def _spoken(version: str) -> str:
    """A version as words: a last part that is zero may be missing."""
    first, *rest = version.split(".")
    if rest == ["0"]:
        return f"v?{first}(?: 0)?(?! \\d)"
    return "v?" + " ".join([first, *rest])


def rules() -> list[Rule]:
    """All rules, by falling priority: those for a version before those for a family."""
    out = []
    for label, name, versions, keyword in FAMILIES:
        licence = f"(?:{name})(?: public)? licen[cs]e"
        for version in versions:
            said = _spoken(version)
            out.append(Rule(f"{label}-{version}", f"{licence} (?:version |v )?{said}", keyword, 90, 1.0))
            out.append(Rule(f"{label}-{version}", f"spdx license identifier {label} {said}(?: only)?", "spdx", 95, 1.0))
            out.append(Rule(f"{label}-{version}-or-later", f"spdx license identifier {label} {said} or later", "spdx", 96, 1.0))
            out.append(Rule(f"{label}-{version}", f"{label} ?(?:version |v )?{said}(?= licen|$)", keyword, 60, 0.7))
        out.append(Rule(label, f"(?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?{licence}", keyword, 70, 0.9))
        out.append(Rule(label, licence, keyword, 50, 0.8))
        out.append(Rule(label, f"spdx license identifier {re.escape(label).replace('-', ' ').replace(chr(92), '')}", "spdx", 75, 1.0))
    for label, sentence, keyword in SENTENCES:
        out.append(Rule(label, sentence, keyword, 80, 0.9))
    for label, form, keyword in SHORT:
        out.append(Rule(label, form, keyword, 88, 0.9))
    for short, terms in COMMONS.items():
        letters = short.replace("-", " ")
        for version in COMMONS_VERSIONS:
            said = _spoken(version)
            out.append(Rule(f"cc-{short}-{version}", f"creative commons {terms}(?: {said})(?: international| unported)?", "creative commons", 90, 1.0))
            out.append(Rule(f"cc-{short}-{version}", f"cc {letters} {said}", "cc", 85, 0.9))
            out.append(Rule(f"cc-{short}-{version}", f"creativecommons org licenses {letters} {said}", "creativecommons", 95, 1.0))
        out.append(Rule(f"cc-{short}", f"creative commons {terms}(?: licen[cs]e)?", "creative commons", 55, 0.8))
    for label, phrase in ((label, phrase) for phrase, label in BASE):
        out.append(Rule(label, phrase, "licen", 40, 0.8))
    out.append(Rule("unknown", "(?:licensed|released|distributed) under (?:the )?(?:terms of the )?(?:\\S+ ){1,6}?licen[cs]e", "licen", 10, 0.4))
    return sorted(out, key=lambda r: -r.priority)


def _gate(names: list[str]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for name in names:
        automaton.add_word(name, name)
    automaton.make_automaton()
    return automaton


def resolved(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of detections (priority, start, end, rule) those that no detection kept before contains.

    Of the kept ones only the outermost can contain others: their starts and ends both rise, so
    the last that starts in time has the farthest end.
    """
    kept: list[tuple[int, int, int, int]] = []
    starts: list[int] = []
    ends: list[int] = []
    for one in sorted(found, key=lambda x: (-x[0], x[1] - x[2], x[1], x[3])):
        _, start, end, _ = one
        before = bisect_right(starts, start)
        if before and ends[before - 1] >= end:
            continue
        kept.append(one)
        first, last = bisect_left(starts, start), bisect_right(ends, end)
        starts[first : max(first, last)] = [start]
        ends[first : max(first, last)] = [end]
    return sorted(kept, key=lambda x: (x[1], x[2], x[3]))


def _scanner(table: list[Rule], base: tuple) -> Callable:
    words_of = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A keyword is looked for in the raw text, where other marks may stand between its words.
        by_keyword: dict[str, list[int]] = {}
        for i, rule in enumerate(table):
            for keyword in rule.keyword.split("|"):
                by_keyword.setdefault(max(keyword.split(), key=len), []).append(i)
        gate = _gate([*by_keyword, *{p.split()[-1] for p, _ in base}])
        whole = [re.compile(rf"(?<!\S)(?:{r.pattern})(?!\S)") for r in table]
        phrases = [(re.compile(rf"(?<!\S){p}(?!\S)"), label, p.split()[-1]) for p, label in base]
        for batch in pooled(batches, "_text"):
            column = batch.column("_text")
            counts = split(column, marks(), False).bounds
            out = []
            for text in column.cast(pa.binary()).to_pylist():
                lower = (text or b"").lower().decode()
                hits = {name for _, name in gate.iter(lower)}
                places, labels, spans, weight = [], set(), [], 0.0
                if hits:
                    words = words_of.findall(lower)
                    joined = " ".join(words)
                    begins = list(accumulate((len(w) + 1 for w in words), initial=0))
                    number = lambda at: bisect_right(begins, at) - 1  # noqa: B023, E731
                    for phrase, label, keyword in phrases:
                        if keyword in hits and (at := [m.start() for m in phrase.finditer(joined)]):
                            labels.add(label)
                            places += [number(a) for a in at]
                    found = []
                    for i in sorted({i for name in hits & by_keyword.keys() for i in by_keyword[name]}):
                        found += [(table[i].priority, *m.span(), i) for m in whole[i].finditer(joined)]
                    for _, first, last, i in resolved(found):
                        spans.append((table[i].label, number(first), number(last - 1) + 1, table[i].weight))
                        weight = max(weight, table[i].weight)
                out.append((len(places), min(places, default=None), max(places, default=None), sorted(labels), spans, weight))
            n_base, low, high, labels, spans, weights = zip(*out) if out else ((),) * 6
            kind = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("weight", pa.float64())])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"), pa.array((counts[1:] - counts[:-1]).tolist(), pa.int64()),
                    pa.array(n_base, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64()),
                    pa.array(labels, pa.list_(pa.string())), pa.array(spans, pa.list_(kind)), pa.array(weights, pa.float64()),
                ],
                names=["_id", "n_words", "n_base", "first_word", "last_word", "base", "spans", "score"],
            )

    return run


def scan_licenses(docs: DataFrame, text: str = "text", key: str = "doc_id", table: list[Rule] | None = None, base=BASE) -> DataFrame:
    """Per row: its key, n_words, n_base, first_word, last_word, base, spans and score.

    Words are runs of digits, letters and characters beyond ASCII, A-Z in lower case, counted
    from 0. n_base counts all places of the ``base`` phrases, first_word and last_word are the
    smallest and largest word at which one starts (null without any), base their distinct
    labels. spans lists the detections that are left (label, first_word, end_word, weight), and
    score is the largest weight among them. A null text is empty: no words, no labels, score 0.
    Rows are independent: repeated rows, null and repeated keys are kept as they are. Other
    columns are not read. An empty table gives none.
    """
    base_rows = docs.select(F.col(key).alias("_id"), F.col(text).cast("string").alias("_text"))
    struct = "array<struct<label: string, first_word: long, end_word: long, weight: double>>"
    kind = dict(base_rows.dtypes)["_id"]
    return base_rows.mapInArrow(
        _scanner(table or rules(), base),
        f"_id {kind}, n_words long, n_base long, first_word long, last_word long, base array<string>, spans {struct}, score double",
    ).withColumnRenamed("_id", key)
