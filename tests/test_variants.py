"""Fields of JSON documents that differ by row."""

import json
from collections import Counter

from delaylens.operators.variants import fields, schema_of, typed

DOCS = [
    '{"a": 1, "b": {"c": "x", "d": [1, "y", null, {"e": 2.5}]}}', '{"a": "7", "b": {}}', '{"a": 1e30, "b": []}', '{"a": null, "z.q": true}',
    '[1, [2, 3], {"a": false}]', '"text"', "12", "null", "{", "", None, '{"a": 2.0}', '{"a": 123456789012345678901234567890}', '{"b": {"c": {"x": {"y": 1}}}}',
]


def kind(value):
    if isinstance(value, bool):
        return "truth"
    names = {dict: "object", list: "list", str: "text", type(None): "nothing", int: "whole", float: "fraction"}
    return names[type(value)]


def walk(path, value, depth, out):
    out[path or "$", kind(value)] += 1
    if depth and isinstance(value, dict):
        for key, inner in value.items():
            walk(f"{path}.{key}" if path else key, inner, depth - 1, out)
    if depth and isinstance(value, list):
        for inner in value:
            walk(f"{path}[]", inner, depth - 1, out)


def expected(depth):
    out = Counter()
    for text in DOCS:
        try:
            # Written with a fraction of zero, a number is whole.
            value = None if text is None else json.loads(text, parse_float=lambda x: int(float(x)) if x == "2.0" else float(x))
        except ValueError:
            out["$", "unreadable"] += 1
            continue
        if text is None:
            out["$", "missing"] += 1
        else:
            walk("", value, depth, out)
    return out


def test_fields_by_kind_at_every_depth(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(DOCS)], "_v0 int, doc string").repartition(4)
    for depth in (0, 1, 3):
        assert {(r.path, r.kind): r.n for r in fields(rows, "doc", depth=depth).collect()} == expected(depth)


def test_fields_by_key(spark):
    rows = spark.createDataFrame([("k", '{"a":1}'), ("k", '{"a":2}'), (None, '{"a":"x"}')], "path string, n string")
    found = {tuple(r) for r in fields(rows.withColumnRenamed("path", "g"), "n", "g").collect()}
    assert found == {("k", "$", "object", 2), ("k", "a", "whole", 2), (None, "$", "object", 1), (None, "a", "text", 1)}
    assert fields(rows.where("false"), "n").count() == 0


def test_one_schema_for_all(spark):
    rows = spark.createDataFrame([('{"a":1,"b":"x"}',), ('{"a":2.5,"c":[true]}',), ("{",), (None,)], "d string")
    assert schema_of(rows, "d") == "OBJECT<a: DECIMAL(21,1), b: STRING, c: ARRAY<BOOLEAN>>"


def test_typed_columns_and_problems(spark):
    texts = ['{"a":"7","b":{"c":1.5}}', '{"a":"x","b":3}', '{"a":null}', "{}", "{", None, '{"a":{"q":1}}']
    rows = spark.createDataFrame([(t, 9, "keep") for t in texts], "doc string, a int, `p.q` string")
    out = typed(rows, "doc", {"a": ("$.a", "int"), "c": ("$.b.c", "double")}).collect()
    assert [(r.a, r.c) for r in out] == [(7, 1.5), (None, None), (None, None), (None, None), (None, None), (None, None), (None, None)]
    assert [r.problems for r in out] == [[], ["a"], [], [], None, [], ["a"]]
    assert {r["p.q"] for r in out} == {"keep"} and [r.doc for r in out] == texts
