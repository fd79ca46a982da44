"""Registered domains by public-suffix rules."""

from delaylens.operators.suffixes import domains_by_rules

RULES = ("com", "uk", "co.uk", "*.ck", "!www.ck", "jp", "*.kobe.jp", "!city.kobe.jp", "a.b.c.d", "", " ORG ")
# Host and its domain.
CASES = {
    "com": None, "x.com": "x.com", "y.x.com": "x.com", "x.co.uk": "x.co.uk", "co.uk": None, "z.x.uk": "x.uk",
    "ck": None, "foo.ck": None, "bar.foo.ck": "bar.foo.ck", "q.bar.foo.ck": "bar.foo.ck", "www.ck": "www.ck", "q.www.ck": "www.ck",
    "kobe.jp": "kobe.jp", "x.kobe.jp": None, "y.x.kobe.jp": "y.x.kobe.jp", "city.kobe.jp": "city.kobe.jp", "w.city.kobe.jp": "city.kobe.jp",
    "a.b.c.d": None, "e.a.b.c.d": "e.a.b.c.d", "b.c.d": "c.d", "x.unknown": "x.unknown", "unknown": None, "w.x.org": "x.org",
}


def table(spark, rules):
    return spark.createDataFrame([(r,) for r in rules], "rule string")


def test_rules_wildcards_and_exceptions(spark):
    rows = [(i, f"http://{h.upper()}/p?q=1") for i, h in enumerate(CASES)] * 3 + [(90, None), (91, "no address")]
    found = domains_by_rules(spark.createDataFrame(rows, "id long, u string"), "u", table(spark, RULES)).collect()
    assert len(found) == len(rows)
    got = {r.host: r.domain for r in found if r.host}
    assert got == CASES
    assert {r.domain for r in found if r.id >= 90} == {None}


def test_no_rules_and_no_rows(spark):
    rows = spark.createDataFrame([(1, "http://a.b.c/")], "id long, u string")
    assert domains_by_rules(rows, "u", table(spark, [])).first().domain == "b.c"
    assert domains_by_rules(rows.where("false"), "u", table(spark, RULES)).count() == 0
