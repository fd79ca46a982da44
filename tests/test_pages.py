from delaylens.operators import pages
from delaylens.plans import rows


def registry_page(cells=26):
    def table(values):
        return "<TABLE class='x'>" + "".join(f"<tr><td align=left> <b>{v}</b>\n</td></tr>" for v in values) + "</TABLE>"

    filler = "".join(table(["-"]) for _ in range(4))
    return "<html>" + filler + "".join(table([f"{t}-{i}" for i in range(cells)]) for t in (4, 5, 6)) + "</html>"


def test_registry_records(spark):
    df = spark.createDataFrame([("N1", registry_page()), ("N2", registry_page(20)), ("N3", "<p>none</p>")], "TailNum string, html string")
    records = pages.table_records(df, "TailNum").collect()
    assert [r.TailNum for r in records] == ["N1"]
    assert (records[0].serial_number, records[0].mfr_year, records[0].owner_state, records[0].engine_model) == (
        "4-1", "4-25", "5-9", "6-5",
    )
    flagged = pages.table_records(df, "TailNum", keep_incomplete=True)
    assert {r.TailNum: r.complete for r in flagged.collect()} == {"N1": True, "N2": False, "N3": False}


def test_head_records(spark):
    html = '<html><title> A  <i>b</i></title><pre>no</pre><p class="x">First\n <a class=y href="/l?a=1">link</a>.</p><p>Second</p>'
    row = pages.head_records(spark.createDataFrame([(1, "http://www.x.com/a", html)], "i int, url string, html string"), "i").first()
    assert (row.title, row.first_link, row.summary, row.domain) == ("A b", "/l?a=1", "First link .", "x.com")


def test_registry_pages_are_spread_over_tasks(spark, folder, monkeypatch):
    monkeypatch.setattr(rows, "PAGES", 50, raising=False)
    assert len(rows._registry_pages(spark, folder).inputFiles()) > 1


def test_records_are_judged_by_their_cells(spark):
    cells = {"a": (0, 1), "b": (1, 0)}
    tables = ["<table><td>x</td><td>1</td></table><table><td>2</td></table>", "<table><td>x</td></table><table><td>2</td></table>", "<table><td>x</td><td></td></table><table><td> </td></table>", "", None, "<table><td>x</td><td>1</td></table>"]
    saved = spark.createDataFrame(list(enumerate(tables)), "id int, html string")
    found = pages.table_records(saved, "id", cells=cells)
    assert sorted(map(tuple, found.collect())) == [(0, "1", "2"), (2, "", "")]
    flags = {r.id: r.complete for r in pages.table_records(saved, "id", cells=cells, keep_incomplete=True).collect()}
    assert flags == {0: True, 1: False, 2: True, 3: False, 4: False, 5: False}
    # The filter does not work out the texts of the cells.
    filters = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line]
    assert filters and not any("regexp_replace" in line for line in filters)
