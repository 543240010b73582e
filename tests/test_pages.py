"""S1-S4 on a synthetic page (the driver pages carry no tables)."""

import random

from statweave.sources import pages

PAGE = """<html><body>
<table id="other"><tr><td>no keys here</td></tr></table>
<table class="stats_table" id="stats_standard_9">
<thead>
 <tr><th></th><th colspan="2">Playing Time</th><th colspan="2">Performance</th></tr>
 <tr><th data-stat="player">Player</th><th>MP</th><th>Min</th><th>Gls</th><th>Gls</th></tr>
</thead>
<tbody>
 <tr><td data-stat="player"><a href="/players/abc123/Bukayo-Saka">Bukayo Saka</a></td>
     <td>20</td><td>1,700</td><td>6</td><td>0.3</td></tr>
 <tr class="thead"><th>Player</th><th>MP</th><th>Min</th><th>Gls</th><th>Gls</th></tr>
 <tr><td data-stat="player">No Link</td><td>1</td><td>9</td><td>0</td><td>0</td></tr>
 <tr><td data-stat="player"><a href="/players/def456/X">Ødegaard &amp; co</a></td>
     <td>15</td><td>1200</td><td>N/a</td><td></td></tr>
</tbody></table></body></html>"""


def test_extract_page():
    *status, cells = pages.extract_page(7, PAGE, suffixes={"Gls": ["", "_per90"]})
    assert status[:6] == [7, 2, 1, 3, 2, "ok"]
    rows = {(c[0], c[4]): c[5] for c in cells}
    assert rows[(0, "Player")] == "Bukayo Saka" and rows[(0, "Gls_per90")] == "0.3"
    assert rows[(1, "Player")] == "Ødegaard & co" and rows[(1, "Gls")] == "N/a"
    assert {c[6] for c in cells} == {"abc123", "def456"}
    assert {c[2] for c in cells if c[4] == "MP"} == {"Playing Time"}


def test_extract_no_table():
    *status, cells = pages.extract_page(1, "<html><p>none</p></html>")
    assert cells == [] and status[5] == "no_table"


def _key(k):
    return f'<td data-stat="player"><a href="/players/{k}/x">{k}</a>'


HEAD = "<thead><tr><th>Player<th>A<th>B</tr></thead>"


def _rows(html):
    *status, cells = pages.extract_page(1, html)
    return status[5], [(c[6], c[1], c[3], c[5]) for c in cells]


def test_omitted_end_tags():
    status, got = _rows(f"<table>{HEAD}<tr>{_key('a')}<td>1<td>2<tr>{_key('b')}<td>3</td><td>4</table>")
    assert status == "ok"
    assert got == [("a", 0, "Player", "a"), ("a", 1, "A", "1"), ("a", 2, "B", "2"),
                   ("b", 0, "Player", "b"), ("b", 1, "A", "3"), ("b", 2, "B", "4")]
    assert _rows(f"<table>{HEAD}<tr>{_key('a')}<td>1<td>2")[1][-1] == ("a", 2, "B", "2")


def test_nested_table_keeps_the_outer_row():
    _, got = _rows(f"<table>{HEAD}<tr>{_key('a')}</td><td><table><tr><td>x</td></tr></table>1</td>"
                   "<td>2</td></tr></table>")
    assert got == [("a", 0, "Player", "a"), ("a", 1, "A", "1"), ("a", 2, "B", "2")]


def test_body_spans():
    _, got = _rows("<table><thead><tr><th>Player<th>A<th>B<th>C</tr></thead>"
                   f"<tr>{_key('a')}<td colspan=2>9<td>7<tr>{_key('b')}<td rowspan=2>1<td>2<td>3"
                   f"<tr>{_key('c')}<td>5<td>6</table>")
    assert [g for g in got if g[0] == "a"][1:] == [("a", 1, "A", "9"), ("a", 3, "C", "7")]
    assert [g for g in got if g[0] == "c"][1:] == [("c", 1, "A", "1"), ("c", 2, "B", "5"), ("c", 3, "C", "6")]


def test_header_without_thead():
    _, got = _rows(f"<table><tr><th>Player</th><th>A</th></tr><tr>{_key('a')}</td><td>1</td></tr></table>")
    assert got == [("a", 0, "Player", "a"), ("a", 1, "A", "1")]


def test_reference_sources_and_headers():
    from statweave.specs import reference_table_specs, suffixed_header
    by = {s.name: s for s in reference_table_specs()}
    assert by["standard"].source == "/stats/" and by["goalkeeping"].table_id == "stats_keepers_9"
    assert [suffixed_header(c) for c in ("Gls", "Gls.1", "Save%.1", "Cmp%.3", "Fld", "MP")] == [
        "Gls_total", "Gls_per90", "Save%_pk", "Cmp%_long", "Fld_sca", "MP"]


def test_extract_job_and_pivot(spark):
    df = spark.createDataFrame([(7, PAGE), (8, "<html></html>"), (9, None)], "page_id long, html string")
    cells = pages.extract_cells(df, suffixes={"Gls": ["", "_per90"]})
    wide = pages.cells_to_wide(cells, ["MP", "Min", "Gls", "Gls_per90"], {"Gls_per90": "Gls/90"})
    got = {r["entity_key"]: (r["MP"], r["Gls/90"]) for r in wide.collect()}
    assert got == {"abc123": ("20", "0.3"), "def456": ("15", "")}
    st = {r["page_id"]: r["status"] for r in pages.page_status(df).collect()}
    assert st == {7: "ok", 8: "no_table", 9: "no_table"}


def _by_parser(html):
    p = pages._Tables()
    p.feed(html)
    p.close()
    return p.tables


def test_pattern_reads_like_the_parser(monkeypatch):
    """Plain pages are cut by a pattern, to the parser's result; others go
    through the parser."""
    rnd = random.Random(5)
    plain = ["<table>", '<TABLE id="t">', "</table>", "<tr>", '<tr class="thead">', "</tr>", "<td>", "</td >",
             '<td data-stat="player" colspan="2">', '<th\n Scope="col">', "</th>", "<tbody>", "</tbody>", "<b>",
             '<a href="/players/x1/">', "</a>", "a &amp; b", " x&nbsp;", "&lt;td&gt;", "5 > 4", "é\U0001f600", "\n"]
    odd = ["<!-- <td> -->", "<script>'<td>'</script>", "<td class=x>", "<td title='1 > 0'>", "<br/>", "a < b",
           '<a href="?a&amp;b">', "<td", "<?x?>", '</td class="x">', "<title><td></title>", "<![CDATA[x]]>"]
    for i in range(600):
        html = "".join(rnd.choice(plain + (odd if i % 2 else [])) for _ in range(rnd.randint(0, 40)))
        assert pages._read(html).tables == _by_parser(html), html
    fed = []
    monkeypatch.setattr(pages._Tables, "feed", lambda self, html: fed.append(html))
    pages._read("".join(plain))
    assert not fed
    pages._read("".join(odd))
    assert fed


def test_cells_are_not_stored(spark, monkeypatch):
    """Neither the status nor the cells of pages go through
    a stored copy of all cells, and rendered pages are spread over all cores."""
    from statweave.plans import ingest, q_text
    kept = []

    def cut(df):
        kept.append(df.columns)
        return df
    monkeypatch.setattr(q_text, "cut_lineage", cut)
    monkeypatch.setattr(ingest, "cut_lineage", cut)
    monkeypatch.setattr(q_text, "once", lambda spark, sf_dir, name, build: build())
    sf = "/root/testdata/sf0.001"
    q_text.page_extract_status_q(spark, sf)
    q_text.html_table_extract_q(spark, sf)
    q_text._ingest(spark, sf, "aggregate")
    assert kept and not any("cells" in c for c in kept)
    assert q_text.rendered_pages(spark, sf).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
