"""Stage-1 pipeline on synthetic pages: extraction, join modes, filters."""

from statweave.plans.ingest import ingest
from statweave.specs import MeasureSpec, TableSpec


def _page(header_top, headers, rows):
    th = "".join(f'<th colspan="{n}">{t}</th>' for t, n in header_top)
    hd = "".join(f"<th>{h}</th>" for h in headers)
    body = ""
    for key, name, vals in rows:
        cells = "".join(f"<td>{v}</td>" for v in vals)
        link = f'<a href="/players/{key}/x">{name}</a>' if key else name
        body += f'<tr><td data-stat="player">{link}</td>{cells}</tr>'
    return (f'<table class="stats_table"><thead><tr>{th}</tr><tr><th>Player</th>{hd}</tr></thead>'
            f"<tbody>{body}</tbody></table>")


def test_ingest_modes(spark):
    std = _page([("", 1), ("Time", 4), ("Per 90", 1)], ["Squad", "Age", "Min", "Gls", "Gls"], [
        ("p1", "Ann Lee", ["Arsenal", "25-100", "100", "2", "0.5"]),
        ("p1", "Ann Lee", ["Wolves", "25-100", "50", "1", "0.7"]),
        ("p2", "Bob Ray", ["Chelsea", "30-1", "80", "N/a", "0.1"]),
        (None, "No Link", ["Chelsea", "20-1", "900", "9", "9"]),
    ])
    kp = _page([("", 1), ("Keeper", 1)], ["Save%"], [
        ("p1", "Ann Lee", ["70"]), ("p1", "Ann Lee", ["80"]), ("p3", "Cy", ["50"])])
    pages = spark.createDataFrame([(1, "http://x/standard/a", std), (2, "http://x/keeper/a", kp),
                                   (3, "http://x/keeper/b", "<html>no table</html>")],
                                  "page_id long, url string, html string")
    specs = [TableSpec("standard", "/standard/", ("Player", "Squad", "Age", "Min", "Gls", "Gls.1"),
                       {"Gls.1": "Gls_per90"}),
             TableSpec("keeper", "/keeper/", ("Player", "Save%"), {}),
             TableSpec("misc", "/misc/", ("Player", "Fls"), {})]
    measures = [MeasureSpec("Min"), MeasureSpec("Gls"), MeasureSpec("Gls_per90", agg="mean"),
                MeasureSpec("Save%", agg="mean"), MeasureSpec("Fls")]
    desc = {"Player": "first", "Squad": "concat", "Age": "first"}
    out, fail = ingest(pages, specs, measures, desc, "aggregate", "Min", 90)
    rows = {r.entity_key: r.asDict() for r in out.collect()}
    assert set(rows) == {"p1"}                      # Bob has 80 minutes (F2); no-link row dropped
    a = rows["p1"]
    assert (a["Min"], a["Gls"], a["Squad"], a["Age"]) == (150.0, 3.0, "Arsenal, Wolves", 25)
    assert a["Save%"] == 75.0 and a["Gls_per90"] == 0.6 and a["Fls"] is None
    fan, _ = ingest(pages, specs, measures, desc, "fanout", "Min", 0)
    f = {r.entity_key: r.asDict() for r in fan.collect()}
    assert f["p1"]["Min"] == 300.0 and f["p1"]["Save%"] == 75.0    # 2 keeper rows double the sums
    assert f["p2"]["Gls"] == 0.0                                    # all-missing sum is 0
    assert {(r.page_id, r.status) for r in fail.collect()} == {(3, "no_table"), (None, "no_rows")}
