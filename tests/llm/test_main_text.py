"""Boilerplate of a host, inside containers and in the open."""

from collections import Counter

from statweave.llm import main_text

SIGN = "Sign up today for our weekly letter and never miss another story again"


def own(i, n=30):
    return " ".join(f"w{i}x{k}" for k in range(n))


def extracted(spark, pages):
    d = spark.createDataFrame([(i, f"http://h.org/{i}", h) for i, h in pages], "page_id long, url string, html string")
    got = main_text.extract(d).collect()
    assert Counter(r["page_id"] for r in got) == Counter(i for i, _ in pages)
    return {r["page_id"]: r["text"] for r in got}


def test_repeats_inside_the_container_go(spark):
    got = extracted(spark, [(i, f"<article><p>{own(i)}</p><p>{SIGN}</p><p>Read more</p></article>") for i in range(6)])
    assert got == {i: own(i) for i in range(6)}


def test_near_copies_of_an_article_stay(spark):
    words = own(0, 80).split()
    near = {i: " ".join([*words[:10 + 5 * i], f"edit{i}", *words[11 + 5 * i:]]) for i in range(8)}
    other = {20 + i: own(20 + i) for i in range(4)}
    for tag in ("article", "div"):
        pages = [(i, f"<{tag}><p>{t}</p></{tag}>") for i, t in {**near, **other}.items()]
        assert extracted(spark, pages) == {**near, **other}


def test_quotes_stay_and_short_or_split_repeats_go(spark):
    quote = "to be or not to be that is the question"
    menu = "<p>Subscribe now</p><p>All rights</p><p>reserved by the owners of</p><p>this small site</p>"
    got = extracted(spark, [(i, f"<div><p>{own(i)}{' ' + quote if i < 2 else ''}</p>{menu}</div>") for i in range(5)])
    assert got == {i: own(i) + (" " + quote if i < 2 else "") for i in range(5)}


def test_zones_decide_the_route(spark):
    lines = "a line that five pages of this host have in common here"
    pages = [(i, f"<!-- <article > --><p>{own(i)}</p><p>{lines}</p>") for i in range(5)]
    pages += [(10 + i, f"<p>outside</p><div role=main><p>{own(10 + i)}</p>"
               f"<p>{'shared by three articles of a host with many pages' if i < 3 else own(50 + i)}</p></div>")
              for i in range(12)]
    got = extracted(spark, pages)
    assert all(got[i] == own(i) for i in range(5))
    assert got[10] == own(10) + "\n\nshared by three articles of a host with many pages"


def test_wrappers_keep_their_page():
    """Names that only mention furniture, forms around the page, and containers
    that nothing else is left of."""
    page = "<article><h1>Title</h1><p>the story</p></article>"
    story = [(main_text.CONTENT, "Title"), (main_text.CONTENT, "the story")]
    for wrapped in (f"<div class='layout has-sidebar'>{page}</div>", f"<div class='entry no-comments'>{page}</div>",
                    f"<div id='page-banner-layout'><main>{page}</main></div>", f"<div class='sidebar'>{page}</div>"):
        assert main_text.blocks(wrapped) == story
    form = main_text.blocks(f"<form id='aspnetForm'><p>top</p>{page}</form>")
    assert form == [(main_text.OPEN, "top"), *story]
    assert main_text.blocks("<form><p>a whole page without any container in it</p></form><p>x</p>")[0][0] == main_text.OPEN
    assert main_text.blocks("<p>the page itself has the text</p><form><p>your mail</p></form>") == [
        (main_text.OPEN, "the page itself has the text")]
    assert main_text.blocks("<article><p>a</p><form><p>mail</p></form><div class='ad-free story'>b</div></article>") == [
        (main_text.CONTENT, "a"), (main_text.CONTENT, "b")]


def test_furniture_names():
    yes = "sidebar site-footer main-nav left_sidebar ad-slot cookie-banner comments comment-list nav-bar menu2".split()
    no = "has-sidebar no-comments page-banner-layout ad-free story adventure shares-outstanding".split()
    assert [t for t in yes if not main_text.furniture_name(t)] == []
    assert [t for t in no if main_text.furniture_name(t)] == []


def test_comment_articles_stay_out():
    page = ("<p>the text</p><div class='comments'><article><p>me too</p></article></div>"
            "<section id=comment-list><article>first</article></section>")
    assert main_text.blocks(page) == [(main_text.OPEN, "the text")]


def test_short_leftovers_stay(spark):
    banner = "This banner of the whole site stands before every number of it"
    got = extracted(spark, [(i, f"<p>{own(i)}</p><p>{banner} Total {i:03}</p>") for i in range(5)])
    # "Total" ends the repeated run
    assert got == {i: own(i) + f"\n\n{i:03}" for i in range(5)}


def test_runs_are_handed_on_packed(spark, monkeypatch):
    """Only runs that two pages may share become rows; whether the repeated
    ones are broadcast or joined, the texts are the same."""
    import numpy as np
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 32, 500, np.uint64))
    assert (main_text._unpacked(main_text._packed(values), 500) == values).all()
    rows = [("h", i, [own(i), SIGN]) for i in range(6)] + [(None, 8, [SIGN]), ("g", 9, [SIGN]), ("g", 9, [SIGN])]
    pages = spark.createDataFrame(rows, "host string, uid long, blocks array<string>").repartition(3)
    bits = main_text.shared_bits(pages)
    assert 0 < np.unpackbits(bits).sum() < 40       # 6 shared runs, copies of one page, chance hits
    assert main_text.repeated_runs(pages).count() == 6
    html = [(i, f"<article><p>{own(i)}</p><p>{SIGN}</p><p>Read more</p></article>") for i in range(6)]
    want = {i: own(i) for i in range(6)}
    assert extracted(spark, html) == want
    monkeypatch.setattr(main_text, "BROADCAST_RUNS", 0)
    assert extracted(spark, html) == want
