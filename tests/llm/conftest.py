"""Fixture tables with the awkward rows that every operator must survive:
nulls in every column, empty and blank texts, a very long text, repeated rows,
ties, and extra columns whose names clash with working columns."""

import pytest
from pyspark.sql import functions as F

DOC_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
              "_row string, th long, fp long, size long, taken long, m long, kept boolean, "
              "score double, lang_pred string, root long, copies long, h string, t string")
EXTRA = ("x", 1, 2, 3, 4, 5, True, 0.5, "xx", 6, 7, "h", "t")

EN = "the cat of the house is in the garden and it was with a dog that sat by the door "
FR = "le chat de la maison est dans le jardin et il est avec un chien qui dort sur la porte "


def doc_rows():
    long_text = " ".join(f"word{i % 5000} the" for i in range(60000))
    rows = [(i, EN + f"number {i} and more words of the story number{i} went on", "en", f"s{i % 3}")
            for i in range(0, 24)]
    rows += [(i, FR + f"nombre {i} et la suite de la phrase numéro{i} continue", "fr", "s1")
             for i in range(24, 40)]
    rows += [
        (100, None, None, None), (101, "", "en", ""), (102, " \t\n ", "en", "s0"),
        (103, long_text, "en", "s2"), (104, "x", "en", None),
        (105, "one two one two one two one two one two one two", "en", "s0"),
        (106, "dup line of the text here\ndup line of the text here\nand of the other is in it", "en", "s0"),
        (107, "### $$$ %%% &&& *** ||| <<< >>> 123 456 789 000", None, "s0"),
        (108, "\u6f22\u5b57 caf\u00e9 na\u00efve \u00c9T\u00c9 the of and to in is that it as", "xx", "s4"),
        (109, "A B c Licensed under CC BY-NC 4.0. All rights reserved. all  RIGHTS-reserved", "en", "s0"),
        (110, "GNU General Public License, general public license", "en", "s0"),
        (120, EN + "number 0 and more words of the story number0 went on", "en", "s0"),  # copy of 0
        (3, EN + "number 3 and more words of the story number3 went on", "en", "s0"),  # repeated row
        (None, EN + "without any id at all in this row of the table", "en", "s1"),
        (None, EN + "without any id at all in this row of the table", "en", "s1"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), *EXTRA) for i, t, lang, s in rows]


PAGE_ROWS = [
    (0, "HTTPS://WWW.Example.com/en/1?q=1", "<html><nav>menu</nav><article><h1>T &amp; U</h1><p>one<br>two"
     "<p>three \n four<div class='comments'><p>c</p></div></article><footer>f</footer>"),
    (1, "https://a.example.com/en/2", "<article><p>x<script>var t='</p>';</script>y"),
    (2, "http://shop.net/es/3#top", "<body><p>plain page</p><form><p>send</p></form>"),
    (3, "http://shop.net/de/4.html", None),
    (4, None, ""),
    (5, "no scheme at all", "< 3 &lt;b&gt; <!-- <p>no</p> --> fin"),
    (6, "http://bad.org?x", "<main><p>kept</p><aside>side</aside></main><p>outside</p>"),
    (6, "http://bad.org?x", "<main><p>kept</p><aside>side</aside></main><p>outside</p>"),
    (None, "x://y.z", "<p>t</p>"),
    *[(20 + i, f"http://open.org/{i}", "<div><p>this same long banner of the site stands on every page of it</p>"
       f"<p>own text number {i} of page {i} with enough words to stay {i}</p></div>") for i in range(5)],
]


@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("edge"))
    spark.createDataFrame(doc_rows(), DOC_SCHEMA).coalesce(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(*r, "x", 1) for r in PAGE_ROWS], "page_id long, url string, html string, "
                          "host string, n long").coalesce(2).write.parquet(f"{d}/pages.parquet")
    vectors = [(i, [0.1 * (i % 7), 0.2, -0.3 * (i % 3)], i % 10, 1) for i in range(60)]
    vectors += [(None, None, None, 1), (50, [], 1, 1), (100, [0.1, None], 2, 1)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int, rid int").write.parquet(
        f"{d}/embeddings.parquet")
    labels = [(i, int(i % 5 > 0), int(i % 4 == 0), "x") for i in range(40)] + [
        (0, None, 1, "x"), (None, 1, 1, "x"), (999, 1, None, "x")]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, text string").write.parquet(
        f"{d}/labels.parquet")
    return d


@pytest.fixture(scope="session")
def empty_dir(spark, edge_dir, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "pages", "labels", "embeddings"):
        spark.read.parquet(f"{edge_dir}/{name}.parquet").filter(F.lit(False)).coalesce(1).write.parquet(
            f"{d}/{name}.parquet")
    return d
