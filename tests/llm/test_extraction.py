import html
import re

import pytest
from pyspark.sql import functions as F

from lake_ingest.llm import extraction as X
from lake_ingest.llm import queries
from tests.conftest import SF_DIR

PAGES = "page_id long, url string, html string"


def _table(spark, rows):
    table = spark.createDataFrame(rows, PAGES)
    return table.withColumns({name: F.lit("clash") for name in ("host", "text", "block", "node", "place", "runs")})


def _texts(spark, rows):
    return {r.page_id: r.text for r in X.main_texts(_table(spark, rows), ["page_id"]).collect()}


def test_articles_of_the_given_pages(spark):
    """The pages mark their articles; what a pattern finds in them is the text."""
    got = {r.page_id: r for r in queries.QUERIES["op11_main_text"](spark, SF_DIR).collect()}
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:
        body = re.search(r"<article>(.*?)</article>", page.html, re.S)[1]
        text = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", body))).split())
        assert tuple(got[page.page_id]) == (page.page_id, page.url, text, len(text))


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        (" \n ", ""),
        ("plain &lt;b&gt; &amp;amp; &eacute;&nbsp;&#233 &copy x", "plain <b> &amp; é é © x"),
        ("<p>a<b>b</b>c<p>d<br>e &amp f", "abc d e & f"),
        ("<p>one</p>two<!-- no --><p>three", "one two three"),
        ("<!-- open <p>x", ""),
        ("a < b <c", "a < b"),
        ("<script>var t='<p>x</p>'</script>y<style>p{}</style><title>t</title>", "y"),
        ("<script>open", ""),
        ("<textarea><p>x</textarea>y<form>a<p>b</form>c", "y c"),
        ("<nav>m</nav><header>h</header><p>x<footer>f</footer><aside>s</aside>", "x"),
        ("<main>m<header><h1>T</h1></header><aside>s</aside></main><div>beside</div>", "m T"),
        ("<div class='comments'><article class=comment>hi</article></div><article>x</article>", "x"),
        ("<body class='has-sidebar'><div class='page sidebar-left'><article>ok</article></div>", "ok"),
        ("<div class='cookie-notice'>n</div><div id=adBox>n</div><div class='article-header'>t</div><p hidden>h</p>x", "t x"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul><table><tr><td>1<td>2<tr><th>3</table>", "a b c d 1 2 3"),
        ("a<span class=ad>x</span>b<i role=navigation>y</i>c", "abc"),
        ("<div>" * 5000 + "deep" + "</div>" * 5000 + " end", "deep end"),
        ("<p>" + "long " * 200_000, ("long " * 200_000).strip()),
    ],
)
def test_one_page(page, text):
    assert " ".join(t for _, noise, t in X.Page(page or "", {}).runs if not noise) == text


def test_odd_inputs(spark):
    rows = [(1, None, "<p>a"), (1, None, "<p>a"), (2, "no address", None), (3, "http://h/x", ""), (4, "http://h", "<b>b")]
    table = _table(spark, rows)
    got = X.main_texts(table, ["page_id", "url"]).collect()
    assert sorted((r.page_id, r.text, r.blocks) for r in got) == [
        (1, "a", ["a"]), (1, "a", ["a"]), (2, "", []), (3, "", []), (4, "b", ["b"]),
    ]
    assert X.main_texts(_table(spark, []), ["page_id"]).count() == 0


WORDS = [f"w{i}" for i in range(400)]


def _article(i, n=8):
    return " ".join(
        f"<p>{' '.join(WORDS[(i * 37 + j * 11 + k * k * (i + 1)) % 400] for k in range(30))}. Also {i} {j}.</p>" for j in range(n)
    )


def test_a_template_without_names_is_removed(spark):
    """Unlabelled blocks that repeat on a host go, by entropy alone; other hosts keep the same place."""
    template = "<div class=x><p>Read us every day, it is free.</p><span>All rights reserved</span></div>"
    rows = [(i, f"http://a.example/{i}", f"<div class=w>{_article(i)}</div>{template}") for i in range(40)]
    own = "<div class=x><p>Notes of {0}, part {0} {1}.</p><span>Seen {0} times {0}</span></div>"
    rows += [(100 + i, f"http://b.example/{i}", f"<div class=w>{_article(50 + i)}</div>{own.format(i, i * i)}") for i in range(40)]
    got = _texts(spark, rows)
    for i, _, page in rows:
        text = " ".join(re.sub(r"<[^>]*>", " ", page.split("</div><div class=x>")[0]).split())
        if i < 100:
            assert got[i] == text
        else:
            assert got[i].startswith(text) and f"Notes of {i - 100}, part" in got[i]


def test_copies_lose_nothing(spark):
    """A host of copies repeats its articles everywhere; none is a template, and small hosts prove nothing."""
    rows = [(i, "http://copies.example/", f"<article><h1>T</h1>{_article(1)}</article>") for i in range(60)]
    rows += [(100 + i, "http://two.example/", f"<div><p>{WORDS[3]} same text</p></div>") for i in range(2)]
    got = _texts(spark, rows)
    whole = " ".join(re.sub(r"<[^>]*>", " ", rows[0][2]).split())
    assert {got[i] for i in range(60)} == {whole}
    assert got[100] == got[101] == "w3 same text"


def test_importance_as_by_hand(spark):
    """One host, four pages: a repeated clause, one on each page, one on two of them."""
    import math

    pages = [f"<div><p>same same</p><p>own {i}</p><p>half {i // 2}</p></div>" for i in range(4)]
    import numpy as np
    import pyarrow as pa

    rows = pa.record_batch({"host": pa.array([7] * 4), "text": pages})
    table, places = X._parsed(rows)
    stats = spark.createDataFrame(X._stats(0, table, places).to_pandas(), X.STATS)
    host = X._tree(
        stats, "node", stats.where("kind = 0").groupBy("node").agg(F.first("chain").alias("chain"))
    ).collect()
    chains = dict(zip(places["place"].to_pylist(), places["chain"].to_pylist()))
    depth = {int(X._hosted(np.array([p]), np.array([7]))[0]): len(c) for p, c in chains.items()}
    got = {depth[r.node]: r.importance for r in host}
    # Seven clauses: entropy 1 of "same same", 0 of four, 1/2 of two.
    content = (0 + 4 * 1 + 2 * 0.5) / 7
    assert math.isclose(got[3], content) and math.isclose(got[2], 0.1 * 0 + 0.9 * content)
