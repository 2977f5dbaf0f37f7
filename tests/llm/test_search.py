"""Top-k search and page extraction against plain versions."""

import math

import numpy as np
import pytest

from notaflow.llm import html_consensus, maxscore


def plain_top(rows, queries, k):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    ints = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = set()
    for q, v in {i: v for i, v in ints if i in queries}.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ints if i != q)
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("shard_rows", [16384, 40])
def test_top_k(spark, shard_rows):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(0, 1, 16).astype(np.float32)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(20)]  # ties
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 16), (403, [float("inf")] * 16), (404, []),
             (405, [2.0, 3.0]), (None, [1.0] * 16), (450, [0.0] * 16), (500, rows[7][1])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows],
                               "vec_id long, embedding array<float>, b string, n long").repartition(3)
    got = maxscore.top_k(df, df.where("vec_id % 50 = 0"), shard_rows=shard_rows).collect()
    want = plain_top(rows, set(range(0, 600, 50)), 5)
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_top_k_few(spark):
    df = spark.createDataFrame([(0, [1.0]), (3, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in maxscore.top_k(df, df.where("vec_id = 0")).collect()] == [(0, 1, 3, 256 * 512)]
    none = df.where("vec_id < 0")
    assert maxscore.top_k(none, none).count() == 0
    assert maxscore.top_k(df, none).count() == 0 and maxscore.top_k(none, df).count() == 0


def test_search_prunes_and_stays_exact():
    """Large magnitudes (beyond exact floats) and unequal widths."""
    rng = np.random.default_rng(9)
    m = rng.integers(-2**40, 2**40, (50, 6))
    q = rng.integers(-2**40, 2**40, (3, 4))
    for qid, ids, scores in maxscore.search_shard(m, np.arange(50), q, np.array([100, 101, 102]), 4):
        full = [int(sum(int(a) * int(b) for a, b in zip(q[qid - 100], row))) for row in m]
        want = sorted(range(50), key=lambda i: (-full[i], i))[:4]
        assert ids.tolist() == want and [int(s) for s in scores] == [full[i] for i in want]


MENU = "<nav><ul><li><a href='/x'>Menu <b>item</b></a></li></ul></nav>"
BODY = "<h1>Title &amp; more</h1><p>First\n  paragraph with <a href='#'>a link</a>.<p>Second &lt;one&gt;<br>goes on and on and on.</p>"
TEXT = "Title & more\nFirst paragraph with a link.\nSecond <one> goes on and on and on."


@pytest.mark.parametrize("page,expected", [
    (f"<html><body>{MENU}<article>{BODY}</article><footer>&copy; us</footer></body></html>", TEXT),
    (f"<body><div class='post-12'>{BODY}<div class='ad'>Buy things now, really many things</div></div>", TEXT),
    (f"<body><header>Site name</header><main>{BODY}<section id='comments'><p>First! I like this very much.</p></section>"
     "<aside>Other things</aside></main>", TEXT),
    (f"<BODY><DIV ID=content>{BODY}<script>var a='</p>';</script><style>p{{}}</style><form><p>Your name</p></form></DIV>", TEXT),
    ("<article><ul><li>One<li>Two</ul><table><tr><td>a<td>b</table><pre>x\n  y</pre></article>", "One\nTwo\na\nb\nx y"),
    ("<article><p>Unclosed <b>bold <i>text<p>next</article>", "Unclosed bold text\nnext"),
    ("<article><!-- <p>no</p> --><p>a &#8212; &eacute;&nbsp;b &unknown; &amp;lt;</p></article>", "a — é b &unknown; &lt;"),
    ("<article><header><h1>Own heading</h1></header><p>Text that is long enough.</p></article>", "Own heading\nText that is long enough."),
    (f"<div class='wrap has-sidebar'><div class='sidebar'>Side</div><article class='no-comments'>{BODY}</article></div>", TEXT),
    ("just text", "just text"), ("", ""), ("<div></div>", ""), ("<p>a < b and <3</p>", "a < b and <3"),
    ("<div class='cookie-notice'>We use cookies</div><div><p>Real text here.</p></div>", "Real text here."),
])
def test_page(page, expected):
    assert html_consensus.Page(page).text([]) == expected


LONG = "Many words of a long article follow one another here. " * 60


@pytest.mark.parametrize("page,expected", [
    (f"<body><div class='post'><h1>Title</h1><div class='entry'><p>{LONG}</p></div></div></body>", f"Title\n{LONG.strip()}"),
    (f"<body><div class='post'><div class='lead'>A lead.</div><div><div class='entry'><p>{LONG}</p></div></div></div></body>",
     f"A lead.\n{LONG.strip()}"),
    (f"<body><h1>Title</h1><div class='entry'><p>{LONG}</p></div></body>", f"Title\n{LONG.strip()}"),
    (f"<article><h2 id='related-work'>Related work</h2><p>{LONG}</p><h2 id='comments'>Comments</h2></article>",
     f"Related work\n{LONG.strip()}\nComments"),
    (f"<div class='content-with-sidebar'><p>{LONG}</p><div class='site-footer'>Us</div><div class='sidebar-2'>Side</div></div>",
     LONG.strip()),
    (f"<div class='post'><div class='post-header'><h1>Title</h1></div><div class='entry'><p>{LONG}</p></div></div>",
     f"Title\n{LONG.strip()}"),
])
def test_nothing_else_is_dropped(page, expected):
    """What stands beside a long text stays, and so does what only has a boilerplate word in its name."""
    assert html_consensus.Page(page).text([]) == expected


@pytest.mark.parametrize("inner,kept", [
    ("<div style='overflow:hidden'><p>Here.</p></div>", "Here."), ("<p>See <a href='/hidden-gems'>our gems</a> now.</p>", "See our gems now."),
    ("<p>On <a href='/p?id=share'>this page</a>.</p>", "On this page."), ("<section title='hidden costs'><p>Costs.</p></section>", "Costs."),
    ("<section data-class='ads' data-id=comments><p>Data.</p></section>", "Data."), ("<div hidden><p>Gone.</p></div>", ""),
    ("<div HIDDEN=''><p>Gone.</p></div>", ""), ("<div role='search'>Gone</div>", ""), ("<div title='a > b' class=\"ads\">Gone</div>", ""),
    ("<div class='post-header'><p>Kept.</p></div>", "Kept."), ("<div id='content-sidebar-wrap'><p>Kept.</p></div>", "Kept."),
    ("<div class='related-work'><p>Kept.</p></div>", "Kept."), ("<div class='comments-open w-1/2'><p>Kept.</p></div>", "Kept."),
    *[(f"<div class='{c}'><p>Gone.</p></div>", "") for c in (
        "ad-slot", "google-ads", "adsbygoogle", "user-comments", "commentlist", "comments-section", "disqus_thread",
        "social-share-buttons", "related-posts", "article-comments", "content-ad", "post-share", "main-menu")]])
def test_boilerplate_by_name(inner, kept):
    page = f"<body class='single comments-open'><article><p>First block.</p>{inner}<p>Last block.</p></article></body>"
    assert html_consensus.Page(page).text([]) == "\n".join(filter(None, ["First block.", kept, "Last block."]))


@pytest.mark.parametrize("page,expected", [
    ("<main><h1>Head</h1><p>Lead.</p><article><p>The article itself is longer.</p></article></main>",
     "Head\nLead.\nThe article itself is longer."),
    ("<main><div><article><p>The article itself is longer.</p></article></div></main><p>Outside.</p>", "The article itself is longer."),
    ("<body><p>Outside.</p><article><div><p>The article itself is longer.</p></div><p>End.</p></article></body>",
     "The article itself is longer.\nEnd."),
])
def test_out_to_main(page, expected):
    assert html_consensus.Page(page).text([]) == expected


@pytest.mark.parametrize("page,words", [
    ("<div class=a>" * 100_000 + "deep words", 2), ("<script" * 150_000, None), ("<a \"" * 250_000, None),
    ("<span>w</i> " * 80_000, 80_000), ("<i><div>w</i></b>" * 60_000, None), ("<a \">\" " * 100_000 + "\"", None), ("<a x=\"\" " * 100_000 + ">", 0),
    ("<div>w</div>" * 80_000, 80_000), ("<!-- " * 200_000, 0), ("</p" * 300_000, None), ("<p>w" * 250_000, 250_000),
])
def test_odd_pages_take_linear_time(page, words):
    """Open, unclosed, stray and unbalanced tags by the megabyte."""
    import time
    import tracemalloc
    began = time.process_time()
    found = html_consensus.Page(page)
    path, text = found.path(found.best()), found.text([])
    assert time.process_time() - began < 10 and len(path) < 50_000  # seconds here, hours if it grew with the square
    assert words is None or len(text.split()) == words
    tracemalloc.start()
    html_consensus.Page(page[:200_000])
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()


def test_consensus_outvotes_a_noisy_page(spark):
    """One page has a longer box elsewhere; its host's pages agree on the article path."""
    good = f"<body><div class='story-7'>{BODY}</div><div class='extra'><p>Short.</p></div></body>"
    noisy = f"<body><div class='story-9'>{BODY}</div><div class='extra'><p>{'Longer than the story. ' * 20}</p></div></body>"
    rows = [(i, f"http://h.example/{i}", good, "x", "y") for i in range(5)]
    rows += [(5, "http://h.example/5?q", noisy, "x", "y"), (6, "https://u@H.example:80/6", good, "x", "y"),
             (7, None, None, "x", "y"), (8, "odd", "<p>Alone here.", "x", "y"), (8, "odd", "<p>Alone here.", "x", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, paths string")
    got = html_consensus.extract(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    assert all(by[i].text == TEXT and by[i].n_chars == len(TEXT) for i in range(7))
    assert by[7].text == "" and by[8].text == "Alone here." and by[5].url.endswith("?q")
    assert html_consensus.extract(df.where("page_id < 0")).count() == 0


def test_long_and_odd_pages():
    page = html_consensus.Page("<article>" + "<div>" * 400 + "<p>" + "word " * 200_000 + "<p>" + "<a b='" * 2000 + "</article>")
    assert page.text([]).startswith("word word")


def test_articles_of_the_tables(spark):
    """On the given pages the article element is the truth."""
    import re
    from html import unescape
    from notaflow.llm.common import table
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    got = {r.page_id: r.text for r in html_consensus.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)(</article>|<footer|$)", r.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split())
                  for b in re.split(r"</?(?:p|h1|li|ul|div)\b[^>]*>", inner)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)
