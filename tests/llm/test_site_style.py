"""Main text by site style trees: planted templates, the given pages by a second parser, awkward markup."""

import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from shelfcast.llm import site_style
from tests.llm.conftest import words

PAGES = "page_id long, url string, html string"


class Plain(HTMLParser):
    """Headings and paragraphs inside <article>, as the given pages mark them."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.held, self.inside = [], [], False

    def cut(self):
        text = " ".join("".join(self.held).split())
        if text:
            self.out.append(text)
        self.held = []

    def handle_starttag(self, tag, attrs):
        if tag in ("article", "p", "h1"):
            self.cut()
        if tag == "br":
            self.held.append(" ")
        self.inside = self.inside or tag == "article"

    def handle_endtag(self, tag):
        if tag in ("article", "p", "h1"):
            self.cut()
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.held.append(data)


def test_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        p = Plain()
        p.feed(r.html)
        p.close()
        want[r.page_id] = "\n".join(p.out)
    got = {r.page_id: r.text for r in site_style.extract(pages).collect()}
    assert got == want


def site(rng, host, n, copies=0):
    """Pages of a site that declares nothing: only the tree can tell its furniture."""
    menu = "".join(f'<div class="x1"><a href="/{w}">{w}</a></div>' for w in words(rng, 6).split())
    foot = words(rng, 12)
    rows, same, title = [], [words(rng, 30) for _ in range(3)], words(rng, 5)
    for i in range(n):
        body = same if i < copies else [words(rng, rng.randint(5, 40)) for _ in range(rng.randint(1, 5))]
        html = (f'<html><body id="top"><div class="x0">{menu}</div><div class="x2"><h2>{title if i < copies else words(rng, 4)}</h2>'
                + "".join(f"<p>{t}" for t in body) + f'</div><div class="x3">{foot}<!-- {i} --></div></body></html>')
        rows.append((host, html, body))
    return rows


def rows_of(sites):
    return [(i, f"https://u@{h.upper()}:80/p/{i}" if h else None, html) for i, (h, html, _) in enumerate(sites)]


def test_furniture_of_undeclared_sites_goes(spark):
    rng = random.Random(4)
    sites = site(rng, "a.example", 40) + site(rng, "b.example", 12, copies=9) + site(rng, "", 3) + site(rng, "few.example", 3)
    df = spark.createDataFrame(rows_of(sites), PAGES).withColumns({c: F.lit(1) for c in ("text", "key", "nodes", "node", "host")})
    for limit in (site_style.BROADCAST_NODES, 0):
        got = {r.page_id: r.text for r in site_style.extract(df, broadcast_nodes=limit).collect()}
        for i, (host, html, body) in enumerate(sites):
            if host in ("", "few.example"):  # no site, or too few pages to tell
                assert len(got[i].split("\n")) == len(body) + 8
            elif host == "b.example":  # four different pages: too few, and copies count once
                assert len(got[i].split("\n")) == len(body) + 8
            else:
                assert got[i].split("\n")[1:] == body and len(got[i].split("\n")) == len(body) + 1


def test_copies_stay(spark):
    rng = random.Random(6)
    sites = site(rng, "c.example", 400, copies=300)
    got = {r.page_id: r.text for r in site_style.extract(spark.createDataFrame(rows_of(sites), PAGES)).collect()}
    assert all(got[i].split("\n")[1:] == body for i, (_, _, body) in enumerate(sites))


def test_repeated_block_inside_articles_goes(spark):
    rng = random.Random(7)
    rows = [(i, "http://d.example/", f'<article><h1>{words(rng, 3)}</h1><div class="k7">Tell your friends</div><p>{words(rng, 20)}</article>')
            for i in range(20)]
    got = [r.text.split("\n") for r in site_style.extract(spark.createDataFrame(rows, PAGES)).collect()]
    assert all(len(t) == 2 and "friends" not in " ".join(t) for t in got)


def test_importance(spark):
    rng = random.Random(9)
    sites = site(rng, "e.example", 30)
    df = spark.createDataFrame(rows_of(sites), PAGES)
    found = site_style.importance(site_style.parse(df, "page_id", "url", "html")).collect()
    values = sorted(round(r.importance, 6) for r in found)
    assert {r.pages for r in found} == {30} and len(found) == 4  # menu entries, heading, paragraphs, foot
    assert values[:2] == [0, 0] and values[2:] == [1, 1]


def text_of(html):
    return [t for _, _, t, _ in site_style.blocks(html)]


def test_markup():
    assert text_of("") == [] and text_of("  \n ") == [] and text_of("a < b &amp; c &lt;p&gt; &eacute;&#x41;") == ["a < b & c <p> éA"]
    assert text_of("<p>one<p>two <b>bold<br>line<p>three</b>") == ["one", "two bold line", "three"]
    assert text_of("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>") == ["a", "b", "c", "d"]
    assert text_of("<table><tr><td>a<td>b<tr><td>c</table>x") == ["a", "b", "c", "x"]
    assert text_of("<script>var a='<p>no</p>';</script><p>yes<!-- <p>no --><style>p{}</style> more") == ["yes", "more"]
    assert text_of("<p>open<script>never closed <p>x") == ["open"]
    assert text_of("<p title=\"a > b\" class='c'>in</p><p>x<!-- open") == ["in", "x"]
    assert text_of("<nav>menu</nav><header>top</header><main><header><h1>T</h1></header>x</main><footer>f</footer>") == ["T", "x"]
    assert text_of('<div class="post"><p>a</p><div id="user-comments"><p>b</p></div><p role="alert">c</p><p hidden>d</p></div>e') == ["a", "e"]
    assert text_of('<div class="content-sidebar"><article><p>a</p></article><p>b</p></div>') == ["a"]
    assert text_of('<p>see <span class="ad">buy</span>this <a href="/x">link</a>, <button>go</button>end') == ["see this link, end"]
    assert text_of("<div>a</div></div></p>b</body></html>c") == ["a", "b", "c"]
    assert text_of("<main><aside>side</aside><form><p>f</p><input></form><p>t</main>") == ["t"]


def test_awkward_pages(spark):
    big = "<div>" * 3000 + "<p>" + "w " * 100_000 + "<a " * 20_000
    rows = [(1, None, None), (2, "", ""), (None, "nonsense", "<p>x"), (3, "//h/x", "<p>y"), (3, "//h/x", "<p>y"), (4, "http://[::1]/", big)]
    df = spark.createDataFrame(rows, PAGES)
    got = site_style.extract(df).collect()
    assert sorted((str(r.page_id), r.text[:2], len(r.text) > 9) for r in got) == [
        ("1", "", False), ("2", "", False), ("3", "y", False), ("3", "y", False), ("4", "w ", True), ("None", "x", False)]
    assert site_style.extract(df.limit(0)).count() == 0
