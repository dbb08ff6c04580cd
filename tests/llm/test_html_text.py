"""Main text of pages: reading of elements, templates of hosts, odd rows, the registered query."""

import html
import os
import re
from collections import defaultdict

import pytest

from snowloom.llm import html_text
from snowloom.llm.html_text import Page
from snowloom.llm.queries import QUERIES
from snowloom.llm.registry import prepare

FOLDER = f"/root/testdata/{os.environ.get('TEST_SF', 'sf0.001')}"
SCHEMA = "page_id long, url string, html string, text string, host string, recurring string"


def text(source, recurring=()):
    return Page(source).text(set(recurring))[0]


@pytest.mark.parametrize(
    "source, want",
    [
        ("", ""),
        ("plain &amp; simple\n  text", "plain & simple text"),
        ("<p>a<p>b<br>c", "a\n\nb c"),
        ("<p><b>a<br><p>b</b> c</p>d", "a\n\nb c\n\nd"),
        ("<ul><li>a<li>b <i>c</i></ul>", "a\n\nb c"),
        ("<table><tr><td>a<td>b<tr><th>c</table>d", "a\n\nb\n\nc\n\nd"),
        ("<div>a</div></div></p>b", "a\n\nb"),
        ("a < b <3 &lt;p&gt; &amp &copy &#233;&#x1F600;&nosuch;", "a < b <3 <p> & \u00a9 \u00e9\U0001f600&nosuch;"),
        ("x<script>var t='</p>';if(a<b){}</script>y<STYLE>p{}</Style >z", "xyz"),
        ("x<!-- <p>no</p> -->y<!-->z<!doctype html><?php a ?>w</ >v", "xyzwv"),
        ("<p title='a > b' data-x=\"</p>\" checked>yes</p>", "yes"),
        ("<p>whole</p><p>cut</p><p class=\"x", "whole\n\ncut"),
        ("whole <scr", "whole"),
        ("whole &am", "whole &am"),
        ("whole<script>never ends", "whole"),
        ("whole<!-- never ends", "whole"),
        ("<title>no</title><textarea><p>no</textarea>yes", "yes"),
        ("<p>one\u00a0two\u2003three\ttwo</p>", "one two three two"),
        ("<body><nav>menu</nav><article><header><h1>T</h1></header><p>a</p><footer>f</footer></article><p>other</p>", "T\n\na"),
        ("<main><h1>T</h1><article><p>a</p></article><section class='comments'><article>c</article></section></main>", "T\n\na"),
        ("<div role=main><p>a<span class='ad x'>buy <span>now</span></span>b</p><aside>s</aside></div>", "ab"),
        ("<article><p>a</p><div class='newsletter-box'><form><p>mail</p></form></div><p hidden>h</p></article>", "a"),
        ("<article><div class='share'><p>all of it is here</p></div></article>", ""),
        ("<body class='has-sidebar'><div id=header>h</div><div class=content><p>body text of the page</p></div></body>", "body text of the page"),
        ("<div><ul><li><a href='/a'>a</a><li><a href='/b'>b</a></ul><p>See <a href='/c'>this</a> page</p></div>", "See this page"),
        ("<form id=aspnet><div><p>The whole page stands in a form</p></div></form>", "The whole page stands in a form"),
        ("<article class='post comment-free'></article><p>x</p>", "x"),
    ],
)
def test_reading(source, want):
    assert text(source) == want


def test_long_and_deep_pages():
    """No recursion, and time in proportion."""
    assert text("<div>" * 20_000 + "x" + "</div>" * 20_000) == "x"
    assert text("<b><i>" * 20_000 + "x").endswith("x")
    assert text("</p>" * 50_000 + "<" * 50_000).startswith("<<<")
    assert len(text("<p>ab cd</p>" * 50_000)) == 50_000 * 7 - 2


def test_hashes_ignore_attributes():
    a, b, c = (Page(f"<div class={k}><p>menu of {w}</p></div><p>{k}</p>") for k, w in (("x", "m"), ("y", "m"), ("z", "n")))
    at = a.tags.index("div")
    assert a.hashes[at] == b.hashes[at] != c.hashes[at]
    assert a.hashes[0] != b.hashes[0]


def article(k):
    return f"<p>Part one of article {k}.</p><p>Said often.</p><p>And more of it, number {k * 7}.</p>"


def site():
    """Hosts whose template bears no telling names, with copies of pages and of paragraphs."""
    box = "<div class=q1><p>Call us</p><p>any day</p></div>"
    rows = [(i, f"https://a.example/{i}", f"<body><div class=z9><p>Welcome to A</p></div><div>{article(i)}</div>{box}</body>") for i in range(20)]
    rows += [(100 + i, f"http://A.example:8080/x{i}", f"<body><main>{article(i + 50)}{box}</main></body>") for i in range(20)]
    rows += [(200 + i, f"//b.example/{i}", f"<body><div><p>Copy of one and the same long article.</p><p>It ends.</p></div><p>{i}</p></body>") for i in range(30)]
    rows += [(300 + i, f"http://c.example/{i}", f"<body>{box}<div>{article(i)}</div></body>") for i in range(2)]
    return rows


def frame(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, u, h, "t", "h", "r") for i, u, h in rows], SCHEMA).repartition(3)


def shown(k, often=True):
    return "\n\n".join([f"Part one of article {k}.", *(["Said often."] if often else []), f"And more of it, number {k * 7}."])


def test_templates(spark):
    """A template goes without any telling name; paragraphs of a marked article and copied pages stay."""
    got = {r.page_id: r.text for r in html_text.extract(frame(spark, site())).collect()}
    # Where no article is marked, a paragraph on every page of a host cannot be told from its template.
    assert all(got[i] == shown(i, often=False) for i in range(20))
    assert all(got[100 + i] == shown(i + 50) for i in range(20))
    assert all(got[200 + i] == f"Copy of one and the same long article.\n\nIt ends.\n\n{i}" for i in range(30))
    # Two pages are no evidence.
    assert all(got[300 + i] == "Call us\n\nany day\n\n" + shown(i) for i in range(2))


def test_counts_equal_direct_ones(spark):
    rows = site()
    pages = defaultdict(lambda: defaultdict(set))
    for _, url, source in rows:
        copy, found = Page(source).subtrees()
        for h in found | {0}:
            pages[re.search("//([^/:]+)", url)[1].lower()][h].add(copy)
    want = {}
    for host, met in pages.items():
        found = {h for h, copies in met.items() if h and len(copies) >= max(html_text.LEAST, html_text.SHARE * len(met[0]))}
        if found:
            want[host] = found
    df = frame(spark, rows).select("page_id", "url", "html").withColumn("host", html_text.host("url"))
    got = {r.host: {h % (1 << 64) for h in r.recurring} for r in html_text.templates(df).collect()}
    assert got == want and set(got) == {"a.example"}


def test_joined_templates(spark, monkeypatch):
    """Beyond the size that may be broadcast, the templates are joined by host, with the same result."""
    df = frame(spark, site())
    want = sorted(tuple(r) for r in html_text.extract(df).collect())
    monkeypatch.setattr(html_text, "BROADCAST_HASHES", -1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(tuple(r) for r in html_text.extract(df).collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (None, None, "<p>a</p>"), (3, "no address", "<p>b</p>"), (4, "http://x.example", "  "), (5, "http:///p", "<p>c &#xD800;</p>")]
    rows += [(6, "http://x.example/", "<p>same</p>")] * 5
    got = sorted(((r.page_id, r.url, r.text, r.n_deleted) for r in html_text.extract(frame(spark, rows)).collect()), key=str)
    want = [(i, u, {None: "a", 3: "b", 5: "c \ufffd", 6: "same"}.get(i, ""), 0) for i, u, _ in rows]
    assert got == sorted(want, key=str)
    assert html_text.extract(frame(spark, rows).where("page_id < 0")).collect() == []


@pytest.mark.parametrize("url, want", [("https://u:p@WWW.A.example:80/x?y", "www.a.example"), ("//b.example", "b.example"), ("http://c.example?q", "c.example"), ("/path", None), ("", None), (None, None)])
def test_host(spark, url, want):
    assert spark.createDataFrame([(url,)], "url string").select(html_text.host("url").alias("h")).first().h == want


def direct(source):
    """The article of a page of the given tables, by patterns that fit these pages alone."""
    inside = re.sub("<[^>]*$", "", re.search("<article>(.*?)(</article>|$)", source, re.S)[1])
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?p>|</?h1>", inside)]
    return "\n\n".join(b for b in blocks if b)


def test_query(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet").collect()
    want = sorted((p.page_id, p.url, direct(p.html), len(direct(p.html))) for p in pages)
    assert sorted(tuple(r) for r in QUERIES["op11_html_extraction"](spark, FOLDER).collect()) == want
