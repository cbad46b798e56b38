from __future__ import annotations

import time

import pytest
from monthloom.llm import html_text
from monthloom.llm.html_text import main_text
from tests.llm.conftest import plain

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><b>";</script></head>
<body class="with-sidebar"><header><a href="/">Site</a></header><nav><ul><li>Home</ul></nav><div class="ad">Buy</div>
<article><header><h1>Title &amp; more</h1></header><p>One<br>two   <b>three</b>&nbsp;four<p>Five &lt;six&gt; <!-- no > --> seven
<ul><li>a<li>b</ul><div class="newsletter-box">Join</div><section id="comments"><p>Nice!</p></section><form><input>Go</form><footer>by me</footer></article>
<aside>Also</aside><div role="dialog">Cookies</div><footer>End</footer></body></html>"""


def test_article_without_furniture():
    assert main_text(PAGE) == "Title & more\n\nOne two three four\n\nFive <six> seven\n\na\n\nb"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain", "plain"),
        ("<p>a<p>b", "a\n\nb"),
        ("<p><b>a<br><p>b</b>", "a\n\nb"),
        ("a < b <c", "a < b"),
        ("<div>x<script>y", "x"),
        ("<p>x<!-- y", "x"),
        ("<p title='a>b'>x", "x"),
        ('<p title="a>b>x', "b>x"),
        ("<main><p>m</p></main><p>o</p>", "m"),
        ("<body><p>o</p><div style='display: none'>h</div>", "o"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n\n2\n\n3"),
        ("<article class=comment>no</article><article>yes</article>", "yes"),
        ("</div></p>x</b>", "x"),
        ("<div>" * 5000 + "deep", "deep"),
        ("<b>" * 5000 + "deep" + "<p>" * 5000 + "er", "deep\n\ner"),
        ('<body class="page has-sidebar"><div><p>Hello world</p></div></body>', "Hello world"),
        ('<body class="sidebar"><p>a</p><div class="sidebar">b</div></body>', "a"),
        ('<div id="content" class="no-sidebar"><p>a</p></div><div class="left-sidebar">b</div>', "a"),
        ('<p>o</p><article class="post comment-open"><p>hello there</p></article>', "hello there"),
        ('<p>o</p><article class="comment"><p>only one</p></article>', "only one"),
        ('<article><p>a</p><section class="related-work"><p>b</p></section><div class="related-posts">c</div></article>', "a\n\nb"),
        ('<div class="widget"><p>all there is</p></div>', "all there is"),
        ("&#233;&eacute;&#x20AC;&unknown;&amp", "éé€&unknown;&"),
    ],
)
def test_odd_markup(html, text):
    assert main_text(html) == text


@pytest.mark.parametrize("html", ["x<" + "a" * 1_000_000, "x<a " + "b=" * 500_000, "<div>" * 100_000 + "x", "x<a '" + "<b>" * 200_000, "x" + "</i" * 300_000])
def test_broken_markup_takes_linear_time(html):
    began = time.monotonic()
    main_text(html, frozenset([1]))
    assert time.monotonic() - began < 5


def test_counts_of_template_hashes(spark):
    """Against counting in plain Python the pages that hold each hash."""
    links = lambda i: "".join(f"<li><a href=/{i}{k}>n {i} {k}</a></li>" for k in range(2 + i % 3))
    html = [f"<div class='n{i}'><ul>{links(i)}</ul></div><div>Same {i % 7}</div><article><ul>{links(i)}</ul><p>t {i}</p></article>" for i in range(50)]
    rows = [(i, f"http://{'a' if i % 5 else 'b'}.example/{i}", h) for i, h in enumerate(html)]
    held = {}
    for i, h in enumerate(html):
        for x in html_text.subtrees(html_text.measure(html_text.parse(h), True), set()):
            held.setdefault(("a" if i % 5 else "b") + ".example", {}).setdefault(x, []).append(i)
    most = {"a.example": 40, "b.example": 10}
    expected = {host: {x for x, own in of.items() if len(own) >= max(html_text.MIN_PAGES, html_text.MIN_SHARE * most[host])} for host, of in held.items()}
    found = {r["host"]: set(r["template"]) for r in html_text.templates(pages(spark, rows)).collect()}
    assert found == {host: x for host, x in expected.items() if x}
    out = {r["page_id"]: r["text"] for r in html_text.extract(pages(spark, rows)).collect()}
    assert out[1] == "n 1 0\n\nn 1 1\n\nn 1 2\n\nt 1"


def test_navigation_with_changing_links_goes_by_its_shape(spark):
    body = lambda i: f"<div><div><ul>{''.join(f'<li><a href=/{k}>Go {i} {k}</a>' for k in range(2 + i % 4))}</ul></div><p>Text <a href=/>{i}</a></p></div>"
    rows = [(i, "http://a.example/", body(i)) for i in range(40)] + [(100 + i, f"http://b{i}.example/", body(i)) for i in range(5)]
    out = {r["page_id"]: r["text"] for r in html_text.extract(pages(spark, rows)).collect()}
    assert out[3] == "Text 3"
    assert out[100] == "Go 0 0\n\nGo 0 1\n\nText 0"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, host string, template int")


def test_template_of_a_site_goes_and_repeated_articles_stay(spark):
    body = lambda i: f"<div><div>Welcome to our site</div><div>Own {i}</div><p>Shared line</p><p>Text {i}</p></div>"
    rows = [(i, f"http://a.example/{i}", body(i)) for i in range(40)]
    rows += [(100 + i, f"http://B{i}.example/", body(i)) for i in range(40)]
    rows += [(200 + i, "http://c.example/", "<article><div><p>Same article</p></div></article>") for i in range(30)]
    out = {r["page_id"]: r["text"] for r in html_text.extract(pages(spark, rows).repartition(5)).collect()}
    assert out[3] == "Own 3\n\nShared line\n\nText 3"
    assert out[103] == "Welcome to our site\n\nOwn 3\n\nShared line\n\nText 3"
    assert out[205] == "Same article"


def test_odd_rows(spark):
    rows = [(1, None, "<p>a"), (2, "nonsense", None), (3, "http://h/", ""), (3, "http://h/", ""), (None, "http://u:p@H:80/x", "<p>é" + "x" * 100_000)]
    out = plain(html_text.extract(pages(spark, rows)))
    assert [(r["page_id"], r["n_chars"]) for r in sorted(out, key=lambda r: (r["page_id"] or 9))] == [(1, 1), (2, 0), (3, 0), (3, 0), (None, 100_001)]
    assert plain(html_text.extract(pages(spark, []))) == []
