"""Wrapper induction: layouts with and without landmarks, broken markup, hosts
whose templates only show across pages, and the pages table against a plain
reading of its one layout."""
import html
import re

from pyspark.sql import types as T

from tessera.llm import html_text as H
from tessera.llm.queries import QUERIES

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no</p>";</script></head><body class="has-sidebar">
<header><a href="/">Site</a></header><nav><ul><li>Menu</li></ul></nav><div class="cookie-notice">We use cookies</div>
<main><article><header class="entry-header"><h1>Title &amp; more</h1></header><p>First <b>bold
 text</b>&nbsp;here.<p>Second<br>line &#233;&lt;x&gt;<div class="ad-box">Buy</div><ul><li>one<li>two</ul>
<form><input name=q>Search</form><aside>Side</aside></article>
<section id="comments"><article class="comment"><p>Nice!</p></article></section></main>
<div id="sidebar"><p>Recent</p></div><footer>&copy; Site</footer></body>"""


def text(source, wrapper=None):
    return H.page_text(source, wrapper)


def test_landmarks_and_marks():
    assert text(PAGE) == "Title & more\nFirst bold text here.\nSecond line é<x>\none\ntwo"


def test_broken_and_empty():
    assert text(None) == "" and text("") == "" and text("<") == "<" and text("plain & simple") == "plain & simple"
    assert text("<article><p>a<!-- <p>b</p> --><p>c</div></article") == "a\nc"
    assert text('<article><p title="x>y">in</p><p class="broken>out</p></article>').startswith("in")
    assert text("<script>x<p>y") == "" and text("<article><script>x</article>") == ""
    deep = "<div>" * 3000 + "core" + "</div>" * 3000
    assert text(deep) == "core"
    assert len(text("<p>" + "word " * 200_000)) == 999_999


def host_pages(n):
    return [f"<body><div class=x1><span>Shop of all things</span></div><div class=x2><p>Article {i} says {i * i}.</p><p>More {i}</p>"
            + ("<p>extra</p>" if i % 3 == 0 else "") + "</div><div class=x3>Opening hours: always</div></body>" for i in range(n)]


def folded(pages):
    out = None
    for p in pages:
        s = H.slots(H.parse(p))[0]
        out = s if out is None else H.merge(out, s)
    return out


def test_template_only_seen_across_pages():
    pages = host_pages(12)
    w = folded(pages)
    assert text(pages[4], w) == "Article 4 says 16.\nMore 4"
    assert text(pages[3], w) == "Article 3 says 9.\nMore 3\nextra"
    # too few pages, or one page many times: no evidence, nothing is dropped
    assert "Shop of all things" in text(pages[4], folded(pages[:3]))
    assert "Shop of all things" in text(pages[4], folded(pages[4:5] * 20))


def test_folding_order_does_not_matter_for_constants():
    pages = host_pages(16)
    a, b = folded(pages[:8]), folded(pages[8:])
    assert text(pages[5], H.merge(a, b)) == text(pages[5], folded(pages[::-1]))


def test_tree_matching_weight_is_the_largest():
    def node(label, *kids):
        return [label, 1, 1, list(kids)]
    a = node("r", node("a", node("x")), node("b"), node("a", node("y"), node("z")))
    b = node("r", node("b"), node("a", node("y"), node("z")), node("c"))
    assert H._weight(a, b) == 5 and H.align(a[3], b[3]) == [(1, 0), (2, 1)]


def test_rows_kept(spark):
    schema = T.StructType.fromDDL("page_id long, url string, html string, text string, host int, wrapper string")
    rows = [(1, "http://h/a", None, "t", 1, "w"), (None, None, "<p>x</p>", "t", 1, "w"), (2, "http://h/b", "<p>y</p>", None, None, None),
            (2, "http://h/b", "<p>y</p>", None, None, None), (3, "nonsense", "", "t", 0, "w")]
    df = spark.createDataFrame(rows, schema)
    out = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in H.main_text(df).collect()), key=str)
    assert out == sorted([(1, "http://h/a", "", 0), (0, None, "x", 1), (2, "http://h/b", "y", 1), (2, "http://h/b", "y", 1), (3, "nonsense", "", 0)], key=str)
    assert H.main_text(df.limit(0)).count() == 0


def test_query_equals_plain_reading(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op1_main_text"](spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(filter(None, blocks)) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url
