from __future__ import annotations

import html
import itertools
import random
import re

import duckdb
from pyspark.sql import functions as F

from zonewright.llm import html_wrapper as hw
from zonewright.llm.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def texts(spark, rows, **more):
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    frame = frame.withColumns({"host": F.lit("x"), "wrapper": F.lit(1), "text": F.lit("t"), "_salt": F.lit(2)})
    got = hw.extract_main_text(frame, **more).collect()
    assert all(r.n_chars == len(r.text) for r in got)
    return sorted((r.page_id is None, r.page_id or 0, r.url, r.text) for r in got)


def one(spark, page):
    return texts(spark, [(1, "http://a/", page)])[0][3]


def test_query_equals_plain_article_text(spark):
    """These pages all name their article; everything else follows from the blocks in it."""
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{SF_DIR}/pages.parquet'").fetchall()
    want = {}
    for name, url, page in rows:
        inner = re.search("<article>(.*?)(?:</article>|$)", page or "", re.S)
        blocks = re.split("</?(?:p|h1|li|ul|div)>", inner[1].replace("<br>", " ") if inner else "")
        plain = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in blocks)
        want[name] = (url, "\n".join(b for b in plain if b))
    got = QUERIES["op13_html_extraction"](spark, SF_DIR).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want and len(got) == len(rows)


def test_parts_that_are_no_article_are_left_out(spark):
    page = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body>
    <header><h2>Site</h2></header><div class="cookie-notice">We use cookies</div>
    <nav><ul><li><a href=/>Home</a></ul></nav><aside>Side</aside><div id="sidebar">More</div>
    <main><header><h1>Head &amp; line</h1></header><p>First <b>bo</b>ld&nbsp;text<br>goes
      on.<p>Second &lt;p&gt; &#233;&#x1F600; <script>var a="</p>";</script>end
    <form><input><p>Mail</p></form><ul><li>one<li>two <i>x</i></ul><table><tr><td>a<td>b</table>
    <div class="ad box"><p>Buy</p></div>loose text<section class="comments"><article>Nice!</article></section>
    <noscript>enable</noscript><!-- a > b --></main><footer>Imprint</footer></body></html>"""
    assert one(spark, page).split("\n") == [
        "Head & line", "First bold text goes on.", "Second <p> é😀 end", "one", "two x", "a", "b", "loose text",
    ]


def test_template_is_learned_where_no_part_is_named(spark, monkeypatch):
    def page(i):
        links = "".join(f"<li><a href=/{k}>topic {k} {i}</a>" for k in range(5))
        return (
            f"<html><body><div>My Site - all about things</div><div><ul>{links}</ul></div>"
            f"<div><h1>Title {i}</h1><p>Body {i} one.</p><p>Body {i} two with <a href=x>a link</a> in it.</p></div>"
            + ("<div>extra " + str(i) + "</div>" if i % 2 else "")
            + "<div>All rights reserved</div></body></html>"
        )

    rows = [(i, f"http://h.example/{i}", page(i)) for i in range(9)]
    for limit in (0, 32 << 20):
        monkeypatch.setattr(hw, "BROADCAST_BYTES", limit)
        got = texts(spark, rows)
        for _, i, _, text in got:
            more = f"\nextra {i}" if i % 2 else ""
            assert text == f"Title {i}\nBody {i} one.\nBody {i} two with a link in it.{more}"
    # a host with too few pages has no template; copies of one page are no evidence
    few = texts(spark, rows[:2])
    assert few[0][3].startswith("My Site - all about things\nTitle 0")
    copies = texts(spark, [(k, "http://c/", page(0)) for k in range(8)])
    assert {t for *_, t in copies} == {few[0][3]}


def test_odd_rows(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>after"
    rows = [
        (1, "http://a/", None),
        (1, "http://a/", ""),
        (2, None, "<p>no host"),
        (None, "x", "plain &am &amp text   <"),
        (3, "http://a/", "<article><p>cut of"),
        (4, "http://a/", "<article>" + "word " * 200_000),
        (5, "http://b/", deep),
        (5, "http://b/", deep),
        (6, "http://a/", "</div></p><li>a</ul>b<p>c</b>d"),
    ]
    got = texts(spark, rows)
    want = ["", "", "no host", "plain &am & text <", "cut of", " ".join(["word"] * 200_000)]
    want += ["deep\nafter"] * 2 + ["a\nb\ncd"]
    assert sorted(r[3] for r in got) == sorted(want)
    assert [r[1] for r in got] == [1, 1, 2, 3, 4, 5, 5, 6, 0] and got[-1][0]
    assert texts(spark, []) == []


def test_matching_is_the_largest_ordered_one():
    rng = random.Random(3)

    def tree(depth):
        slot = hw.Slot(rng.choice("abc"), 1, "", 0, 0)
        slot.kids = [tree(depth - 1) for _ in range(rng.randrange(4))] if depth else []
        return slot

    def largest(a, b):
        best = 0
        for n in range(min(len(a), len(b)) + 1):
            for x, y in itertools.product(itertools.combinations(a, n), itertools.combinations(b, n)):
                if all(p.sign == q.sign for p, q in zip(x, y)):
                    best = max(best, sum(1 + largest(p.kids, q.kids) for p, q in zip(x, y)))
        return best

    for _ in range(200):
        a, b = tree(2), tree(2)
        size, pairs = hw.matching(a.kids, b.kids)
        assert size == hw.NODE * largest(a.kids, b.kids)
        assert sum(hw.NODE + hw.matching(a.kids[i].kids, b.kids[j].kids)[0] for i, j in pairs) == size
