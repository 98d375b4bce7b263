"""Cards, attributes, texts and character references of stored HTML."""

import os
import sys

import pytest
from pyspark.sql import functions as F

from rankdelta.functions import html as H
from rankdelta.plans.registry import load_all
from rankdelta.sources import listing as L

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


def ask(spark, sql, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(F.expr(sql).alias("x")).first()[0]


def cards(spark, html):
    return ask(spark, H.outermost("c0", "li", ("ul", "ol")), html)


@pytest.mark.parametrize("html,want", [
    ("<ul><li>a</li><li>b</li></ul>", ["a", "b"]),
    ("<LI>a</LI><Li CLASS=x>b</lI >", ["a", "b"]),
    ("<li>a<ul><li>n</li><li>m</ul>z</li><li>b</li>", ["a<ul><li>n</li><li>m</ul>z", "b"]),
    ("<ul><li>a<li>b<ol><li>n</ol></ul>tail<ul><li>c", ["a", "b<ol><li>n</ol>", "c"]),
    ("<li title='<li>' x=\"</li>\">a<i y='>'>t</i></li>", ["a<i y='>'>t</i>"]),
    ("<!-- <li>no</li> --><script>'<li>'</script><li>a<!-- </li> -->b</li><style>li>a{}</style>", ["a<!-- </li> -->b"]),
    ("<link><list><li/>a</li>", ["a"]), ("a < b <li>c < d</li>", ["c < d"]), ("</ul></li>", []), ("", []),
    ("<li>a <b title=\"open</li>", ["a <b title=\"open"]), ("<LI\n>a", ["a"]),
])
def test_outermost_items(spark, html, want):
    assert cards(spark, html) == want


def test_long_pages_do_not_exhaust_the_stack(spark):
    html = "<p>x</p><a href='y'>" * 60_000 + "<li>" + "<b z=\"1\" w='2'>t</b>" * 30_000 + "</li>" + "&amp;" * 10
    got = cards(spark, html)
    assert len(got) == 1 and len(got[0]) == 30_000 * 20
    assert len(cards(spark, "<ul>" + "<li>" * 300 + "</ul>" * 2)) == 300
    tag = "<a " + " ".join(f"k{i}='v > {i}'" for i in range(3000)) + " last=end>"
    assert ask(spark, H.attribute("c0", "last"), tag) == "end"


@pytest.mark.parametrize("tag,name,want", [
    ("<a href=\"x>y\" title='t \"q\" t'>", "title", 't "q" t'), ("<A HREF=/p/5>", "href", "/p/5"), ("<a title=\"href=no\" href = 'yes'>", "href", "yes"),
    ("<a x href>", "href", ""), ("<a hrefs=1 data-href=2>", "href", ""), ("<a href=1 href=2>", "href", "1"), ("<a/href='s'/>", "href", "s"),
    ("<a title='&lt;b&gt; &amp;amp; &#39;&#x20AC;&nope; &'>", "title", "<b> &amp; '€&nope; &"), ("<b data-price=\"\">", "data-price", ""),
])
def test_attributes(spark, tag, name, want):
    assert ask(spark, H.attribute("c0", name), tag) == want


def test_class_tokens(spark):
    for tag, want in (("<i class='a price b'>", True), ("<i CLASS=price>", True), ("<i class='pricey old-price'>", False), ("<i class='Price'>", False),
                      ("<i title='price'>", False), ("<i class=\"x\nprice\">", True), ("<i>", False)):
        assert ask(spark, H.has_class("c0", "price"), tag) is want


def test_references(spark):
    cases = {"a &amp; b": "a & b", "&quot;&apos;&lt;&gt;": "\"'<>", "&#128512;&#x1F600;": "😀😀", "&#0;&#xD800;&#1114112;": "&#0;&#xD800;&#1114112;",
             "&bogus; & &;": "&bogus; & &;", "": "", "x&nbsp;y": "x y", "&AMP;": "&AMP;"}
    for text, want in cases.items():
        assert ask(spark, H.decoded("c0"), text) == want


def test_cards_that_a_plain_pattern_misreads(spark):
    html = ("<LI><A>Upper - Case</A></LI><li><a>Aa - nest</a><ul><li>n</li></ul><b data-price='5'></b></li>"
            "<li><a><b>Brand</b> - inner</a></li><li><a>Q &amp; A - x</a><br><span class=price>&pound;3<br>off</span></li><li><img class=price><a>y</a></li>")
    pages = spark.createDataFrame([(1, "https://a/en/", html), (2, "https://a/en/", None), (3, None, "<li><a>no url</a>")], "page_id long, url string, html string")
    got = L.rank_listing(pages).filter("page_id = 1").orderBy("rank").collect()
    assert [(r.brand, r.product) for r in got] == [("Upper", "Case"), ("Aa", "nest"), ("Brand", "inner"), ("Q & A", "x"), ("N/A", "y")]
    priced = L.priced_cards(pages).orderBy("page_id", "position").collect()
    assert [(r.price_text, r.price_source) for r in priced] == [(None, None), ("5", "attr"), (None, None), ("£3off", "inner"), (None, None), (None, None)]


def test_rows_that_a_broken_cut_would_turn_red(spark):
    """The oracle rows of the cuts differ from those without them."""
    from oracle_check import duck
    con, q = duck("/root/testdata/sf0.01"), load_all()

    def rows(name):
        return con.execute(f"SELECT count(*) FROM ({q[name].oracle}) x").fetchone()[0]
    assert rows("card_ranks") < rows("card_items")
    assert con.execute(f"SELECT count(*) FROM ({q['card_sentinels'].oracle}) x WHERE sentinel").fetchone()[0] > 0
    blank = con.execute(f"SELECT max(rank), max(page_id) FROM ({q['card_ranks'].oracle}) x").fetchone()
    nonblank = con.execute(f"SELECT max(rank), max(page_id) FROM ({q['card_ranks_nonblank'].oracle}) x").fetchone()
    assert blank[0] == nonblank[0] == 100 and blank[1] < nonblank[1]
    assert rows("report_top_n") < rows("rank_report")
