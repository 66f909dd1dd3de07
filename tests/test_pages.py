"""The page parser: time in proportion to the markup, nested items, what is broken."""

from __future__ import annotations

import json
import time

import pytest
from attestor.operators import pages as P
from attestor.plans import facts, pages
from pyspark.sql import functions as F

N = 100_000


@pytest.mark.parametrize("markup", ["<li>x" * N, "<b>" * N + "</i>" * N, "<p>x" * N, "<td>x<tr>" * N, "<div itemscope itemprop=a>" * N, "<span itemprop=x>t" * N, "<ul><li>" * N, "<a href=x>y" * N, "<h1>" * N + "x " * N])
def test_time_follows_the_markup(markup):
    part = markup[: len(markup) // 10]
    start = time.process_time()
    P.parse_page("https://a.no/", part)
    small = time.process_time() - start
    start = time.process_time()
    P.parse_page("https://a.no/", markup)
    assert time.process_time() - start < 10 * max(small, 0.05) * 4


def test_left_out_end_tags():
    r = P.parse_page("https://a.no/", "<ul><li><b>one<li>two<ul><li>in</ul>three</ul><p>p<div>d</div><table><tr><td>a<td>b<tr><td>c</table><footer>f<p>g</footer>after")
    assert r["text"] == "one two in three p d a b c f g after"
    assert [p["text"] for p in r["positions"] if p["label"] == "footer"] == ["f g"]


def nodes(html):
    return [(n["type"], json.loads(n["json"])) for n in P.parse_page("https://a.no/", html)["nodes"]]


def test_nested_items():
    html = """<div itemscope itemtype="https://schema.org/WebPage"><span itemprop=name>P</span><div itemprop=about itemscope itemtype="http://schema.org/Organization"><b itemprop="name legalName">Firma <i>AS</i></b>
    <div itemprop=address itemscope><span itemprop=streetAddress>Gate 1<meta itemprop=postalCode content=0150></div><a itemprop=url href=/x>u</a><time itemprop=founded datetime=2001>x</time></div></div>"""
    address = {"@type": [], "streetAddress": "Gate 1", "postalCode": "0150"}
    org = {"@type": "Organization", "name": "Firma AS", "legalName": "Firma AS", "address": address, "url": "/x", "founded": "2001"}
    assert nodes(html) == [("WebPage", {"@type": "WebPage", "name": "P", "about": org}), ("Organization", org)]


def test_references():
    one = '<div itemscope itemtype="x/T" itemref="b a nothing"><i itemprop=p>0</i></div><p id=a><i itemprop=p>1</i><b itemprop=q>2</b></p><div id=b itemprop=p>3</div>'
    assert nodes(one) == [("T", {"@type": "T", "p": ["0", "3", "1"], "q": "2"})]
    ring = '<div id=r><div itemscope itemtype="x/T" itemref=r itemprop=p><i itemprop=q>1</i></div></div>'
    assert nodes(ring)[0][0] == "T"


@pytest.mark.parametrize("url", ["http://[bad", None, "", "http://a.no:x/"])
def test_nothing_ends_the_job(url):
    html = '<link rel=alternate type="application/rss+xml" href="http://[x"><link rel=alternate type="application/rss+xml" href="/f"><a href="http://[x">bad</a><a href="https://b.no/">ok</a><![if x]><!doctype <a' + '<script type="application/ld+json">' + "[" * 100_000 + "</script>"
    r = P.parse_page(url, html)
    assert "ok" in r["text"] and [x["url"] for x in r["links"] if x["url"] == "https://b.no/"] in ([], ["https://b.no/"])
    assert P.parse_page(url, None)["text"] == ""


def test_contacts_leave_out_consumer_mail(spark):
    html = '<a href="mailto:A.B@gmail.com">x</a><a href="mailto:post@firma.no">y</a><a href="mailto:no address">z</a><a href="mailto:c@mail.online.no">z</a><a href="tel:12345678">t</a><a href="tel:+47 22 33 44 55">t</a><p>tlf 22.33.44.66 og 22 33 44 77'
    rows = P.contacts(P.parse_pages(spark.createDataFrame([(1, "https://firma.no/", html)], "page_id long, url string, html string"))).collect()
    assert [(r.field, r.value, r.confidence) for r in rows if r.field == "contact_email"] == [("contact_email", "post@firma.no", 1.0)]
    assert sorted((r.value, r.confidence) for r in rows if r.field == "contact_phone") == [("+4722334455", 1.0), ("+4722334466", 0.8)]


def test_news_only_from_news_pages(spark):
    link = '<a href="/2024/05/x">A headline of May</a><a href="/a"><time datetime="2024-06-01T10:00">juni</time> headline</a><a href="/b">2024-07-01</a><a href="/c">1.7.24</a><a href="https://x.no/">2024-07-01 elsewhere</a>'
    pages = spark.createDataFrame([(1, "https://firma.no/nyheter/", link), (2, "https://firma.no/om-oss/", link.replace("/a", "/z"))], "page_id long, url string, html string")
    got = P.news_items(P.parse_pages(pages)).select("date", F.col("link")).collect()
    assert [tuple(r) for r in sorted(got, reverse=True)] == [("2024-07-01", "https://firma.no/b"), ("2024-06-01", "https://firma.no/a"), ("2024-05", "https://firma.no/2024/05/x")]


def test_title_as_written(spark):
    html = "<head><TITLE lang=no> A &amp;amp;&quot;b &amp</title><title>no</title>"
    r = P.parse_page("https://a.no/", html)
    assert r["title_markup"] == " A &amp;amp;&quot;b &amp"
    assert P.parse_page("https://a.no/", "<title>open")["title_markup"] == P.parse_page(None, None)["title_markup"] == ""


def test_pages_leave_the_parser_in_groups():
    import pyarrow as pa

    n = 2 * P._PAGES + 1
    html = [None if i == 3 else "x" * (P._AT_ONCE if i == 5 else 10) for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array([f"https://a{i}.no/" for i in range(n)]), pa.array(html)], ["page_id", "url", "html"])
    out = list(P._parse(iter([batch])))
    assert [b.num_rows for b in out] == [6, P._PAGES, P._PAGES - 5]
    assert [i for b in out for i in b.column("page_id").to_pylist()] == list(range(n))
    assert [u for b in out for u in b.column("url").to_pylist()] == [f"https://a{i}.no/" for i in range(n)]


def test_plain_tags_and_links_read_as_the_standard_parser_reads_them():
    head = '<div itemscope itemtype="x/T"><p itemprop="n" class="">t<br>u</p><meta itemprop="m" content="c"></div><h1>H</h1><textarea><b>'
    for href in ("/a/b?x=1#y", "/a/../b", "//C.no/d", "/a//b", "/a;b", "/å/b", "/", "/?q", "/u/", "/a b", "/x?a=[b"):
        plain = P.parse_page("HTTPS://A.no/x/y", f'{head}</textarea><a href="{href}">x</a>')
        odd = P.parse_page("HTTPS://A.no/x/y", f"{head.replace('<p ', '<P  ')}</textarea><a  href='{href}' >x</a>")
        assert plain == odd
    assert P._START.match('<a href="/x">') and not P._START.match("<a href='/x'>")


def test_dates_of_news_are_made_once(spark):
    rows = P.news_items(spark.createDataFrame([], P.PARSED))
    # of an article, an anchor, a time element and a path; a filter on the date used to make each of them again
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("date_format(") == 4


#: Columns besides page_id and url that a query reads of parsed pages.
READ = (
    (facts.p6_page_nodes, ("nodes",)),
    (facts.p12_site_absence, ("links", "text", "nodes")),
    (facts.p7_org_facts, ("nodes",)),
    (facts.p11_careers_pages, ("text", "nodes")),
    (pages.p4_contacts, ("links", "text")),
    (pages.p3_site_links, ("links",)),
    (pages.p12_fill_absence, ("links", "text")),
    (pages.p3_page_links, ("links",)),
)


@pytest.mark.parametrize(("query", "columns"), READ, ids=[f.__name__ for f, _ in READ])
def test_only_what_a_query_reads_leaves_the_parser(spark, tmp_path, monkeypatch, query, columns):
    made, parse = [], P.parse_pages
    monkeypatch.setattr(P, "parse_pages", lambda *a: made.append(parse(*a)) or made[-1])
    spark.createDataFrame([(1, "https://a.no/", "<a href='/b'>b</a>")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    query(spark, str(tmp_path)).collect()
    assert [set(m.columns) for m in made] == [{"page_id", "url", *columns}]


def test_named_columns_are_those_of_all(spark):
    pages = spark.createDataFrame([(1, "https://a.no/", "<title>t</title><a href='/b'>b</a>"), (2, None, None)], "page_id long, url string, html string")
    whole, some = P.parse_pages(pages), P.parse_pages(pages, "links", "title")
    assert whole.columns == spark.createDataFrame([], P.PARSED).columns and set(some.columns) == {"page_id", "url", "links", "title"}
    assert sorted(some.collect()) == sorted(whole.select(*some.columns).collect())
    with pytest.raises(ValueError, match="nod"):
        P.parse_pages(pages, "nod")
