"""The markup reader against the standard library's, on plain, broken and hostile pages."""

import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from quern.functions import markup


class Standard(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        first = {}
        for k, v in attrs:
            first.setdefault(k, v or "")
        self.found.append(("start", tag, first))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # a slash closes nothing in HTML

    def handle_endtag(self, tag):
        self.found.append(("end", tag, {}))

    def handle_data(self, data):
        if self.found and self.found[-1][0] == "text":
            self.found[-1] = ("text", self.found[-1][1] + data, {})
        else:
            self.found.append(("text", data, {}))


def joined(events):
    out = []
    for e in events:
        if out and e[0] == out[-1][0] == "text":
            out[-1] = ("text", out[-1][1] + e[1], {})
        else:
            out.append(e)
    return out


PAGES = [
    "<p>a &amp; b&nbsp;&#39;c&#x27; &copy; &unknown; 3 < 4 &lt;</p>", "<A HREF='x?a=1&amp;b=2' href=y Class=\"k l\" disabled>t</A >", "<!-- <a href=no> --><b>x<!doctype html><?php x ?></b>",
    "<script>if (a<b) { '<p>' }</script><style>p>a{}</style><p>after", "<ul><li>one<li>two</ul></ul></nope>", "<td class=a/b>x<br/>y<img src=a.png /></td>", "<p title='a > b'>c</p>", "", "no markup at all", "<p><b><i>unclosed",
    "a < b <c> d", "<h1\nid = 'x'\n>t</h1\n>",
]


@pytest.mark.parametrize("page", PAGES)
def test_reads_as_the_standard_parser(page):
    standard = Standard()
    standard.feed(page)
    standard.close()
    assert joined(markup.Reader(page)) == standard.found


def test_real_pages_read_as_the_standard_parser(spark):
    for row in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect():
        standard = Standard()
        standard.feed(row.html)
        standard.close()
        assert joined(markup.Reader(row.html)) == standard.found


@pytest.mark.parametrize("piece", ["<tr", "<tr ", "<a href='", "<a x=\"y' ", "<!--", "</", "<", "&", "<script>", "</td", "<td class="])
def test_time_is_linear_in_what_is_unclosed(piece):
    began = time.perf_counter()
    for _ in markup.Reader(piece * 100_000):
        pass
    assert time.perf_counter() - began < 3


def test_anchors_and_text(spark):
    html = "<script>var t='<a href=no>x</a>'</script><a href='/a?x=1&amp;y'>One <b>bold</b>\n two</a><a name=z>not</a><a HREF=/b>un<a href=/c>closed<!-- hidden -->"
    got = spark.createDataFrame([(html,), (None,)], "html string").select(markup.anchors(F.col("html")).alias("a"), markup.visible(F.col("html")).alias("v")).collect()
    assert [(x.href, x.text) for x in got[0].a] == [("/a?x=1&y", "One bold two"), ("/b", "un"), ("/c", "closed")] and got[1].a == [] and got[1].v is None
    assert got[0].v == "One bold two not un closed"


def test_listing_of_pages(spark):
    classes = {"kjTime": "time", "kjCode": "code", "kjName": "company", "kjTitle": "title"}
    row = lambda i: f"<tr><td class='x kjTime'>1{i}:00</td><td class=kjCode>{i}</td><td class=kjName>n &amp; m</td><td class=kjTitle><a href='d{i}.pdf'>t{i}</a></td></tr>"
    page = lambda *of: "<table>" + "".join(map(row, of)) + "<tr><td class=kjTime>no more</td></tr></table>"
    pages = [("d1", 1, page(1, 2)), ("d1", 2, page(3, 4)), ("d1", 3, page(5)), ("d1", 4, page(6, 7)), ("d2", 1, page()), ("d3", 1, None), ("d4", 2, page(1)), ("d5", 1, page(1, 2)), ("d5", 2, page()), ("d5", 3, page(9)), ("d6", 1, f"<p>{markup.NOTHING[1]}</p>")]
    rows, issues = markup.listing(spark.createDataFrame(pages, "day string, page int, html string"), ["day"], classes, "title", full=2)
    got = rows.collect()
    assert sorted((r.day, r.page, r.row["code"]) for r in got) == [("d1", 1, "1"), ("d1", 1, "2"), ("d1", 2, "3"), ("d1", 2, "4"), ("d1", 3, "5"), ("d5", 1, "1"), ("d5", 1, "2")]
    assert got[0].row["company"] == "n & m" and {r.row["href"] for r in got} == {f"d{i}.pdf" for i in range(1, 6)}
    assert [(r.day, r.code) for r in issues.collect()] == [("d2", "EMPTY_FIRST_PAGE")]
