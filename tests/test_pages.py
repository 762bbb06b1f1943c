import time

import pytest

from plumbline.functions.html_page import read_page
from plumbline.operators import pages
from plumbline.plans.reports import build_dataset
from plumbline.sources.files import read_jsonl

PAGE = """<!DOCTYPE html><html><head><meta charset="utf-8"><title> A &amp; B
</title><meta name="description" content="about &lt;us&gt;"><meta name="description" content="second">
<style>p > a {margin: 0}</style><script>var t = "</p><img src='/no.png'>";</script>
<script type="application/ld+json">{"name": "Ünit", "n": 1}</script>
<script type="application/ld+json">[{"a": 1}, 2]</script>
<script type="application/ld+json">{broken</script>
<script type="application/ld+json">"text"</script></head>
<body><h1>Big <b>head</b></h1><!-- hidden --><noscript><img src="/no.png"><h1>off</h1></noscript>
<p>one
two   three<p>four &nbsp; five</p>
<img src="http://x/y.png" alt=" y "><img src="/rooted.png"><img src="rel/a.png"><img src="data:image/png;base64,AA">
<img src="" alt="none"><img alt="nothing"><IMG SRC='//host/z.png'>
<h1>Second</h1></body></html>"""
TABLES = """<table><tr><th>K</th><th>V</th></tr><tr><td>a</td><td>1</td></tr><tr><td>short</td></tr>
<tr><td> b <i>c</i></td><td>2</td></tr></table>
<table><tr><td>H</td></tr><tr><td>x</td></tr></table>
<table><tr><th>only header</th></tr></table><table></table>
<table><tr><th>same</th><th>same</th></tr><tr><td>1</td><td>2</td></tr></table>"""


def test_text():
    assert read_page(PAGE)["text"] == "Big head one\ntwo three four five Second"
    assert read_page(PAGE, with_head=True)["text"].startswith("A & B Big head one\ntwo")


def test_metadata():
    got = read_page(PAGE)
    assert got["title"] == "A & B"
    assert got["description"] == "about <us>"
    assert got["h1s"] == ["Bighead", "Second"]
    assert got["word_count"] == 8


def test_json_ld():
    assert read_page(PAGE)["json_ld"] == ['{"name": "Ünit", "n": 1}', '{"a": 1}', "2"]


def test_tables():
    assert read_page(TABLES)["tables"] == [
        [{"K": "a", "V": "1"}, {"K": "bc", "V": "2"}],
        [{"H": "x"}],
        [{"same": "2"}],
    ]


def test_nested_table_belongs_to_both():
    html = "<table><tr><th>A</th></tr><tr><td>x<table><tr><td>B</td></tr><tr><td>y</td></tr></table></td></tr></table>"
    # The outer table sees every row inside it; the row around the inner table has three cells.
    assert read_page(html)["tables"] == [[{"A": "B"}, {"A": "y"}], [{"B": "y"}]]


def test_table_tags_left_open():
    html = "<table><tr><th>A<th>B<tr><td>1<td>2<tr><td>3<td>4</table><p>after"
    assert read_page(html)["tables"] == [[{"A": "1", "B": "2"}, {"A": "3", "B": "4"}]]


@pytest.mark.parametrize(
    ("html", "link"),
    [
        ('<ul><li class="prev"><a href="/1">p</a></li><li class="pager next"><a href="page-2.html">n</a></li></ul>', "page-2.html"),
        ('<li class="next"><span><a href="/x">n</a></span></li>', None),
        ('<li class="nextpage"><a href="/x">n</a></li>', None),
        ('<li class="next"><a>n</a></li><li class="next"><a href="/later">n</a></li>', None),
        ('<ul><li>a<li class=next><a href=/y?a=1&amp;b=2>n</a></ul>', "/y?a=1&b=2"),
        ("", None),
    ],
)
def test_next_link(html, link):
    assert read_page(html)["next_link"] == link


@pytest.mark.parametrize("html", ["<![foo[ x ]]>text", "a < b", "<p", "<<<>>>", "<!", "</", "&#x110000; &bogus;", "<title>", "<table><td>"])
def test_broken_pages_do_not_fail(html):
    read_page(html)


def test_many_tags_left_open_take_linear_time():
    words = [f"w{i}" for i in range(40000)]
    page = read_page("".join(f"<p><b>{w}</b>" for w in words))
    assert page["text"].split() == words


def test_nested_tables_take_linear_time():
    began = time.perf_counter()
    page = read_page("<table><tr><td>x" * 20_000)
    assert page["tables"] == [] and page["word_count"] == 20_000
    assert time.perf_counter() - began < 2


def test_templates_and_ruby_notes_are_no_text():
    html = "<p>a<template>hid<b>den</b></template>b<ruby>k<rp>(</rp><rt>note</rt><rp>)</rp></ruby></p>"
    assert read_page(html)["text"] == "a b k"


def test_blocks_too_deep_or_long_are_kept_as_written():
    deep, long = "[" * 200_000 + "]" * 200_000, '{"n": ' + "9" * 5000 + "}"
    html = "".join(f'<script type="application/ld+json">{x}</script>' for x in (deep, long, "{bad", '{"a": 1}'))
    assert read_page(html)["json_ld"] == [deep, long, '{"a": 1}']


def test_only_named_fields_are_made():
    assert set(read_page(PAGE, fields=["title", "h1s"])) == {"title", "h1s"}


def test_text_after_odd_markup():
    assert read_page("<![if x]>a < b<![endif]> c")["text"] == "a < b c"


@pytest.fixture(scope="module")
def crawl(spark):
    rows = [("u1", PAGE, None), ("u2", TABLES, ""), ("u3", "", None), ("u4", None, None), ("u5", "<p>x</p>", "HTTP 500")]
    return spark.createDataFrame(rows, "url string, html string, error string").cache()


def by_url(df, name):
    return {r.url: r[name] for r in df.collect()}


def test_extract_text(crawl):
    got = by_url(pages.extract_text(crawl), "text")
    assert got["u1"] == "Big head one\ntwo three four five Second" and got["u3"] == got["u4"] == "" and got["u5"] == "x"
    assert by_url(pages.extract_text(crawl, strip_head=False), "text")["u1"].startswith("A & B")


def test_images(crawl):
    got = by_url(pages.extract_images(crawl, "http://base/"), "images")
    assert [tuple(i) for i in got["u1"]] == [
        ("http://x/y.png", "y"),
        ("http://base/rooted.png", ""),
        ("http://base/rel/a.png", ""),
        ("http://base//host/z.png", ""),
    ]
    assert got["u2"] == got["u4"] == []
    relative = by_url(pages.extract_images(crawl, "http://base", resolve_relative=False), "images")
    assert relative["u1"][2].src == "rel/a.png"
    assert [r.src for r in pages.image_table(crawl, "http://base").orderBy("position").collect()] == [i.src for i in got["u1"]]


def test_extract_tables(crawl):
    got = by_url(pages.extract_tables(crawl), "tables")
    assert got["u2"][0] == [{"K": "a", "V": "1"}, {"K": "bc", "V": "2"}] and got["u1"] == []
    cells = {(r.table_no, r.row_no, r.header, r.value) for r in pages.table_cells(crawl).collect()}
    assert cells == {(0, 0, "K", "a"), (0, 0, "V", "1"), (0, 1, "K", "bc"), (0, 1, "V", "2"), (1, 0, "H", "x"), (2, 0, "same", "2")}


def test_extract_json_ld_and_next_link(crawl):
    assert by_url(pages.extract_json_ld(crawl), "json_ld")["u1"][1:] == ['{"a": 1}', "2"]
    assert set(by_url(pages.extract_next_link(crawl), "next_link").values()) == {None}


def test_records_agree_with_the_single_operators(crawl):
    records = pages.parse_pages(crawl, "http://base")
    got = {r.url: r for r in records.collect()}
    assert by_url(pages.extract_text(crawl), "text") == {u: r.text for u, r in got.items()}
    assert by_url(pages.extract_images(crawl, "http://base"), "images") == {u: r.images for u, r in got.items()}
    assert by_url(pages.extract_tables(crawl), "tables") == {u: r.tables for u, r in got.items()}
    assert by_url(pages.extract_json_ld(crawl), "json_ld") == {u: r.json_ld for u, r in got.items()}
    assert by_url(pages.extract_metadata(crawl), "metadata") == {u: r.metadata for u, r in got.items()}
    assert got["u4"].metadata.asDict() == {"title": None, "description": None, "h1s": None, "word_count": None}
    stats = {r.url: (r.word_count, r.image_count) for r in pages.page_stats(records).collect()}
    assert stats["u1"] == (8, 4) and stats["u3"] == (0, 0)


def test_build_dataset(spark, crawl, folder):
    path = f"{folder}/records"
    build_dataset(crawl, path, "http://base")
    build_dataset(crawl, path, "http://base")  # overwrites
    schema = pages.parse_pages(crawl).schema
    back = {r.url: r for r in read_jsonl(spark, path, schema).collect()}
    assert set(back) == {"u1", "u2", "u3", "u4"}
    want = {r.url: r for r in pages.parse_pages(crawl, "http://base").collect()}
    for url in ("u1", "u2"):
        assert back[url] == want[url]
