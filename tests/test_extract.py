import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pagemill.functions.html import PageReader, Spans, page_title, read_page
from pagemill.functions.page_rules import content_type, is_boilerplate
from pagemill.operators.enrich import as_documents, enrich
from pagemill.operators.extract import SLICE_BYTES, extract, page_slices, with_content
from pagemill.operators.links import extract_links
from pagemill.schema import DOCUMENT


@pytest.mark.parametrize("html, title", [
    ("<title>Harbour</title><h1>Other</h1>", "Harbour"),
    ("<title>\n  Two \n words </title>", "Two \n words"),
    ("<title>  </title><h1>Heading</h1>", ""),
    ("<title></title><h1> A <b>B</b> c</h1>", "ABc"),
    ("<body><h1></h1></body>", ""),
    ('<meta property="og:title" content=" Shared "><p>x</p>', "Shared"),
    ('<meta property="og:title" content=""><meta property="og:title" content="late">', "Untitled"),
    ("<p>nothing</p>", "Untitled"),
    ("<title>a &amp; b &eacute; &#8217; &nope;</title>", "a & b é ’ &nope"),
    ("<title>cut &am</title><h1>h</h1>", "cut &am"),
    ("", "Untitled"),
])
def test_title(html, title):
    assert read_page(html)["title"] == title


@pytest.mark.parametrize("html, body", [
    ("<body>x<main>in <b>the</b> main</main>y</body>", "in the main"),
    ('<body>x<div class="Main-Content wide">by class</div></body>', "by class"),
    ('<body>x<div class="page big content">joined</div></body>', "joined"),
    ('<body>x<div id="the-CONTENT">by id</div></body>', "by id"),
    ('<div class="plain">d</div><body>body</body>', "body"),
    ("<p>no body</p>tail", "no body tail"),
    ("<body><article>kept</article><nav>n</nav><div><footer>f</footer>deep<aside>a</aside></div></body>", "kept deep"),
    ("<body>a<script>var x='</p>';</script><style>p{}</style><!-- c -->b</body>", "a b"),
    ("<body>a<template>t</template><ruby>k<rt>r</rt></ruby></body>", "a k"),
    ("<body><p>one<p>two<b>three</body>", "one two three"),
    ("<body>text<footer>runs to the end<p>still footer", "text"),
    ("<body><nav>n<nav>m</nav>o</nav>p</body>", "p"),
    ("<nav><main>inside</main></nav>", "inside"),
    ("<body>&lt;tag&gt; &copy;&nbsp;x &#65;&#x42;</body>", "<tag> © x AB"),
    ("<body>a<br/>b<hr>c</br>d</body>", "a b c d"),
    ("<body><div/>x</body>", "x"),
    ("<body>x<![CDATA[y]]></body>", "x y"),
])
def test_body(html, body):
    assert read_page(html)["body_text"] == body


def test_code_and_links():
    page = read_page('<body><nav><a href="/n">nav</a></nav><a href="/x"> one </a><a>two<a href="">in</a></a>'
                     "<pre>c</pre></body>")
    assert page["has_code_tag"]
    assert page["hrefs"] == ["/n", "/x", ""]
    assert page["link_text_len"] == len(" ".join([" one ", "twoin", "in"]))
    assert not read_page("<body><nav><code>c</code></nav>x</body>")["has_code_tag"]
    assert read_page("<body><a> \n </a></body>")["link_text_len"] == 1


def test_boilerplate_elements(column):
    rows = [("nav", "", ""), ("div", "sidebar", ""), ("div", "", "footer-menu"), ("div", "SideBar x", None),
            ("div", "ad", ""), ("p", None, None), ("header", "", "")]
    got = column(rows, ["t", "c", "i"], is_boilerplate(F.col("t"), F.col("c"), F.col("i")))
    assert got == [True, True, True, True, False, False, False]


def test_content_type(column):
    long = "w" * 1501
    rows = [("https://e.com/docs/a", "t", "b", 0.9, "doc_page"), ("https://e.com/Documentation/a", "t", "b", 0.0, "doc_page"),
            ("https://e.com/blog/a", "t", "b", 0.9, "article"), ("https://e.com/post/a", "t", "b", 0.9, "article"),
            ("https://e.com/product/a", "t", "b", 0.9, "product_page"), ("https://e.com/catalogue_1", "t", "b", 0.9, "product_page"),
            ("https://e.com/x", "A Guide", long, 0.3001, "list_page"), ("https://e.com/x", "A Guide", long, 0.3, "tutorial"),
            ("https://e.com/x", "How To do", long, 0.0, "tutorial"), ("https://e.com/x", "guide", "w" * 1500, 0.0, "article"),
            ("https://e.com/x", "plain", long, 0.0, "article")]
    got = column(rows, ["u", "t", "b", "d", "e"], content_type(F.col("u"), F.col("t"), F.col("b"), F.col("d")))
    assert got == [row[-1] for row in rows]


def test_pages_to_documents(spark):
    words = "some words for a page with enough content to be kept in the collection " * 3
    pages = spark.createDataFrame([
        ("https://e.com/docs/1", f"<title>T</title><body><nav>skip</nav>{words}<a href='/a'>link</a> ```</body>", 200, 1),
        ("https://e.com/thin", "<body>thin</body>", 200, 2),
        ("https://e.com/none", None, 200, 2),
    ], "url string, html string, http_status int, crawl_depth int")
    rows = with_content(extract(pages)).withColumn("language", F.lit("en"))
    docs = as_documents(enrich(rows, fetched_at=F.timestamp_seconds(F.lit(0)))).collect()
    assert len(docs) == 1 and docs[0].asDict().keys() == set(DOCUMENT.fieldNames())
    doc = docs[0]
    body = words.strip() + " link ```"
    assert doc.body_text == body and doc.word_count == len(body.split()) and doc.char_count == len(body)
    assert doc.content_type == "doc_page" and doc.has_code_blocks and doc.paragraph_count == 1
    assert doc.link_density == round(4 / len(body), 3)
    assert doc.estimated_read_time_minutes == round(doc.word_count / 200, 2)
    assert (doc.http_status, doc.crawl_depth) == (200, 1)


def test_links(spark):
    page = ("<nav><a href='/one'>1</a></nav><a href='two#x'>2</a><a href='https://other.com/'>o</a>"
            "<a href='/one/'>again</a><a href='/login'>l</a><a name='no'>n</a>")
    frame = spark.createDataFrame([("https://e.com/base/", page)], ["url", "html"])
    got = [tuple(r) for r in extract_links(extract(frame)).orderBy("pos").collect()]
    assert got == [("https://e.com/base/", 0, "https://e.com/one"), ("https://e.com/base/", 1, "https://e.com/base/two"),
                   ("https://e.com/base/", 3, "https://e.com/one")]
    assert extract_links(extract(frame), "other.com").count() == 1


def test_unreadable_page_is_reported_not_raised(spark):
    frame = spark.createDataFrame([("u", "<body>ok</body>"), ("v", "<body><![weird[ x")], ["url", "html"])
    rows = {r.url: r for r in extract(frame).collect()}
    assert rows["u"].error is None and rows["u"].body_text == "ok"


def test_nested_anchors_stay_cheap():
    import time
    html = "<body>" + "<a href=x>word " * 70_000      # about 1 MB, never closed
    started = time.perf_counter()
    found = read_page(html, elements=False)
    assert time.perf_counter() - started < 5
    assert found["link_text_len"] == 5 * 70_000 * 70_001 // 2 + 69_999


def test_deep_nesting_takes_time_in_proportion():
    deep = 50_000
    started = time.perf_counter()
    assert read_page(f"<title>{'<b>' * 3}x</title><body>{'<i>' * deep}text{'</i>' * deep}</body>")["body_text"] == "text"
    spans_title = "<svg><title>" + "<i>" * deep + "only" + "</i>" * deep + "</title></svg>"
    read_page(spans_title)
    assert time.perf_counter() - started < 5


class _Titled(PageReader):
    """Reads a title's tags as elements, as older parsers do."""
    CDATA_CONTENT_ELEMENTS, RCDATA_CONTENT_ELEMENTS = (), ()


@pytest.mark.parametrize("html, title", [
    ("<title><b><i>only</i></b></title>", "only"), ("<title><b>one</b><i>two</i></title><h1>h</h1>", "h"),
    ("<title><b>one</b> tail</title><h1>h</h1>", "h"), ("<title><b></b></title><h1>h</h1>", "h"),
    ("<title><br></title><h1>h</h1>", "h"), ("<title>" + "<i>" * 3000 + "deep" + "</i>" * 3000 + "</title>", "deep")])
def test_title_of_nested_tags(html, title):
    reader = _Titled().read(html)
    assert page_title(reader, Spans(reader)) == title


def test_findings_of_a_batch_are_held_in_slices():
    """A full batch is read slice by slice, every page once and in order; a long page is a slice of its own."""
    sizes = [SLICE_BYTES // 3] * 10 + [0, None, SLICE_BYTES * 2, 5, SLICE_BYTES, 1]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(sizes))), "html": [n if n is None else "x" * n for n in sizes]},
                                       pa.schema([("id", pa.int64()), ("html", pa.string())]))
    parts = list(page_slices(batch, batch.column(1)))
    assert [i for part in parts for i in part.column(0).to_pylist()] == list(range(len(sizes)))
    assert len(parts) > 4
    for part in parts:
        assert part.num_rows == 1 or sum(len(h or "") for h in part.column(1).to_pylist()) <= SLICE_BYTES
