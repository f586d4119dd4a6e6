from urllib.parse import urljoin, urlsplit

from pyspark.sql import functions as F

from pagemill.functions import urls

BASES = ["https://example.com", "https://example.com/", "https://example.com/a/b/c", "https://example.com/a/b/",
         "http://Ex.com:80/a;p=1?q=2#f", "HTTPS://x.org/d/e.html?z", "https://example.com/a//b/../c",
         "https://example.com?x=1"]
HREFS = ["", "#", "#top", "?q=1", "?", "/", "//other.com/x", "//other.com", "/a/b", "a", "./a", "../a", "../../a",
         "../../../a", "a/./b", "a/../b", "/a/../b", "/./", "..", ".", "a/..", "mailto:x@y.z", "javascript:void(0)",
         "http://example.com/z/", "https:rel", "https://example.com/p;q;r", "x;y", "a b", " /lead", "/tab\tin", "a//b",
         "/a//b/", "g;x=1/./y", "g?y/./x", "g#s/../x", "/p?q=/", "HTTPS://EXAMPLE.com/Up", "ftp://f/x", "tel:123",
         "/a;b/c;d?x#y", "//", "///x", "/..", "/../", "http:", "?#", "x?", "\nfoo"]


def test_normal_form(column):
    cases = {
        "https://example.com/page#section": "https://example.com/page",
        "https://example.com/page/": "https://example.com/page",
        "https://example.com/page//": "https://example.com/page/",
        "https://example.com/": "https://example.com/",
        "https://example.com": "https://example.com",
        "https://example.com/find?k=v": "https://example.com/find?k=v",
        "https://example.com/find?": "https://example.com/find",
        "https://example.com/p?q=/": "https://example.com/p?q=",
        "https://example.com/a;v=1/b;v=2": "https://example.com/a;v=1/b",
        "HTTP://Example.com/X": "http://Example.com/X",
        "https://a.example.com/en/25#top": "https://a.example.com/en/25",
    }
    assert column([(u,) for u in cases], ["u"], urls.normalize_url(F.col("u"))) == list(cases.values())


def test_same_page_same_form(column):
    forms = column([("https://e.com/p",), ("https://e.com/p#x",), ("https://e.com/p/",)], ["u"],
                   urls.normalize_url(F.col("u")))
    assert len(set(forms)) == 1


def test_normalising_twice_changes_nothing(column):
    rows = [(b,) for b in BASES if "#" not in b]
    assert (column(rows, ["u"], urls.normalize_url(urls.normalize_url(F.col("u"))))
            == column(rows, ["u"], urls.normalize_url(F.col("u"))))


def test_resolution_agrees_with_the_standard_library(column):
    pairs = [(b, h) for b in BASES for h in HREFS]
    got = column(pairs, ["b", "h"], urls.resolve_url(F.col("b"), F.col("h")))
    for (base, href), absolute in zip(pairs, got):
        expected, found = urlsplit(urljoin(base, href)), urlsplit(absolute)
        assert (expected.scheme, expected.netloc, expected.path, expected.query) == (
            found.scheme, found.netloc, found.path, found.query), (base, href, absolute)


def test_crawlable(column):
    cases = {
        "https://example.com/page": True, "https://other.com/page": False, "https://example.com:8080/page": False,
        "https://Example.com/page": False, "https://example.com/login": False, "https://example.com/LOGIN": False,
        "https://example.com/cart": False, "https://example.com/a.pdf": False, "https://example.com/x.png.html": False,
        "https://example.com/accounting": False, "https://example.com/p?q=1": False, "https://example.com/p?page=1": True,
        "https://example.com/p#x": False,
    }
    got = column([(u,) for u in cases], ["u"], urls.is_crawlable(F.col("u"), "example.com"))
    assert got == list(cases.values())
