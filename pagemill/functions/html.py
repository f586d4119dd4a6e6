"""Reading one HTML page: a flat list of elements and texts, and what is taken from it.

The page is kept flat: every element covers a span of text positions, so "text of
the region without its boilerplate" is a walk over spans rather than over a tree.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from html import unescape
from html.entities import html5
from html.parser import HTMLParser
from itertools import accumulate

from pagemill.functions.page_rules import BOILERPLATE_TAGS

# Elements without an end tag.
VOID_TAGS = frozenset(
    "area base br col embed hr img input keygen link menuitem meta param source track wbr "
    "basefont bgsound command frame image isindex nextid spacer".split())
# Elements whose strings are not page text, and those that keep blanks as written.
SILENT_TAGS = frozenset(("script", "style", "template", "rt", "rp"))
VERBATIM_TAGS = frozenset(("pre", "textarea"))

# What marks a main region by class or id.
_MAIN_CLASS = re.compile(r"page.*content|main.*content|site.*content|container.*page", re.I)
_MAIN_ID = re.compile(r"content|main", re.I)
_ENTITIES = {name.rstrip(";"): text for name, text in html5.items()}
_BLANKS = " \n\t\f\r"


class Element:
    """A start tag with its attributes and the span [start, end) of events it covers."""

    __slots__ = ("tag", "attrs", "start", "end")

    def __init__(self, tag, attrs, start):
        self.tag, self.attrs, self.start, self.end = tag, attrs, start, None

    def classes(self):
        return self.attrs.get("class", "").split()


class PageReader(HTMLParser):
    """Collects elements in document order and (position, text, is_page_text, is_markup) strings."""

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.elements, self.strings = [], []
        self.at = 0
        self._open, self._open_count, self._pending = [], {}, []

    def read(self, html):
        self.feed(html)
        self.close()
        self._flush()
        self.at += 1
        for element in self._open:
            element.end = self.at
        return self

    def _flush(self, markup=False):
        if not self._pending:
            return
        text = "".join(self._pending)
        self._pending = []
        verbatim = any(self._open_count.get(t) for t in VERBATIM_TAGS)
        if not verbatim and not text.strip(_BLANKS):
            text = "\n" if "\n" in text else " "
        silent = markup or any(self._open_count.get(t) for t in SILENT_TAGS)
        self.at += 1
        self.strings.append((self.at, text, not silent))

    def handle_starttag(self, tag, attrs):
        self._start(tag, attrs, closed=tag in VOID_TAGS)

    def handle_startendtag(self, tag, attrs):
        self._start(tag, attrs, closed=True)

    def _start(self, tag, attrs, closed):
        self._flush()
        self.at += 1
        element = Element(tag, {k: "" if v is None else v for k, v in attrs}, self.at)
        self.elements.append(element)
        if closed:
            element.end = self.at + 1
            return
        self._open.append(element)
        self._open_count[tag] = self._open_count.get(tag, 0) + 1

    def handle_endtag(self, tag):
        self._flush()
        if not self._open_count.get(tag):
            return
        self.at += 1
        while True:
            element = self._open.pop()
            element.end = self.at
            self._open_count[element.tag] -= 1
            if element.tag == tag:
                return

    def handle_data(self, data):
        self._pending.append(data)

    def handle_charref(self, name):
        self._pending.append(unescape(f"&#{name};"))

    def handle_entityref(self, name):
        self._pending.append(_ENTITIES.get(name, "&" + name))

    def _markup(self, data):
        self._flush()
        self._pending.append(data)
        self._flush(markup=True)

    handle_comment = handle_decl = handle_pi = _markup

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self._flush()
            self._pending.append(data[len("CDATA["):])
            self._flush()
        else:
            self._markup(data)


class Spans:
    """Where elements and strings of a page begin, for questions about what lies inside an element.

    Both are in document order, so the elements of a span are a run of the list, and so are its strings.
    """

    def __init__(self, reader):
        self.reader = reader
        self.starts = [e.start for e in reader.elements]
        self.places = [at for at, _, _ in reader.strings]

    def elements_in(self, element):
        """(first, end) of the elements that begin inside the element, without itself."""
        return bisect_right(self.starts, element.start), bisect_left(self.starts, element.end)

    def strings_in(self, element):
        return bisect_left(self.places, element.start), bisect_left(self.places, element.end)

    def text_of(self, element):
        """Strings that count as page text within an element."""
        first, end = self.strings_in(element)
        return [text for _, text, is_text in self.reader.strings[first:end] if is_text]

    def single_string(self, element):
        """The element's only string, looking through only-child elements; None otherwise.

        A level costs a few searches, so deep nesting costs no more than wide.
        """
        strings = self.strings_in(element)
        while True:
            first, end = self.elements_in(element)
            if first == end:
                return self.reader.strings[strings[0]][1] if strings[1] - strings[0] == 1 else None
            child = self.reader.elements[first]
            # Nothing may begin behind the first child, and no string may stand outside it.
            if bisect_left(self.starts, child.end) < end or self.strings_in(child) != strings:
                return None
            element = child


def page_title(reader, spans):
    first = {}
    for element in reader.elements:
        first.setdefault(element.tag, element)
    if "title" in first:
        text = spans.single_string(first["title"])
        if text:
            return text.strip()
    if "h1" in first:
        return "".join(t.strip() for t in spans.text_of(first["h1"]))
    for element in reader.elements:
        if element.tag == "meta" and element.attrs.get("property") == "og:title":
            if element.attrs.get("content"):
                return element.attrs["content"].strip()
            break
    return "Untitled"


def _class_match(element):
    names = element.classes()
    return any(_MAIN_CLASS.search(n) for n in names) or bool(_MAIN_CLASS.search(" ".join(names)))


def main_region(reader):
    """First main, else first div by class, else first div by id, else body, else everything."""
    tests = (lambda e: e.tag == "main",
             lambda e: e.tag == "div" and "class" in e.attrs and _class_match(e),
             lambda e: e.tag == "div" and "id" in e.attrs and bool(_MAIN_ID.search(e.attrs["id"])),
             lambda e: e.tag == "body")
    for test in tests:
        for element in reader.elements:
            if test(element):
                return element
    whole = Element("", {}, 0)
    whole.end = reader.at + 1
    return whole


def read_page(html, elements=True):
    """Title, region text, code flag, anchor text length, links and, if asked for, elements of one page."""
    reader = PageReader().read(html or "")
    region = main_region(reader)
    kept, cut_until = [], -1
    cuts = []
    for element in reader.elements:
        if not (region.start < element.start < region.end) or element.start < cut_until:
            continue
        if element.tag in BOILERPLATE_TAGS:
            cut_until = element.end
            cuts.append((element.start, element.end))
        else:
            kept.append(element)
    texts, cut = [], iter(cuts + [(float("inf"), float("inf"))])
    low, high = next(cut)
    for at, text, is_text in reader.strings:
        if not is_text or not region.start <= at < region.end:
            continue
        while at >= high:
            low, high = next(cut)
        if at < low:
            texts.append((at, text))
    places = [at for at, _ in texts]
    # Anchors may nest, so their text is measured, not built: lengths up to each string, two searches an anchor.
    upto = [0, *accumulate(len(t) for _, t in texts)]
    anchors = [upto[bisect_left(places, a.end)] - upto[bisect_left(places, a.start)] for a in kept if a.tag == "a"]
    return {
        "title": page_title(reader, Spans(reader)),
        "body_text": " ".join(" ".join(t for _, t in texts).split()),
        "has_code_tag": any(e.tag in ("code", "pre") for e in kept),
        "link_text_len": sum(anchors) + max(0, len(anchors) - 1),
        "hrefs": [e.attrs["href"] for e in reader.elements if e.tag == "a" and "href" in e.attrs],
        "elements": [{"tag": e.tag, "css_class": " ".join(e.classes()), "element_id": e.attrs.get("id", "")}
                     for e in reader.elements] if elements else [],
    }
