"""Rules about a page: its content type, and which elements are boilerplate."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Element names and class / id substrings that mark boilerplate.
BOILERPLATE_TAGS = ("nav", "footer", "aside", "script", "style")
BOILERPLATE_SUBSTRINGS = (
    "navbar", "navigation", "menu-", "sidebar", "side-bar", "footer", "site-footer",
    "page-footer", "header-nav", "site-header", "advertisement", "ad-", "cookie-", "popup",
    "modal", "banner-ad", "share-button", "social-share")

# Thresholds and markers of the content-type rules, first match wins.
_TYPE_BY_URL = (
    ("doc_page", ("/docs/", "/documentation/")),
    ("article", ("/blog/", "/article/", "/post/")),
    ("product_page", ("/product/", "catalogue")),
)
LIST_PAGE_DENSITY = 0.3
TUTORIAL_MIN_CHARS = 1500
TUTORIAL_TITLE_WORDS = ("tutorial", "guide", "how to")


def _has_any(text: Column, needles: tuple[str, ...]) -> Column:
    test = F.contains(text, F.lit(needles[0]))
    for needle in needles[1:]:
        test = test | F.contains(text, F.lit(needle))
    return test


def content_type(url: Column, title: Column, body: Column, link_density: Column) -> Column:
    """Page type from URL, title, length and the unrounded link density."""
    rules = None
    for label, needles in _TYPE_BY_URL:
        test = _has_any(F.lower(url), needles)
        rules = F.when(test, label) if rules is None else rules.when(test, label)
    tutorial = (F.length(body) > TUTORIAL_MIN_CHARS) & _has_any(F.lower(title), TUTORIAL_TITLE_WORDS)
    return (rules.when(link_density > LIST_PAGE_DENSITY, "list_page")
            .when(tutorial, "tutorial")
            .otherwise("article"))


def is_boilerplate(tag: Column, css_class: Column, element_id: Column) -> Column:
    """True for boilerplate tags, or when class or id holds a boilerplate substring."""
    pattern = "|".join(re.escape(s) for s in BOILERPLATE_SUBSTRINGS)
    return (tag.isin(*BOILERPLATE_TAGS)
            | F.coalesce(F.lower(css_class).rlike(pattern), F.lit(False))
            | F.coalesce(F.lower(element_id).rlike(pattern), F.lit(False)))
