"""URL columns: normal form, crawlable test, reference resolution.

Each rule is a pattern applied once to its input, so a URL costs a few compiled matches
and the expressions stay small when rules are applied one after the other.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions.binding import let

# RFC 3986, appendix B, in pieces.
_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*:"
_AUTHORITY = rf"\A(?:{_SCHEME})?+//([^/?#]*)"
_PATH = rf"\A(?:{_SCHEME})?+(?://[^/?#]*)?+([^?#]*)"
# Of a reference without scheme, authority and fragment: its path, then ;params and query.
_PATH_THEN_REST = r"(?s)\A((?:[^/?]*/)*+[^/?;]*)(.*)\z"
_DOT_SEGMENT = r"(?:\A|/)\.\.?(?:/|\z)"

# Schemes whose last path segment may end in ;params.
_PARAM_SCHEMES = ("", "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtspu",
                  "sip", "sips", "mms", "sftp", "tel")

# Substrings of a lower-cased URL that make it not worth crawling.
SKIP_SUBSTRINGS = ("/login", "/logout", "/signin", "/signup", "/register", "/cart", "/checkout",
                   "/account", "/search", "?search=", "?q=", ".pdf", ".jpg", ".png", ".gif",
                   ".zip", ".exe", "#")


def tidy_url(url: Column) -> Column:
    """Leading control characters and spaces, and any tab or newline, are not part of a URL."""
    return F.regexp_replace(url, r"\A[\x00-\x20]+|[\t\r\n]", "")


def _lower_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, rf"\A({_SCHEME})", 1))


def url_host(url: Column) -> Column:
    """The authority exactly as written: case and port are kept."""
    return F.regexp_extract(tidy_url(url), _AUTHORITY, 1)


# ;params end the last path segment: a segment up to its first semicolon, then what follows
# until the query, for a URL with one of the schemes above or without a scheme.
_PARAMS = (rf"(?s)\A(?=(?i:{'|'.join(re.escape(s) for s in _PARAM_SCHEMES if s)}):|(?!{_SCHEME}))"
           rf"((?:{_SCHEME})?+(?://[^/?]*+)?+(?:[^/?]*/)*+[^/?;]*);[^?]*")
_FRAGMENT_OR_EMPTY_QUERY = r"(?s)\??#.*\z|\?\z"
_FINAL_SLASH = r"(?s)\A((?:[^/]*/){3}.*)/\z"


def normalize_url(url: Column) -> Column:
    """Dedup form: no fragment, no ;params, no empty query, at most one final slash removed."""
    kept = F.regexp_replace(F.regexp_replace(tidy_url(url), _FRAGMENT_OR_EMPTY_QUERY, ""), _PARAMS, "$1")
    after_scheme = F.regexp_replace(kept, rf"\A(?:{_SCHEME})?+(?://)?", "")
    scheme = F.regexp_replace(_lower_scheme(kept), ":", "")
    return F.regexp_replace(F.concat(scheme, F.lit("://"), after_scheme), _FINAL_SLASH, "$1")


def has_skip_substring(url: Column) -> Column:
    lowered = F.lower(url)
    return reduce(or_, [F.contains(lowered, F.lit(s)) for s in SKIP_SUBSTRINGS])


def is_crawlable(url: Column, allowed_host: Column | str) -> Column:
    """Same authority as the start URL and none of the skip substrings."""
    host = F.lit(allowed_host) if isinstance(allowed_host, str) else allowed_host
    return (url_host(url) == host) & ~has_skip_substring(url)


def _fold_dots(path: Column) -> Column:
    """RFC 3986 section 5.2.4: drop dot segments, let double dots remove what is before them."""
    def step(done: Column, segment: Column) -> Column:
        return (F.when(segment == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
                .when(segment == ".", done)
                .otherwise(F.concat(done, F.array(segment))))

    folded = F.aggregate(F.split(path, "/", -1), F.array().cast("array<string>"), step)
    ends_in_folder = path.rlike(r"(?:\A|/)\.\.?\z")
    closed = let(folded, lambda kept: F.concat(
        F.array_join(kept, "/"), F.when(ends_in_folder & (F.size(kept) > 0), F.lit("/")).otherwise("")))
    return F.when(path.rlike(_DOT_SEGMENT), F.regexp_replace(closed, r"\A(?!/)", "/")).otherwise(path)


def base_parts(tidy: Column) -> Column:
    """What links of a page resolve against: scheme, root, path, folder and query of its URL."""
    scheme, path = _lower_scheme(tidy), F.regexp_extract(tidy, _PATH, 1)
    return F.struct(
        scheme.alias("scheme"),
        F.concat(scheme, F.lit("//"), F.regexp_extract(tidy, _AUTHORITY, 1)).alias("root"),
        path.alias("path"),
        F.when(path == "", F.lit("/")).otherwise(F.regexp_replace(path, r"[^/]*\z", "")).alias("folder"),
        F.regexp_replace(tidy, r"(?s)\A[^?#]*|\?(?=#|\z)|#.*\z", "").alias("query"))


def reference(tidy: Column) -> Column:
    """A link without its fragment, and what is left of it when the scheme is the page's own."""
    # A link's own scheme, its fragment and an empty authority add nothing to the page's.
    short = F.regexp_replace(F.regexp_replace(tidy, rf"(?s)\A{_SCHEME}|#.*\z", ""), r"\A//(?=[/?]|\z)", "")
    return F.struct(_lower_scheme(tidy).alias("scheme"), short.alias("ref"),
                    F.regexp_replace(tidy, r"(?s)#.*\z", "").alias("all"))


def join_reference(parts: Column, link: Column) -> Column:
    """A link as (before, path, after); what is still to do is to fold the dots of ``path``.

    ``parts`` are the :func:`base_parts` of its page, ``link`` is its :func:`reference`.
    """
    ref = link["ref"]
    foreign = (link["scheme"] != "") & (link["scheme"] != parts["scheme"])
    page = F.concat(parts["root"], parts["path"])
    path, rest = F.regexp_extract(ref, _PATH_THEN_REST, 1), F.regexp_extract(ref, _PATH_THEN_REST, 2)
    rooted = F.startswith(ref, F.lit("/"))
    folder_path = F.regexp_replace(F.concat(parts["folder"], path), r"/{2,}", "/")
    whole = (F.when(foreign, link["all"])
             .when((ref == "") | (ref == "?"), F.concat(page, parts["query"]))
             .when(F.startswith(ref, F.lit("//")), F.concat(parts["scheme"], ref))
             .when(F.startswith(ref, F.lit("?")), F.concat(page, ref))
             .when(rooted & ~F.contains(ref, F.lit("/.")), F.concat(parts["root"], ref)))
    return F.struct(
        whole.alias("whole"), parts["root"].alias("before"),
        F.when(whole.isNull(), F.when(rooted, path).otherwise(folder_path)).alias("path"),
        F.when(whole.isNull(), rest).alias("after"))


def join_pieces(pieces: Column) -> Column:
    """The absolute URL of a :func:`join_reference`."""
    return F.coalesce(pieces["whole"], F.concat(pieces["before"], _fold_dots(pieces["path"]), pieces["after"]))


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute form, without fragment, of a link found on page ``base``."""
    return let(tidy_url(base), lambda page: let(base_parts(page), lambda parts: let(
        tidy_url(href), lambda tidy: let(reference(tidy), lambda link: let(
            join_reference(parts, link), join_pieces)))))
