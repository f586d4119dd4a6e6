"""The same results in plain SQL over the same tables, for DuckDB."""

from __future__ import annotations

from pagemill.operators.language import BUCKETS, STEPS

_SPACE = (r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
          r"\x{202f}\x{205f}\x{3000}]+")
_FIRST_FETCH = 1735689600


def _clean(text: str) -> str:
    return f"trim(regexp_replace({text}, '{_SPACE}', ' ', 'g'))"


def _words(body: str) -> str:
    return f"CASE WHEN {body} = '' THEN 0 ELSE len(string_split({body}, ' ')) END"


def _py_round(a: str, b: str, digits: int) -> str:
    s = 10 ** digits
    t, h = f"({2 * s} * ({a})::BIGINT)", f"(({2 * s} * ({a})::BIGINT) // ({b}))"
    x = f"(({a})::DOUBLE / ({b})::DOUBLE)"
    hi = f"({x}::FLOAT::DOUBLE)"
    err = f"((({a})::DOUBLE - ({b})::DOUBLE * {hi}) - ({b})::DOUBLE * ({x} - {hi}))"
    return (f"(CASE WHEN {t} % ({b}) = 0 AND {h} % 2 = 1 THEN"
            f" CASE WHEN {err} < 0 THEN {h} // 2 + 1 WHEN {err} > 0 THEN {h} // 2"
            f" ELSE {h} // 2 + ({h} // 2) % 2 END"
            f" ELSE ({t} + ({b})) // (2 * ({b})) END)::DOUBLE / {s}.0::DOUBLE")


def _pct(part: str, total: str) -> str:
    return f"round_even(({part})::DOUBLE / ({total})::DOUBLE * 100.0::DOUBLE, 0)"


def _content_type(density: str) -> str:
    u, t = "lower(url)", "lower(title)"
    return f"""CASE
      WHEN contains({u}, '/docs/') OR contains({u}, '/documentation/') THEN 'doc_page'
      WHEN contains({u}, '/blog/') OR contains({u}, '/article/') OR contains({u}, '/post/') THEN 'article'
      WHEN contains({u}, '/product/') OR contains({u}, 'catalogue') THEN 'product_page'
      WHEN {density} > 0.3 THEN 'list_page'
      WHEN length(body_text) > 1500 AND (contains({t}, 'tutorial') OR contains({t}, 'guide')
           OR contains({t}, 'how to')) THEN 'tutorial'
      ELSE 'article' END"""


# The derived collection.

_COLLECTION = f"""base AS (
  SELECT doc_id AS doc_ord,
    'https://' || source || '.example.org/'
      || ['docs','blog','product','wiki','catalogue'][(doc_id % 5 + 1)::INT] || '/' || doc_id AS url,
    (CASE WHEN doc_id % 3 = 0 THEN 'Guide ' ELSE 'Page ' END) || doc_id AS title,
    {_clean('text')} AS body_text, {_FIRST_FETCH} + doc_id AS fetched_at, lang, source,
    doc_id % 4 = 0 AS has_code_blocks, (doc_id % 61)::DOUBLE / 100.0::DOUBLE AS link_density,
    CASE WHEN doc_id % 17 = 0 THEN 404 ELSE 200 END AS http_status, 0 AS crawl_depth
  FROM documents),
counted AS (
  SELECT *, ({_words('body_text')})::BIGINT AS word_count, length(body_text) AS char_count,
    (CASE WHEN body_text = '' THEN 0 ELSE 1 END)::BIGINT AS paragraph_count,
    CASE WHEN length(body_text) < 50 THEN 'unknown' ELSE lang END AS language,
    {_content_type('link_density')} AS content_type
  FROM base),
collection AS (
  SELECT *, {_py_round('word_count', '200', 2)} AS estimated_read_time_minutes FROM counted)"""

_GAPS = _COLLECTION + """,
gaps AS (
  SELECT * REPLACE (
    CASE WHEN doc_ord % 7 <> 0 THEN word_count END AS word_count,
    CASE WHEN doc_ord % 11 <> 0 THEN link_density END AS link_density,
    CASE WHEN doc_ord % 13 <> 0 THEN language END AS language)
  FROM collection)"""

_FIELDS = ("url, title, body_text, fetched_at, content_type, word_count, char_count, language, "
           "estimated_read_time_minutes, has_code_blocks, link_density, paragraph_count, "
           "http_status, crawl_depth")


def _from(ctes: str, select: str) -> str:
    return f"WITH {ctes}\n{select}"


# Pages: the same regions cut out with patterns, which these tag-regular pages allow.

def _decoded(text: str) -> str:
    for entity, char in (("&quot;?", '"'), ("&lt;?", "<"), ("&gt;?", ">"), ("&copy;?", "©"),
                         ("&middot;?", "·"), ("&nbsp;?", " "), ("&amp;?", "&")):
        text = f"regexp_replace({text}, '{entity}', '{char}', 'g')"
    return text


def _body() -> str:
    text = r"regexp_extract(html, '(?s)<body[^>]*>(.*?)(?:</body>|\z)', 1)"
    for pattern in (r"(?s)<!--.*?-->", r"(?s)<(?:script|style)[^>]*>.*?</(?:script|style)>",
                    r"(?s)<(?:nav|aside)[^>]*>.*?</(?:nav|aside)>", r"(?s)<footer[^>]*>.*?(?:</footer>|\z)",
                    r"(?s)<[^>]*>"):
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    return _clean(_decoded(text))


_PAGES = f"""extracted AS (
  SELECT page_id, url, html,
    {_clean("''")} AS nothing,
    regexp_replace({_decoded("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")},
                   '^{_SPACE}|{_SPACE}$', '', 'g') AS title,
    {_body()} AS body_text,
    regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs
  FROM pages)"""

_URL = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$"


def _url_part(url: str, group: int) -> str:
    return f"regexp_extract({url}, '{_URL}', {group})"


def _normalized(url: str) -> str:
    query = _url_part(url, 4)
    full = (f"(lower({_url_part(url, 1)}) || '://' || {_url_part(url, 2)}"
            f" || regexp_replace({_url_part(url, 3)}, ';[^/]*$', '')"
            f" || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END)")
    return (f"CASE WHEN ends_with({full}, '/') AND length({full}) - length(replace({full}, '/', '')) > 3"
            f" THEN left({full}, length({full}) - 1) ELSE {full} END")


def _crawlable(url: str, host: str) -> str:
    needles = ("/login", "/logout", "/signin", "/signup", "/register", "/cart", "/checkout",
               "/account", "/search", "?search=", "?q=", ".pdf", ".jpg", ".png", ".gif",
               ".zip", ".exe", "#")
    tests = " OR ".join(f"contains(lower({url}), '{n}')" for n in needles)
    return f"({_url_part(url, 2)} = {host} AND NOT ({tests}))"


# Every link of the pages is root-relative, so it resolves to scheme, host and itself.
_LINKS = _PAGES + f""",
raw_links AS (
  SELECT page_id, url AS src_url, unnest(hrefs) AS href, unnest(range(len(hrefs))) AS pos,
    {_url_part('url', 1)} || '://' || {_url_part('url', 2)} AS root, {_url_part('url', 2)} AS host
  FROM extracted),
targets AS (
  SELECT page_id, src_url, pos, host, {_normalized('(root || href)')} AS dst_url FROM raw_links),
links AS (SELECT page_id, src_url, pos, dst_url FROM targets WHERE {_crawlable('dst_url', 'host')})"""


# Language: profile learned from every document, scores over every trigram.

def _letters(text: str) -> str:
    return (f"' ' || trim(regexp_replace(lower({text}),"
            r" '(?:[\x{10000}-\x{10FFFF}]|[^\p{L}\p{M}])+', ' ', 'g')) || ' '")


def _grams(source: str, key: str, text: str) -> str:
    a, b, c = STEPS
    return (f"SELECT {key}, unnest(list_transform(range(1, greatest(len(c) - 1, 1)),"
            f" lambda i: ({a} * unicode(c[i]) + {b} * unicode(c[i + 1]) + {c} * unicode(c[i + 2])) % {BUCKETS}))::INTEGER AS bucket"
            f" FROM (SELECT {key}, string_split({_letters(text)}, '') AS c FROM {source}) WHERE len(c) >= 3")


_PROFILE = f"""training AS ({_grams('(SELECT * FROM documents WHERE lang IS NOT NULL)', 'lang', 'text')}),
counts AS (SELECT lang AS language, bucket, count(*) AS n FROM training GROUP BY ALL),
totals AS (SELECT language, sum(n) AS total FROM counts GROUP BY 1),
profile AS (
  SELECT language, bucket,
    round(ln(1.0::DOUBLE + (n::DOUBLE / total::DOUBLE) / 5e-5::DOUBLE) * 1000000.0::DOUBLE)::BIGINT AS weight
  FROM counts JOIN totals USING (language))"""


def _trigrams(source: str, key: str, text: str) -> str:
    return (f"SELECT {key}, unnest(list_transform(range(1, greatest(len(c) - 1, 1)),"
            f" lambda i: c[i] || c[i + 1] || c[i + 2])) AS trigram"
            f" FROM (SELECT {key}, string_split({_letters(text)}, '') AS c FROM {source}) WHERE len(c) >= 3")


_LANGUAGE_SCORES = f"""WITH cleaned AS (SELECT doc_id, {_clean('text')} AS body_text FROM documents),
training AS ({_trigrams('(SELECT * FROM documents WHERE lang IS NOT NULL)', 'lang', 'text')}),
counts AS (SELECT lang AS language, trigram, count(*) AS n FROM training GROUP BY ALL),
totals AS (SELECT language, sum(n) AS total FROM counts GROUP BY 1),
profile AS (
  SELECT language, trigram,
    round(ln(1.0::DOUBLE + (n::DOUBLE / total::DOUBLE) / 5e-5::DOUBLE) * 1000000.0::DOUBLE)::BIGINT AS weight
  FROM counts JOIN totals USING (language)),
grams AS ({_trigrams('cleaned', 'doc_id', 'body_text')})
SELECT doc_id, language, sum(weight)::BIGINT AS score FROM grams JOIN profile USING (trigram) GROUP BY ALL"""


def _detected(source: str, key: str) -> str:
    return f"""texts AS ({_grams(f'(SELECT * FROM {source} WHERE length(body_text) >= 50)', key, 'body_text')}),
scores AS (
  SELECT {key}, language, sum(weight)::BIGINT AS score FROM texts JOIN profile USING (bucket) GROUP BY ALL),
best AS (
  SELECT {key}, language FROM
    (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, language) AS rn FROM scores)
  WHERE rn = 1),
detected AS (
  SELECT s.{key}, coalesce(b.language, 'unknown') AS language FROM {source} s LEFT JOIN best b USING ({key}))"""


_CLEANED = f"cleaned AS (SELECT doc_id, {_clean('text')} AS body_text FROM documents), " + _PROFILE + ", "

_PAGE_DOCUMENTS = _PAGES + ", " + _PROFILE + ", " + _detected("extracted", "page_id") + f"""
SELECT url, title, body_text, {_FIRST_FETCH} + page_id AS fetched_at,
  {_content_type('0.0')} AS content_type, ({_words('body_text')})::BIGINT AS word_count,
  length(body_text) AS char_count, language,
  {_py_round(f"({_words('body_text')})", '200', 2)} AS estimated_read_time_minutes,
  contains(body_text, '```') AS has_code_blocks, 0.0::DOUBLE AS link_density,
  (CASE WHEN body_text = '' THEN 0 ELSE 1 END)::BIGINT AS paragraph_count, 200 AS http_status, 0 AS crawl_depth
FROM extracted JOIN detected USING (page_id) WHERE length(body_text) >= 100"""


def _chunks(size: int, overlap: int) -> str:
    step = size - overlap
    return _from(_COLLECTION + f""",
tokens AS (SELECT url, body_text, CASE WHEN body_text = '' THEN [] ELSE string_split(body_text, ' ') END AS w
           FROM collection),
starts AS (SELECT *, CASE WHEN len(w) <= {size} THEN [0] ELSE range(0, len(w), {step}) END AS first_word FROM tokens),
placed AS (SELECT *, unnest(range(len(first_word))) AS chunk_id, len(first_word) AS total_chunks FROM starts)""",
                 f"""SELECT CASE WHEN len(w) <= {size} THEN body_text ELSE
    array_to_string(w[chunk_id * {step} + 1 : chunk_id * {step} + {size}], ' ') END AS text,
  url AS source_url, chunk_id::INTEGER AS chunk_id, total_chunks::INTEGER AS total_chunks FROM placed""")


def _export(table: str, ctes: str) -> str:
    return _from(ctes + f""",
mode AS (SELECT coalesce(language, 'unknown') AS language FROM {table}
         GROUP BY 1 ORDER BY count(*) DESC, min(doc_ord) LIMIT 1),
kept AS (SELECT * FROM {table} WHERE coalesce(word_count, 0) >= 100 AND coalesce(link_density, 1.0) <= 0.3
         AND language = (SELECT language FROM mode))""", "SELECT ")


def _distribution(table: str, ctes: str, column: str) -> str:
    return _from(ctes, f"""SELECT coalesce({column}, 'unknown') AS {column}, count(*) AS n,
  {_pct('count(*)', f'(SELECT count(*) FROM {table})')} AS pct, min(doc_ord) AS first_seen
FROM {table} GROUP BY 1""")


def _map_text(table: str, ctes: str, column: str, name: str = "counts") -> str:
    return _from(ctes, f"""SELECT string_agg(k || '=' || n, ',' ORDER BY k) AS {name} FROM
  (SELECT coalesce({column}, 'unknown') AS k, count(*) AS n FROM {table} GROUP BY 1)""")


_CLEAN = "coalesce(word_count, 0) >= 100 AND coalesce(link_density, 1.0) <= 0.3"
_USE_COLUMNS = "SELECT url, content_type, word_count, has_code_blocks, link_density FROM collection"

# The shop graph and a crawl written out level by level.

_SHOP = """pairs AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS p FROM lineitem),
edges AS (
  SELECT 'https://shop.example.com/o/' || o AS src_url, p AS pos, 'https://shop.example.com/p/' || p AS dst_url FROM pairs
  UNION ALL
  SELECT 'https://shop.example.com/p/' || p, o, 'https://shop.example.com/o/' || o FROM pairs),
site AS (
  SELECT 'https://shop.example.com/o/' || o_orderkey AS url,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'error' WHEN o_orderpriority = '5-LOW' THEN 'skipped'
         ELSE 'crawled' END AS outcome
  FROM orders WHERE o_orderstatus <> 'P'
  UNION ALL
  SELECT 'https://shop.example.com/p/' || p_partkey, CASE WHEN p_size < 10 THEN 'skipped' ELSE 'crawled' END FROM part),
start AS (SELECT 'https://shop.example.com/p/' || min(p_partkey) AS url FROM part WHERE p_size >= 10)"""


def _levels(depth: int, site: str = _SHOP) -> str:
    ctes = [site, """level0 AS MATERIALIZED (
  SELECT start.url, coalesce(outcome, 'error') AS outcome, 0 AS depth, 1::BIGINT AS rank FROM start LEFT JOIN site USING (url))"""]
    for d in range(1, depth + 1):
        seen = " UNION ALL ".join(f"SELECT url FROM level{i}" for i in range(d))
        ctes.append(f"""first{d} AS (
  SELECT dst_url AS url, min(struct_pack(r := rank, p := pos)) AS place
  FROM level{d - 1} l JOIN edges e ON e.src_url = l.url WHERE l.outcome = 'crawled' GROUP BY 1),
level{d} AS MATERIALIZED (
  SELECT f.url, coalesce(outcome, 'error') AS outcome, {d} AS depth, row_number() OVER (ORDER BY f.place) AS rank
  FROM first{d} f LEFT JOIN site USING (url) WHERE f.url NOT IN ({seen}))""")
    every = " UNION ALL ".join(f"SELECT * FROM level{i}" for i in range(depth + 1))
    return ",\n".join(ctes) + f",\nvisits AS ({every})"


# The archive: what was put on every page, instead of what its html reads like.

_ARCHIVE = f"""archive AS (
  SELECT doc_id AS k, 'https://archive.example.net/' || ['docs','blog','product','wiki','catalogue'][(doc_id % 5 + 1)::INT] || '/' || doc_id AS url,
    CASE WHEN doc_id % 17 = 5 THEN 404 WHEN doc_id % 13 = 4 THEN 203 ELSE 200 END AS http_status,
    CASE doc_id % 6 WHEN 0 THEN 'Archive ' || doc_id WHEN 1 THEN 'Heading' || doc_id WHEN 2 THEN 'Guide to ' || doc_id
      WHEN 3 THEN 'Shared ' || doc_id WHEN 4 THEN 'Untitled' ELSE 'Two ' || chr(10) || ' words & ' || doc_id END AS title,
    list_transform(range(1, 5), lambda j: CASE WHEN doc_id % 11 = 3 THEN 'read the long story of page ' || (4 * doc_id + j) || ' in the archive'
      ELSE 'page ' || (4 * doc_id + j) END) || ['back'] AS labels,
    concat_ws(' ',
      CASE WHEN doc_id % 7 = 4 AND doc_id % 6 = 0 THEN 'Archive ' || doc_id WHEN doc_id % 7 = 4 AND doc_id % 6 = 5 THEN 'Two words & ' || doc_id END,
      CASE WHEN doc_id % 7 IN (3, 4, 6) THEN 'banner' END,
      CASE doc_id % 6 WHEN 1 THEN 'Heading ' || doc_id WHEN 2 THEN 'Guide to ' || doc_id END, nullif({_clean("coalesce(text, '')")}, ''),
      CASE doc_id % 8 WHEN 0 THEN 'code ' || doc_id WHEN 1 THEN '``` ' || doc_id END, array_to_string(labels, ' ')) AS body_text,
    doc_id % 8 IN (0, 1) AS has_code_blocks, length(array_to_string(labels, ' ')) AS link_text_len
  FROM documents),
read AS (
  SELECT *, link_text_len::DOUBLE / greatest(length(body_text), 1)::DOUBLE AS link_ratio,
    CASE WHEN http_status >= 400 THEN 'error' WHEN length(body_text) < 100 THEN 'skipped' ELSE 'crawled' END AS outcome
  FROM archive),
site AS (SELECT url, outcome FROM read),
links AS (
  SELECT url AS src_url, pos, 'https://archive.example.net/' || ['docs','blog','product','wiki','catalogue'][(target % 5 + 1)::INT] || '/' || target AS dst_url
  FROM (SELECT url, unnest(range(1, 6)) AS pos, unnest([4 * k + 1, 4 * k + 2, 4 * k + 3, 4 * k + 4, k // 3]) AS target FROM read)),
edges AS (SELECT * FROM links),
start AS (SELECT 'https://archive.example.net/docs/0' AS url)"""


def _crawled_documents(levels: int, pages: int | None) -> str:
    words = _words("body_text")
    kept = "true" if pages is None else f"before < {pages}"
    return _levels(levels, _ARCHIVE) + f""",
placed AS (SELECT *, row_number() OVER (ORDER BY depth, rank) - 1 AS position,
  count(*) FILTER (outcome = 'crawled') OVER (ORDER BY depth, rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    - (outcome = 'crawled')::INT AS before FROM visits),
visited AS (SELECT * FROM placed WHERE {kept}),
accepted AS (SELECT a.*, v.depth, v.position FROM visited v JOIN read a USING (url) WHERE v.outcome = 'crawled'),
{_PROFILE}, {_detected("accepted", "k")},
crawled AS (
  SELECT url, title, body_text, {_FIRST_FETCH} + position AS fetched_at, {_content_type('link_ratio')} AS content_type,
    ({words})::BIGINT AS word_count, length(body_text) AS char_count, language,
    {_py_round(f"({words})", '200', 2)} AS estimated_read_time_minutes, has_code_blocks,
    {_py_round('link_text_len', 'greatest(length(body_text), 1)', 3)} AS link_density, 1::BIGINT AS paragraph_count,
    http_status, depth AS crawl_depth
  FROM accepted JOIN detected USING (k))"""


_EVENTS = """log AS (SELECT ts AS fetched_at, CASE event_type WHEN 'error' THEN 'error' WHEN 'signup' THEN 'skipped'
  ELSE 'crawled' END AS outcome, 'https://shop.example.com/u/' || user_id || '/' || event_type AS url,
  'https://shop.example.com/u/' || user_id || '/' || event_type || '/#e' || event_id AS full_url FROM events)"""

_IMPERFECT = _COLLECTION + """,
imperfect AS (
  SELECT * REPLACE (
    CASE WHEN source = 'src1' THEN 'no uri ' || url ELSE url END AS url,
    CASE WHEN source <> 'src2' THEN title END AS title,
    CASE WHEN source = 'src3' THEN 'forum' ELSE content_type END AS content_type,
    CASE WHEN source = 'src4' THEN -word_count ELSE word_count END AS word_count,
    link_density * 2 AS link_density,
    CASE WHEN source = 'src5' THEN 999 ELSE http_status END AS http_status)
  FROM collection),
broken AS (
  SELECT doc_ord, [
    CASE WHEN title IS NULL THEN 'required:title' END,
    CASE WHEN NOT regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.\\-]*:[^\\s]*$') THEN 'format:url' END,
    CASE WHEN source = 'src6' THEN 'format:fetched_at' END,
    CASE WHEN content_type NOT IN ('article', 'doc_page', 'product_page', 'list_page', 'tutorial')
         THEN 'enum:content_type' END,
    CASE WHEN word_count < 0 THEN 'minimum:word_count' END,
    CASE WHEN link_density < 0 OR link_density > 1 THEN 'range:link_density' END,
    CASE WHEN http_status < 100 OR http_status > 599 THEN 'range:http_status' END] AS rules
  FROM imperfect)"""

_VECTOR_FIELDS = ("SELECT md5(url) AS id, body_text AS text, url, title, content_type, language, word_count, "
                  "fetched_at FROM collection")
_UNIFORM = "struct_pack(section := {}, metric := {}, value := ({})::DOUBLE, pct := ({})::DOUBLE, first_seen := ({})::BIGINT)"


def _collection_profile() -> str:
    counts = {"high_link": "coalesce(link_density, 0) > 0.3", "thin": "coalesce(word_count, 0) < 100",
              "has_code": "coalesce(has_code_blocks, false)", "clean": _CLEAN}
    scalars = [("overview", "total_docs", "count(*)"), ("content", "total_words", "sum(coalesce(word_count, 0))"),
               ("content", "min_words", "min(coalesce(word_count, 0))"),
               ("content", "max_words", "max(coalesce(word_count, 0))"),
               ("content", "mean_words", "sum(coalesce(word_count, 0))::DOUBLE / count(*)::DOUBLE"),
               ("content", "median_words", "median(coalesce(word_count, 0))")]
    parts = [f"SELECT '{s}' AS section, '{m}' AS metric, ({v})::DOUBLE AS value, NULL::DOUBLE AS pct,"
             f" NULL::BIGINT AS first_seen FROM gaps" for s, m, v in scalars]
    for name, test in counts.items():
        n = f"count(*) FILTER ({test})"
        parts.append(f"SELECT 'quality', '{name}', ({n})::DOUBLE, {_pct(n, 'count(*)')}, NULL FROM gaps")
    for section, column in (("languages", "language"), ("content_types", "content_type")):
        parts.append(f"SELECT '{section}', coalesce({column}, 'unknown'), count(*)::DOUBLE,"
                     f" {_pct('count(*)', '(SELECT count(*) FROM gaps)')}, min(doc_ord) FROM gaps GROUP BY 2")
    return _from(_GAPS, "\nUNION ALL\n".join(parts))


ORACLE: dict[str, str] = {
    "scan_jsonl": _from(_COLLECTION, f"SELECT {_FIELDS} FROM collection"),
    "scan_detected_format": _from(_GAPS, f"SELECT {_FIELDS} FROM gaps"),
    "scan_pages": "SELECT page_id, url, 200 AS http_status FROM pages WHERE NOT starts_with(url, 'http:')",
    "sink_export": _export("collection", _COLLECTION)
        + "url, language, word_count, link_density, body_text FROM kept",
    "sink_vectors": _from(_COLLECTION, _VECTOR_FIELDS),
    "sink_partitioned": _from(_COLLECTION, f"SELECT {_FIELDS} FROM collection"),
    "route_by_metadata": _from(_COLLECTION, """SELECT url, language, content_type, word_count FROM collection
WHERE language = 'en' AND content_type = 'doc_page' AND has_code_blocks"""),
    "page_title": _from(_PAGES, "SELECT page_id, title FROM extracted"),
    "boilerplate_elements": """SELECT page_id, tag, count(*) AS n FROM
  (SELECT page_id, unnest(regexp_extract_all(html, '<(nav|footer|aside|script|style)[ >]', 1)) AS tag FROM pages)
GROUP BY ALL""",
    "page_body": _from(_PAGES, """SELECT page_id, body_text, (CASE WHEN body_text = '' THEN 0 ELSE 1 END)::BIGINT AS paragraph_count
FROM extracted"""),
    "page_signals": _from(_PAGES, """SELECT page_id, contains(body_text, '```') AS has_code_blocks,
  0::BIGINT AS link_text_len, 0.0::DOUBLE AS link_ratio, len(hrefs)::INTEGER AS n_links, false AS failed FROM extracted"""),
    "clean_text": f"SELECT doc_id, {_clean('text')} AS body_text FROM documents",
    "paragraph_counts": f"""SELECT doc_id, (CASE WHEN {_clean('text')} = '' THEN 0 ELSE 1 END)::BIGINT AS paragraph_count,
  len(list_filter(string_split(text, chr(10) || chr(10)), lambda p: {_clean('p')} <> '')) AS raw_paragraph_count
FROM documents""",
    "code_fence_flag": "SELECT doc_id, contains(text, '```') AS has_code_blocks FROM documents",
    "text_counts": f"""SELECT doc_id, length(b) AS char_count, {_words('b')} AS word_count
FROM (SELECT doc_id, {_clean('text')} AS b FROM documents)""",
    "read_time": f"""SELECT doc_id, {_py_round('w', '200', 2)} AS estimated_read_time_minutes
FROM (SELECT doc_id, {_words('b')} AS w FROM (SELECT doc_id, {_clean('text')} AS b FROM documents))""",
    "link_density_rounded": f"""SELECT doc_id, {_py_round('w', 'greatest(n, 1)', 3)} AS link_density
FROM (SELECT doc_id, length(b) AS n, {_words('b')} AS w FROM (SELECT doc_id, {_clean('text')} AS b FROM documents))""",
    "language_profile": _from(_PROFILE, "SELECT * FROM profile"),
    "language_of_documents": _from(_CLEANED + _detected("cleaned", "doc_id"), "SELECT * FROM detected"),
    "language_by_join": _from(_CLEANED + _detected("cleaned", "doc_id"), "SELECT * FROM detected"),
    "language_scores": _LANGUAGE_SCORES,
    "language_of_pages": _from(_PAGES + ", " + _PROFILE + ", " + _detected("extracted", "page_id"),
                               "SELECT * FROM detected"),
    "build_collection": _from(_COLLECTION, f"SELECT {_FIELDS} FROM collection"),
    "content_types": _from(_COLLECTION, "SELECT url, title, content_type FROM collection"),
    "page_documents": "WITH " + _PAGE_DOCUMENTS,
    "url_normalized": f"SELECT page_id, {_normalized('url')} AS url_norm FROM pages",
    "url_crawlable": f"""SELECT page_id, {_url_part('u', 2)} AS host,
  {_crawlable('u', "'spam-farm.example.org'")} AS on_spam_farm, {_crawlable('u', _url_part('url', 2))} AS crawlable
FROM (SELECT page_id, url, {_normalized('url')} AS u FROM pages)""",
    "page_links": _from(_LINKS, "SELECT src_url, pos, dst_url FROM links"),
    "vector_records": _from(_COLLECTION, _VECTOR_FIELDS),
    "rag_records": _from(_COLLECTION, """SELECT body_text AS text, url AS source, title, content_type AS type, language,
  fetched_at FROM collection
WHERE word_count BETWEEN 100 AND 2000 AND link_density <= 0.4 AND language <> 'unknown'"""),
    "chunks": _chunks(512, 50),
    "chunks_200_50": _chunks(200, 50),
    "filter_min_content": _from(_PAGES, "SELECT page_id, length(body_text)::INTEGER AS chars FROM extracted WHERE length(body_text) >= 100"),
    "filter_http_status": _from(_COLLECTION, "SELECT url, http_status FROM collection WHERE http_status < 400"),
    "filter_clean": _from(_COLLECTION, f"SELECT url, word_count, link_density FROM collection WHERE {_CLEAN}"),
    "filter_clean_with_gaps": _from(_GAPS, f"SELECT url, word_count, link_density FROM gaps WHERE {_CLEAN}"),
    "filter_export": _export("collection", _COLLECTION) + "url, language FROM kept",
    "filter_export_with_gaps": _export("gaps", _GAPS) + "url, language FROM kept",
    "use_case_code_qa": _from(_COLLECTION, f"{_USE_COLUMNS} WHERE has_code_blocks AND content_type IN ('doc_page', 'tutorial')"),
    "use_case_general_qa": _from(_COLLECTION, f"""{_USE_COLUMNS}
WHERE word_count >= 100 AND content_type IN ('article', 'doc_page') AND link_density <= 0.3"""),
    "use_case_product_info": _from(_COLLECTION, f"{_USE_COLUMNS} WHERE content_type = 'product_page' AND word_count >= 50"),
    "use_case_anything_else": _from(_COLLECTION, _USE_COLUMNS),
    "filter_same_host": f"""SELECT page_id, url, {_url_part('url', 2)} AS host FROM pages
WHERE {_url_part('url', 2)} = (SELECT min_by({_url_part('url', 2)}, page_id) FROM pages)""",
    "frontier_outcomes": _from(_SHOP, """SELECT t.url, in_links, coalesce(outcome, 'error') AS outcome
FROM (SELECT dst_url AS url, count(*) AS in_links FROM edges GROUP BY 1) t LEFT JOIN site USING (url)"""),
    "unvisited_links": _from(_LINKS, f"""SELECT src_url, pos, dst_url FROM links
WHERE dst_url NOT IN (SELECT {_normalized('url')} FROM pages)"""),
    "url_dedup": f"""SELECT {_normalized('url')} AS url_norm, min(page_id) AS first_seen, count(*) AS copies
FROM pages GROUP BY 1""",
    "keep_first_page": f"""SELECT page_id, url_norm, html_chars FROM
  (SELECT page_id, {_normalized('url')} AS url_norm, length(html)::INTEGER AS html_chars,
     row_number() OVER (PARTITION BY {_normalized('url')} ORDER BY page_id) AS rn FROM pages) WHERE rn = 1""",
    "keep_first_body": _from(_COLLECTION, """SELECT doc_ord, url, body_hash FROM
  (SELECT doc_ord, url, md5(body_text) AS body_hash,
     row_number() OVER (PARTITION BY md5(body_text) ORDER BY doc_ord) AS rn FROM collection) WHERE rn = 1"""),
    "distinct_languages": _from(_COLLECTION, "SELECT DISTINCT language FROM collection"),
    "duplicate_bodies": _from(_COLLECTION, """SELECT md5(body_text) AS body_hash, count(*) AS copies,
  min_by(url, doc_ord) AS first_url FROM collection GROUP BY 1 HAVING count(*) > 1"""),
    "word_stats": _from(_GAPS, """SELECT count(*) AS total_docs, sum(w)::BIGINT AS total_words, min(w) AS min_words,
  max(w) AS max_words, sum(w)::DOUBLE / count(*)::DOUBLE AS mean_words, median(w)::DOUBLE AS median_words,
  (sum(w) // count(*))::BIGINT AS floor_words_per_page FROM (SELECT coalesce(word_count, 0) AS w FROM gaps)"""),
    "language_distribution": _distribution("gaps", _GAPS, "language"),
    "content_type_distribution": _distribution("collection", _COLLECTION, "content_type"),
    "content_type_map": _map_text("collection", _COLLECTION, "content_type"),
    "language_map": _map_text("gaps", _GAPS, "language"),
    "modal_language": _from(_GAPS, """SELECT coalesce(language, 'unknown') AS language, count(*) AS n,
  min(doc_ord) AS first_seen FROM gaps GROUP BY 1 ORDER BY n DESC, first_seen LIMIT 1"""),
    "quality_counts": _from(_GAPS, f"""SELECT *, {_pct('high_link', 'total_docs')} AS high_link_pct,
  {_pct('thin', 'total_docs')} AS thin_pct, {_pct('has_code', 'total_docs')} AS has_code_pct,
  {_pct('clean', 'total_docs')} AS clean_pct
FROM (SELECT count(*) AS total_docs, count(*) FILTER (coalesce(link_density, 0) > 0.3) AS high_link,
  count(*) FILTER (coalesce(word_count, 0) < 100) AS thin,
  count(*) FILTER (coalesce(has_code_blocks, false)) AS has_code, count(*) FILTER ({_CLEAN}) AS clean FROM gaps)"""),
    "collection_profile": _collection_profile(),
    "profile_by_increments": _collection_profile(),
    "training_audit": _from(_COLLECTION + """,
flags AS (SELECT count(*) AS total_docs, count(DISTINCT content_type) AS types, count(DISTINCT language) AS langs,
  count(*) FILTER (word_count < 50) AS thin, count(*) FILTER (link_density > 0.5) AS nav FROM collection),
per_language AS (SELECT language, count(*) AS n FROM collection GROUP BY 1),
listed AS (SELECT string_agg('''' || language || ''': ' || n, ', ' ORDER BY language) AS l FROM per_language)""",
        """SELECT total_docs, concat_ws(' | ',
    CASE WHEN types = 1 THEN 'All same content type' END,
    CASE WHEN thin / total_docs > 0.2 THEN thin || ' docs are really short (<50 words)' END,
    CASE WHEN nav / total_docs > 0.3 THEN nav || ' look like navigation/index pages' END,
    CASE WHEN langs > 1 THEN 'Mixed languages: {' || l || '}' END) AS quality_issues,
  concat_ws(' | ',
    CASE WHEN types = 1 THEN 'Mix different page types for better results' END,
    CASE WHEN thin / total_docs > 0.2 THEN 'Filter these out, they dont add much' END,
    CASE WHEN nav / total_docs > 0.3 THEN 'Remove high link-density pages' END,
    CASE WHEN langs > 1 THEN 'Split by language for better training' END) AS recommendations
FROM flags, listed"""),
    "collection_stats": _from(_COLLECTION, """SELECT sum(word_count)::BIGINT AS total_words,
  (sum(word_count) // count(*))::BIGINT AS avg_words_per_page,
  (SELECT string_agg(language, ',' ORDER BY language) FROM (SELECT DISTINCT language FROM collection)) AS languages,
  (SELECT string_agg(k || '=' || n, ',' ORDER BY k) FROM
    (SELECT content_type AS k, count(*) AS n FROM collection GROUP BY 1)) AS content_types
FROM collection"""),
    "first_documents": _from(_COLLECTION, "SELECT doc_ord, url, word_count FROM collection ORDER BY doc_ord LIMIT 5"),
    "crawl_site": _from(_levels(3) + """,
ordered AS (SELECT *, row_number() OVER (ORDER BY depth, rank) - 1 AS position,
  count(*) FILTER (outcome = 'crawled') OVER (ORDER BY depth, rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    - (outcome = 'crawled')::INT AS before FROM visits)""",
        "SELECT url, depth, outcome, position FROM ordered WHERE before < 100"),
    "crawl_depth_limit": _from(_levels(1), "SELECT url, depth, outcome FROM visits"),
    "crawl_reachable": "WITH RECURSIVE " + _SHOP + """,
reach(url, depth) AS (
  SELECT url, 0 FROM start
  UNION
  SELECT e.dst_url, r.depth + 1 FROM reach r JOIN site s ON s.url = r.url AND s.outcome = 'crawled'
    JOIN edges e ON e.src_url = r.url WHERE r.depth < 30)
SELECT url, min(depth) AS depth FROM reach GROUP BY 1""",
    "crawl_snapshot": _from(_LINKS + """,
first AS (SELECT * FROM links WHERE page_id = (SELECT min(page_id) FROM pages)),
found AS (SELECT dst_url, min(pos) AS p FROM first GROUP BY 1)""",
        """SELECT url, 0 AS depth, 'crawled' AS outcome, 0 AS position FROM pages WHERE page_id = (SELECT min(page_id) FROM pages)
UNION ALL
SELECT dst_url, 1, 'error', row_number() OVER (ORDER BY p) FROM found"""),
    "crawl_documents": _from(_crawled_documents(3, 100), f"SELECT {_FIELDS} FROM crawled"),
    "crawl_report": _from(_crawled_documents(16, None), """SELECT pages_crawled, pages_skipped, errors, duration_seconds,
  pages_crawled / duration_seconds AS pages_per_second, total_words, avg_words_per_page, languages, content_types
FROM (SELECT count(*) FILTER (outcome = 'crawled') AS pages_crawled, count(*) FILTER (outcome = 'skipped') AS pages_skipped,
        count(*) FILTER (outcome = 'error') AS errors FROM visited),
  (SELECT (max(fetched_at) - min(fetched_at))::DOUBLE AS duration_seconds, sum(word_count)::BIGINT AS total_words,
     (sum(word_count) // count(*))::BIGINT AS avg_words_per_page FROM crawled),
  (SELECT string_agg(language, ',' ORDER BY language) AS languages FROM (SELECT DISTINCT language FROM crawled)),
  (SELECT string_agg(k || '=' || n, ',' ORDER BY k) AS content_types FROM
    (SELECT content_type AS k, count(*) AS n FROM crawled GROUP BY 1))"""),
    "crawl_continued": _from(_levels(16, _ARCHIVE), "SELECT url, outcome, depth FROM visits"),
    "archive_pages": _from(_ARCHIVE, """SELECT k AS page_id, title, body_text, has_code_blocks, link_text_len, link_ratio,
  7 AS n_links, outcome FROM read"""),
    "archive_boilerplate": _from(_ARCHIVE, """SELECT k AS page_id, unnest(['nav', 'div', 'aside', 'script', 'style', 'footer']) AS tag,
  unnest([CASE WHEN k % 8 = 2 THEN 2 ELSE 1 END, 1, 1, 1, 1, 1])::BIGINT AS n FROM read"""),
    "archive_links": _from(_ARCHIVE, "SELECT src_url, pos::BIGINT AS pos, dst_url FROM links"),
    "crawl_summary": _from(_EVENTS, """SELECT *, pages_crawled / duration_seconds AS pages_per_second FROM
  (SELECT count(*) FILTER (outcome = 'crawled') AS pages_crawled, count(*) FILTER (outcome = 'skipped') AS pages_skipped,
     count(*) FILTER (outcome = 'error') AS errors,
     (epoch_us(max(fetched_at)) - epoch_us(min(fetched_at)))::DOUBLE / 1e6::DOUBLE AS duration_seconds FROM log)"""),
    "page_outcomes": _from(_PAGES, """SELECT CASE WHEN starts_with(url, 'http:') THEN 'error'
  WHEN length(body_text) < 100 THEN 'skipped' ELSE 'crawled' END AS outcome, count(*) AS n FROM extracted GROUP BY 1"""),
    "stream_documents": "WITH " + _PAGE_DOCUMENTS,
    "stream_first_urls": _from(_EVENTS, "SELECT DISTINCT url AS url_norm FROM log"),
    "stream_first_fetches": _from(_EVENTS, """SELECT url_day, epoch_us(fetched_at) AS fetched_at, outcome, full_url AS url FROM (
  SELECT *, row_number() OVER (PARTITION BY url_day ORDER BY fetched_at, full_url) AS rn
  FROM (SELECT *, url || '/' || strftime(fetched_at, '%Y-%m-%d') AS url_day FROM log))
WHERE rn = 1 AND fetched_at + INTERVAL 1 DAY < (SELECT max(fetched_at) FROM log) - INTERVAL 5 MINUTE"""),
    "stream_crawl_rate": _from(_EVENTS, """SELECT epoch(w)::BIGINT AS window_start, epoch(w)::BIGINT + 60 AS window_end, outcome, n
FROM (SELECT date_trunc('minute', fetched_at) AS w, outcome, count(*) AS n FROM log GROUP BY ALL)
WHERE w + INTERVAL 1 MINUTE <= (SELECT max(fetched_at) FROM log) - INTERVAL 5 MINUTE"""),
    "schema_violations": _from(_IMPERFECT, """SELECT doc_ord, array_to_string(list_filter(rules, lambda r: r IS NOT NULL), ',') AS violations
FROM broken"""),
    "violation_summary": _from(_IMPERFECT, """SELECT rule, count(*) AS n FROM (SELECT unnest(rules) AS rule FROM broken)
WHERE rule IS NOT NULL GROUP BY 1"""),
}
