"""The registered queries of the operators, and the same results in SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import (
    byte_language,
    dart_minhash,
    decontaminate,
    embedding_tiles,
    lexical_search,
    licence_paragraphs,
    pivotal_mix,
    prefix_trie,
    secret_ownership,
    site_lines,
    suffix_dedup,
    toxicity,
    weak_pii,
)
from pagemill.sources.readers import read_table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    REGISTRY[function.__name__] = function
    return function


@query
def op1_spaced_seed_overlaps(spark, sf):
    """Every document that repeats a benchmark item, with each item and the longest overlap."""
    return decontaminate.contaminated_pairs(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


@query
def op2_toxicity_chain(spark, sf):
    """The documents found toxic, with the probabilities of all categories."""
    docs = read_table(spark, sf, "documents")
    chain = toxicity.train(docs, read_table(spark, sf, "labels"))
    scored = toxicity.with_probabilities(docs.select("doc_id", "text"), chain)
    toxic = toxicity.is_toxic(chain)
    return scored.filter(toxic).select("doc_id", *[f"p_{c}" for c in chain.categories], F.lit(True).alias("toxic"))


@query
def op3_byte_language(spark, sf):
    """The language of every document, by a network that saw two thirds of them at most."""
    docs = read_table(spark, sf, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    net = byte_language.fit(docs.filter(fold != 1))
    held_out = F.coalesce(fold == 1, F.lit(False))
    return byte_language.with_language(docs.select("doc_id", held_out.alias("held_out"), "text"), net).select(
        "doc_id", "held_out", "lang_pred", "score")


@query
def op4_site_lines(spark, sf):
    """The text lines of every page without the boilerplate of its host."""
    pages = read_table(spark, sf, "pages").select(
        "page_id", site_lines.page_host(F.col("url")).alias("host"), site_lines.page_lines(F.col("html")).alias("text"))
    return site_lines.drop_boilerplate(pages, host="host", text="text", dropped="n_dropped")


ORACLE["op4_site_lines"] = f"""
WITH pages_text AS (
  SELECT page_id,
    nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
      '{site_lines._HIDDEN}', '', 'g'), '\\s+', ' ', 'g'), '{site_lines._BREAK}', chr(10), 'g'),
      '<[^>]*>', '', 'g'), ' ?\\n ?', chr(10), 'g'), '\\n{{2,}}', chr(10), 'g') AS text
  FROM pages),
lines AS (
  SELECT page_id, host, text, line, pos, trim(line, ' ' || chr(9) || chr(13) || chr(12)) AS bare
  FROM (SELECT page_id, host, text, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM pages_text)),
totals AS (SELECT host, count(DISTINCT coalesce(text, chr(0))) AS host_pages FROM pages_text GROUP BY host),
drops AS (
  SELECT c.host, c.bare FROM (
    SELECT host, bare, count(DISTINCT text) AS n FROM lines WHERE bare <> '' GROUP BY host, bare) c
  JOIN totals t ON c.host IS NOT DISTINCT FROM t.host
  WHERE c.n >= {site_lines.LEAST_PAGES} AND c.n / t.host_pages >= {site_lines.RATIO}),
marked AS (
  SELECT l.page_id, l.line, l.pos, d.bare IS NOT NULL AS gone
  FROM lines l LEFT JOIN drops d ON l.host IS NOT DISTINCT FROM d.host AND l.bare = d.bare)
SELECT p.page_id, p.host, coalesce(m.text, CASE WHEN p.text IS NOT NULL THEN '' END) AS text,
       coalesce(m.n_dropped, 0) AS n_dropped
FROM pages_text p LEFT JOIN (
  SELECT page_id, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS text,
         count(*) FILTER (gone) AS n_dropped FROM marked GROUP BY page_id) m USING (page_id)
"""


@query
def op5_dart_minhash(spark, sf):
    """The class of near duplicates of every document."""
    found = dart_minhash.near_duplicates(read_table(spark, sf, "documents"))
    return found.withColumn("kept", F.col("doc_id") == F.col("class_id"))


@query
def op6_secret_ownership(spark, sf):
    """The secrets of every document, and how many of them look live or are widely copied."""
    found = secret_ownership.scan(read_table(spark, sf, "documents"))

    def number(kind: str):
        place = [k[0] for k in secret_ownership.KINDS].index(kind)
        return F.size(F.filter("spans", lambda s: s["kind"] == place)).cast("long").alias(f"n_{kind}")

    def judged(verdict: str):
        return F.size(F.filter("spans", lambda s: s["verdict"] == verdict)).cast("long").alias(f"n_{verdict}")

    def most(column: str):
        return F.coalesce(F.array_max(f"spans.{column}"), F.lit(0)).cast("long").alias(f"most_{column}")

    listed = secret_ownership.span_list
    return found.select("doc_id", *map(number, secret_ownership.BASE),
                        F.sha2(listed(F.col("spans"), secret_ownership.BASE), 256).alias("base_sha256"),
                        listed(F.col("spans")).alias("spans"), judged("live"), judged("copied"),
                        most("owners"), most("repositories"))


@query
def op7_embedding_tiles(spark, sf):
    """The links and the component of every embedding."""
    return embedding_tiles.near_duplicates(read_table(spark, sf, "embeddings"))


ORACLE["op7_embedding_tiles"] = f"""
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    AND len(list_filter(embedding, lambda v: v <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= {embedding_tiles.THRESHOLD}),
reach AS (
  SELECT vec_id AS node, vec_id AS root FROM embeddings
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node WHERE r.root < l.b)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, m.root AS component_id, m.root = e.vec_id AS kept
FROM embeddings e JOIN (SELECT node, min(root) AS root FROM reach GROUP BY node) m ON m.node = e.vec_id
"""


@query
def op8_licence_paragraphs(spark, sf):
    """The paragraphs of all documents that state a licence, with its family and whether the wording confirms it."""
    docs = read_table(spark, sf, "documents")
    return licence_paragraphs.scan(docs, licence_paragraphs.train(docs))


@query
def op9_suffix_dedup(spark, sf):
    """What is left of every document without the strings that stand earlier in the corpus."""
    found = suffix_dedup.without_repeats(read_table(spark, sf, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@query
def op10_pivotal_mix(spark, sf):
    """How many words the mix takes of every document."""
    plan = pivotal_mix.mixing_plan(read_table(spark, sf, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op11_prefix_trie(spark, sf):
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.prefix_trie(read_table(spark, sf, "conversations"))


ORACLE["op11_prefix_trie"] = f"""
WITH said AS (
  SELECT conv_id, turn, sha256(length(r) || ':' || r || t) AS key, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL)),
turns AS (
  SELECT conv_id, key, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) - 1 AS pos FROM said),
convs AS (
  SELECT conv_id, conv_id - conv_id % {prefix_trie.GROUP} AS base,
    -- CRC-32: a byte is mixed in, then eight shifts (-1) follow.
    xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
      lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda x, e: CASE WHEN e >= 0 THEN xor(x, e) ELSE xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END) END),
      4294967295::BIGINT) % {prefix_trie.MOST_SHARED} AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
placed AS (
  SELECT c.conv_id, 0 AS own, t.pos, t.key, t.words FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
  UNION ALL
  SELECT c.conv_id, 1, t.pos, t.key, t.words FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos >= c.h),
lists AS (SELECT conv_id, list(key ORDER BY own, pos) AS ks, list(words ORDER BY own, pos) AS ws FROM placed GROUP BY conv_id),
members AS (
  SELECT conv_id, depth, md5(array_to_string(ks[1:depth], ',')) AS node, md5(array_to_string(ks[1:depth - 1], ',')) AS above,
    CASE WHEN depth = 0 THEN 0 ELSE ws[depth] END AS words, depth = len(ks) AS last
  FROM (SELECT c.conv_id, coalesce(ks, []) AS ks, ws, unnest(range(len(coalesce(ks, [])) + 1)) AS depth FROM convs c LEFT JOIN lists USING (conv_id))),
reps AS (
  SELECT node, depth, min(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '') AS ends
  FROM members GROUP BY node, depth),
children AS (SELECT above AS node, depth - 1 AS depth, count(*) AS n FROM reps WHERE depth > 0 GROUP BY ALL),
nodes AS (SELECT r.*, coalesce(c.n, 0) AS n_children FROM reps r LEFT JOIN children c ON c.node = r.node AND c.depth = r.depth),
below AS (
  SELECT m.node, m.depth, count(*) FILTER (u.n_children = 0) AS n_leaves, sum((u.n_convs - 1) * u.words)::BIGINT AS saved_tokens
  FROM nodes u JOIN members m ON m.conv_id = u.conv_id AND m.depth <= u.depth GROUP BY ALL)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b ON b.node = n.node AND b.depth = n.depth
LEFT JOIN reps p ON n.depth > 0 AND p.node = n.above AND p.depth = n.depth - 1
"""


@query
def op12_weak_pii(spark, sf):
    """The personal data of every document."""
    found = weak_pii.scan(read_table(spark, sf, "documents"))
    return found.select("doc_id", *[weak_pii.count_of(kind).alias(f"n_{kind}") for kind in weak_pii.BASE],
                        F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op13_lexical_search(spark, sf):
    """The documents that answer every benchmark item best."""
    return lexical_search.rank(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


_TERMS = ("list_transform(regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), "
          "lambda t: translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))")
ORACLE["op13_lexical_search"] = f"""
WITH words AS (SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents),
counted AS (SELECT row, doc_id, len(terms)::HUGEINT AS size, terms FROM words WHERE len(terms) > 0),
total AS (SELECT count(*)::HUGEINT AS docs, sum(size)::HUGEINT AS length FROM counted),
items AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
tf AS (
  SELECT row, doc_id, size, term, count(*) AS tf FROM (SELECT row, doc_id, size, unnest(terms) AS term FROM counted)
  WHERE term IN (SELECT term FROM items) GROUP BY ALL),
df AS (
  SELECT term, floor(1000.0::DOUBLE * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, total GROUP BY term, docs),
scored AS (
  SELECT item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * size * docs) // length))))::BIGINT AS score
  FROM items JOIN tf USING (term) JOIN df USING (term), total GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= {lexical_search.TOP}
"""
