import hashlib
import json
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.operators import conformance, dedup, filters, prepare, profile
from pagemill.schema import DOCUMENT
from pagemill.sources import readers, writers


def document(i, **changes):
    row = {"url": f"https://e.com/{i}", "title": f"T{i}", "body_text": f"body {i}", "content_type": "article",
           "word_count": 150, "char_count": 900, "language": "en", "estimated_read_time_minutes": 0.75,
           "has_code_blocks": False, "link_density": 0.1, "paragraph_count": 1, "http_status": 200, "crawl_depth": 0,
           "doc_ord": i, "fetched": 1735689600 + i}
    return {**row, **changes}


@pytest.fixture
def frame(spark):
    kinds = {f.name: f.dataType.simpleString() for f in DOCUMENT.fields if f.name != "fetched_at"}
    schema = ", ".join(f"{n} {t}" for n, t in kinds.items()) + ", doc_ord long, fetched long"

    def make(rows):
        data = [tuple(r[n] for n in [*kinds, "doc_ord", "fetched"]) for r in rows]
        return spark.createDataFrame(data, schema).withColumn("fetched_at", F.timestamp_seconds("fetched")).drop("fetched")
    return make


def urls_of(frame):
    return sorted(int(r.url.rsplit("/", 1)[1]) for r in frame.select("url").collect())


MIXED = [
    document(0), document(1, language="de", word_count=99), document(2, language="de", link_density=0.31),
    document(3, language=None), document(4, word_count=None), document(5, link_density=None),
    document(6, language="de", content_type="doc_page", has_code_blocks=True), document(7, word_count=2001),
    document(8, link_density=0.4, language="de"), document(9, language="unknown"),
    document(10, content_type="product_page", word_count=50), document(11, word_count=40, content_type="product_page"),
]


def test_filters(frame):
    docs = frame(MIXED)
    assert urls_of(filters.rag_ready(docs)) == [0, 2, 6, 8]
    assert urls_of(filters.clean(docs)) == [0, 3, 6, 7, 9]
    assert urls_of(filters.export_ready(docs)) == [0, 7]
    assert urls_of(filters.use_case(docs, "code_qa")) == [6]
    assert urls_of(filters.use_case(docs, "general_qa")) == [0, 3, 6, 7, 9]
    assert urls_of(filters.use_case(docs, "product_info")) == [10]
    assert len(urls_of(filters.use_case(docs, "other"))) == len(MIXED)
    assert urls_of(filters.route(docs, "de", "doc_page", True)) == [6]


def test_missing_language_never_passes_the_export(frame):
    docs = frame([document(0, language=None), document(1, language=None), document(2)])
    assert urls_of(filters.export_ready(docs)) == []
    docs = frame([document(0, language=None), document(1, language="unknown"), document(2)])
    assert urls_of(filters.export_ready(docs)) == [1]


def test_profile_against_plain_python(frame):
    docs = frame(MIXED)
    words = [d["word_count"] or 0 for d in MIXED]
    rows = {(r.section, r.metric): r for r in profile.collection_profile(docs).collect()}
    n = len(MIXED)
    assert rows["overview", "total_docs"].value == n
    assert rows["content", "total_words"].value == sum(words)
    assert rows["content", "median_words"].value == statistics.median(words)
    assert rows["content", "mean_words"].value == sum(words) / n
    assert (rows["content", "min_words"].value, rows["content", "max_words"].value) == (min(words), max(words))
    thin = sum(w < 100 for w in words)
    assert rows["quality", "thin"].value == thin and f"{rows['quality', 'thin'].pct:.0f}" == f"{thin / n * 100:.0f}"
    counts = Counter(d["language"] or "unknown" for d in MIXED)
    got = [(r["language"], r["n"]) for r in profile.distribution(docs, "language").collect()]
    assert got == counts.most_common()
    stats = profile.word_stats(docs).first()
    assert (stats.total_words, stats.median_words, stats.floor_words_per_page) == (
        sum(words), statistics.median(words), sum(words) // n)


def test_empty_collection(frame):
    docs = frame(MIXED).filter("false")
    assert profile.collection_profile(docs).count() == 0
    assert profile.word_stats(docs).count() == 0
    assert profile.quality_counts(docs).count() == 0
    assert [tuple(r) for r in profile.training_audit(docs).collect()] == [(0, [], [])]


def test_audit(frame):
    rows = [document(i, word_count=20, link_density=0.9, language=("de" if i else "en")) for i in range(3)]
    audit = profile.training_audit(frame(rows)).first()
    assert audit.total_docs == 3
    assert audit.quality_issues == [
        "All same content type", "3 docs are really short (<50 words)", "3 look like navigation/index pages",
        "Mixed languages: {'de': 2, 'en': 1}"]
    assert len(audit.recommendations) == 4
    fine = profile.training_audit(frame([document(0), document(1, content_type="doc_page")])).first()
    assert fine.quality_issues == [] and fine.recommendations == []


def test_chunks(spark):
    for n, size, overlap in [(0, 5, 2), (5, 5, 2), (6, 5, 2), (7, 5, 0), (23, 5, 4), (100, 7, 3)]:
        tokens = [f"w{i}" for i in range(n)]
        text = "  ".join(tokens)
        docs = spark.createDataFrame([("u", text)], ["url", "body_text"])
        got = prepare.chunk(docs, size, overlap).orderBy("chunk_id").collect()
        if n <= size:
            assert [(r.text, r.chunk_id, r.total_chunks) for r in got] == [(text, 0, 1)]
            continue
        starts = list(range(0, n, size - overlap))
        assert [r.text for r in got] == [" ".join(tokens[s:s + size]) for s in starts]
        assert [r.chunk_id for r in got] == list(range(len(starts)))
        assert {r.total_chunks for r in got} == {len(starts)}
    for size, overlap in [(5, 5), (5, 6), (5, -1)]:
        with pytest.raises(ValueError):
            prepare.chunk(docs, size, overlap)


def test_records(frame):
    docs = frame(MIXED[:2])
    record = prepare.vector_records(docs).orderBy("metadata.url").first()
    assert record.id == hashlib.md5(b"https://e.com/0").hexdigest()
    assert list(record.metadata.asDict()) == ["url", "title", "content_type", "language", "word_count", "fetched_at"]
    rag = prepare.rag_records(docs).collect()
    assert len(rag) == 1 and list(rag[0].metadata.asDict()) == ["source", "title", "type", "language", "fetched_at"]


def test_duplicates_with_a_hot_group(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_ord"), F.concat(F.lit("u"), "id").alias("url"),
        F.when(F.col("id") % 3 == 1, "same").otherwise(F.concat(F.lit("b"), "id")).alias("body_text"))
    dup = dedup.duplicate_bodies(rows).collect()
    assert [(r.copies, r.first_url) for r in dup] == [(1000, "u1")]
    kept = dedup.keep_first(rows, "body_text", "doc_ord")
    assert kept.count() == 2001 and kept.filter("body_text = 'same'").first().doc_ord == 1


def test_jsonl_round_trip(spark, frame, tmp_path):
    docs = frame([document(0, title="café —", language=None)]).drop("doc_ord")
    path = str(tmp_path / "out")
    writers.save_jsonl(docs, path)
    line = next(p for p in (tmp_path / "out").glob("part-*") if p.stat().st_size).read_text(encoding="utf-8")
    raw = json.loads(line)
    assert "café —" in line and raw["language"] is None
    assert raw["fetched_at"] == "2025-01-01T00:00:00.000000+00:00"
    back = readers.load_collection(spark, path).select(*docs.columns)
    assert back.collect() == docs.collect()


@pytest.mark.parametrize("content, urls", [
    ('{"url": "a"}\n\n{"url": "b"}\n', ["a", "b"]),
    ('[{"url": "a"}, {"url": "b"}]', ["a", "b"]),
    ('[\n {"url": "a"},\n {"url": "b"}\n]\n', ["a", "b"]),
    ('{\n "url": "a"\n}\n', ["a"]),
    ('', []),
])
def test_format_detection(spark, tmp_path, content, urls):
    path = tmp_path / "c.json"
    path.write_text(content)
    rows = readers.load_documents(spark, str(path)).select("url").collect()
    assert sorted(r.url for r in rows) == urls


def test_bad_line_fails(spark, tmp_path):
    path = tmp_path / "c.jsonl"
    path.write_text('{"url": "a"}\n{"url": \n')
    with pytest.raises(Exception):
        readers.load_documents(spark, str(path)).collect()


def test_partitioned_collection_prunes(spark, frame, tmp_path):
    path = str(tmp_path / "cols")
    writers.save_collection(frame(MIXED).drop("doc_ord"), path)
    picked = filters.route(spark.read.parquet(path), "de", "doc_page")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(language" in plan and urls_of(picked) == [6]


def test_filters_reach_the_scan(spark, frame, tmp_path):
    path = str(tmp_path / "plain")
    frame(MIXED).write.parquet(path)
    picked = filters.use_case(spark.read.parquet(path), "product_info").select("url")
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(content_type,product_page)" in plan or "PushedFilters: [IsNotNull(content_type)" in plan
    assert "ReadSchema: struct<url:string,content_type:string,word_count:bigint>" in plan


def test_conformance(frame):
    rows = [document(0), document(1, url="not a uri", content_type="forum", word_count=-1),
            document(2, link_density=1.2, http_status=99, title=None)]
    got = {r.doc_ord: r.violations for r in conformance.with_violations(frame(rows)).collect()}
    assert got == {0: [], 1: ["format:url", "enum:content_type", "minimum:word_count"],
                   2: ["required:title", "range:link_density", "range:http_status"]}
    summary = {r.rule: r.n for r in conformance.violation_summary(frame(rows)).collect()}
    assert summary == Counter(v for vs in got.values() for v in vs)
    missing = conformance.with_violations(frame(rows).drop("title")).first()
    assert "required:title" in missing.violations


def test_wrong_types_are_reported(spark, tmp_path):
    good = {"url": "https://e.com/1", "title": "t", "body_text": "b", "fetched_at": "2025-01-01T00:00:00+00:00",
            "content_type": "article", "word_count": 1, "char_count": 1, "language": "en",
            "estimated_read_time_minutes": 0.01, "has_code_blocks": False, "link_density": 0.0, "paragraph_count": 1,
            "http_status": 200, "crawl_depth": 0}
    path = tmp_path / "rows.jsonl"
    path.write_text(json.dumps(good) + "\n" + json.dumps({**good, "word_count": "many"}) + "\n")
    schema = T.StructType([*DOCUMENT.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = readers.load_collection(spark, str(path), schema, mode="PERMISSIVE").cache()
    got = [r.violations for r in conformance.with_violations(rows).orderBy(F.col("_corrupt_record").isNotNull()).collect()]
    assert got[0] == [] and "type" in got[1]


def test_every_file_has_its_own_format(spark, tmp_path):
    folder = tmp_path / "mixed"
    folder.mkdir()
    (folder / "a.json").write_text('\n  \n{"url": "l1"}\n\n{"url": "l2"}\n')
    (folder / "b.json").write_text('[{"url": "a1"}, {"url": "a2"}]')
    (folder / "c.json").write_text('{\n  "url": "object"\n}\n')
    (folder / "d.json").write_text('[\n{"url": "p1"},\n{"url": "p2"}\n]')
    (folder / "e.json").write_text("\n \n")
    (folder / "f.json").write_text('{"url": "single"}')
    got = sorted(r.url for r in readers.load_documents(spark, str(folder)).select("url").collect())
    assert got == ["a1", "a2", "l1", "l2", "object", "p1", "p2", "single"]
    kinds = {r.file.rsplit("/", 1)[1]: r.by_lines for r in readers._json_kinds(spark, str(folder)).collect()}
    assert kinds == {"a.json": True, "b.json": False, "c.json": False, "d.json": False, "f.json": True}


def test_format_of_a_long_array_is_found_in_tasks(spark, tmp_path):
    path = tmp_path / "long.json"
    with open(path, "w") as out:
        out.write("[" + ",".join(f'{{"url": "u{i}", "title": "{"t" * 200}"}}' for i in range(50_000)) + "]")
    assert readers.load_documents(spark, str(path)).count() == 50_000
