"""Collection profile, distributions and the training-data audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemill.functions.text import percent

# Wording of the audit's issues and recommendations.
SAME_TYPE = ("All same content type", "Mix different page types for better results")
SHORT = ("%d docs are really short (<50 words)", "Filter these out, they dont add much")
NAVIGATION = ("%d look like navigation/index pages", "Remove high link-density pages")
LANGUAGES = ("Mixed languages: {%s}", "Split by language for better training")


def most_common(docs: DataFrame, value: Column, order: str, name: str) -> DataFrame:
    """(name, n, first_seen), most frequent first, ties by first occurrence."""
    return (docs.groupBy(value.alias(name))
            .agg(F.count("*").alias("n"), F.min(order).alias("first_seen"))
            .orderBy(F.desc("n"), "first_seen"))


def distribution(docs: DataFrame, column: str, order: str = "doc_ord") -> DataFrame:
    """(column, n, pct, first_seen) in :func:`most_common` order; missing counts as unknown.

    For columns with few values, such as languages and types.
    """
    counts = most_common(docs, F.coalesce(column, F.lit("unknown")), order, column)
    # One row per distinct value is left, so the total over them is cheap and the documents,
    # which may still have to be extracted, are read once.
    total = F.sum("n").over(Window.partitionBy())
    return (counts.select(column, "n", percent(F.col("n"), total).alias("pct"), "first_seen")
            .orderBy(F.desc("n"), "first_seen"))


def counts_map(docs: DataFrame, column: str) -> DataFrame:
    """One row with a map value -> count."""
    counts = docs.groupBy(F.coalesce(column, F.lit("unknown")).alias("value")).agg(F.count("*").alias("n"))
    return counts.groupBy().agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("value", "n")))).alias("counts"))


def word_stats(docs: DataFrame) -> DataFrame:
    """Document and word totals, extremes, mean, exact median, floor average.

    Documents are first counted per distinct word count. The median is then taken over
    that short histogram, so no task ever sees more rows than there are text lengths.
    """
    words = F.coalesce("word_count", F.lit(0)).alias("words")
    histogram = docs.groupBy(words).agg(F.count("*").alias("n"))
    return _word_stats(histogram)


def _word_stats(histogram: DataFrame) -> DataFrame:
    total = F.sum(F.col("words") * F.col("n"))
    docs = F.sum("n")
    return (histogram.groupBy()
            .agg(docs.alias("total_docs"), total.alias("total_words"),
                 F.min("words").alias("min_words"), F.max("words").alias("max_words"),
                 (total.cast("double") / docs.cast("double")).alias("mean_words"),
                 F.percentile("words", 0.5, F.col("n")).alias("median_words"),
                 F.floor(total / docs).alias("floor_words_per_page"))
            .filter("total_docs > 0"))


COUNTS = ("section string, label string, words long, n long, first_seen long, high_link long, has_code long, clean long")
_FLAGS = ("high_link", "has_code", "clean")


def profile_counts(docs: DataFrame, order: str = "doc_ord") -> DataFrame:
    """What a profile needs of some documents, as a small table of COUNTS; those of several parts can be merged.

    Every document is counted under its language, its type and its word count at once.
    """
    flags = {
        "high_link": F.coalesce("link_density", F.lit(0.0)) > 0.3,
        "has_code": F.coalesce("has_code_blocks", F.lit(False)),
        "clean": ((F.coalesce("word_count", F.lit(0)) >= 100)
                  & (F.coalesce("link_density", F.lit(1.0)) <= 0.3)),
    }

    def entry(section: str, label: Column, words: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), label.alias("label"), words.alias("words"))

    nothing = F.lit(None)
    grouped = (docs
               .select(F.col(order).alias("ord"), *[test.cast("long").alias(n) for n, test in flags.items()],
                       F.explode(F.array(
                           entry("languages", F.coalesce("language", F.lit("unknown")), nothing.cast("long")),
                           entry("content_types", F.coalesce("content_type", F.lit("unknown")), nothing.cast("long")),
                           entry("overview", nothing.cast("string"), F.coalesce("word_count", F.lit(0)).cast("long")),
                       )).alias("e"))
               .groupBy("e.section", "e.label", "e.words")
               .agg(F.count("*").alias("n"), F.min("ord").alias("first_seen"),
                    *[F.sum(n).alias(n) for n in flags]))
    return grouped.select("section", "label", "words", "n", F.col("first_seen").cast("long").alias("first_seen"), *_FLAGS)


def merged_counts(*counts: DataFrame) -> DataFrame:
    """The counts of all parts together; new documents are counted without a second scan of the old ones."""
    whole = counts[0]
    for more in counts[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("section", "label", "words").agg(
        F.sum("n").alias("n"), F.min("first_seen").alias("first_seen"), *[F.sum(name).alias(name) for name in _FLAGS])


def collection_profile(docs: DataFrame, order: str = "doc_ord") -> DataFrame:
    """(section, metric, value, pct, first_seen): the whole profile from one scan."""
    return profile_of_counts(profile_counts(docs, order))


def profile_of_counts(counts: DataFrame) -> DataFrame:
    """The profile of :func:`profile_counts`, be they of one scan or merged; the median is exact either way."""
    total = F.sum("n")
    word_total = F.sum(F.col("words") * F.col("n"))
    merged = (counts.groupBy("section", "label")
              .agg(total.alias("n"), F.min("first_seen").alias("first_seen"),
                   word_total.alias("word_total"), F.min("words").alias("low"), F.max("words").alias("high"),
                   (word_total.cast("double") / total.cast("double")).alias("mean"),
                   F.percentile("words", 0.5, F.col("n")).alias("median"),
                   F.sum(F.when(F.col("words") < 100, F.col("n")).otherwise(0)).alias("thin"),
                   *[F.sum(name).alias(name) for name in _FLAGS]))

    def line(section: str, metric: Column | str, value: Column, pct: Column | None = None,
             seen: Column | None = None) -> Column:
        return F.struct(F.lit(section).alias("section"),
                        (F.lit(metric) if isinstance(metric, str) else metric).alias("metric"),
                        value.cast("double").alias("value"),
                        (F.lit(None) if pct is None else pct).cast("double").alias("pct"),
                        (F.lit(None) if seen is None else seen).cast("long").alias("first_seen"))

    n = F.col("n")

    def counted(metric: str) -> Column:
        return line("quality", metric, F.col(metric), percent(F.col(metric), n))

    overview = F.array(
        line("overview", "total_docs", n), line("content", "total_words", F.col("word_total")),
        line("content", "min_words", F.col("low")), line("content", "max_words", F.col("high")),
        line("content", "mean_words", F.col("mean")), line("content", "median_words", F.col("median")),
        counted("high_link"), counted("thin"), counted("has_code"), counted("clean"))

    # Each document is counted once in every section, so a section's sum is the total.
    all_docs = F.sum("n").over(Window.partitionBy("section"))
    share = percent(n, F.col("all_docs"))
    lines = (F.when(F.col("section") == "overview", overview)
             .when(F.col("section") == "languages",
                   F.array(line("languages", F.col("label"), n, share, F.col("first_seen"))))
             .otherwise(F.array(line("content_types", F.col("label"), n, share, F.col("first_seen")))))
    return merged.withColumn("all_docs", all_docs).select(F.inline(lines))


def quality_counts(docs: DataFrame) -> DataFrame:
    """High-link, thin, code and clean counts with their percentages, one pass."""
    density_0 = F.coalesce("link_density", F.lit(0.0))
    words = F.coalesce("word_count", F.lit(0))
    counts = docs.groupBy().agg(
        F.count("*").alias("total_docs"),
        F.count_if(density_0 > 0.3).alias("high_link"),
        F.count_if(words < 100).alias("thin"),
        F.count_if(F.coalesce("has_code_blocks", F.lit(False))).alias("has_code"),
        F.count_if((words >= 100) & (F.coalesce("link_density", F.lit(1.0)) <= 0.3)).alias("clean"))
    return counts.filter("total_docs > 0").select(
        "*", *[percent(F.col(c), F.col("total_docs")).alias(f"{c}_pct")
               for c in ("high_link", "thin", "has_code", "clean")])


def training_audit(docs: DataFrame) -> DataFrame:
    """(total_docs, quality_issues, recommendations): one row, arrays in a fixed order."""
    by_pair = docs.groupBy(
        F.coalesce("language", F.lit("unknown")).alias("language"),
        F.coalesce("content_type", F.lit("unknown")).alias("content_type"),
    ).agg(F.count("*").alias("n"), F.count_if(F.col("word_count") < 50).alias("thin"),
          F.count_if(F.col("link_density") > 0.5).alias("nav"))
    by_language = by_pair.groupBy("language").agg(
        F.sum("n").alias("n"), F.sum("thin").alias("thin"), F.sum("nav").alias("nav"),
        F.collect_set("content_type").alias("types"))
    whole = by_language.groupBy().agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_docs"), F.sum("thin").alias("thin"),
        F.sum("nav").alias("nav"),
        F.size(F.array_distinct(F.flatten(F.collect_list("types")))).alias("n_types"),
        F.array_sort(F.collect_list(F.struct("language", "n"))).alias("languages"))
    total = F.col("total_docs").cast("double")
    listed = F.array_join(F.transform("languages", lambda e: F.concat(
        F.lit("'"), e["language"], F.lit("': "), e["n"].cast("string"))), ", ")
    checks = [
        (F.col("n_types") == 1, SAME_TYPE, F.lit(SAME_TYPE[0])),
        (F.col("thin") / total > 0.2, SHORT, F.format_string(SHORT[0], "thin")),
        (F.col("nav") / total > 0.3, NAVIGATION, F.format_string(NAVIGATION[0], "nav")),
        (F.size("languages") > 1, LANGUAGES, F.format_string(LANGUAGES[0], listed)),
    ]
    some = F.col("total_docs") > 0
    issues = F.array(*[F.when(some, F.when(test, text)) for test, _, text in checks])
    advice = F.array(*[F.when(some, F.when(test, F.lit(words[1]))) for test, words, _ in checks])
    return whole.select("total_docs", F.array_compact(issues).alias("quality_issues"),
                        F.array_compact(advice).alias("recommendations"))


def collection_stats(docs: DataFrame) -> DataFrame:
    """Total words, floor average per page, sorted languages, type counts: one row.

    A missing language or type counts as unknown.
    """
    known = docs.withColumns({c: F.coalesce(c, F.lit("unknown")) for c in ("language", "content_type")})
    by_pair = known.groupBy("language", "content_type").agg(
        F.count("*").alias("n"), F.sum("word_count").alias("words"))
    by_type = by_pair.groupBy("content_type").agg(
        F.sum("n").alias("n"), F.sum("words").alias("words"), F.collect_set("language").alias("languages"))
    whole = by_type.groupBy().agg(
        F.sum("n").alias("docs"), F.sum("words").alias("total_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("languages")))).alias("languages"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("content_type", "n")))).alias("content_types"))
    return whole.filter("docs > 0").select(
        "total_words", F.call_function("div", "total_words", "docs").alias("avg_words_per_page"),
        "languages", "content_types")


def distinct_values(docs: DataFrame, column: str) -> DataFrame:
    return docs.select(column).distinct()
