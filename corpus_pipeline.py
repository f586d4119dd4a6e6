"""From raw documents to a mixed training corpus: five stages, each a table for the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemill.llm import dart_minhash, decontaminate, pivotal_mix, site_lines, toxicity
from pagemill.llm.tables import written
from pagemill.sources.readers import read_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not find toxic; null and empty texts stay."""
    chain = toxicity.train(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return toxicity.with_probabilities(docs.select(*COLUMNS), chain).filter(~toxicity.is_toxic(chain)).select(*COLUMNS)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate on their source; the source is the site."""
    rest = site_lines.drop_boilerplate(docs.select(*COLUMNS), host="source", text="text")
    return rest.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars"))).select(*COLUMNS)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near duplicates the document with the smallest id."""
    return dart_minhash.one_of_each(docs.select(*COLUMNS)).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat no benchmark item."""
    return decontaminate.clean_rows(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes every document."""
    return pivotal_mix.mixing_plan(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("near_dedup", one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# A trained classifier decides the first stage, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
