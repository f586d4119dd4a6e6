"""Scans: JSON collections, page snapshots, parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemill.schema import DOCUMENT


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_collection(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT,
                    mode: str = "FAILFAST") -> DataFrame:
    """JSON Lines; blank lines are skipped, a bad line fails the job unless ``mode`` says otherwise."""
    return spark.read.schema(schema).option("mode", mode).json(path)


def load_documents(spark: SparkSession, path: str, schema: T.StructType = DOCUMENT) -> DataFrame:
    """A file or folder of JSON, each file as JSON Lines or as whole-file JSON (array or object).

    A file is JSON Lines when its first line that is not blank is a JSON object of its own. That is decided
    file by file inside the tasks; only names and kinds come to the driver. Blank files hold no rows.
    """
    kinds = _json_kinds(spark, path).collect()
    reader = spark.read.schema(schema).option("mode", "FAILFAST")
    by_lines, whole = ([r["file"] for r in kinds if r["by_lines"] == kind] for kind in (True, False))
    parts = ([reader.json(by_lines)] if by_lines else []) + ([reader.option("multiLine", True).json(whole)] if whole else [])
    if not parts:
        return spark.createDataFrame([], schema)
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _json_kinds(spark: SparkSession, path: str) -> DataFrame:
    """(file, by_lines) of every file with text: does its first non-blank line parse as an object?

    The first lines are found by their numbers; only they are read as JSON.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line")).filter(F.trim("value") != "")
    # Lines of one block are numbered in order; of a file's blocks the first with text counts.
    per_block = lines.groupBy("file", "block").agg(F.min("line").alias("line"))
    firsts = per_block.groupBy("file").agg(F.min("block").alias("block")).join(per_block, ["file", "block"])
    is_object = F.startswith(F.ltrim("value"), F.lit("{")) & F.try_parse_json("value").isNotNull()
    return lines.join(F.broadcast(firsts), ["file", "block", "line"]).select("file", is_object.alias("by_lines"))


def read_pages(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Page snapshot (url, html[, http_status]); a missing status becomes 200.

    ``partitions`` spreads a small scan over that many tasks; without it the pages stay where they are.
    """
    pages = spark.read.parquet(path)
    status = F.coalesce("http_status", F.lit(200)) if "http_status" in pages.columns else F.lit(200)
    return (pages.repartition(partitions) if partitions else pages).withColumn("http_status", status.cast("int"))
