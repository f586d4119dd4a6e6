"""Duplicates: by normalised URL and by exact body."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.session import new_table_path

# Words of 64 rows with a surplus row that may be broadcast; of more, wide rows are exchanged by their place.
BROADCAST_WORDS = 1_000_000
_ROWS_OF_A_WORD = 64
# Steps that leave every row of a scan where it was.
_IN_PLACE = {"Project", "Filter", "Relation", "SubqueryAlias", "View"}


def placed(rows: DataFrame) -> DataFrame:
    """The rows with the file and the row number they stand at.

    Parquet scans know both. Rows that come from anywhere else are written first.
    """
    steps = {line.lstrip(" :+-").split(" ")[0].split("[")[0] for line in rows._jdf.queryExecution().analyzed().toString().splitlines()}
    if steps <= _IN_PLACE:
        try:
            return rows.select("*", F.col("_metadata.file_path").alias("_place_file"), F.col("_metadata.row_index").alias("_place_row"))
        except AnalysisException:  # a scan of another format
            pass
    path = new_table_path(rows.sparkSession, "rows")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).select(
        "*", F.col("_metadata.file_path").alias("_place_file"), F.col("_metadata.row_index").alias("_place_row"))


def place_words(places: DataFrame) -> DataFrame:
    """Rows given by file and row number as a written table of words: one bit a row, 64 rows a word."""
    spark, path = places.sparkSession, new_table_path(places.sparkSession, "places")
    (places.groupBy("_place_file", F.call_function("div", F.col("_place_row"), F.lit(_ROWS_OF_A_WORD)).alias("_place_word"))
     .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(_place_row % {_ROWS_OF_A_WORD} AS int))")).alias("_place_bits"))
     .write.parquet(path))
    return spark.read.schema("_place_file string, _place_word long, _place_bits long").parquet(path)


def rows_by_place(stored: DataFrame, words: DataFrame, listed: bool) -> DataFrame:
    """The rows of a :func:`placed` table that are listed, or those that are not, without their places.

    A short list goes to every task, so wide rows stay where they are scanned; of a longer one than
    BROADCAST_WORDS the rows meet their words by an exchange.
    """
    near = F.broadcast(words) if words.count() <= BROADCAST_WORDS else words
    bit = F.expr(f"shiftright(coalesce(_place_bits, 0L), cast(_place_row % {_ROWS_OF_A_WORD} AS int)) & 1L")
    return (stored.withColumn("_place_word", F.call_function("div", F.col("_place_row"), F.lit(_ROWS_OF_A_WORD)))
            .join(near, ["_place_file", "_place_word"], "inner" if listed else "left").filter(bit == int(listed))
            .select([f"`{c}`" for c in stored.columns if not c.startswith("_place_")]))


def keep_first(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per key: the first by ``order``, of equal ones the first by its place in the files.

    Rows without key are no copies of each other and all stay. Only keys, orders and places are grouped
    and compared; surplus rows are listed as bits by file and row number and dropped where they are scanned,
    so wide rows are not exchanged while the list is small.
    """
    spark, stored = rows.sparkSession, placed(rows)
    path = new_table_path(spark, "keys")
    place = (*order, "_place_file", "_place_row")
    stored.filter(F.col(key).isNotNull()).select(F.col(key).alias("key"), F.struct(*place).alias("place")).write.parquet(path)
    narrow = spark.read.parquet(path)
    first = (narrow.groupBy("key").agg(F.min("place").alias("first"), F.count("*").alias("copies"))
             .filter("copies > 1").select("key", "first"))
    surplus = narrow.join(first, "key").filter(F.col("place") != F.col("first")).select("place._place_file", "place._place_row")
    return rows_by_place(stored, place_words(surplus), listed=False)


def distinct_urls(rows: DataFrame, key: str, order: str) -> DataFrame:
    """(key, first_seen, copies) for every distinct normalised URL."""
    return rows.groupBy(key).agg(F.min(order).alias("first_seen"), F.count("*").alias("copies"))


def duplicate_bodies(docs: DataFrame, order: str = "doc_ord") -> DataFrame:
    """(body_hash, copies, first_url) of every body that occurs more than once.

    Counting needs only hashes and numbers; the URL of each first copy is looked up after.
    """
    groups = (docs.groupBy(F.md5(F.col("body_text").cast("binary")).alias("body_hash"))
              .agg(F.count("*").alias("copies"), F.min(order).alias("first_seen"))
              .filter("copies > 1"))
    firsts = docs.select(F.col(order).alias("first_seen"), F.col("url").alias("first_url"))
    return groups.join(firsts, "first_seen").select("body_hash", "copies", "first_url")
