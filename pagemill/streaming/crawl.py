"""A crawl that goes on as pages arrive.

A state folder holds what every batch adds: extracted pages, their outcomes, their links, and a log of depths
(url, depth). The depth of a URL is the smallest one in the log: more pages only ever shorten ways, so the log is
appended to and never changed. A batch brings new pages; those that were already linked to are expanded at their
depth, and every URL that comes closer is logged and expanded in turn, until none does. Only the URLs that move are
joined with the tables.

Batches have numbers. A batch writes folders of its own and its number last; readers see committed numbers only. A
batch that was cut off is written over when it comes again, one that was committed is passed by.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagemill.operators.crawl import keyed_pages, outcomes_and_links, under_start_url
from pagemill.operators.dedup import place_words, placed, rows_by_place
from pagemill.operators.extract import extract
from pagemill.session import new_table_path

_FIRST = 0      # number of the batch that only logs the start
_TABLES = {
    "outcomes": "url string, outcome string",
    "edges": "src_url string, dst_url string",
    "depths": "url string, depth int, round int",
    "commits": "start_url string, max_depth int",
}


@dataclass(frozen=True)
class ContinuedCrawl:
    """A crawl from ``start_url`` whose state lies in the shared folder ``path``."""
    spark: SparkSession
    path: str
    start_url: str
    max_depth: int | None = None

    def _read(self, name: str, upto: int) -> DataFrame:
        return (self.spark.read.schema(f"{_TABLES[name]}, batch int").parquet(f"{self.path}/{name}")
                .filter(F.col("batch") <= upto))

    def _write(self, frame: DataFrame, name: str, number: int, inside: str = "") -> None:
        frame.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={number}{inside}")

    def committed(self) -> int:
        """Number of the last committed batch; a new folder is given its start."""
        try:
            commits = self.spark.read.schema(f"{_TABLES['commits']}, batch int").parquet(f"{self.path}/commits")
            last = commits.agg(F.max("batch").alias("n"), F.first("start_url").alias("start_url"), F.first("max_depth").alias("max_depth")).first()
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            last = None
        if last is None or last["n"] is None:
            row = self.spark.range(1)
            self._write(row.select(F.lit(self.start_url).alias("url"), F.lit(0).alias("depth")), "depths", _FIRST, "/round=0")
            for name in ("outcomes", "edges"):
                self._write(self.spark.createDataFrame([], _TABLES[name]), name, _FIRST)
            self._commit(_FIRST)
            return _FIRST
        if (last["start_url"], last["max_depth"]) != (self.start_url, self.max_depth):
            raise ValueError(f"{self.path} holds the crawl from {last['start_url']} to depth {last['max_depth']}")
        return last["n"]

    def _commit(self, number: int) -> None:
        row = self.spark.range(1).select(F.lit(self.start_url).alias("start_url"), F.lit(self.max_depth).cast("int").alias("max_depth"))
        self._write(row, "commits", number)

    def extend(self, pages: DataFrame, number: int, page_id: str = "page_id") -> None:
        """Add the pages (page_id, url, html[, http_status]) of batch ``number``, counted from 1.

        The first page of a URL counts: that of the earliest batch, in it that of the smallest ``page_id``. Rows
        without URL are not reachable and dropped; an empty batch changes nothing.
        """
        if number <= self.committed():
            return
        new = self._new_pages(pages, number, page_id)
        outcomes, links = outcomes_and_links(new, self.start_url)
        self._write(outcomes, "outcomes", number)
        self._write(links.select("src_url", "dst_url").distinct(), "edges", number)
        self._relax(number)
        self._commit(number)

    def _new_pages(self, pages: DataFrame, number: int, page_id: str) -> DataFrame:
        """Extract and write the pages of URLs not known yet; html is never shuffled."""
        stored = placed(keyed_pages(pages, self.start_url, page_id))
        known = self._read("outcomes", number - 1).select(F.col("url").alias("key"))
        places = ("form", "id", "_place_file", "_place_row")
        first = (stored.filter("key is not null").select("key", *places).join(known, "key", "left_anti")
                 .groupBy("key").agg(F.min(F.struct(*places)).alias("first")).select("first._place_file", "first._place_row"))
        once = rows_by_place(stored, place_words(first), listed=True)
        self._write(extract(under_start_url(once, self.start_url)), "pages", number)
        return self.spark.read.parquet(f"{self.path}/pages/batch={number}")

    def _depths(self, number: int, rounds: int, urls: DataFrame) -> DataFrame:
        """(url, depth) of those of ``urls`` that were reached before the batch or in its first ``rounds`` rounds."""
        log = self._read("depths", number).filter((F.col("batch") < number) | (F.col("round") < rounds))
        return log.join(urls.select("url"), "url", "left_semi").groupBy("url").agg(F.min("depth").alias("depth"))

    def _relax(self, number: int) -> None:
        outcomes, edges = self._read("outcomes", number), self._read("edges", number)
        accepted = outcomes.filter("outcome = 'crawled'").select("url")
        arrived = outcomes.filter((F.col("batch") == number) & (F.col("outcome") == "crawled"))
        active, rounds = self._depths(number, 0, arrived), 0
        while True:
            if self.max_depth is not None:
                active = active.filter(F.col("depth") < self.max_depth)
            found = self._working(edges.join(active.withColumnRenamed("url", "src_url"), "src_url")
                                  .groupBy(F.col("dst_url").alias("url")).agg((F.min("depth") + 1).alias("depth")))
            before = self._depths(number, rounds, found).withColumnRenamed("depth", "was")
            closer = found.join(before, "url", "left").filter("was is null or depth < was").select("url", "depth")
            self._write(closer, "depths", number, f"/round={rounds}")
            closer = self.spark.read.schema("url string, depth int").parquet(f"{self.path}/depths/batch={number}/round={rounds}")
            rounds += 1
            if closer.isEmpty():
                return
            active = closer.join(accepted, "url", "left_semi")

    def _working(self, frame: DataFrame) -> DataFrame:
        """Written, so that its size is known where it is joined."""
        path = new_table_path(self.spark, "found")
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def visited(self) -> DataFrame:
        """(url, outcome, depth) of all URLs reached so far; a page that has not arrived is an error until it does.

        The rows are those of a :func:`pagemill.operators.crawl.crawl` without page limit over all pages that arrived.
        """
        number = self.committed()
        depths = self._read("depths", number).groupBy("url").agg(F.min("depth").alias("depth"))
        return (depths.join(self._read("outcomes", number).select("url", "outcome"), "url", "left")
                .select("url", F.coalesce("outcome", F.lit("error")).alias("outcome"), "depth"))

    def extracted(self) -> DataFrame:
        """The pages that arrived, as ``crawl_documents`` takes them; needs one committed batch of pages."""
        return self.spark.read.parquet(f"{self.path}/pages").filter(F.col("batch") <= self.committed()).drop("batch")

    def follow(self, pages: DataFrame, page_id: str = "page_id") -> StreamingQuery:
        """Extend the crawl by all pages a stream has now, then stop; called again, it goes on from there.

        The place in the stream is kept in the state folder, so batch numbers and state belong together.
        """
        self.committed()
        return (pages.writeStream.foreachBatch(lambda batch, number: self.extend(batch, number + 1, page_id))
                .option("checkpointLocation", f"{self.path}/place").trigger(availableNow=True).start())
