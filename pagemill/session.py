"""Session defaults and the shared working folder for materialised steps."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# One html row can be megabytes, so Arrow batches are kept short.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "pagemill", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    A temporary folder stands in only for a local master, where driver and
    executors are one process on one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="pagemill-")
    return _LOCAL_DIRS[app]


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="pagemill-code-"), "pagemill")
        spark.sparkContext.addPyFile(shutil.make_archive(
            archive, "zip", root_dir=os.path.dirname(package), base_dir=os.path.basename(package)))
        _SHIPPED.add(app)


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def bucketed_table(frame: DataFrame, name: str, *columns: str, partition: str | None = None, into: str | None = None) -> str:
    """Write rows as a table bucketed by ``columns``, or add them to the table ``into``; its name.

    There are as many buckets as shuffle partitions, so a join or grouping by these columns meets shuffled
    rows bucket by bucket and the table itself never moves again. Each bucket is written by one task.
    """
    spark = frame.sparkSession
    number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = into or f"{name}_{uuid.uuid4().hex}"
    writer = frame.repartition(number, *columns).write.format("parquet").bucketBy(number, *columns)
    if partition:
        writer = writer.partitionBy(partition)
    if into is None:
        writer = writer.option("path", new_table_path(spark, name))
    writer.mode("append" if into else "error").saveAsTable(table)
    return table
