"""Working tables in the shared folder, and connected components over written edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemill.session import new_table_path


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table of the shared folder: cuts the lineage, survives lost executors."""
    spark = frame.sparkSession
    path = new_table_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def without(frame: DataFrame, *names: str) -> DataFrame:
    """The frame without the columns that an operator is about to add."""
    taken = {n.lower() for n in names}
    return frame.select(*[frame[f"`{c}`"] for c in frame.columns if c.lower() not in taken])


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable over the edges (a, b), for every node with an edge.

    Each round hooks every node to its smallest neighbour, follows the hooks to their roots by
    pointer jumping, and goes on with the edges between different roots. Neighbours are reduced by
    partial aggregates, so a node with very many edges costs no task more than others.
    """
    edges = written(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a <> b").distinct(), "edges")
    found = None
    while not edges.isEmpty():
        both = edges.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                            .alias("e")).select("e.a", "e.b")
        hooks = written(both.groupBy("a").agg(F.min("b").alias("low"))
                        .select(F.col("a").alias("node"), F.least("a", "low").alias("root")), "hooks")
        while True:
            above = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            jumped = written(hooks.join(above, "root").select(
                "node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "hooks")
            hooks = jumped.select("node", "root")
            if jumped.filter("moved").isEmpty():
                break
        found = hooks if found is None else written(
            found.join(hooks.withColumnRenamed("node", "old").withColumnRenamed("root", "new"),
                       F.col("root") == F.col("old"), "left")
            .select("node", F.coalesce("new", "root").alias("root")), "components")
        left = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = written(edges.join(left, "a").join(right, "b")
                        .select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b"))
                        .filter("a <> b").distinct(), "edges")
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.select("node", F.col("root").alias("component"))
