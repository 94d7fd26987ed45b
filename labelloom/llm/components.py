"""Connected components of a table of links, by label passing with jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` of all nodes that (a, b) links touch; the root is the least node.

    Every round, a node takes the least root among its neighbours' and then its root's root,
    so rounds grow with the logarithm of a component's width. A round reads and writes
    tables in the shared folder, which lets the optimizer split hot nodes' rows; minima are
    taken inside tasks before rows are shuffled.
    """
    edges = written(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a != b").distinct(),
        "edges",
    )
    labels = written(edges.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("root")), "labels")
    while True:
        heard = (
            edges.join(labels, edges.b == labels.node)
            .groupBy("a").agg(F.min("root").alias("heard"))
        )
        told = written(
            labels.join(heard, labels.node == heard.a).select(
                "node", F.col("root").alias("was"), F.least("root", "heard").alias("root")),
            "labels",
        )
        roots = told.select(F.col("node").alias("at"), F.col("root").alias("far"))
        labels = written(
            told.join(roots, F.col("root") == F.col("at")).select("node", "was", "far")
            .withColumnRenamed("far", "root"),
            "labels",
        )
        if labels.where("root != was").limit(1).count() == 0:
            return labels.select("node", "root")
        labels = labels.select("node", "root")
