"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starloom.session import written_once


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for each node of ``edges`` (a, b); the label is the smallest node of its component.

    Labels spread along the edges and are then shortened through the labels' own labels, until nothing
    changes: about log2 of a component's diameter in rounds. All joins read written tables on both sides,
    so that the partition of a node with very many edges can be split, and so that a lost executor costs
    no more than the round it is lost in.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written_once(both.where("a <> b").distinct(), "component-edges")
    labels = written_once(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select(
            "node", F.least("node", "label").alias("label")
        ),
        "component-labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "a"), "a")
            .groupBy(F.col("b").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        spread = written_once(
            labels.join(near, "node").select("node", F.least("label", "near").alias("label"), F.col("label").alias("old")),
            "component-spread",
        )
        of = spread.select(F.col("node").alias("label"), F.col("label").alias("shorter"))
        after = written_once(
            spread.join(of, "label").select("node", F.col("shorter").alias("label"), "old"), "component-labels"
        )
        changed = after.where("label <> old").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels
