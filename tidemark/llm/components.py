"""Connected components of links, by labels that fall to the least of their neighbours'."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise


def components(links: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Columns ``node`` and ``label`` for every node of ``links`` (columns ``x``, ``y``) and of ``before``.

    ``label`` is the least node of the component.  ``before`` are labels found from some of the
    links already.  Each round a label falls to the least among its node's neighbours and then to
    the label of that, so that long chains shorten by half; the rounds are written tables.
    """
    both = links.select("x", "y").union(links.select("y", "x")).distinct()
    edges = materialise(both.toDF("x", "y"), "links")
    labels = edges.select(F.col("x").alias("node")).distinct().withColumn("label", F.col("node"))
    if before is not None:
        known = before.select("node", F.col("label").alias("known"))
        labels = labels.join(known, "node", "full").select("node", F.coalesce("known", "label").alias("label"))
        # Nodes that were one component before stay linked through its label.
        kept = before.where("node <> label").select(F.col("node").alias("x"), F.col("label").alias("y"))
        edges = materialise(edges.union(kept).union(kept.select("y", "x")).distinct(), "links")
    labels = materialise(labels, "labels")
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("y"), "label"), "y")
            .groupBy(F.col("x").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        fallen = labels.join(near, "node", "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label")
        )
        fallen = materialise(fallen, "labels")
        above = fallen.select(F.col("node").alias("label"), F.col("label").alias("above"))
        jumped = fallen.join(above, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("above", "label")).alias("label")
        )
        jumped = materialise(jumped, "labels")
        labels = jumped.drop("old")
        if jumped.where("old <> label").isEmpty():
            return labels
