"""Connected components of a graph given as a table of links, by labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the label is the smallest node it can reach.

    A round gives each node the smallest label among itself and its neighbours, then the label's own
    label, twice; rounds end when nothing changes. Labels lie in the shared folder between rounds;
    the driver sees one count a round.
    """
    edges = stored(
        links.select(F.col("a").alias("u"), F.col("b").alias("v"))
        .union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
        .filter("u <> v")
        .distinct(),
        "edges",
    )
    near = edges.groupBy("u").agg(F.min("v").alias("least"))
    labels = stored(near.select(F.col("u").alias("node"), F.least("u", "least").alias("label")), "labels")
    while True:
        seen = edges.join(labels.withColumnsRenamed({"node": "v", "label": "theirs"}), "v")
        seen = seen.groupBy("u").agg(F.min("theirs").alias("theirs"))
        new = labels.join(seen.withColumnRenamed("u", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "theirs").alias("label")
        )
        for _ in range(2):
            above = labels.select(F.col("node").alias("label"), F.col("label").alias("top"))
            new = new.join(above, "label", "left").select("node", "old", F.least("label", F.coalesce("top", "label")).alias("label"))
        new = stored(new, "labels")
        labels = new.select("node", "label")
        if not new.filter("label <> old").limit(1).count():
            return labels
