"""Connected components of a graph given as a table of links, without links or labels on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, comp): the least node of its component for each end of links (a, b). Each round takes the least label next to a node, then the label of that label; chains halve, and each round is a table."""
    both = scratch.put(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{name}-links")
    labels = scratch.put(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), f"{name}-labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("near"))
        mine = labels.join(near, labels["node"] == near["a"], "left").select("node", F.col("comp").alias("old"), F.least("comp", F.coalesce("near", "comp")).alias("new"))
        jump = labels.select(F.col("node").alias("at"), F.col("comp").alias("beyond"))
        nxt = mine.join(jump, mine["new"] == jump["at"], "left").select("node", "old", F.least("new", F.coalesce("beyond", "new")).alias("comp"))
        nxt = scratch.put(nxt, f"{name}-labels")
        labels = nxt.select("node", "comp")
        if nxt.filter("old <> comp").isEmpty():
            return labels
