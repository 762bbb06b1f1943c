"""Connected components by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import settled


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is named by its smallest node.

    Each round gives every node the smallest name among its own and its neighbours', then
    follows names twice. Names pass through partial aggregation, so a hub is no hot spot.
    """
    links = links.where("a != b").select("a", "b")
    both = settled(links.union(links.select("b", "a")).distinct(), "links")
    names = settled(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")), "names")
    while True:
        heard = both.join(names.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("heard"))
        moved = names.join(heard, "node").select("node", F.col("component").alias("before"), F.least("component", "heard").alias("component"))
        moved = settled(moved, "moved")
        for _ in range(2):
            ahead = moved.select(F.col("node").alias("n"), F.col("component").alias("further"))
            moved = moved.join(ahead, F.col("component") == F.col("n")).select("node", "before", F.least("component", "further").alias("component"))
        moved = settled(moved, "names")
        names = moved.select("node", "component")
        if moved.where("component != before").isEmpty():
            return names
