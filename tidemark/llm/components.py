"""Connected components of a link table, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b): component is the smallest node reachable.

    Each round points every node at the smallest label among itself and its
    neighbours, lets the old label learn of the new one, and then follows labels of
    labels, so that long chains shrink by a factor each round.  Aggregates combine on
    the map side and joins are plain equi-joins, so a hub with any number of links is
    split.  Null ends and self links are ignored; no links give no rows."""
    links = links.filter("a is not null and b is not null and a <> b")
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component"))
    for _ in range(most_rounds):
        near = both.join(labels.select(F.col("node").alias("b"), F.col("component").alias("m")), "b").groupBy("a").agg(F.min("m").alias("m"))
        hooked = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", "component", F.least("component", "m").alias("low"))
        # what a node has learnt also holds for the label it had
        taught = hooked.filter("low < component").groupBy(F.col("component").alias("node")).agg(F.min("low").alias("taught"))
        told = hooked.join(taught, "node", "left").select("node", F.col("component").alias("old"), F.least("low", F.coalesce("taught", "low")).alias("low"))
        step = stored(told, "labels")
        if not step.filter("low <> old").limit(1).count():
            return step.select("node", F.col("low").alias("component"))
        labels = step.join(step.select(F.col("node").alias("low"), F.col("low").alias("next")), "low", "left").select(
            "node", F.least("low", F.coalesce("next", "low")).alias("component"))
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
