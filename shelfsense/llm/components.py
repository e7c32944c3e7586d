"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsense.llm.common import stored
from shelfsense.session import Rounds


def connected_components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """Smallest node reachable from each node of `links` (a, b): (node, component).

    After `rounds` rounds, if given, it ends early: nodes of one label are connected then, but
    connected nodes may still have different labels.

    Every round gives a node the smallest label among its neighbours, then replaces a label by the
    label of that node, so labels cover twice the distance in each round. Minima are partially
    aggregated, so a node with very many links is no hot key of a group. Labels are written each
    round, with a mark where they changed, and those of the round before are dropped; only whether
    any did reaches the driver.
    """
    both = stored(links.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))).distinct())
    least, jumped = Rounds(links.sparkSession), Rounds(links.sparkSession)
    labels = jumped.store(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("component")))
    done = 0
    while True:
        own = labels.select("node", "component", F.col("component").alias("before"))
        offered = both.join(labels, both["b"] == labels["node"]).select(F.col("a").alias("node"), "component", F.lit(None).cast(labels.schema["node"].dataType).alias("before"))
        nearest = least.store(own.unionByName(offered).groupBy("node").agg(F.min("component").alias("component"), F.max("before").alias("before")))
        roots = nearest.select(F.col("node").alias("component"), F.col("component").alias("root"))
        shorter = F.least("component", "root")
        labels = jumped.store(nearest.join(roots, "component").select("node", shorter.alias("component"), (shorter != F.col("before")).alias("changed")))
        done += 1
        if done == rounds or labels.filter("changed").isEmpty():
            return labels.select("node", "component")
