"""Connected components by label propagation with root hooking and shortcuts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from marketlane.llm.common import scratch, stored, stored_counted


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (a, b); root is the least node reached.

    Each step gives every node, and every node's root, the least root among its
    neighbours, then follows roots of roots; the number of steps grows with the
    logarithm of the longest chain. Labels are written to the shared folder in each
    step and read back: the lineage stays short, and since both sides of the join on edges
    are plain scans, a hub with very many edges is split by AQE. Null ends and
    loops link nothing. No edges: no rows.
    """
    with scratch(edges.sparkSession) as keep:
        return _propagated(edges, keep)


def _propagated(edges: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    links = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    both, size = stored_counted(links.union(links.select("b", "a")).distinct(), "links")
    first = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("root"))
    labels = stored(first, "labels", size)
    while True:
        seen = both.join(labels.select("node", "root"), F.col("b") == F.col("node")).groupBy("a").agg(F.min("root").alias("near"))
        mine = labels.select("node", "root").join(seen, F.col("node") == F.col("a")).select("node", "root", "near")
        # A node takes the least root near it; so does its root.
        own = mine.select("node", F.least("root", "near").alias("to"), F.col("root").alias("was"))
        theirs = mine.filter("near < root").select(F.col("root").alias("node"), F.col("near").alias("to"))
        hooked = own.unionByName(theirs, allowMissingColumns=True).groupBy("node")
        hooked = stored(hooked.agg(F.min("to").alias("to"), F.min("was").alias("was")), "hooked", size)
        jump = hooked.select(F.col("node").alias("mid"), F.col("to").alias("far"))
        moved = hooked.join(jump, F.col("to") == F.col("mid")).select("node", F.col("far").alias("root"), "was")
        changed = Observation()
        moved = moved.observe(changed, F.count_if(F.col("root") != F.col("was")).alias("n"))
        labels = stored(moved, "labels", size)
        if not changed.get["n"]:
            return keep(labels).select("node", "root")
