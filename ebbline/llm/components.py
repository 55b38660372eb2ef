"""Connected components of a link table, by joins and aggregates only.

Every round hooks a node to its smallest neighbour, flattens the trees by pointer
jumping, and contracts the links.  Aggregates are minima, which combine before the
shuffle, and joins look up tables with one row per key, so a node linked with a third
of all others is split by adaptive skew handling instead of landing in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import keep


def _flat(tree: DataFrame) -> DataFrame:
    """(node, parent) with every parent a root: parents' parents until none moves."""
    while True:
        up = tree.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        jumped = keep(
            tree.join(up, "parent", "left").select(
                "node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")
            ),
            "component-tree",
        )
        tree = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            return tree


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) of every node that isn't the smallest of its component.

    Links may repeat, point both ways or join a node with itself; a null end is no link.
    Nodes that aren't returned are their own component.
    """
    low, high = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    pairs = keep(links.where(F.col(a) != F.col(b)).select(low.alias("low"), high.alias("high")).distinct(), "component-links")
    labels = None
    while not pairs.isEmpty():
        tree = _flat(keep(pairs.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("parent")), "component-hooks"))
        if labels is None:
            labels = tree
        else:
            up = tree.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            labels = keep(
                labels.join(up, "parent", "left").select("node", F.coalesce("above", "parent").alias("parent")).unionByName(tree),
                "component-labels",
            )
        lows = tree.select(F.col("node").alias("low"), F.col("parent").alias("low_root"))
        highs = tree.select(F.col("node").alias("high"), F.col("parent").alias("high_root"))
        ends = (
            pairs.join(lows, "low", "left")
            .join(highs, "high", "left")
            .select(F.coalesce("low_root", "low").alias("x"), F.coalesce("high_root", "high").alias("y"))
            .where("x != y")
        )
        pairs = keep(ends.select(F.least("x", "y").alias("low"), F.greatest("x", "y").alias("high")).distinct(), "component-links")
    if labels is None:
        return pairs.select(F.col("low").alias("node"), F.col("high").alias("component"))
    return labels.select("node", F.col("parent").alias("component"))
