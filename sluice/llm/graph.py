"""Connected components of a link table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialize

MAX_ROUNDS = 60


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` for every node of ``links``; the component is its
    smallest node.  Nodes without links are not in the result, nor are links
    with a null end or between a node and itself; an empty table gives no rows.

    Each round hooks every node's present root to the smallest root among its
    neighbours and then halves the paths, so the rounds grow with the
    logarithm of the longest chain.  Group minima combine on the map side, and
    the joins are plain equi-joins whose hot keys adaptive execution may
    split.  Each round's labels are written to the shared folder.
    """
    both = links.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = materialize(both.unionByName(both.select(F.col("y").alias("x"), F.col("x").alias("y"))).filter("x <> y").distinct(), "links")
    labels = materialize(both.groupBy(F.col("x").alias("node")).agg(F.least(F.col("x"), F.min("y")).alias("root")), "roots")
    for _ in range(MAX_ROUNDS):
        of_y = labels.select(F.col("node").alias("y"), F.col("root").alias("near"))
        # The smallest root in sight of each root's nodes becomes its parent.
        seen = both.join(of_y, "y").groupBy(F.col("x").alias("node")).agg(F.min("near").alias("near")).join(labels, "node")
        hooks = seen.groupBy(F.col("root").alias("old")).agg(F.min("near").alias("near")).filter("near < old")
        hooked = materialize(
            labels.join(hooks, labels["root"] == hooks["old"], "left").select("node", F.least("root", F.coalesce("near", "root")).alias("root"), F.col("near").isNotNull().alias("moved")), "hooked"
        )
        if not hooked.filter("moved").limit(1).count():
            return hooked.select("node", F.col("root").alias("component"))
        up = hooked.select(F.col("node").alias("root"), F.col("root").alias("top"))
        labels = materialize(hooked.select("node", "root").join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots")
    raise RuntimeError(f"components still change after {MAX_ROUNDS} rounds")
