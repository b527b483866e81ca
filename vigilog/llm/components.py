"""Connected components with DataFrame operations only.

Large-star and small-star steps alternate: each node hands its smallest neighbour to the larger
(then the smaller) ones, until every component is a star around its smallest node. The number of
steps grows with the logarithm of the longest path. Each step is written to the shared folder,
which cuts the lineage and survives lost executors. Nothing but two numbers a step reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigilog.session import materialize

MOST_STEPS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v) with u > v; the result has that form again.

    Only the smallest neighbours are grouped. A hub's edges stay spread: its row joins them by
    a sort-merge join whose hot partitions adaptive execution splits.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    around = both if large else edges
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    joined = around.join(least, "u").withColumn("m", F.least("m", "u"))
    if large:
        pairs = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        pairs = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return pairs.filter("u > v").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every end of ``edges`` (src, dst); component is its smallest node.

    Rows with a null end, loops and repeated rows are allowed: a loop makes its node a component
    of its own unless other edges join it, a row with a null end says nothing.
    """
    ends = edges.select("src", "dst").filter("src is not null and dst is not null")
    ends = materialize(ends.distinct(), f"{name}-edges")
    stars = ends.filter("src <> dst").select(
        F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")
    )
    before = None
    for step in range(MOST_STEPS):
        stars = materialize(_star(_star(stars, large=True), large=False), f"{name}-{step}")
        now = stars.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if now == before or not now[0]:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MOST_STEPS} steps")
    nodes = ends.select(F.col("src").alias("node")).unionByName(
        ends.select(F.col("dst").alias("node"))
    ).distinct()
    return nodes.join(
        stars.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left"
    ).select("node", F.coalesce("component", "node").alias("component"))
