"""Connected components of a graph given by its links, by alternating star operations.

A star operation links the neighbours of a node to the smallest of them. Alternating between larger and smaller
neighbours turns every component into one star around its smallest node, in a number of rounds that grows with the
logarithm of the longest path. Links stay in the shared folder; nothing of them comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.session import materialize

MOST_ROUNDS = 60


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """links (a, b) with a > b; the result has the same form, repeats included."""
    if larger:
        around = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        center = around.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        moved = around.join(center, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        center = links.groupBy("a").agg(F.min("b").alias("m"))
        moved = links.join(center, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = moved.unionByName(center.select("a", F.col("m").alias("b")))
    return moved.filter("a > b")


def _is_stars(links: DataFrame) -> bool:
    """Whether every node has one link upwards at most, and none if it has links from below."""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1").isEmpty()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; root is the smallest node of its component.

    `links` has two columns of one type; direction, repeats and links of a node to itself do not matter.
    """
    one, two = (F.col(c) for c in links.columns)
    now = materialize(links.select(F.greatest(one, two).alias("a"), F.least(one, two).alias("b")).filter("a > b").distinct(), "links")
    for _ in range(MOST_ROUNDS):
        if _is_stars(now):
            roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        now = materialize(_star(_star(now, larger=True), larger=False).distinct(), "links")
    raise RuntimeError("the components did not settle")
