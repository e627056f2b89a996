"""Connected components of a table of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from recspark.sources.scratch import written


#: Links up to which a round runs in one task, without a shuffle: some 16 bytes each. More links are dealt to all tasks.
FEW_LINKS = 100_000


def _nearest(edges: DataFrame) -> DataFrame:
    """(u, m): each left end with the smallest of itself and its right ends; partial sums come before the shuffle."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _written(edges: DataFrame, name: str) -> tuple[DataFrame, tuple]:
    """``edges`` written, with the number of those that aren't self-links and the sum of all hashes, taken as they are written."""
    seen = Observation()
    out = written(edges.observe(seen, F.count_if(F.col("u") != F.col("v")).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")), name)
    return out, (seen.get.get("n") or 0, seen.get.get("h"))


def _together(edges: DataFrame, n: int) -> DataFrame:
    """``edges`` in one partition if ``n`` are few, so that no step of a round shuffles them."""
    return edges.coalesce(1) if n <= FEW_LINKS else edges


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all ends of ``links`` (a, b), the component being its smallest node. Self-links are allowed.

    Each round points neighbours at the smallest node seen; rounds grow with the logarithm of a component's length. ``links`` are read once.
    """
    given, before = _written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    n = before[0]
    edges = given.where("u <> v")
    while before[0]:
        both = _together(edges, before[0]).select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        large = both.join(_nearest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = _nearest(large)
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, now = _written(_together(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v"), before[0]).distinct(), "stars")
        if now == before:
            break
        before = now
    nodes = _together(given, n).select(F.explode(F.array("u", "v")).alias("node")).distinct()
    return nodes.join(_together(edges, n).withColumnRenamed("u", "node"), "node", "left").select("node", F.coalesce("v", "node").alias("component"))
