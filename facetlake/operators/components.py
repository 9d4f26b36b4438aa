"""Connected components with the smallest member as label, as a loop of distributed joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.functions.storage import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node on an edge; nulls and loops join nothing but a loop's node is returned.

    Alternating large-star and small-star steps: every step points nodes at the smallest neighbour, so chains
    halve and stars stay stars. The minima are written out before they are joined, which leaves two plain exchanges that
    AQE can split when one node holds a large share of the edges. No side is broadcast, however small: each round would send its minima through the driver.
    """
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    loops = pairs.where("u = v").select(F.col("u").alias("node"))
    now = materialize(pairs.where("u > v").distinct(), "edges")
    nodes = now.select(F.col("u").alias("node")).union(now.select(F.col("v").alias("node"))).union(loops).distinct()

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
        least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "minima")
        joined = both.join(least.hint("merge"), "u")
        if large:  # the larger neighbours of u move to the smallest one; u itself moves on its own turn
            out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            own = least.where("m < u").select("u", F.col("m").alias("v"))
        else:
            out = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            own = least.where("m < u").select("u", F.col("m").alias("v"))
        return materialize(out.unionAll(own).where("u > v").distinct(), "edges")

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit((1 << 40) - 1))), F.lit(0))).first())

    before = None
    while (after := mark(now)) != before:
        before = after
        now = star(star(now, True), False)
    return nodes.join(now.select(F.col("u").alias("node"), F.col("v").alias("component")).hint("merge"), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
