"""Growing sets of nodes from seeds under a rule, and one-to-one matching in order: loops of joins over all groups at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetlake.functions.storage import materialize

MOST = 9  # members that a growth can have


def grow(arcs: DataFrame, starts: DataFrame, walls: DataFrame, nodes: DataFrame, seeds: DataFrame, allowed: Column, most: int = MOST) -> DataFrame:
    """(growth, members): what each growth reaches from its start without its walls, null where it reaches a node that is not allowed or more than ``most``.

    ``arcs`` has src and dst, both ways; ``starts`` growth and node; ``walls`` growth and node, or node alone where it bounds every growth; ``allowed`` is a condition over the columns of
    ``nodes`` (node and others) and ``seeds`` (growth and others). A growth that fails is dropped at once with all its nodes, and a node with more neighbours than its growth has room
    for fails it before they are fetched, so a round moves at most ``most`` times the room of each growth, whatever a node's degree. As every
    round adds a node, there are at most ``most`` + 1. A node that ``nodes`` lacks is not allowed; a growth whose start is all wall has no members.
    """
    arcs = arcs.select("src", "dst").where("src <> dst").distinct()
    starts = starts.select("growth", "node").distinct()
    if "growth" not in walls.columns:
        common = walls.select("node").distinct()
        arcs, starts = arcs.join(common, F.col("dst") == F.col("node"), "left_anti"), starts.join(common, "node", "left_anti").select("growth", "node")
        walls = starts.where(F.lit(False))
    arcs = materialize(arcs, "arcs")
    degree = materialize(arcs.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("degree")), "degrees")
    walls = materialize(walls.select("growth", "node").distinct(), "walls")
    room = walls.groupBy("growth").agg(F.count(F.lit(1)).alias("walled"))
    fits = F.coalesce(allowed, F.lit(False)) & (F.coalesce("degree", F.lit(0)) <= F.coalesce("walled", F.lit(0)) + most - 1)
    frontier = starts.join(walls, ["growth", "node"], "left_anti")
    members, failed = frontier.withColumn("ok", F.lit(True)).limit(0), frontier.select("growth").limit(0)
    for _ in range(most + 1):
        judged = frontier.join(nodes, "node", "left").join(seeds, "growth", "left").join(degree, "node", "left").join(room, "growth", "left")
        members = members.unionAll(materialize(judged.select("growth", "node", fits.alias("ok")), "judged"))
        counts = members.groupBy("growth").agg(F.count(F.lit(1)).alias("n"), F.bool_and("ok").alias("ok"))
        failed = materialize(failed.unionAll(counts.where(~F.col("ok") | (F.col("n") > most)).select("growth")), "failed")
        members = materialize(members.join(failed, "growth", "left_anti"), "members")
        reached = members.join(frontier, ["growth", "node"], "left_semi").join(arcs, F.col("node") == F.col("src")).select("growth", F.col("dst").alias("node")).distinct()
        frontier = materialize(reached.join(walls, ["growth", "node"], "left_anti").join(members, ["growth", "node"], "left_anti"), "reached")
        if frontier.isEmpty():
            break
    sets = members.groupBy("growth").agg(F.sort_array(F.collect_list("node")).alias("members"))  # at most ``most`` each
    all_growths = seeds.select("growth").distinct()
    found = all_growths.join(sets, "growth", "left").join(failed.distinct().withColumn("_failed", F.lit(True)), "growth", "left")
    return found.select("growth", F.when(F.col("_failed").isNull(), F.coalesce("members", F.array().cast(sets.schema["members"].dataType))).alias("members"))


def match_in_order(pairs: DataFrame, left: str = "left", right: str = "right", group: tuple[str, ...] = ()) -> DataFrame:
    """One-to-one matches out of the pairs that may match: what comes out when each left, in order, takes the smallest right still free.

    Rounds of proposals instead of a loop over rows: each left proposes to the smallest right it still has, each right keeps its smallest proposer, and every pair of
    that right with a larger left falls away for good, as a right's holder only ever gets smaller. When each proposal is kept, the proposals are the
    matches. Rounds are at most as many as lefts compete for the same rights in one group; all groups go on at once.
    """
    on = [*group]
    now = materialize(pairs.select(*on, F.col(left).alias("left"), F.col(right).alias("right")).distinct(), "pairs")
    while True:
        asked = now.groupBy(*on, "left").agg(F.min("right").alias("right"))
        held = materialize(asked.groupBy(*on, "right").agg(F.min("left").alias("holder"), F.count(F.lit(1)).alias("n")), "held")
        if held.where("n > 1").isEmpty():
            return held.select(*on, F.col("holder").alias(left), F.col("right").alias(right))
        now = materialize(now.join(held, [*on, "right"], "left").where("holder IS NULL OR left <= holder").drop("holder", "n"), "pairs")
