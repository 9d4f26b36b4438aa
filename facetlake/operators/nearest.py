"""The nearest point of another group, exactly: a join over grid cells that widens until nothing outside can be nearer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.functions.storage import materialize


def nearest_other(points: DataFrame, key: str, coordinates: list[str], group: str, rows_per_cell: int = 32, rounds: int = 60) -> DataFrame:
    """(key, other, distance2): for each point the nearest one of another group by squared distance, ties to the smaller key; points with no other group are left out.

    Points of one place and group are one site with their smallest key, so copies cost nothing. The grid starts so fine that no cell holds
    more than ``rows_per_cell`` sites, as far as halving its side sixteen times can do it. Each round meets the sites that are still open with those of the cells
    around their own; what is nearer than a cell's side is settled, as everything else is farther, and the side doubles for the rest. Sites far
    from all others stay open longest and meet coarse cells: their number, not that of all sites, multiplies with a coarse cell's.
    Points with a null or NaN coordinate, a null group or a null key take no part.
    """
    x = [f"_x{i}" for i in range(len(coordinates))]
    clean = points.select(F.col(key).alias("_key"), F.col(group).alias("_group"), *[F.col(c).cast("double").alias(n) for c, n in zip(coordinates, x)])
    clean = clean.where(reduce(lambda a, b: a & b, [~F.isnan(n) & F.col(n).isNotNull() for n in x], F.col("_key").isNotNull() & F.col("_group").isNotNull()))
    sites = materialize(clean.groupBy(*x, "_group").agg(F.min("_key").alias("_key")), "sites")
    span = sites.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("_group").alias("groups"), *[F.min(n).alias(f"low{i}") for i, n in enumerate(x)], *[F.max(n).alias(f"high{i}") for i, n in enumerate(x)]).first()
    found = None
    if span.groups > 1:
        low = [span[f"low{i}"] for i in range(len(x))]
        extent = max(span[f"high{i}"] - low[i] for i in range(len(x))) or 1.0
        side = extent / max(1.0, span.n ** (1 / len(x)))
        cells = lambda d, s: [F.floor((F.col(n) - a) / s).alias(f"_c{i}") for i, (n, a) in enumerate(zip(x, low))]
        for _ in range(16):
            fullest = sites.groupBy(*cells(sites, side)).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
            if fullest <= rows_per_cell:
                break
            side /= 2
        names = [f"_c{i}" for i in range(len(x))]
        right = [F.col("_key").alias("_other"), F.col("_group").alias("_theirs"), *[F.col(n).alias(f"_y{n}") for n in x]]
        distance = reduce(lambda a, b: a + b, [(F.col(n) - F.col(f"_y{n}")) * (F.col(n) - F.col(f"_y{n}")) for n in x])
        open_sites, settled = sites, []
        for _ in range(rounds):
            around = open_sites.select("*", *cells(open_sites, side))
            for c in names:
                around = around.withColumn(c, F.explode(F.array(F.col(c) - 1, F.col(c), F.col(c) + 1)))
            met = around.join(sites.select(*right, *cells(sites, side)), names).where(F.col("_group") != F.col("_theirs"))
            best = met.groupBy("_key", "_group", *x).agg(F.min(F.struct(distance.alias("d2"), F.col("_other").alias("other"))).alias("best"))
            done = extent <= side  # the cells around hold everything
            near = best if done else best.where(F.col("best.d2") <= (side * (1 - 1e-9)) ** 2)
            near = materialize(near.select("_key", "_group", *x, F.col("best.other").alias("_other"), F.col("best.d2").alias("_d2")), "near")
            settled.append(near)
            if done:
                break
            open_sites = materialize(open_sites.join(near.select("_key", "_group"), ["_key", "_group"], "left_anti"), "open")
            if open_sites.isEmpty():
                break
            side *= 2
        found = reduce(DataFrame.unionByName, settled)
    if found is None:
        found = sites.where(F.lit(False)).select("_key", "_group", *x, F.col("_key").alias("_other"), F.lit(0.0).alias("_d2"))
    # Back from sites to their points: written tables on both sides, so that a place which many points share is split.
    return clean.join(materialize(found.drop("_key"), "found"), [*x, "_group"]).select(F.col("_key").alias(key), F.col("_other").alias("other"), F.col("_d2").alias("distance2"))
