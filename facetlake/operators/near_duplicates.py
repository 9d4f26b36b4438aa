"""Near-duplicate parts by tolerant signatures: a band join that only meets neighbours, and components."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetlake.functions.constants import NEAR_BOX_ABSOLUTE, NEAR_BOX_RELATIVE, NEAR_RELATIVE
from facetlake.functions.storage import materialize
from facetlake.operators.components import connected_components


def signatures(parts: DataFrame, part: str, volume: Column, area: Column, dims: Column) -> DataFrame:
    """One row per distinct signature: its smallest part, its parts' number, and the values with the dimensions in order."""
    rows = parts.select(F.col(part).alias("part"), volume.cast("double").alias("volume"), area.cast("double").alias("area"), F.array_sort(dims.cast("array<double>")).alias("dims"))
    return rows.groupBy("volume", "area", "dims").agg(F.min("part").alias("part"), F.count(F.lit(1)).alias("members"))


def is_near(a: Column, b: Column, relative: float = NEAR_RELATIVE) -> Column:
    """Whether two structs (volume, area, dims) match within tolerance; nothing is binned, so no match is lost at an edge."""
    close = lambda x, y: F.abs(x - y) <= relative * F.greatest(F.abs(x), F.abs(y))
    box = F.forall(F.zip_with(a["dims"], b["dims"], lambda x, y: F.abs(x - y) <= NEAR_BOX_ABSOLUTE + NEAR_BOX_RELATIVE * F.greatest(x, y)), lambda ok: ok)
    return close(a["volume"], b["volume"]) & close(a["area"], b["area"]) & box


def near_duplicate_pairs(distinct: DataFrame, relative: float = NEAR_RELATIVE) -> DataFrame:
    """(a, b), a < b, of distinct signatures within tolerance.

    Volumes and areas fall into logarithmic bands a little wider than the tolerance, so matches are in the same or the next band of each;
    one side stands in the nine bands around its own, and the join is a hash join on both. Negative values have bands of their own in the
    same way, as no tolerance reaches over zero, and zero matches zero alone.
    """
    width = 1.01 * -math.log1p(-relative)
    size = lambda v: F.floor(F.log(F.abs(v)) / width)
    band = lambda v: F.when(v > 0, size(v)).when(v < 0, (1 << 40) + size(v)).otherwise(F.lit(-(1 << 40)))  # noqa: E731  # sizes are far smaller than 2^40
    rows = distinct.select("part", F.struct("volume", "area", "dims").alias("s"), band(F.col("volume")).alias("kv"), band(F.col("area")).alias("ka"))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    left = rows.withColumn("d", F.explode(steps)).select(F.col("part").alias("a"), F.col("s").alias("sa"), (F.col("kv") + F.col("d.i")).alias("kv"), (F.col("ka") + F.col("d.j")).alias("ka"))
    right = rows.select(F.col("part").alias("b"), F.col("s").alias("sb"), "kv", "ka")
    return left.join(right.hint("merge"), ["kv", "ka"]).where((F.col("a") < F.col("b")) & is_near(F.col("sa"), F.col("sb"), relative)).select("a", "b")


def near_duplicate_clusters(parts: DataFrame, part: str, volume: Column, area: Column, dims: Column) -> DataFrame:
    """(part, cluster) of parts in clusters of two and more; the cluster is its smallest part. Equal signatures join without pairs."""
    distinct = materialize(signatures(parts, part, volume, area, dims), "signatures")
    linked = connected_components(near_duplicate_pairs(distinct))
    heads = distinct.join(linked.hint("merge"), distinct["part"] == linked["node"], "left").select("volume", "area", "dims", F.coalesce("component", "part").alias("cluster"), "members", F.col("component").isNotNull().alias("linked"))
    heads = materialize(heads.where("linked or members > 1"), "heads")
    rows = parts.select(F.col(part).alias("part"), volume.cast("double").alias("volume"), area.cast("double").alias("area"), F.array_sort(dims.cast("array<double>")).alias("dims"))
    return rows.join(heads.hint("merge"), ["volume", "area", "dims"]).select("part", "cluster")
