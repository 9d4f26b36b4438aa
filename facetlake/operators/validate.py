"""Checks of a sample's outputs, and the decision over a diagnosed shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetlake.functions import vectors as v
from facetlake.functions.constants import DEFAULT_CONFIG

_REPAIR = DEFAULT_CONFIG["repair"]


def shape_code(solids: Column, closed: Column, valid: Column, repaired_valid: Column, deviation: Column, volume_change: Column) -> Column:
    """The verdict on a diagnosed and, where needed, repaired shape: null passes. A kernel fills the columns."""
    beyond = (deviation > _REPAIR["max_deviation_mm"]) | (F.abs(volume_change) > _REPAIR["max_relative_volume_change"])
    return F.when(solids > 1, "MULTI_BODY").when((solids == 0) | ~closed, "NO_SOLID").when(valid, F.lit(None)).when(~F.coalesce(repaired_valid, F.lit(False)), "INVALID_GEOMETRY").when(beyond, "REPAIR_DEVIATION_EXCEEDED")


def mesh_checks(triangles: DataFrame, faces: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """One row a sample: face ids in range, every face has triangles, and the mesh's area is within 2 % of the faces'."""
    area = v.triangle_area(F.col("a"), F.col("b"), F.col("c"))
    mesh = triangles.groupBy("sample_id").agg(F.countDistinct("face_idx").alias("hit"), F.min("face_idx").alias("low"), F.max("face_idx").alias("high"), F.sum(area).alias("mesh_area"))
    own = faces.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"), F.sum("area_mm2").alias("area"))
    rows = own.join(mesh, "sample_id", "left")
    no = F.lit(False)
    return rows.select("sample_id", F.coalesce((F.col("low") >= 0) & (F.col("high") < F.col("n")), no).alias("mesh_faces_in_range"), F.coalesce(F.col("hit") == F.col("n"), no).alias("every_face_triangulated"), F.coalesce(F.abs(F.col("mesh_area") - F.col("area")) <= tolerance * F.col("area"), no).alias("mesh_area_close"))


def evenly(k: Column, n: Column, most: int) -> Column:
    """Whether number k of n, from 0, is one of the ``most`` whole parts of evenly spaced numbers from 0 to n - 1; all of them where there are no more."""
    step = (n - 1).cast("double") / (most - 1)
    j = F.floor(k / step)  # one of this and the next falls on k, if any does; the last number is always k = n - 1
    falls = lambda i: (i < most - 1) & (F.floor(i * step) == k)
    return (n <= most) | (k == n - 1) | falls(j) | falls(j + 1)


def view_checks(pixels: DataFrame, faces: DataFrame, most: int = 400, tolerance: float = 1.0) -> DataFrame:
    """One row a sample: pixel face ids are faces, and evenly spaced pixels of every view, at most ``most`` from the first to the last, lie within the tolerance of their face's box.

    ``pixels`` has the unprojected point p; the thinning is the check's own feature.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("sample_id", "view").orderBy("row", "col")
    placed = pixels.withColumn("k", F.row_number().over(w) - 1).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("sample_id", "view")))
    picked = placed.where(evenly(F.col("k"), F.col("n"), most))
    off = F.greatest(*[F.greatest(F.col("bbox_min_mm")[k] - F.col("p")[k], F.col("p")[k] - F.col("bbox_max_mm")[k]) for k in "xyz"])
    near = picked.join(faces, ["sample_id", "face_idx"], "left").groupBy("sample_id").agg((F.max(F.coalesce(off, F.lit(float("inf")))) <= tolerance).alias("pixels_near_face"))
    known = pixels.join(faces.select("sample_id", "face_idx", F.lit(True).alias("is_face")), ["sample_id", "face_idx"], "left").groupBy("sample_id").agg(F.bool_and(F.coalesce("is_face", F.lit(False))).alias("mask_ids_valid"))
    return known.join(near, "sample_id")


def feature_coverage(features: DataFrame, faces: DataFrame) -> DataFrame:
    """One row a sample: whether each face is in a feature."""
    named = features.select("sample_id", F.explode("face_indices").alias("face_idx")).distinct().withColumn("named", F.lit(True))
    return faces.join(named, ["sample_id", "face_idx"], "left").groupBy("sample_id").agg(F.bool_and(F.coalesce("named", F.lit(False))).alias("every_face_assigned"))


def round_trip(written: DataFrame, read: DataFrame, name: str = "graph_round_trip") -> DataFrame:
    """One row a sample: whether the rows that were written are those that are read back, repeated ones included."""
    lost, new = written.exceptAll(read).select("sample_id"), read.exceptAll(written).select("sample_id")
    return written.select("sample_id").distinct().join(lost.unionAll(new).distinct().withColumn("changed", F.lit(True)), "sample_id", "left").select("sample_id", F.col("changed").isNull().alias(name))


def output_checks(faces: DataFrame, face_edge: DataFrame, graph: dict[str, DataFrame], points: DataFrame, triangles: DataFrame, pixels: DataFrame, features: DataFrame, reread: DataFrame) -> DataFrame:
    """(sample_id, failed, code) over all 19 checks of a sample's outputs: seven of the graph, five of its points, three of the mesh, two of the views, the features' coverage, and the arcs as read back.

    ``graph`` has "pairs" and "nodes"; ``reread`` is the table of pairs as it was stored.
    """
    from facetlake.operators import cloud
    from facetlake.operators import graph as graphs

    own = [graphs.invariants(faces, graph["pairs"], graph["nodes"], face_edge), cloud.cloud_checks(points, faces, cloud.normalization(points.select("sample_id", "p.*")))]
    return verdict(*own, mesh_checks(triangles, faces), view_checks(pixels, faces), feature_coverage(features, faces), round_trip(graph["pairs"], reread))


def verdict(*checks: DataFrame) -> DataFrame:
    """(sample_id, failed, code): the names of failed checks over all tables of checks, and the error code if there are any. A check without a row fails."""
    rows = reduce(lambda a, b: a.join(b, "sample_id", "full_outer"), checks)
    names = [c for c in rows.columns if c != "sample_id"]
    failed = F.filter(F.array(*[F.when(~F.coalesce(F.col(c), F.lit(False)), F.lit(c)) for c in names]), lambda x: x.isNotNull())
    return rows.select("sample_id", failed.alias("failed"), F.when(F.size(failed) > 0, "OUTPUT_INVARIANT_VIOLATION").alias("code"))
