"""Canonical order, fingerprints and ranges of faces and edges: none depends on the order of the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetlake.functions.constants import CURVE_TYPES, SURFACE_TYPES
from facetlake.functions.identity import quantize, short_hash


def type_rank(kind: Column, types: tuple[str, ...] = SURFACE_TYPES) -> Column:
    place = F.array_position(F.array(*map(F.lit, types)), kind)
    return F.when(place > 0, place - 1).otherwise(99)


def canonical_order(rows: DataFrame, sample: str, keys: list[Column], index: str = "face_idx") -> DataFrame:
    """Adds the rank of a row within its sample by the keys, from 0. The keys must end in a total tie-break."""
    return rows.withColumn(index, (F.row_number().over(Window.partitionBy(sample).orderBy(*keys)) - 1).cast("int"))


def face_keys(step: float = 1e-3) -> list[Column]:
    """Order of faces: type, centroid, area, box, fingerprint, place in the file."""
    point = lambda c: [quantize(F.col(f"{c}.{k}"), step) for k in "xyz"]
    return [type_rank(F.col("surface_type")), *point("centroid_mm"), quantize("area_mm2", step), *point("bbox_min_mm"), *point("bbox_max_mm"), F.col("fingerprint"), F.col("traversal_index")]


def edge_keys(step: float = 1e-3) -> list[Column]:
    """Order of edges: curve, middle, length, the smaller and the larger end, fingerprint, place in the file."""
    point = lambda c: F.struct(*[quantize(F.col(f"{c}.{k}"), step).alias(k) for k in "xyz"])
    start, end = point("start_mm"), point("end_mm")
    return [type_rank(F.col("curve_type"), CURVE_TYPES), point("mid_mm"), quantize("length_mm", step), F.least(start, end), F.greatest(start, end), F.col("fingerprint"), F.col("traversal_index")]


def ranges(rows: DataFrame, sample: str, index: str, count: str) -> DataFrame:
    """Adds ``start`` and ``end``: the half-open range of each row's items, laid end to end in order."""
    before = Window.partitionBy(sample).orderBy(index).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("start", F.coalesce(F.sum(count).over(before), F.lit(0)).cast("long")).withColumn("end", (F.col("start") + F.col(count)).cast("long"))


def histogram(rows: DataFrame, keys: list[str], kind: str) -> DataFrame:
    """(keys, type, n): how often each type occurs."""
    return rows.groupBy(*keys, kind).agg(F.count(F.lit(1)).alias("n"))


def histogram_text(rows: DataFrame, keys: list[str], kind: str, name: str = "histogram") -> DataFrame:
    """(keys, "type:count,..."), in order of the type."""
    counts = histogram(rows, keys, kind)
    entry = F.sort_array(F.collect_list(F.struct(F.col(kind).alias("k"), "n")))
    return counts.groupBy(*keys).agg(F.concat_ws(",", F.transform(entry, lambda e: F.concat_ws(":", e["k"], e["n"].cast("string")))).alias(name))


def face_fingerprints(faces: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Pose-free fingerprint of each face: type, area to 0.01, radii and cone angle to 3 places, loops, edges, and the types around it.

    ``faces`` is as in ``facetlake.schemas``, ``neighbours`` has (sample_id, face_idx, neighbour_type), one row per adjacent face.
    """
    around = histogram_text(neighbours, ["sample_id", "face_idx"], "neighbour_type", "around")
    p = "analytic_params"
    radii = [F.coalesce(F.round(f"{p}.{k}", 3).cast("string"), F.lit("-")) for k in ("radius", "major_radius", "minor_radius", "ref_radius", "semi_angle_rad")]
    own = [F.col("surface_type"), quantize("area_mm2", 0.01).cast("string"), *radii, F.col("loop_count").cast("string"), F.coalesce(F.size("boundary_edges"), F.lit(0)).cast("string")]
    return faces.join(around, ["sample_id", "face_idx"], "left").withColumn("fingerprint", short_hash(*own, F.coalesce("around", F.lit("")))).drop("around")


def neighbour_types(faces: DataFrame) -> DataFrame:
    """(sample_id, face_idx, neighbour_type) from the faces' own lists of adjacent ones."""
    around = faces.select("sample_id", "face_idx", F.explode("adjacent").alias("other"))
    return around.join(faces.select("sample_id", F.col("face_idx").alias("other"), F.col("surface_type").alias("neighbour_type")), ["sample_id", "other"]).drop("other")


def edge_fingerprint(curve: Column, length: Column, convexity: Column, face_fingerprints: Column) -> Column:
    return short_hash(curve, quantize(length, 0.01).cast("string"), convexity, F.concat_ws(",", F.array_sort(face_fingerprints)))


def unambiguous_matches(left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str) -> DataFrame:
    """Pairs whose key occurs once on both sides."""
    once = lambda d, i, n: d.groupBy(key).agg(F.min(i).alias(n), F.count(F.lit(1)).alias("times")).where("times = 1").drop("times")
    return once(left, left_id, "left_id").join(once(right, right_id, "right_id"), key)


def convexity(degenerate: Column, seam: Column, n_faces: Column, normal_a: Column, normal_b: Column, tangent: Column, degrees: float = 2.0) -> tuple[Column, Column]:
    """Class of an edge and its dihedral angle in degrees, from both faces' normals and the edge's tangent in the first face's sense."""
    from facetlake.functions.vectors import cross, dot

    # Lengths only matter to the angle; a normal of length zero stands at a right angle to all.
    lengths = F.sqrt(dot(normal_a, normal_a) * dot(normal_b, normal_b))
    cosine = F.when(lengths > 0, dot(normal_a, normal_b) / lengths).otherwise(0.0)
    between = F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))))
    side = dot(cross(normal_a, normal_b), tangent)
    two = F.when(between < degrees, "smooth").when(side > 0, "convex").otherwise("concave")
    kind = F.when(degenerate, "unknown").when(seam, "seam").when(n_faces == 0, "unknown").when(n_faces == 1, "boundary").when(n_faces > 2, "non_manifold").otherwise(two)
    angle = F.when(n_faces == 2, F.round(F.when(kind == "concave", 180 + between).otherwise(180 - between), 4))
    return kind, angle
