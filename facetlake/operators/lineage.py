"""From a face to everything made of it, with each link verified."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHECKS = ("node_matches_face", "points_in_range", "triangles_in_range", "pixels_recomputed", "neighbours_match", "features_name_face")


def index(faces: DataFrame, points: DataFrame, triangles: DataFrame, pixels: DataFrame, features: DataFrame) -> DataFrame:
    """One row a face: half-open ranges of its points and triangles, pixels over all views, features. A view over the tables, nothing is stored."""
    span = lambda d, i, n: d.groupBy("sample_id", "face_idx").agg(F.min(i).alias(f"{n}_start"), (F.max(i) + 1).alias(f"{n}_end"), F.count(F.lit(1)).alias(f"{n}_count"))
    seen = pixels.groupBy("sample_id", "face_idx").agg(F.count(F.lit(1)).alias("pixels"))
    named = features.select("sample_id", "feature_id", F.explode("face_indices").alias("face_idx")).groupBy("sample_id", "face_idx").agg(F.sort_array(F.collect_set("feature_id")).alias("feature_ids"))
    rows = faces.select("sample_id", "face_idx")
    for other in (span(points, "point_idx", "point"), span(triangles, "tri_idx", "triangle"), seen, named):
        rows = rows.join(other, ["sample_id", "face_idx"], "left")
    return rows.fillna(0, ["point_count", "triangle_count", "pixels"])


def verify(stored: DataFrame, faces: DataFrame, nodes: DataFrame, points: DataFrame, triangles: DataFrame, pixels: DataFrame, arcs: DataFrame, features: DataFrame) -> DataFrame:
    """One row a face: whether each link of the stored index holds against the tables."""
    now = index(faces, points, triangles, pixels, features).alias("n")
    around = arcs.groupBy("sample_id", F.col("src").alias("face_idx")).agg(F.sort_array(F.collect_set("dst")).alias("graph_neighbours"))
    own = faces.select("sample_id", "face_idx", F.sort_array("adjacent").alias("adjacent"))
    node = nodes.select("sample_id", "face_idx", F.lit(True).alias("has_node"))
    rows = stored.alias("s").join(now, ["sample_id", "face_idx"], "left").join(around, ["sample_id", "face_idx"], "left").join(own, ["sample_id", "face_idx"], "left").join(node, ["sample_id", "face_idx"], "left")
    same = lambda *names: F.forall(F.array(*[F.col(f"s.{c}").eqNullSafe(F.col(f"n.{c}")) for c in names]), lambda ok: ok)
    dense = lambda k: (F.col(f"n.{k}_end") - F.col(f"n.{k}_start")).eqNullSafe(F.nullif(F.col(f"n.{k}_count"), F.lit(0)))
    empty = F.array().cast("array<int>")
    checks = (F.coalesce("has_node", F.lit(False)), same("point_start", "point_end") & dense("point"), same("triangle_start", "triangle_end") & dense("triangle"), same("pixels"), F.coalesce("graph_neighbours", empty) == F.coalesce("adjacent", empty), same("feature_ids"))
    return rows.select("sample_id", "face_idx", *[c.alias(n) for n, c in zip(CHECKS, checks, strict=True)]).withColumn("verified", F.forall(F.array(*CHECKS), lambda ok: ok))


def range_checks(rows: DataFrame, sample: str, index: str, count: str) -> DataFrame:
    """One row a sample: whether the half-open ranges (start, end) of its faces are laid end to end from zero and hold all of its items."""
    after = F.lead("start").over(Window.partitionBy(sample).orderBy(index))
    checked = rows.withColumn("_next", after)
    return checked.groupBy(sample).agg(F.count(F.lit(1)).alias("faces"), F.bool_and(F.col("_next").isNull() | (F.col("_next") == F.col("end"))).alias("gapless"), (F.min("start") == 0).alias("from_zero"), (F.max("end") == F.sum(count)).alias("complete"))


def trace(verified: DataFrame, stored: DataFrame, sample: str, face: int) -> DataFrame:
    """One face's row of the index with its checks; the keys reach the scans."""
    want = (F.col("sample_id") == sample) & (F.col("face_idx") == face)
    return stored.where(want).join(verified.where(want), ["sample_id", "face_idx"])
