"""Schemas of the typed tables; each column says in its metadata how its values come about."""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, MapType, StringType, StructField, StructType

OBSERVED, COMPUTED, INFERRED, TRUTH = "observed", "computed", "inferred", "ground_truth"
VEC = StructType([StructField(k, DoubleType()) for k in "xyz"])
_S, _D, _I, _L, _B = StringType(), DoubleType(), IntegerType(), LongType(), BooleanType()


def table(provenance: str, **columns) -> StructType:  # noqa: ANN003
    return StructType([StructField(k, t, metadata={"provenance": provenance}) for k, t in columns.items()])


PARAMS = StructType([*(StructField(k, _D) for k in ("radius", "major_radius", "minor_radius", "ref_radius", "semi_angle_rad")), *(StructField(k, VEC) for k in ("axis", "axis_origin", "origin", "center", "apex"))])
CURVATURE = StructType([StructField(k, _D) for k in ("samples", "mean_curvature_mean", "mean_curvature_min", "mean_curvature_max", "gaussian_curvature_mean")])
EVIDENCE = ArrayType(StructType([StructField("check", _S), StructField("passed", _B), StructField("detail", _S)]))

FACES = table(COMPUTED, sample_id=_S, face_idx=_I, traversal_index=_I, surface_type=_S, orientation=_S, area_mm2=_D, centroid_mm=VEC, bbox_min_mm=VEC, bbox_max_mm=VEC, normal_at_centroid=VEC, uv_bounds=ArrayType(_D), analytic_params=PARAMS, curvature=CURVATURE, adjacent=ArrayType(_I), boundary_edges=ArrayType(_I), outer_loop_edges=ArrayType(_I), loop_count=_I, fingerprint=_S)
EDGES = table(COMPUTED, sample_id=_S, edge_idx=_I, traversal_index=_I, curve_type=_S, length_mm=_D, start_mm=VEC, mid_mm=VEC, end_mm=VEC, closed=_B, degenerated=_B, adjacent=ArrayType(_I), convexity=_S, dihedral_angle_deg=_D, fingerprint=_S)
FEATURES = table(INFERRED, sample_id=_S, feature_id=_S, feature_type=_S, face_indices=ArrayType(_I), parameters=MapType(_S, _D), confidence=_D, evidence=EVIDENCE)
OBSERVATIONS = table(COMPUTED, sample_id=_S, face_idx=_I, surface_type=_S, material_side=_S, area_mm2=_D, radius_mm=_D, major_radius_mm=_D, minor_radius_mm=_D, span_deg=_D, concave=_B, axis=VEC, axis_origin=VEC, normal=VEC)
GROUND_TRUTH = table(TRUTH, source_sha256=_S, family=_S, variant=_S, design_group=_S, seed=_I, params=MapType(_S, _D), fillet_radii=ArrayType(_D))
