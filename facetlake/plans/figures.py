"""Queries of figures about faces and files: fingerprints, curvature, merged histograms, thinning, file keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from facetlake.functions.constants import GRAPH_SURFACES
from facetlake.operators import canonical, graph, intake, metrics, validate
from facetlake.plans.catalogue import T_SQL, query, read, supplier_faces, topology

_KINDS = [*GRAPH_SURFACES[:5], "bspline", "other"]


@query(
    f"""WITH {T_SQL}, f AS (SELECT s_suppkey AS face_idx, s_suppkey AS k, {_KINDS}[s_suppkey % 7 + 1] AS kind, CAST(round_even(abs(s_acctbal) / 0.01::DOUBLE, 0) AS BIGINT) AS area FROM supplier),
n AS (SELECT src AS face_idx, kind, count(*) AS n FROM (SELECT DISTINCT src, dst FROM pairs) p JOIN f ON f.face_idx = dst GROUP BY ALL),
a AS (SELECT face_idx, string_agg(kind || ':' || n, ',' ORDER BY kind) AS around FROM n GROUP BY 1)
SELECT f.face_idx, substr(sha256(kind || '|' || area || '|' || coalesce(CASE WHEN k % 7 = 1 THEN (k % 13) || '.0' END, '-') || '|-|' || coalesce(CASE WHEN k % 7 = 4 THEN (k % 4) || '.0' END, '-') || '|' || coalesce(CASE WHEN k % 7 = 2 THEN (k % 6) || '.0' END, '-')
  || '|-|' || (k % 3 + 1) || '|0|' || coalesce(around, '')), 1, 16) AS fingerprint FROM f LEFT JOIN a USING (face_idx)"""
)
def face_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as faces, each with the types of the faces around it."""
    face_edge, _ = topology(spark, d)
    own = supplier_faces(spark, d)
    pairs = graph.adjacent_faces(face_edge).select("sample_id", F.col("src").alias("face_idx"), F.col("dst").alias("other"))
    around = pairs.join(own.select("sample_id", F.col("face_idx").alias("other"), F.col("surface_type").alias("neighbour_type")), ["sample_id", "other"])
    p = F.col("analytic_params")
    params = F.struct(p["radius"], p["major_radius"], p["minor_radius"], p["ref_radius"], F.lit(None).cast("double").alias("semi_angle_rad"))
    faces = own.withColumn("analytic_params", params).withColumn("boundary_edges", F.array().cast("array<int>"))
    return canonical.face_fingerprints(faces, around).select("face_idx", "fingerprint")


@query(
    """WITH s AS (SELECT user_id, value / 100 AS h, value * value / 1000 AS k, event_type <> 'error' AND value < 400 AS ok FROM events)
SELECT user_id, count(*) FILTER (ok)::DOUBLE AS samples, round(avg(h) FILTER (ok), 6)::DOUBLE AS mean, round(min(h) FILTER (ok), 6)::DOUBLE AS low, round(max(h) FILTER (ok), 6)::DOUBLE AS high, round(avg(k) FILTER (ok), 6)::DOUBLE AS gaussian FROM s GROUP BY 1"""
)
def curvature_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Events as the places of a face where curvature was measured; errors have no normal, and very large values no finite curvature."""
    rows = read(spark, d, "events").select(F.lit("all").alias("sample_id"), F.col("user_id").alias("face_idx"), (F.col("event_type") != "error").alias("has_normal"), F.when(F.col("value") < 400, F.col("value") / 100).otherwise(float("inf")).alias("mean_curvature"), (F.col("value") * F.col("value") / 1000).alias("gaussian_curvature"))
    found = metrics.curvature_statistics(rows)
    c = lambda name: F.round(f"curvature.{name}", 6)
    return found.select(F.col("face_idx").alias("user_id"), c("samples").alias("samples"), c("mean_curvature_mean").alias("mean"), c("mean_curvature_min").alias("low"), c("mean_curvature_max").alias("high"), c("gaussian_curvature_mean").alias("gaussian"))


@query(
    """WITH n AS (SELECT o_custkey, l_returnflag || l_linestatus AS kind, count(*) AS n FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY ALL)
SELECT o_custkey, string_agg(kind || ':' || n, ',' ORDER BY n DESC, kind) AS histogram FROM n GROUP BY 1"""
)
def merged_histograms(spark: SparkSession, d: str) -> DataFrame:
    """The types of each order's items as a map, merged over the orders of each customer, the most frequent first."""
    items = read(spark, d, "lineitem").select("l_orderkey", F.concat("l_returnflag", "l_linestatus").alias("kind"))
    maps = canonical.histogram(items, ["l_orderkey"], "kind").groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("kind", "n"))).alias("types"))
    own = maps.join(read(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    merged = metrics.merge_histograms(own, ["o_custkey"], "types")
    return merged.select("o_custkey", F.array_join(F.transform("types", lambda e: F.concat_ws(":", e["kind"], e["n"].cast("string"))), ",").alias("histogram"))


@query(
    """WITH r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS k, count(*) OVER (PARTITION BY event_type) AS n FROM events),
j AS (SELECT event_type, n, CASE WHEN i = least(n, 400) - 1 THEN n - 1 WHEN n <= 400 THEN i ELSE CAST(floor(i * (CAST(n - 1 AS DOUBLE) / 399)) AS BIGINT) END AS k FROM (SELECT DISTINCT event_type, n FROM r) CROSS JOIN range(400) g(i) WHERE i < least(n, 400))
SELECT event_type, event_id, k FROM r JOIN j USING (event_type, n, k)"""
)
def even_thinning(spark: SparkSession, d: str) -> DataFrame:
    """Of each kind of events 400, evenly spaced from the first to the last: the thinning is the feature."""
    w = Window.partitionBy("event_type")
    rows = read(spark, d, "events").select("event_type", "event_id").withColumn("k", (F.row_number().over(w.orderBy("event_id")) - 1).cast("long")).withColumn("n", F.count(F.lit(1)).over(w))
    return rows.where(validate.evenly(F.col("k"), F.col("n"), 400)).select("event_type", "event_id", "k")


@query(
    """WITH f AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'nist_CTC_' WHEN 1 THEN 'NIST_ftc_' WHEN 2 THEN 'nist_stc_' ELSE 'other_ctc_' END || lpad((doc_id % 11)::VARCHAR, 2, '0') || '_asme1_' || lang || '.STP' AS file FROM documents)
SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'ctc_' || lpad((doc_id % 11)::VARCHAR, 2, '0') WHEN 3 THEN file ELSE 'ftc_' || lpad((doc_id % 11)::VARCHAR, 2, '0') END AS part,
  CASE doc_id % 4 WHEN 0 THEN 'ctc:' || lang WHEN 1 THEN 'ftc:' || lang WHEN 2 THEN 'stc:' || lang ELSE '?' END AS variant FROM f JOIN documents USING (doc_id)"""
)
def part_keys(spark: SparkSession, d: str) -> DataFrame:
    """Documents as exports of test parts: which of them show one part."""
    kind = F.element_at(F.array(*map(F.lit, ("nist_CTC_", "NIST_ftc_", "nist_stc_", "other_ctc_"))), (F.col("doc_id") % 4 + 1).cast("int"))
    name = F.concat(kind, F.lpad((F.col("doc_id") % 11).cast("string"), 2, "0"), F.lit("_asme1_"), "lang", F.lit(".STP"))
    part, variant = intake.part_key(name)
    return read(spark, d, "documents").select("doc_id", part.alias("part"), variant.alias("variant"))
