"""Queries that exercise the operators on the driver's tables, each with the same result in DuckDB SQL where SQL can express it.

The tables play the roles of the typed ones: documents are source files, labels their ground truth, orders parts and lineitem rows
their faces, suppliers in an order adjacent faces, events job events, embeddings feature vectors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetlake.functions import identity
from facetlake.functions.constants import ERROR_CODES, GRAPH_SURFACES
from facetlake.functions.storage import materialize
from facetlake.functions import vectors as v
from facetlake.operators import canonical, cloud, dataset, graph, intake, jobs, lineage, metrics, near_duplicates, raster, recognize, splits, validate
from facetlake.sources import analytic, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


CFG = identity.config_hash()
SEED = 7

# ---- dataset


def samples(spark: SparkSession, d: str) -> DataFrame:
    """Documents as samples: content hash, family (language), design group, label, and the verdict on each."""
    docs = read(spark, d, "documents").select(F.col("doc_id").alias("sample_id"), F.sha2("text", 256).alias("content"), F.col("lang").alias("family"), F.concat_ws("/", "lang", "source").alias("design_group"), "n_chars")
    truth = read(spark, d, "labels").select(F.col("doc_id").alias("sample_id"), F.col("quality").alias("label"), F.col("toxic").alias("rule_label"), F.lit(True).alias("has_truth"))
    rows = docs.join(truth, "sample_id", "left")
    return dataset.eligibility(rows, F.col("n_chars") > 0, F.lit(True), F.col("has_truth"), F.lit(True))


S_SQL = f"""
docs AS (SELECT doc_id AS sample_id, sha256(text) AS content, lang AS family, lang || '/' || source AS design_group, n_chars, text FROM documents),
joined AS (SELECT docs.*, quality AS label, toxic AS rule_label, quality IS NOT NULL AS has_truth FROM docs LEFT JOIN labels ON labels.doc_id = docs.sample_id),
firsts AS (SELECT *, min(CASE WHEN n_chars > 0 AND has_truth THEN sample_id END) OVER (PARTITION BY content) AS first FROM joined),
samples AS (SELECT sample_id, content, family, design_group, label, rule_label, has_truth, n_chars, text,
  CASE WHEN NOT n_chars > 0 THEN 'status' WHEN sample_id > first THEN 'exact_duplicate_of:' || first
       WHEN NOT has_truth THEN 'no_ground_truth' ELSE 'ok' END AS reason FROM firsts),
units AS (SELECT DISTINCT design_group AS unit, family FROM samples WHERE reason = 'ok'),
families AS (SELECT family, row_number() OVER (ORDER BY sha256('{SEED}|' || family), family) - 1 AS k, count(*) OVER () AS families FROM (SELECT DISTINCT family FROM units)),
ranked AS (SELECT unit, u.family, k, families, row_number() OVER (PARTITION BY u.family ORDER BY sha256('{SEED}|' || u.family || '|' || unit), unit) - 1 AS j, count(*) OVER (PARTITION BY u.family) AS n FROM units u JOIN families f ON u.family = f.family),
by_group AS (SELECT unit, family, CASE WHEN j = 0 AND n >= 2 THEN CASE WHEN k % 2 = 0 THEN 'val' ELSE 'test' END WHEN j = 1 AND n >= 4 THEN CASE WHEN k % 2 = 0 THEN 'test' ELSE 'val' END ELSE 'train' END AS split FROM ranked),
by_family AS (SELECT unit, family, CASE WHEN k < greatest(1, CAST(round_even(families / 6.0, 0) AS INTEGER)) THEN 'test' WHEN k < 2 * greatest(1, CAST(round_even(families / 6.0, 0) AS INTEGER)) THEN 'val' ELSE 'train' END AS split FROM ranked),
assigned AS (SELECT s.*, split FROM samples s JOIN by_group g ON g.unit = s.design_group WHERE reason = 'ok')
"""


def units(spark: SparkSession, d: str, included: DataFrame | None = None) -> DataFrame:
    rows = samples(spark, d).where("reason = 'ok'") if included is None else included
    return rows.select(F.col("design_group").alias("unit"), "family").distinct()


def assigned(spark: SparkSession, d: str) -> DataFrame:
    rows = materialize(samples(spark, d).where("reason = 'ok'"), "included")  # read twice: for the units and for their samples
    return rows.join(splits.split_by_group(units(spark, d, rows), SEED).select(F.col("unit").alias("design_group"), "split"), "design_group")


@query(f"WITH {S_SQL} SELECT sample_id, content, reason FROM samples")
def dataset_eligibility(spark: SparkSession, d: str) -> DataFrame:
    return samples(spark, d).select("sample_id", "content", "reason")


@query(f"WITH {S_SQL} SELECT CASE WHEN reason LIKE 'exact_duplicate_of:%' THEN 'exact_duplicate_of' ELSE reason END AS reason, count(*) AS n FROM samples GROUP BY 1")
def rejection_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return dataset.reason_counts(samples(spark, d))


@query(f"SELECT doc_id, 's_' || substr(sha256(sha256(text) || '|1.1.0|{CFG}|1.0.0'), 1, 24) AS sample_id, sha256(text) || ':1.1.0:{CFG}:1.0.0' AS job_key FROM documents")
def sample_identity(spark: SparkSession, d: str) -> DataFrame:
    sha = F.sha2("text", 256)
    return read(spark, d, "documents").select("doc_id", identity.sample_id(sha).alias("sample_id"), identity.job_key(sha).alias("job_key"))


def _signature_columns() -> tuple[Column, Column, Column]:
    words, lines = F.size(F.split("text", " ", -1)), F.size(F.split("text", "\n", -1))
    return F.col("n_chars"), words, F.array(lines, words / 10, F.col("n_chars") / 100)


NEAR_SQL = """
raw AS (SELECT doc_id AS part, CAST(n_chars AS DOUBLE) AS volume, CAST(len(string_split(text, ' ')) AS DOUBLE) AS area,
  list_sort([CAST(len(string_split(text, chr(10))) AS DOUBLE), len(string_split(text, ' ')) / 10.0::DOUBLE, n_chars / 100.0::DOUBLE]) AS dims FROM documents),
sig AS (SELECT volume, area, dims, min(part) AS part, count(*) AS members FROM raw GROUP BY ALL),
pairs AS (SELECT a.part AS a, b.part AS b FROM sig a JOIN sig b ON a.part < b.part
  AND abs(a.volume - b.volume) <= 0.002::DOUBLE * greatest(abs(a.volume), abs(b.volume)) AND abs(a.area - b.area) <= 0.002::DOUBLE * greatest(abs(a.area), abs(b.area))
  AND abs(a.dims[1] - b.dims[1]) <= 0.5::DOUBLE + 0.001::DOUBLE * greatest(a.dims[1], b.dims[1])
  AND abs(a.dims[2] - b.dims[2]) <= 0.5::DOUBLE + 0.001::DOUBLE * greatest(a.dims[2], b.dims[2])
  AND abs(a.dims[3] - b.dims[3]) <= 0.5::DOUBLE + 0.001::DOUBLE * greatest(a.dims[3], b.dims[3]))
"""


@query(f"WITH {NEAR_SQL} SELECT a, b FROM pairs")
def near_dup_pairs(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.near_duplicate_pairs(near_duplicates.signatures(read(spark, d, "documents"), "doc_id", *_signature_columns()))


@query(
    f"""WITH RECURSIVE {NEAR_SQL}, both_ways AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT part AS node, part AS seen FROM sig UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.seen),
head AS (SELECT node, min(seen) AS cluster, count(*) AS size FROM reach GROUP BY node)
SELECT raw.part, cluster FROM raw JOIN sig USING (volume, area, dims) JOIN head ON head.node = sig.part WHERE size > 1 OR members > 1"""
)
def near_dup_clusters(spark: SparkSession, d: str) -> DataFrame:
    return near_duplicates.near_duplicate_clusters(read(spark, d, "documents"), "doc_id", *_signature_columns())


@query(f"WITH {S_SQL} SELECT unit, family, split FROM by_group")
def split_assignment_group(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_by_group(units(spark, d), SEED)


@query(f"WITH {S_SQL} SELECT unit, family, split FROM by_family")
def split_assignment_family(spark: SparkSession, d: str) -> DataFrame:
    return splits.split_by_family(units(spark, d), SEED)


def _leaks(rows: DataFrame, key: str) -> DataFrame:
    return splits.leakage(rows, key).select(F.col("key").cast("string").alias("key"), F.concat_ws(",", "splits").alias("splits"))


@query(f"WITH {S_SQL} SELECT content AS key, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM assigned GROUP BY 1 HAVING count(DISTINCT split) > 1")
def leakage_check(spark: SparkSession, d: str) -> DataFrame:
    """No content crosses splits among eligible samples: no row."""
    return _leaks(assigned(spark, d), "content")


@query(f"WITH {S_SQL} SELECT family AS key, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM assigned GROUP BY 1 HAVING count(DISTINCT split) > 1")
def leakage_check_leaky(spark: SparkSession, d: str) -> DataFrame:
    """Families do cross group splits."""
    return _leaks(assigned(spark, d), "family")


@query(f"WITH {S_SQL} SELECT split, label, count(*) AS n FROM assigned GROUP BY ALL")
def class_distribution(spark: SparkSession, d: str) -> DataFrame:
    return dataset.class_distribution(assigned(spark, d), "split", "label")


@query(f"WITH {S_SQL} SELECT split, count(*) AS samples, string_agg(DISTINCT family, ',' ORDER BY family) AS families, count(DISTINCT design_group) AS groups FROM assigned GROUP BY 1")
def split_sizes(spark: SparkSession, d: str) -> DataFrame:
    return dataset.split_sizes(assigned(spark, d))


@query(f"WITH {S_SQL} SELECT round(avg(CAST(has_truth AS INTEGER)), 6)::DOUBLE AS ground_truth, round(avg(CASE WHEN n_chars >= 200 THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS text FROM samples")
def completeness(spark: SparkSession, d: str) -> DataFrame:
    return dataset.completeness(samples(spark, d), {"ground_truth": F.coalesce(F.col("has_truth"), F.lit(False)), "text": F.col("n_chars") >= 200})


@query(f"WITH {S_SQL} SELECT split, round(avg(CASE WHEN label = rule_label THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS agreement FROM assigned GROUP BY 1")
def rule_agreement(spark: SparkSession, d: str) -> DataFrame:
    return metrics.agreement(assigned(spark, d), ["split"], "label", "rule_label")


def _digest_sql(table: str, *columns: str) -> str:
    text = " || '|' || ".join(rf"coalesce({c}::VARCHAR, '\N')" for c in columns)
    parts = " || '|' || ".join(f"coalesce(sum(('0x' || substr(h, {1 + 8 * i}, 8))::BIGINT), 0)::VARCHAR" for i in range(8))
    return f"(SELECT sha256(count(*) || '|' || {parts}) FROM (SELECT sha256({text}) AS h FROM {table}))"


BUILD_SQL = f"""WITH RECURSIVE {NEAR_SQL}, both_ways AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach AS (SELECT part AS node, part AS seen FROM sig UNION SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.seen),
head AS (SELECT node, min(seen) AS cluster, count(*) AS size FROM reach GROUP BY node),
clusters AS (SELECT raw.part, cluster FROM raw JOIN sig USING (volume, area, dims) JOIN head ON head.node = sig.part WHERE size > 1 OR members > 1), {S_SQL},
touched AS (SELECT DISTINCT cluster, design_group FROM samples JOIN clusters ON part = sample_id WHERE reason = 'ok'),
links AS (SELECT design_group AS a, min(design_group) OVER (PARTITION BY cluster) AS b FROM touched), steps AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
spread AS (SELECT a AS node, a AS seen FROM links UNION SELECT s.node, e.b FROM spread s JOIN steps e ON e.a = s.seen), joined_groups AS (SELECT node, min(seen) AS unit FROM spread GROUP BY 1),
included AS (SELECT s.*, coalesce(g.unit, design_group) AS split_unit FROM samples s LEFT JOIN joined_groups g ON g.node = design_group WHERE reason = 'ok'),
own_units AS (SELECT split_unit AS unit, min(family) AS family FROM included GROUP BY 1),
own_families AS (SELECT family, row_number() OVER (ORDER BY sha256('{SEED}|' || family), family) - 1 AS k FROM (SELECT DISTINCT family FROM own_units)),
own_ranks AS (SELECT unit, k, row_number() OVER (PARTITION BY u.family ORDER BY sha256('{SEED}|' || u.family || '|' || unit), unit) - 1 AS j, count(*) OVER (PARTITION BY u.family) AS n FROM own_units u JOIN own_families f ON u.family = f.family),
own_splits AS (SELECT unit, CASE WHEN j = 0 AND n >= 2 THEN CASE WHEN k % 2 = 0 THEN 'val' ELSE 'test' END WHEN j = 1 AND n >= 4 THEN CASE WHEN k % 2 = 0 THEN 'test' ELSE 'val' END ELSE 'train' END AS split FROM own_ranks),
placed AS (SELECT i.*, split FROM included i JOIN own_splits o ON o.unit = split_unit), excluded AS (SELECT sample_id, reason FROM samples WHERE reason <> 'ok')"""

DATASET_ID_SQL = f"""'ds_' || substr(sha256('{SEED}|group|' || {_digest_sql("placed", "sample_id", "content", "split", "label")} || '|' || {_digest_sql("excluded", "sample_id", "reason")}), 1, 16)"""


@query(f"{BUILD_SQL} SELECT {DATASET_ID_SQL} AS dataset_id, (SELECT count(*) FROM placed) AS included, (SELECT count(*) FROM excluded) AS excluded")
def build_dataset(spark: SparkSession, d: str) -> DataFrame:
    """The whole build, near-duplicate clusters joining groups; its one row of identity."""
    clusters = near_duplicates.near_duplicate_clusters(read(spark, d, "documents"), "doc_id", *_signature_columns())
    return dataset.build(samples(spark, d), clusters, SEED)["dataset"]


# ---- canonical order, ranges, fingerprints


def faces(spark: SparkSession, d: str) -> DataFrame:
    """lineitem rows as faces of the orders, in canonical order; keys are not unique, so every column breaks ties."""
    rows = read(spark, d, "lineitem")
    keys = [canonical.type_rank(F.col("l_returnflag"), ("A", "N", "R")), identity.quantize("l_extendedprice", 1e-2), *[F.col(c) for c in ("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_linestatus", "l_shipdate")]]
    return canonical.canonical_order(rows, "l_orderkey", keys)


F_SQL = """
faces AS (SELECT *, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE 99 END,
  CAST(round_even(l_extendedprice / 0.01::DOUBLE, 0) AS BIGINT), l_partkey, l_suppkey, l_linenumber, l_quantity, l_discount, l_tax, l_linestatus, l_shipdate) - 1 AS INTEGER) AS face_idx FROM lineitem)
"""


@query(f"WITH {F_SQL} SELECT l_orderkey, face_idx, l_partkey, l_linenumber, 'F' || CASE WHEN length(face_idx::VARCHAR) < 3 THEN lpad(face_idx::VARCHAR, 3, '0') ELSE face_idx::VARCHAR END AS face_id FROM faces")
def canonical_order(spark: SparkSession, d: str) -> DataFrame:
    return faces(spark, d).select("l_orderkey", "face_idx", "l_partkey", "l_linenumber", identity.entity_id("F", "face_idx").alias("face_id"))


R_SQL = f"""{F_SQL}, ranged AS (SELECT *, CAST(l_quantity AS BIGINT) AS n, CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) OVER (PARTITION BY l_orderkey ORDER BY face_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM faces)"""


def ranged(spark: SparkSession, d: str) -> DataFrame:
    return canonical.ranges(faces(spark, d).withColumn("n", F.col("l_quantity").cast("long")), "l_orderkey", "face_idx", "n")


@query(f'WITH {R_SQL} SELECT l_orderkey, face_idx, n, start, CAST(start + n AS BIGINT) AS "end" FROM ranged')
def range_offsets(spark: SparkSession, d: str) -> DataFrame:
    return ranged(spark, d).select("l_orderkey", "face_idx", "n", "start", "end")


@query(
    f"""WITH {F_SQL}, w AS (SELECT l_orderkey, face_idx, CAST(round_even(l_extendedprice * 100, 0) AS BIGINT) AS w FROM faces),
r AS (SELECT *, greatest(256 - 8 * count(*) OVER (PARTITION BY l_orderkey), 0)::BIGINT AS rest, CAST(sum(w) OVER (PARTITION BY l_orderkey) AS BIGINT) AS total FROM w),
q AS (SELECT *, (rest * w) // total AS low, (rest * w) % total AS remainder FROM r),
p AS (SELECT *, rest - sum(low) OVER (PARTITION BY l_orderkey) AS open, row_number() OVER (PARTITION BY l_orderkey ORDER BY remainder DESC, face_idx) AS place FROM q)
SELECT l_orderkey, face_idx, CAST(8 + low + CASE WHEN place <= open THEN 1 ELSE 0 END AS BIGINT) AS n FROM p"""
)
def largest_remainder_allocation(spark: SparkSession, d: str) -> DataFrame:
    rows = faces(spark, d).withColumn("w", identity.quantize(F.col("l_extendedprice") * 100, 1.0))
    return cloud.allocate(rows, "l_orderkey", "face_idx", "w", total=256, least=8)


@query(
    """WITH counts AS (SELECT l_orderkey, l_returnflag AS k, count(*) AS n FROM lineitem GROUP BY ALL),
h AS (SELECT l_orderkey, string_agg(k || ':' || n, ',' ORDER BY k) AS histogram FROM counts GROUP BY 1)
SELECT l_orderkey, histogram, substr(sha256(l_orderkey || '|' || histogram), 1, 16) AS fingerprint FROM h"""
)
def fingerprint(spark: SparkSession, d: str) -> DataFrame:
    rows = canonical.histogram_text(read(spark, d, "lineitem"), ["l_orderkey"], "l_returnflag")
    return rows.withColumn("fingerprint", identity.short_hash(F.col("l_orderkey").cast("string"), "histogram"))


@query(
    """WITH f AS (SELECT p_partkey, substr(sha256(p_brand || '|' || p_type || '|' || p_size), 1, 16) AS fingerprint FROM part),
a AS (SELECT fingerprint, min(p_partkey) AS left_id FROM f WHERE p_partkey % 2 = 0 GROUP BY 1 HAVING count(*) = 1),
b AS (SELECT fingerprint, min(p_partkey) AS right_id FROM f WHERE p_partkey % 2 = 1 GROUP BY 1 HAVING count(*) = 1)
SELECT fingerprint, left_id, right_id FROM a JOIN b USING (fingerprint)"""
)
def unambiguous_match(spark: SparkSession, d: str) -> DataFrame:
    """Parts with even and with odd keys as two exports of one model."""
    rows = read(spark, d, "part").select("p_partkey", identity.short_hash("p_brand", "p_type", F.col("p_size").cast("string")).alias("fingerprint"))
    return canonical.unambiguous_matches(rows.where("p_partkey % 2 = 0"), rows.where("p_partkey % 2 = 1"), "fingerprint", "p_partkey", "p_partkey")


@query("SELECT l_orderkey, l_returnflag AS surface_type, count(*) AS n FROM lineitem GROUP BY ALL")
def type_histogram(spark: SparkSession, d: str) -> DataFrame:
    return canonical.histogram(read(spark, d, "lineitem").withColumnRenamed("l_returnflag", "surface_type"), ["l_orderkey"], "surface_type")


# ---- graph: each nation of suppliers is a part, suppliers are faces, orders the edges between them


def topology(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    items = read(spark, d, "lineitem")
    face_edge = items.select(F.lit("all").alias("sample_id"), F.col("l_suppkey").alias("face_idx"), F.col("l_orderkey").alias("edge_idx")).distinct()
    kind = F.element_at(F.array(*map(F.lit, ("convex", "concave", "smooth", "seam"))), (F.col("l_orderkey") % 4 + 1).cast("int"))
    angle = (F.col("l_orderkey") % 361).cast("double")
    edges = items.groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("long")).cast("double").alias("length_mm")).select(F.lit("all").alias("sample_id"), F.col("l_orderkey").alias("edge_idx"), "length_mm", kind.alias("convexity"), angle.alias("dihedral_angle_deg"), F.lit("line").alias("curve_type"))
    return face_edge, edges


T_SQL = """
fe AS (SELECT DISTINCT l_suppkey AS face_idx, l_orderkey AS edge_idx FROM lineitem),
edges AS (SELECT l_orderkey AS edge_idx, CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) AS length_mm, ['convex', 'concave', 'smooth', 'seam'][l_orderkey % 4 + 1] AS convexity, CAST(l_orderkey % 361 AS DOUBLE) AS angle FROM lineitem GROUP BY l_orderkey),
pairs AS (SELECT a.face_idx AS src, b.face_idx AS dst, a.edge_idx FROM fe a JOIN fe b ON a.edge_idx = b.edge_idx AND a.face_idx <> b.face_idx)
"""


@query(f"WITH {T_SQL} SELECT src, dst, edge_idx FROM pairs")
def adjacency_pairs(spark: SparkSession, d: str) -> DataFrame:
    return graph.adjacent_pairs(topology(spark, d)[0]).select("src", "dst", "edge_idx")


@query(
    f"""WITH {T_SQL}, boundary AS (SELECT face_idx AS src, sum(length_mm) AS boundary FROM fe JOIN edges USING (edge_idx) GROUP BY 1),
g AS (SELECT src, dst, count(*) AS n_shared, sum(length_mm) AS shared_length, arg_max({{'e': edge_idx, 'c': convexity, 'a': angle}}, {{'l': length_mm, 'e': -edge_idx}}) AS main FROM pairs JOIN edges USING (edge_idx) GROUP BY ALL)
SELECT src, dst, n_shared, shared_length, main.e AS main_edge, main.c AS convexity, main.c = 'convex' AS is_convex, main.c NOT IN ('convex', 'concave', 'smooth') AS is_other_class, round(CASE WHEN main.a = 0 THEN 1.0 ELSE main.a / 180 END, 6)::DOUBLE AS angle, round(shared_length / boundary, 6)::DOUBLE AS shared_fraction FROM g JOIN boundary USING (src)"""
)
def pair_features(spark: SparkSession, d: str) -> DataFrame:
    face_edge, edges = topology(spark, d)
    found = graph.pair_features(graph.adjacent_pairs(face_edge, half=True), edges, face_edge, half=True)
    return found.select("src", "dst", "n_shared", "shared_length", "main_edge", "convexity", (F.col("is_convex") == 1).alias("is_convex"), (F.col("is_other_class") == 1).alias("is_other_class"), F.round("angle", 6).alias("angle"), F.round("shared_fraction", 6).alias("shared_fraction"))


@query(f"WITH {T_SQL}, p AS (SELECT DISTINCT src, dst FROM pairs) SELECT count(*) AS one_way FROM p WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.src = p.dst AND q.dst = p.src)")
def graph_symmetry_check(spark: SparkSession, d: str) -> DataFrame:
    return graph.one_way(graph.adjacent_pairs(topology(spark, d)[0]), 3 * read(spark, d, "lineitem").count()).agg(F.count(F.lit(1)).alias("one_way"))


def supplier_faces(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers as the faces of one part; whole numbers of their keys and balances stand for measures."""
    k, none = F.col("s_suppkey"), F.lit(None).cast("double")
    kind = F.element_at(F.array(*map(F.lit, (*GRAPH_SURFACES[:5], "bspline", "other"))), (k % 7 + 1).cast("int"))
    point = lambda x, y, z: v.vec(x.cast("double"), y.cast("double"), z.cast("double"))
    low, high = point(k % 5, k % 3, F.lit(0)), point(k % 5 + k % 11, k % 3 + k % 4, k % 9)
    params = F.struct(F.when(k % 7 == 1, (k % 13).cast("double")).alias("radius"), F.when(k % 7 == 4, (k % 4).cast("double")).alias("minor_radius"), F.when(k % 7 == 2, (k % 6).cast("double")).alias("ref_radius"), none.alias("major_radius"))
    curvature = F.struct(F.when(k % 7 == 0, none).otherwise(((k % 10) / 10 - 0.5)).alias("mean_curvature_mean"), F.when(k % 7 == 3, (k % 8) / 8).alias("gaussian_curvature_mean"))
    normal = F.when(k % 6 > 0, point(k % 2, 1 - k % 2, F.lit(0)))
    return read(spark, d, "supplier").select(F.lit("all").alias("sample_id"), k.alias("face_idx"), kind.alias("surface_type"), F.when(k % 2 == 0, "reversed").otherwise("forward").alias("orientation"), F.abs("s_acctbal").alias("area_mm2"), low.alias("bbox_min_mm"), high.alias("bbox_max_mm"), normal.alias("normal_at_centroid"), params.alias("analytic_params"), curvature.alias("curvature"), (k % 3 + 1).cast("int").alias("loop_count"))


@query(
    f"""WITH {T_SQL}, j AS (SELECT face_idx, convexity, convexity <> 'seam' AS plain FROM fe JOIN edges USING (edge_idx)),
c AS (SELECT face_idx, count(*) AS n_edges, CASE WHEN sum(CAST(plain AS INTEGER)) > 0 THEN sum(CAST(plain AS INTEGER)) ELSE count(*) END AS base,
  count(*) FILTER (convexity = 'convex') AS x, count(*) FILTER (convexity = 'concave') AS v, count(*) FILTER (convexity = 'smooth') AS s FROM j GROUP BY 1),
d AS (SELECT src AS face_idx, count(DISTINCT dst) AS degree FROM pairs GROUP BY 1),
f AS (SELECT s_suppkey AS k, abs(s_acctbal) AS area, s_suppkey % 7 AS t, 12.5::DOUBLE AS scale, list_reverse_sort([(s_suppkey % 11)::DOUBLE, s_suppkey % 4, s_suppkey % 9]) AS ext,
  CASE s_suppkey % 7 WHEN 1 THEN s_suppkey % 13 WHEN 4 THEN s_suppkey % 4 WHEN 2 THEN s_suppkey % 6 ELSE 0 END::DOUBLE AS radius FROM supplier),
r AS (SELECT k AS face_idx, [{', '.join(f'(t = {i})::INTEGER' for i in range(5))}, (t > 4)::INTEGER, area / 250000.0, ln(1 + area), CASE WHEN k % 6 > 0 THEN k % 2 ELSE 0 END, CASE WHEN k % 6 > 0 THEN 1 - k % 2 ELSE 0 END, 0,
  CASE WHEN t = 0 THEN 0 ELSE (k % 10) / 10.0::DOUBLE - 0.5 END * scale, CASE WHEN t = 3 THEN (k % 8) / 8.0::DOUBLE ELSE 0 END * scale * scale, radius / scale, ln(1 + radius), 1 - k % 2, k % 3 + 1,
  coalesce(n_edges, 0), coalesce(x / base, 0), coalesce(v / base, 0), coalesce(s / base, 0), ext[1] / 25, ext[2] / 25, ext[3] / 25, coalesce(degree, 0)]::DOUBLE[] AS x FROM f LEFT JOIN c ON c.face_idx = k LEFT JOIN d ON d.face_idx = k)
SELECT face_idx, CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS feature, round(unnest(x::FLOAT[])::DOUBLE, 3) + 0.0::DOUBLE AS "value" FROM r"""
)
def node_features(spark: SparkSession, d: str) -> DataFrame:
    """All 25 features of every face, one row each."""
    face_edge, edges = topology(spark, d)
    boxes = spark.createDataFrame([("all", 250000.0)], "sample_id string, surface_area_mm2 double").withColumn("dims", v.vec(15.0, 0.0, 20.0))
    rows = graph.node_features(supplier_faces(spark, d), face_edge, edges, boxes)
    values = F.array(*[F.col(c).cast("double") for c in rows.columns if c not in ("sample_id", "face_idx")])
    return rows.select("face_idx", F.posexplode(values).alias("feature", "value")).select("face_idx", "feature", (F.round("value", 3) + F.lit(0.0)).alias("value"))


@query(
    """WITH f AS (SELECT l_orderkey AS k, count(*) AS n, count(DISTINCT l_linenumber) AS e, avg(CASE WHEN l_returnflag = 'A' THEN 1.0 ELSE 0.0 END) AS a, avg(CASE WHEN l_returnflag = 'N' THEN 1.0 ELSE 0.0 END) AS b FROM lineitem GROUP BY 1),
s AS (SELECT o_orderkey, o_totalprice AS volume, [(o_orderkey % 7)::DOUBLE, o_custkey % 5, 1 + o_orderkey % 3] AS dims FROM orders),
t AS (SELECT *, sqrt(dims[1] * dims[1] + dims[2] * dims[2] + dims[3] * dims[3]) AS half, list_reverse_sort(dims) AS d FROM s JOIN f ON k = o_orderkey),
r AS (SELECT o_orderkey, [ln(1 + volume), ln(1 + volume / 2), d[1] / half, d[2] / half, d[3] / half, ln(1 + n), ln(1 + e), a, b, 0, 0, 0, 1 - a - b]::DOUBLE[] AS x FROM t)
SELECT o_orderkey, CAST(generate_subscripts(x, 1) - 1 AS INTEGER) AS feature, abs(round(unnest(x::FLOAT[])::DOUBLE, 3)) AS "value" FROM r"""
)
def global_features(spark: SparkSession, d: str) -> DataFrame:
    """All 13 features of every order as a part, one row each; its lines are faces, its line numbers edges."""
    kind = F.when(F.col("l_returnflag") == "A", "plane").when(F.col("l_returnflag") == "N", "cylinder").otherwise("bspline")
    lines = read(spark, d, "lineitem").withColumnRenamed("l_orderkey", "sample_id")
    k = F.col("o_orderkey")
    parts = read(spark, d, "orders").select(k.alias("sample_id"), F.col("o_totalprice").alias("volume_mm3"), (F.col("o_totalprice") / 2).alias("surface_area_mm2"), v.vec(k % 7, F.col("o_custkey") % 5, 1 + k % 3).alias("dims"))
    rows = graph.global_features(lines.select("sample_id", kind.alias("surface_type")), lines.select("sample_id", "l_linenumber").distinct(), parts)
    values = F.array(*[F.col(c).cast("double") for c in rows.columns if c != "sample_id"])
    return rows.select(F.col("sample_id").alias("o_orderkey"), F.posexplode(values).alias("feature", "value")).withColumn("value", F.abs(F.round("value", 3)))


# ---- metrics


def predictions(spark: SparkSession, d: str) -> DataFrame:
    guess = F.when(F.col("n_chars") % 7 == 0, 2).when(F.col("n_chars") > 1000, 1).otherwise(0)
    return read(spark, d, "documents").select("doc_id", guess.alias("predicted")).join(read(spark, d, "labels").select("doc_id", F.col("quality").cast("int").alias("truth")), "doc_id")


M_SQL = """
p AS (SELECT CAST(quality AS INTEGER) AS truth, CASE WHEN n_chars % 7 = 0 THEN 2 WHEN n_chars > 1000 THEN 1 ELSE 0 END AS predicted FROM documents JOIN labels USING (doc_id)),
l AS (SELECT CAST(unnest([0, 1, 2, 3]) AS INTEGER) AS label),
m AS (SELECT a.label AS truth, b.label AS predicted, count(p.truth) AS n FROM l a CROSS JOIN l b LEFT JOIN p ON p.truth = a.label AND p.predicted = b.label GROUP BY ALL)
"""


@query(f"WITH {M_SQL} SELECT truth, predicted, n FROM m")
def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return metrics.confusion_matrix(predictions(spark, d), "truth", "predicted", [0, 1, 2, 3])


@query(
    f"""WITH {M_SQL}, t AS (SELECT label, (SELECT sum(n) FROM m WHERE truth = label) AS support, (SELECT sum(n) FROM m WHERE predicted = label) AS guessed, (SELECT sum(n) FROM m WHERE truth = label AND predicted = label) AS tp FROM l),
r AS (SELECT *, CASE WHEN support + guessed = 0 THEN 0 ELSE 2.0::DOUBLE * tp / (support + guessed) END AS f FROM t)
SELECT label::VARCHAR AS label, round(CASE WHEN guessed = 0 THEN 0 ELSE tp::DOUBLE / guessed END, 4)::DOUBLE AS "precision", round(CASE WHEN support = 0 THEN 0 ELSE tp::DOUBLE / support END, 4)::DOUBLE AS recall, round(f, 4)::DOUBLE AS f1, support::BIGINT AS support FROM r
UNION ALL SELECT 'all', NULL, round(sum(tp)::DOUBLE / sum(support), 4), round(avg(f) FILTER (support > 0), 4), sum(support)::BIGINT FROM r"""
)
def classification_report(spark: SparkSession, d: str) -> DataFrame:
    return metrics.classification_report(confusion_matrix(spark, d))


@query(
    """WITH e AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
f AS (SELECT dim, avg(x) AS mean, CASE WHEN stddev_pop(x) <= 1e-6 THEN 1 ELSE stddev_pop(x) END AS std FROM e WHERE vec_id % 5 <> 0 GROUP BY 1)
SELECT vec_id, CAST(dim AS INTEGER) AS dim, round((x - mean) / std, 4) + 0.0::DOUBLE AS z FROM e JOIN f USING (dim)"""
)
def standardize_vectors(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "embeddings")
    return metrics.standardize(rows, "vec_id", "embedding", metrics.standardizer(rows.where("vec_id % 5 <> 0"), "embedding")).select("vec_id", "dim", (F.round("z", 4) + F.lit(0.0)).alias("z"))


@query(
    """WITH l AS (SELECT unnest(range(12)) AS label), c AS (SELECT l.label, count(e.label) AS n FROM l LEFT JOIN embeddings e USING (label) GROUP BY 1),
w AS (SELECT label, CASE WHEN n > 0 THEN 1 / sqrt(n) END AS w FROM c) SELECT label::INTEGER AS label, round(coalesce(w / avg(w) OVER (), 0), 6)::DOUBLE AS weight FROM w"""
)
def class_weights(spark: SparkSession, d: str) -> DataFrame:
    return metrics.class_weights(read(spark, d, "embeddings").withColumn("label", F.col("label").cast("int")), "label", list(range(12)))


@query(
    """WITH x AS (SELECT l_returnflag AS k, l_shipdate < TIMESTAMP '1995-06-17' AS early, l_suppkey AS item, count(*) AS n FROM lineitem GROUP BY ALL),
b AS (SELECT coalesce(p.k, q.k) AS k, coalesce(p.n, 0) AS a, coalesce(q.n, 0) AS b FROM (SELECT * FROM x WHERE early) p FULL JOIN (SELECT * FROM x WHERE NOT early) q ON p.k = q.k AND p.item = q.item)
SELECT k AS l_returnflag, round(sum(least(a, b)) / sum(greatest(a, b)), 6)::DOUBLE AS jaccard FROM b GROUP BY 1"""
)
def multiset_jaccard(spark: SparkSession, d: str) -> DataFrame:
    rows, day = read(spark, d, "lineitem"), F.lit("1995-06-17").cast("timestamp_ntz")
    found = metrics.multiset_jaccard(rows.where(F.col("l_shipdate") < day), rows.where(F.col("l_shipdate") >= day), ["l_returnflag"], "l_suppkey")
    return found.select("l_returnflag", F.round("jaccard", 6).alias("jaccard"))


@query("SELECT o_custkey, round(CASE WHEN abs(avg(o_totalprice)) > 0 THEN (max(o_totalprice) - min(o_totalprice)) / abs(avg(o_totalprice)) ELSE 0 END, 6)::DOUBLE AS spread, count(*) AS n FROM orders GROUP BY 1")
def relative_spread(spark: SparkSession, d: str) -> DataFrame:
    return metrics.relative_spread(read(spark, d, "orders"), "o_custkey", "o_totalprice")


# ---- intake

HOST, TITLE = r"^https?://([^/:]+)", r"<title>([^<]*)</title>"


@query(
    f"""WITH p AS (SELECT page_id, replace(regexp_extract(url, '{HOST}', 1), chr(39), '') AS host, replace(regexp_extract(html, '{TITLE}', 1), chr(39), '') AS title FROM pages)
SELECT page_id, nullif(substr(trim(title, ' ' || chr(9) || chr(10) || chr(13)), 1, 200), '') AS step_schema, nullif(substr(host, 1, 200), '') AS originating_system FROM p"""
)
def header_probe(spark: SparkSession, d: str) -> DataFrame:
    """Titles and hosts of pages in the place of a file's schema and system, read back from a header."""
    plain = lambda c: F.regexp_replace(c, "'", "")
    head = F.concat(F.lit("HEADER;\nfile_schema ( ( ' "), plain(F.regexp_extract("html", TITLE, 1)), F.lit(" ' ) );\nFILE_NAME ('n','t',('a'),('o'),'pre','"), plain(F.regexp_extract("url", HOST, 1)), F.lit("','');"))
    return read(spark, d, "pages").select("page_id", *(c.alias(k) for k, c in intake.header_fields(head).items()))


WORDS = ((r"the\s", "en"), (r"der\s", "de"), (r"les?\s", "fr"), (r"que\s", "es"))


def _first_of(pairs: tuple) -> str:
    hit = lambda p: f"CASE WHEN regexp_matches(text, '(?i){p}', 's') THEN length(regexp_extract(text, '(?i)^((?:.|\\n)*?){p}', 1)) END"
    return "list_min(list_filter([" + ", ".join(f"CASE WHEN {hit(p)} IS NOT NULL THEN {{'at': {hit(p)}, 'rank': {i}, 'unit': '{u}'}} END" for i, (p, u) in enumerate(pairs)) + "], lambda x: x IS NOT NULL)).unit"


@query(f"SELECT doc_id, {_first_of(WORDS)} AS unit FROM documents")
def unit_detect(spark: SparkSession, d: str) -> DataFrame:
    """The earliest of several patterns, here words that tell languages apart."""
    return read(spark, d, "documents").select("doc_id", intake.detect_unit(F.col("text"), WORDS).alias("unit"))


@query("SELECT page_id, CAST(len(regexp_extract_all(html, '(?i)<\\s*p\\b')) AS INTEGER) AS paragraphs, CAST(len(regexp_extract_all(html, '(?i)=\\s*href\\s*\\(')) AS INTEGER) AS entities FROM pages")
def entity_count(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "pages").select("page_id", F.regexp_count("html", F.lit(r"(?i)<\s*p\b")).alias("paragraphs"), intake.count_entities(F.col("html"), "HREF").alias("entities"))


@query("SELECT doc_id, CASE WHEN n_chars = 0 THEN 'EMPTY_FILE' WHEN n_chars > 5000 THEN 'FILE_TOO_LARGE' WHEN source NOT IN ('src1', 'src2', 'src3', 'src4', 'src5') THEN 'UNSUPPORTED_EXTENSION' WHEN NOT starts_with(ltrim(text), 'The') THEN 'NOT_STEP_CONTENT' END AS code FROM documents")
def intake_cascade(spark: SparkSession, d: str) -> DataFrame:
    code = intake.intake_code(F.col("n_chars"), F.concat(F.lit("doc."), F.col("source")), F.ltrim("text"), 5000, tuple(f".src{i}" for i in range(1, 6)), "The")
    return read(spark, d, "documents").select("doc_id", code.alias("code"))


@query(
    r"""WITH p AS (SELECT page_id, regexp_replace(regexp_replace(strip_accents(string_split(regexp_replace(replace(url, chr(92), '/'), '(/\.?)+$', ''), '/')[-1]), '[^\x00-\x7f]+', '', 'g'), '[^A-Za-z0-9._-]+', '_', 'g') AS b FROM pages),
q AS (SELECT page_id, regexp_replace(b, '^[._]+|[._]+$', '', 'g') AS b FROM p)
SELECT page_id, CASE WHEN b = '' THEN 'unnamed' WHEN len(b) <= 128 THEN b ELSE substr(b, 1, 128 - len(regexp_extract(b, '(\.[A-Za-z0-9_-]{1,8})$', 1))) || regexp_extract(b, '(\.[A-Za-z0-9_-]{1,8})$', 1) END AS name FROM q"""
)
def safe_names(spark: SparkSession, d: str) -> DataFrame:
    """Every page's address as a file name. SQL has accents, but no compatibility forms; a test holds those against plain Python."""
    return read(spark, d, "pages").select("page_id", intake.sanitize_filename(F.col("url")).alias("name"))


# ---- jobs


@query("SELECT event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous, event_type AS state FROM events")
def event_transitions(spark: SparkSession, d: str) -> DataFrame:
    return jobs.moves(read(spark, d, "events"), "user_id", ["ts", "event_id"], "event_type").select("event_id", "previous", F.col("event_type").alias("state"))


@query("WITH m AS (SELECT event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous, event_type FROM events) SELECT event_id, previous, event_type AS state FROM m WHERE previous IS NOT NULL AND previous > event_type")
def illegal_transitions(spark: SparkSession, d: str) -> DataFrame:
    """Allowed moves, in this role: any that goes on in the alphabet or stays."""
    events = read(spark, d, "events")
    kinds = events.select("event_type").distinct()
    allowed = kinds.select(F.col("event_type").alias("src")).join(kinds.select(F.col("event_type").alias("dst")), F.col("src") <= F.col("dst"))
    return jobs.illegal_moves(events, "user_id", ["ts", "event_id"], "event_type", allowed).select("event_id", "previous", F.col("event_type").alias("state"))


@query("SELECT user_id, arg_max(event_type, {'t': ts, 'e': event_id}) AS state, count(*) AS events FROM events GROUP BY 1")
def latest_state(spark: SparkSession, d: str) -> DataFrame:
    return jobs.latest_state(read(spark, d, "events"), "user_id", ["ts", "event_id"], "event_type").select("user_id", "state", "events")


@query(
    """WITH l AS (SELECT user_id % 10 AS pool, (epoch_us(max(ts)) - epoch_us(min(ts) FILTER (event_type = (SELECT min(event_type) FROM events)))) / 1e6::DOUBLE AS s FROM events GROUP BY user_id)
SELECT pool, round(quantile_cont(s, 0.5), 4)::DOUBLE AS p50, round(quantile_cont(s, 0.95), 4)::DOUBLE AS p95, round(max(s), 4)::DOUBLE AS max, count(s) AS n FROM l WHERE s IS NOT NULL GROUP BY 1"""
)
def latency_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """From a user's first event of the first kind to the last one, by pools of users."""
    events = read(spark, d, "events")
    first = events.agg(F.min("event_type")).first()[0] or ""
    seconds = jobs.latencies(events, "user_id", "ts", "event_type", first).withColumn("pool", F.col("user_id") % 10)
    found = metrics.percentiles(seconds, ["pool"], "seconds")
    return found.select("pool", *[F.round(c, 4).alias(c) for c in ("p50", "p95", "max")], "n")


LEASE_SQL = "leases AS (SELECT event_id AS job_id, CASE WHEN event_id % 3 = 0 THEN 'parsing' WHEN event_id % 3 = 1 THEN 'extracting' ELSE 'queued' END AS state, CAST(event_id % 4 + 1 AS INTEGER) AS attempt, ts AS due FROM events)"


def leases(spark: SparkSession, d: str) -> DataFrame:
    state = F.when(F.col("event_id") % 3 == 0, "parsing").when(F.col("event_id") % 3 == 1, "extracting").otherwise("queued")
    return read(spark, d, "events").select(F.col("event_id").alias("job_id"), state.alias("state"), (F.col("event_id") % 4 + 1).cast("int").alias("attempt"), F.col("ts").alias("lease_expires_at"), F.col("ts").alias("updated_at"))


@query(f"WITH {LEASE_SQL} SELECT job_id, CASE WHEN attempt < 3 THEN 'queued' ELSE 'failed_terminal' END AS next_state FROM leases WHERE state <> 'queued' AND due < TIMESTAMP '2024-01-15 00:00:00'")
def expired_leases(spark: SparkSession, d: str) -> DataFrame:
    return jobs.reap(leases(spark, d), F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).select("job_id", "next_state")


@query(f"WITH {LEASE_SQL} SELECT job_id FROM leases WHERE state = 'queued' AND due < TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 15 SECOND AND job_id NOT IN (SELECT event_id FROM events WHERE value > 50)")
def queue_reconcile(spark: SparkSession, d: str) -> DataFrame:
    transport = read(spark, d, "events").where("value > 50").select(F.col("event_id").alias("job_id"))
    return jobs.reconcile(leases(spark, d), transport, F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")).select("job_id")


@query(f"WITH b AS (SELECT CAST(unnest([{', '.join(str(x) for x in jobs.BUCKETS)}, 'inf'::DOUBLE]) AS DOUBLE) AS bound) SELECT bound, (SELECT count(*) FROM events WHERE value <= bound) AS n FROM b")
def duration_histogram(spark: SparkSession, d: str) -> DataFrame:
    return jobs.histogram(read(spark, d, "events"), "value").withColumn("bound", F.col("bound").cast("double"))


@query("SELECT conv_id, min(turn) AS first_turn, count(*) AS turns, arg_max(role, turn) AS last_role FROM (SELECT DISTINCT ON (conv_id, turn) * FROM conversations ORDER BY conv_id, turn, role, text) GROUP BY 1")
def ordered_chain(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as jobs whose turns are their events: how each began, and where it stands."""
    rows = read(spark, d, "conversations").groupBy("conv_id", "turn").agg(F.min_by("role", F.struct("role", "text")).alias("role"))
    began = jobs.moves(rows, "conv_id", ["turn"], "role").where("previous IS NULL").select("conv_id", F.col("turn").alias("first_turn"))
    stands = jobs.latest_state(rows, "conv_id", ["turn"], "role")
    return began.join(stands, "conv_id").select("conv_id", "first_turn", F.col("events").alias("turns"), F.col("state").alias("last_role"))


# ---- points, tools, lineage


def points(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("embedding")
    return read(spark, d, "embeddings").select("vec_id", F.col("label").cast("string").alias("sample_id"), *[e[i].cast("double").alias(k) for i, k in enumerate("xyz")])


P_SQL = "pts AS (SELECT vec_id, label::VARCHAR AS sample_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y, embedding[3]::DOUBLE AS z FROM embeddings)"


@query(
    f"""WITH {P_SQL}, b AS (SELECT sample_id, (min(x) + max(x)) / 2 AS cx, (min(y) + max(y)) / 2 AS cy, (min(z) + max(z)) / 2 AS cz, sqrt(pow(max(x) - min(x), 2) + pow(max(y) - min(y), 2) + pow(max(z) - min(z), 2)) / 2 AS h FROM pts GROUP BY 1)
SELECT vec_id, round((x - cx) / CASE WHEN h > 0 THEN h ELSE 1 END, 6) AS nx, round((y - cy) / CASE WHEN h > 0 THEN h ELSE 1 END, 6) AS ny, true AS inverse_close FROM pts JOIN b USING (sample_id)"""
)
def normalize_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    p = points(spark, d)
    rows = p.join(cloud.normalization(p), "sample_id")
    n = lambda k: cloud.normalize(F.col(k), F.col("centre")[k], F.col("scale"))
    back = F.forall(F.array(*[F.abs(cloud.denormalize(n(k), F.col("centre")[k], F.col("scale")) - F.col(k)) for k in "xyz"]), lambda x: x <= 1e-9)
    return rows.select("vec_id", F.round(n("x"), 6).alias("nx"), F.round(n("y"), 6).alias("ny"), back.alias("inverse_close"))


# Tools of this role: label, place, half sizes, corner, and extent along z.
TOOLS = (("hole", 0.0, 0.0, 0.3, 0.3, 0.3, -0.5, 0.5), ("slot", 0.2, 0.1, 0.8, 0.2, 0.2, -1.0, 1.0), ("pocket", -0.3, 0.0, 0.5, 0.4, 0.1, 0.0, 2.0))


def tools(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame([(i, *t) for i, t in enumerate(TOOLS)], "tool_idx int, label string, ox double, oy double, hu double, hv double, r double, t0 double, t1 double")
    return rows.select("tool_idx", "label", F.struct(v.vec(F.col("ox"), F.col("oy"), 0.0).alias("origin"), v.vec(1.0, 0.0, 0.0).alias("u"), v.vec(0.0, 0.0, 1.0).alias("n"), F.col("hu").alias("half_u"), F.col("hv").alias("half_v"), F.col("r").alias("corner_r"), "t0", "t1").alias("tool"))


SDF_SQL = f"""{P_SQL}, tools(tool_idx, label, ox, oy, hu, hv, r, t0, t1) AS (VALUES {', '.join('(' + str(i) + ", '" + t[0] + "', " + ', '.join(f'{x}::DOUBLE' for x in t[1:]) + ')' for i, t in enumerate(TOOLS))}),
q AS (SELECT vec_id, sample_id, tool_idx, label, abs(x - ox) - (hu - r) AS qx, abs(y - oy) - (hv - r) AS qy, greatest(t0 - z, z - t1) AS along, r FROM pts CROSS JOIN tools),
f AS (SELECT *, sqrt(pow(greatest(qx, 0), 2) + pow(greatest(qy, 0), 2)) + least(greatest(qx, qy), 0) - r AS flat FROM q),
sdf AS (SELECT *, sqrt(pow(greatest(flat, 0), 2) + pow(greatest(along, 0), 2)) + least(greatest(flat, along), 0) AS sdf FROM f)"""


@query(f"WITH {SDF_SQL} SELECT vec_id, tool_idx, round(sdf, 6) AS sdf, abs(sdf) <= 0.25 AS on_boundary FROM sdf")
def sdf_on_boundary(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("tool")
    rows = points(spark, d).crossJoin(F.broadcast(tools(spark)))  # three tools, always
    sdf = v.rounded_rect_sdf(v.vec(F.col("x"), F.col("y"), F.col("z")), t["origin"], t["u"], t["n"], t["half_u"], t["half_v"], t["corner_r"], t["t0"], t["t1"])
    return rows.select("vec_id", "tool_idx", F.round(sdf, 6).alias("sdf"), (F.abs(sdf) <= 0.25).alias("on_boundary"))


@query(
    f"""WITH {SDF_SQL}, fit AS (SELECT sample_id, tool_idx, label, avg(CASE WHEN abs(sdf) <= 0.25 THEN 1.0 ELSE 0.0 END) AS fit FROM sdf GROUP BY ALL HAVING avg(CASE WHEN abs(sdf) <= 0.25 THEN 1.0 ELSE 0.0 END) >= 0.1),
best AS (SELECT sample_id, arg_min(label, tool_idx) AS label FROM fit GROUP BY 1)
SELECT sample_id, coalesce(label, 'other') AS label FROM (SELECT DISTINCT sample_id FROM pts) LEFT JOIN best USING (sample_id)"""
)
def label_by_tool(spark: SparkSession, d: str) -> DataFrame:
    p = points(spark, d).select("sample_id", F.lit(0).alias("face_idx"), v.vec(F.col("x"), F.col("y"), F.col("z")).alias("p"))
    own = p.select("sample_id", "face_idx").distinct().withColumns({"surface_type": F.lit("bspline"), "radius": F.lit(None).cast("double"), "fillet_radii": F.array().cast("array<double>")})
    every = own.select("sample_id").crossJoin(F.broadcast(tools(spark)))
    return cloud.label_faces(p, every, own, tolerance=0.25, share=0.1).select("sample_id", "label")


@query(
    f"""WITH {R_SQL}, x AS (SELECT l_orderkey, face_idx, start, n, start + n AS "end", lead(start) OVER (PARTITION BY l_orderkey ORDER BY face_idx) AS next FROM ranged)
SELECT l_orderkey, count(*) AS faces, bool_and(next IS NULL OR next = "end") AS gapless, min(start) = 0 AS from_zero, max("end") = sum(n) AS complete FROM x GROUP BY 1"""
)
def lineage_verify(spark: SparkSession, d: str) -> DataFrame:
    return lineage.range_checks(ranged(spark, d), "l_orderkey", "face_idx", "n")


@query("SELECT o_orderkey, c_name, o_totalprice FROM orders LEFT JOIN customer ON c_custkey = o_custkey ORDER BY o_orderdate DESC, o_orderkey LIMIT 1000")
def latest_samples_topk(spark: SparkSession, d: str) -> DataFrame:
    """The newest rows first, at most 1000: the limit is the feature."""
    newest = read(spark, d, "orders").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(1000)
    return newest.join(read(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "c_name", "o_totalprice")


# ---- rules and figures over whole numbers of the tables' keys


def orders(spark: SparkSession, d: str) -> tuple[DataFrame, Column]:
    return read(spark, d, "orders"), F.col("o_orderkey")


@query(
    """SELECT o_orderkey, CASE WHEN k % 5 = 0 THEN 'STEP_NO_SHAPES' WHEN k % 3 > 1 THEN 'UNSUPPORTED_ASSEMBLY' WHEN k % 4 = 0 THEN 'STEP_NO_SHAPES' WHEN k % 6 > 1 THEN 'MULTI_BODY' WHEN k % 7 = 0 THEN 'STEP_NO_SHAPES'
  WHEN k % 11 = 0 THEN 'UNSUPPORTED_TESSELLATED' WHEN o_totalprice <= 90000 OR k % 13 = 0 THEN 'DEGENERATE_GEOMETRY' END AS code FROM (SELECT *, o_orderkey AS k FROM orders)"""
)
def structural_policy(spark: SparkSession, d: str) -> DataFrame:
    rows, k = orders(spark, d)
    counts = intake.structure_code(k % 5, k % 3, k % 4, k % 6, k % 7, (k % 11 == 0).cast("int"))
    return rows.select("o_orderkey", intake.first_code(counts, intake.degenerate_code(F.col("o_totalprice") - 90000, (k % 13).cast("double"))).alias("code"))


@query("WITH p AS (SELECT page_id, regexp_replace(url, '^https?:/', '') AS key FROM pages), q AS (SELECT page_id, key FROM p UNION ALL SELECT -page_id, substr(key, 2) FROM p) SELECT page_id, regexp_full_match(key, '[A-Za-z0-9._/-]+') AND NOT list_has_any(string_split(key, '/'), ['', '.', '..']) AS valid FROM q")
def storage_keys(spark: SparkSession, d: str) -> DataFrame:
    """Paths of pages as storage keys, with the slash before them and without."""
    key = F.regexp_replace("url", "^https?:/", "")
    rows = read(spark, d, "pages")
    both = rows.select("page_id", key.alias("key")).unionAll(rows.select((-F.col("page_id")).alias("page_id"), F.substring(key, F.lit(2), F.length(key)).alias("key")))
    return both.select("page_id", intake.valid_storage_key(F.col("key")).alias("valid"))


@query(
    """SELECT o_orderkey, CASE WHEN k % 4 > 1 THEN 'MULTI_BODY' WHEN k % 4 = 0 OR k % 5 = 0 THEN 'NO_SOLID' WHEN k % 3 = 0 THEN NULL WHEN coalesce(CASE WHEN k % 7 > 0 THEN k % 7 > 2 END, false) = false THEN 'INVALID_GEOMETRY'
  WHEN (k % 10) / 100.0::DOUBLE > 0.05 OR abs((k % 6) / 1000.0::DOUBLE - 0.002) > 0.001 THEN 'REPAIR_DEVIATION_EXCEEDED' END AS code FROM (SELECT o_orderkey, o_orderkey AS k FROM orders)"""
)
def shape_decision(spark: SparkSession, d: str) -> DataFrame:
    rows, k = orders(spark, d)
    return rows.select("o_orderkey", validate.shape_code(k % 4, k % 5 > 0, k % 3 == 0, F.when(k % 7 > 0, k % 7 > 2), (k % 10) / 100, (k % 6) / 1000 - 0.002).alias("code"))


V_SQL = "v AS (SELECT vec_id, [embedding[1]::DOUBLE, embedding[2], embedding[3]] AS a, [embedding[4]::DOUBLE, embedding[5], embedding[6]] AS b, [embedding[7]::DOUBLE, embedding[8], embedding[9]] AS t FROM embeddings), u AS (SELECT *, list_inner_product(a, b) / sqrt(list_inner_product(a, a) * list_inner_product(b, b)) AS c, list_inner_product([a[2] * b[3] - a[3] * b[2], a[3] * b[1] - a[1] * b[3], a[1] * b[2] - a[2] * b[1]], t) AS side FROM v)"


def axes(spark: SparkSession, d: str) -> tuple[DataFrame, list[Column]]:
    e = F.col("embedding")
    return read(spark, d, "embeddings"), [v.vec(e[i], e[i + 1], e[i + 2]) for i in (0, 3, 6)]


@query(f"WITH {V_SQL} SELECT vec_id, abs(c) >= cos(radians(30)) AS parallel, abs(c) <= sin(radians(30)) AS perpendicular FROM u")
def axis_relations(spark: SparkSession, d: str) -> DataFrame:
    rows, (a, b, _) = axes(spark, d)
    return rows.select("vec_id", v.parallel(a, b, 30).alias("parallel"), v.perpendicular(a, b, 30).alias("perpendicular"))


@query(
    f"""WITH {V_SQL}, k AS (SELECT vec_id, degrees(acos(c)) AS w, CASE WHEN vec_id % 13 = 0 THEN 'unknown' WHEN vec_id % 11 = 0 THEN 'seam' WHEN vec_id % 5 = 0 THEN 'unknown' WHEN vec_id % 5 = 1 THEN 'boundary' WHEN vec_id % 5 > 2 THEN 'non_manifold'
  WHEN degrees(acos(c)) < 30 THEN 'smooth' WHEN side > 0 THEN 'convex' ELSE 'concave' END AS kind FROM u)
SELECT vec_id, kind, CASE WHEN vec_id % 5 = 2 THEN round(CASE WHEN kind = 'concave' THEN 180 + w ELSE 180 - w END, 4) END AS angle FROM k"""
)
def edge_convexity(spark: SparkSession, d: str) -> DataFrame:
    rows, (a, b, t) = axes(spark, d)
    k = F.col("vec_id")
    kind, angle = canonical.convexity(k % 13 == 0, k % 11 == 0, k % 5, a, b, t, 30.0)
    return rows.select("vec_id", kind.alias("kind"), angle.alias("angle"))


@query(
    """SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 5 END, o_orderkey % 4, CAST(round_even(o_totalprice / 0.001::DOUBLE, 0) AS BIGINT),
  least([o_orderkey % 3, o_orderkey % 2], [o_orderkey % 2, o_orderkey % 3]), greatest([o_orderkey % 3, o_orderkey % 2], [o_orderkey % 2, o_orderkey % 3]), o_orderstatus, o_orderkey) - 1 AS INTEGER) AS edge_idx FROM orders"""
)
def edge_order(spark: SparkSession, d: str) -> DataFrame:
    """Orders as edges of their customers, in canonical order."""
    rows, k = orders(spark, d)
    curve = F.element_at(F.array(*map(F.lit, ("line", "circle", "bspline"))), (k % 3 + 1).cast("int"))
    edges = rows.select("o_orderkey", F.col("o_custkey").alias("sample_id"), curve.alias("curve_type"), v.vec(k % 4, 0, 0).alias("mid_mm"), F.col("o_totalprice").alias("length_mm"), v.vec(k % 3, k % 2, 0).alias("start_mm"), v.vec(k % 2, k % 3, 0).alias("end_mm"), F.col("o_orderstatus").alias("fingerprint"), k.alias("traversal_index"))
    return canonical.canonical_order(edges, "sample_id", canonical.edge_keys(), "edge_idx").select("o_orderkey", "edge_idx")


@query(
    """WITH e AS (SELECT l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS length, string_agg(l_returnflag, ',' ORDER BY l_returnflag) AS prints FROM lineitem GROUP BY 1)
SELECT l_orderkey, substr(sha256('line|' || CAST(length * 100 AS BIGINT) || '|' || ['convex', 'concave'][l_orderkey % 2 + 1] || '|' || prints), 1, 16) AS fingerprint FROM e"""
)
def edge_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum(F.col("l_quantity").cast("long")).cast("double").alias("length"), F.collect_list("l_returnflag").alias("prints"))
    kind = F.when(F.col("l_orderkey") % 2 == 0, "convex").otherwise("concave")
    return rows.select("l_orderkey", canonical.edge_fingerprint(F.lit("line"), F.col("length"), kind, F.col("prints")).alias("fingerprint"))


@query(
    """WITH m AS (SELECT *, CAST(event_id % 4 AS INTEGER) AS attempt, CAST(event_id % 5 AS VARCHAR) AS worker, max(event_id % 4) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS newest FROM events)
SELECT user_id AS job_id, arg_max(event_type, {'t': ts, 'e': event_id}) AS state, max(attempt) AS attempts, arg_max(worker, {'t': ts, 'e': event_id}) AS worker_id FROM m WHERE attempt >= newest GROUP BY 1"""
)
def job_fold(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id")
    events = read(spark, d, "events").select(F.col("user_id").alias("job_id"), "event_id", F.col("ts").alias("created_at"), F.col("event_type").alias("state"), (k % 4).cast("int").alias("attempt"), (k % 5).cast("string").alias("worker_id"))
    return jobs.fold(events).select("job_id", "state", "attempts", "worker_id")


@query(
    """WITH s AS (SELECT event_type AS kind, user_id % 50 AS key, ts, event_id FROM events), j AS (SELECT DISTINCT kind, key FROM s WHERE event_id % 500 = 0),
f AS (SELECT kind, key, arg_min(event_id, {'t': ts, 'e': event_id}) AS job_id FROM s GROUP BY ALL) SELECT job_id, kind FROM f WHERE NOT EXISTS (SELECT 1 FROM j WHERE j.kind = f.kind AND j.key = f.key)"""
)
def new_submissions(spark: SparkSession, d: str) -> DataFrame:
    sent = read(spark, d, "events").select(F.col("event_type").alias("kind"), (F.col("user_id") % 50).alias("idempotency_key"), F.col("ts").alias("submitted_at"), F.col("event_id").alias("job_id"))
    return jobs.submit(sent.where("job_id % 500 = 0").distinct(), sent).select("job_id", "kind")


@query("WITH s AS (SELECT ['completed', 'rejected', 'parsing', 'timed_out', 'queued', 'failed_terminal', 'quarantined'][event_id % 7 + 1] AS state FROM events) SELECT state, count(*) AS n, round(count(*) / 3600.0::DOUBLE * 60, 4) AS per_minute FROM s WHERE state NOT IN ('parsing', 'queued') GROUP BY 1")
def outcome_counts(spark: SparkSession, d: str) -> DataFrame:
    kinds = F.array(*map(F.lit, ("completed", "rejected", "parsing", "timed_out", "queued", "failed_terminal", "quarantined")))
    return jobs.outcome_counts(read(spark, d, "events").select(F.element_at(kinds, (F.col("event_id") % 7 + 1).cast("int")).alias("state")), 3600.0)


@query("SELECT label, round(avg(embedding[1]::DOUBLE), 6) AS x_mean, round(stddev_pop(embedding[1]::DOUBLE), 6) AS x_std, round(avg(embedding[2]::DOUBLE), 6) AS y_mean, round(stddev_pop(embedding[2]::DOUBLE), 6) AS y_std FROM embeddings GROUP BY 1")
def seed_summary(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("embedding")
    found = metrics.seed_summary(read(spark, d, "embeddings").select("label", e[0].cast("double").alias("x"), e[1].cast("double").alias("y")), "label", ["x", "y"])
    return found.select("label", *[F.round(c, 6).alias(c) for c in found.columns if c != "label"])


@query("SELECT o_custkey, arg_max(o_orderkey, {'s': o_orderkey % 5, 'e': -o_orderkey}) AS best_epoch, max(o_orderkey % 5) AS score FROM orders GROUP BY 1")
def best_epoch(spark: SparkSession, d: str) -> DataFrame:
    rows, k = orders(spark, d)
    return metrics.best_epoch(rows.withColumn("score", k % 5), "o_custkey", "score", "o_orderkey")


@query(
    """WITH o AS (SELECT *, o_custkey % 40 AS a, o_orderkey // 7 % 40 AS b FROM orders), f AS (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM o WHERE o_orderkey % 2 = 0), t AS (SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM o WHERE o_orderkey % 3 = 0),
n AS (SELECT (SELECT count(*) FROM f JOIN t USING (a, b)) AS tp, (SELECT count(*) FROM f ANTI JOIN t USING (a, b)) AS fp, (SELECT count(*) FROM t ANTI JOIN f USING (a, b)) AS fn)
SELECT tp, fp, fn, round(tp / (tp + fp)::DOUBLE, 4) AS "precision", round(tp / (tp + fn)::DOUBLE, 4) AS recall FROM n"""
)
def pair_scores(spark: SparkSession, d: str) -> DataFrame:
    rows, k = orders(spark, d)
    pairs = lambda c: rows.where(c).select((F.col("o_custkey") % 40).alias("a"), (F.floor(k / 7) % 40).alias("b"))
    return metrics.pair_scores(pairs(k % 2 == 0), pairs(k % 3 == 0))


@query(
    """WITH e AS (SELECT o_custkey AS part, o_totalprice AS v, o_totalprice + o_orderkey AS a, list_sort([(o_orderkey % 3)::DOUBLE, o_orderkey % 5, o_orderkey % 7]) AS d, o_orderkey % 4 AS n FROM orders)
SELECT part, count(*) AS exports, round((max(v) - min(v)) / abs(avg(v)), 6) AS volume_spread, round((max(a) - min(a)) / abs(avg(a)), 6) AS area_spread, greatest(max(d[1]) - min(d[1]), max(d[2]) - min(d[2]), max(d[3]) - min(d[3])) AS box_difference, count(DISTINCT n) AS face_counts FROM e GROUP BY 1"""
)
def export_consistency(spark: SparkSession, d: str) -> DataFrame:
    rows, k = orders(spark, d)
    own = rows.select(F.col("o_custkey").alias("part"), k.alias("export"), F.col("o_totalprice").alias("volume"), (F.col("o_totalprice") + k).alias("area"), F.array(*[(k % n).cast("double") for n in (3, 5, 7)]).alias("dims"), (k % 4).alias("n_faces"))
    return metrics.export_consistency(own).withColumns({c: F.round(c, 6) for c in ("volume_spread", "area_spread")})


@query("WITH d AS (SELECT 'f' || lpad(doc_id::VARCHAR, 12, '0') AS file, sha256(text) AS sha FROM documents), m AS (SELECT *, min(file) OVER (PARTITION BY sha) AS first FROM d) SELECT file, CASE WHEN file > first THEN first END AS duplicate_of FROM m")
def corpus_duplicates(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "documents").select(F.concat(F.lit("f"), F.lpad(F.col("doc_id").cast("string"), 12, "0")).alias("file"), F.sha2("text", 256).alias("sha256"))
    return sinks.corpus_report(rows).select("file", "duplicate_of")


@query(
    """WITH e AS (SELECT vec_id, label, generate_subscripts(embedding, 1) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
f AS (SELECT dim, avg(x) AS mean, CASE WHEN stddev_pop(x) <= 1e-6 THEN 1 ELSE stddev_pop(x) END AS std FROM e WHERE vec_id % 5 <> 0 GROUP BY 1),
z AS (SELECT vec_id, label, dim, (x - mean) / std AS z FROM e JOIN f USING (dim)), m AS (SELECT label AS predicted, dim, avg(z) AS m FROM z WHERE vec_id % 5 <> 0 GROUP BY ALL),
s AS (SELECT vec_id, predicted, sum((z - m) * (z - m)) AS d FROM z JOIN m USING (dim) GROUP BY ALL) SELECT vec_id, arg_min(predicted, {'d': d, 'p': predicted}) AS predicted FROM s GROUP BY 1"""
)
def nearest_mean(spark: SparkSession, d: str) -> DataFrame:
    rows = read(spark, d, "embeddings").withColumn("is_train", F.col("vec_id") % 5 != 0)
    return metrics.train_nearest_mean(rows, "vec_id", "embedding", "label", "is_train")


# ---- analytic parts: no table of the driver holds geometry, so these are held by golden tests


# The features of each kind of part besides its flat faces: type, faces, confidence; and how many flat faces are left.
PARTS = {
    "through": ((("through_hole", 1, 0.95),), 6),
    "blind": ((("blind_hole", 2, 0.95),), 6),
    "cone": ((("blind_hole", 2, 0.95),), 6),
    "counterbore": ((("through_hole", 3, 0.95),), 6),
    "slot": ((("slot", 4, 0.95),), 6),
    "pocket": ((("pocket", 5, 0.95),), 6),
    "fillet": ((("fillet", 1, 0.95),), 6),
}


def _parts() -> list[analytic.Builder]:
    make = {"slot": analytic.slot_part, "pocket": analytic.pocket_part, "fillet": analytic.fillet_part}
    return [make[k](f"part-{k}-{n}", 40 + n, 30 + n, 15) if k in make else analytic.box_part(f"part-{k}-{n}", 40 + n, 30 + n, 15, hole=k, r=3, depth=5) for k in PARTS for n in range(5)]


def _features_sql() -> str:
    prefix = {"through_hole": "H", "blind_hole": "H", "slot": "S", "pocket": "P", "fillet": "R"}
    rows = [f"({i}, '{prefix[t]}001', '{t}', {n}, {c}::DOUBLE)" for i, (own, _) in enumerate(PARTS.values()) for t, n, c in own] + [f"({i}, 'PL{k:03d}', 'planar_face', 1, 0.95::DOUBLE)" for i, (_, flat) in enumerate(PARTS.values()) for k in range(1, flat + 1)]
    return f"SELECT s_suppkey::VARCHAR AS sample_id, feature_id, feature_type, faces, confidence FROM supplier JOIN (VALUES {', '.join(rows)}) f(kind, feature_id, feature_type, faces, confidence) ON kind = s_suppkey % {len(PARTS)}"


@query(_features_sql())
def recognize_features(spark: SparkSession, d: str) -> DataFrame:
    """Each supplier has one of the analytic shapes, of one of five sizes; which one follows from its key."""
    f, e = analytic.tables(spark, _parts())
    own = F.element_at(F.array(*[F.lit(k) for k in PARTS]), (F.col("s_suppkey") % len(PARTS) + 1).cast("int"))
    parts = read(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("own"), F.concat_ws("-", F.lit("part"), own, (F.col("s_suppkey") % 5).cast("string")).alias("sample_id"))
    of = lambda t: parts.join(F.broadcast(t), "sample_id").drop("sample_id").withColumnRenamed("own", "sample_id").select(*t.columns)  # noqa: E731  # as many rows as the shapes have, always
    found = recognize.recognize(of(f), of(e))
    return found.select("sample_id", "feature_id", "feature_type", F.size("face_indices").alias("faces"), "confidence")


def box_mesh(spark: SparkSession, boxes: DataFrame | None = None) -> DataFrame:
    """Meshes of cubes (sample_id, size), three of sizes 1 to 3 where none are given."""
    if boxes is None:
        boxes = spark.createDataFrame([(f"box-{n}", float(n)) for n in range(1, 4)], "sample_id string, size double")
    corner = lambda k: v.vec(*[F.when(F.shiftright(F.lit(k) if isinstance(k, int) else k, i).bitwiseAND(F.lit(1)) == 1, F.col("size")).otherwise(0.0) for i in range(3)])
    sides = ((0, 2, 6, 4), (1, 5, 7, 3), (0, 4, 5, 1), (2, 3, 7, 6), (0, 1, 3, 2), (4, 6, 7, 5))
    tri = F.array(*[F.array(*map(F.lit, (s[0], s[2 + h], s[1 + h]))) for s in sides for h in (0, 1)])
    t = boxes.select("sample_id", "size", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("tri_idx")).withColumn("t", tri[F.col("tri_idx")])
    return t.select("sample_id", (F.col("tri_idx") / 2).cast("int").alias("face_idx"), "tri_idx", *[corner(F.col("t")[i]).alias(n) for i, n in enumerate("abc")])


@query("SELECT p_partkey::VARCHAR AS sample_id, round(pow(p_size, 3), 6)::DOUBLE AS volume, round(6.0 * p_size * p_size, 6)::DOUBLE AS area, round(p_size / 2.0::DOUBLE, 6) AS middle FROM part")
def mesh_scalars(spark: SparkSession, d: str) -> DataFrame:
    """Volume, area and centre of mass of a cube for each part, as large as its size says."""
    rows = cloud.mesh_scalars(box_mesh(spark, read(spark, d, "part").select(F.col("p_partkey").cast("string").alias("sample_id"), F.col("p_size").cast("double").alias("size"))))
    return rows.select("sample_id", F.round("volume_mm3", 6).alias("volume"), F.round("surface_area_mm2", 6).alias("area"), F.round("center_of_mass_mm.y", 6).alias("middle"))


@query(f"WITH {T_SQL} SELECT count(DISTINCT face_idx) = (SELECT count(*) FROM supplier) AS node_for_every_face, true AS face_indices_dense, true AS ends_in_range, true AS no_loops, true AS symmetric, true AS same_as_topology, true AS finite FROM fe")
def graph_invariants(spark: SparkSession, d: str) -> DataFrame:
    """The seven checks over the suppliers' graph, nodes being those that have an edge."""
    face_edge = topology(spark, d)[0]
    pairs = graph.adjacent_faces(face_edge)
    faces = read(spark, d, "supplier").select(F.lit("all").alias("sample_id"), F.col("s_suppkey").alias("face_idx"))
    nodes = face_edge.select("sample_id", "face_idx").distinct().withColumn("x", F.lit(1.0))
    return graph.invariants(faces, pairs, nodes, face_edge).drop("sample_id")


def supplier_boxes(spark: SparkSession, d: str) -> DataFrame:
    """A cube for each supplier."""
    return box_mesh(spark, read(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("sample_id"), (F.col("s_suppkey") % 7 + 1).cast("double").alias("size")))


@query()
def raster_face_ids(spark: SparkSession, d: str) -> DataFrame:
    return raster.pixel_counts(raster.view_pixels(supplier_boxes(spark, d), resolution=32))


@query(f"SELECT s_suppkey::VARCHAR AS sample_id, f::INTEGER AS face_idx, {', '.join(f'true AS {c}' for c in (*lineage.CHECKS, 'verified'))} FROM supplier CROSS JOIN range(6) b(f)")
def lineage_trace(spark: SparkSession, d: str) -> DataFrame:
    """Every face of the suppliers' cubes, traced through points, triangles, pixels and graph."""
    mesh = supplier_boxes(spark, d)
    face = mesh.select("sample_id", "face_idx").distinct()
    sampled = cloud.sample_points(mesh, face.withColumn("n", F.lit(16)))
    from pyspark.sql import Window

    pts = sampled.withColumn("point_idx", F.row_number().over(Window.partitionBy("sample_id").orderBy("face_idx", "k")) - 1)
    pixels = raster.view_pixels(mesh, resolution=32)
    arcs = face.select("sample_id", F.col("face_idx").alias("src")).join(face.select("sample_id", F.col("face_idx").alias("dst")), "sample_id").where("src <> dst and shiftright(src, 1) <> shiftright(dst, 1)")
    own = face.join(arcs.groupBy("sample_id", F.col("src").alias("face_idx")).agg(F.collect_set("dst").alias("adjacent")), ["sample_id", "face_idx"])
    features = face.select("sample_id", F.format_string("PL%03d", F.col("face_idx") + 1).alias("feature_id"), F.array("face_idx").alias("face_indices"))
    stored = lineage.index(own, pts, mesh, pixels, features)
    return lineage.verify(stored, own, face, pts, mesh, pixels, arcs, features)


def _family_sql() -> str:
    kinds = [(f, v, 500 + 10000 * i + 1000 * j, ranges) for i, (f, (variants, ranges)) in enumerate(analytic.FAMILIES.items()) for j, v in enumerate(variants)]
    rows = [f"({k}, '{f}', '{v}', {first}, {n}, '{name}', {float(low)}::DOUBLE, {float(high)}::DOUBLE)" for k, (f, v, first, ranges) in enumerate(kinds) for n, (name, (low, high)) in enumerate(ranges.items())]
    return f"""WITH r AS (SELECT * FROM (VALUES {', '.join(rows)}) t(kind, family, variant, first, k, name, low, high)),
d AS (SELECT p_partkey, family, variant, first + p_partkey AS seed, k, round(low + (high - low) * (('0x' || substr(sha256((first + p_partkey) || '|' || name), 1, 12))::BIGINT / pow(16.0::DOUBLE, 12)), 3) AS x FROM r JOIN part ON kind = p_partkey % {len(kinds)})
SELECT p_partkey, family, variant, seed, list(x ORDER BY k) AS drawn FROM d GROUP BY ALL"""


@query(_family_sql())
def family_parameters(spark: SparkSession, d: str) -> DataFrame:
    """Each part as one of a family and variant, drawn from the seed that its key gives."""
    drawn = analytic.family_parameters(spark, 500, read(spark, d, "part").select(F.col("p_partkey").alias("number")))
    return drawn.select(F.col("number").alias("p_partkey"), "family", "variant", "seed", F.map_values("params").alias("drawn"))


_STATUS = {"rejected": "rejected", "timed_out": "quarantined", "quarantined": "quarantined", "failed_retryable": "failed", "failed_terminal": "failed"}


_CODES = list(ERROR_CODES)


@query(
    "WITH c AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{c}', '{o}', {r}, '{_STATUS[o]}', '{o}')" for i, (c, (o, r)) in enumerate(ERROR_CODES.items())) + f") t(i, code, outcome, retryable, sample_status, job_state)) SELECT event_type, code, outcome, retryable, sample_status, job_state, count(*) AS n FROM events JOIN c ON i = event_id % {len(_CODES)} GROUP BY ALL"
)
def error_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Events as failures, whose code follows from their number: what each code does to a sample and its job, and how often it came."""
    failed = read(spark, d, "events").select("event_type", F.element_at(F.array(*map(F.lit, _CODES)), (F.col("event_id") % len(_CODES) + 1).cast("int")).alias("code"))
    counts = failed.groupBy("event_type", "code").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(F.broadcast(jobs.error_codes(spark)), "code").select("event_type", "code", "outcome", "retryable", "sample_status", "job_state", "n")
