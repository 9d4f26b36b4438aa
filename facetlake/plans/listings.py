"""Queries of listings, a dataset's quality and description, and a run's predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetlake.functions.identity import config_hash
from facetlake.operators import dataset, listing, near_duplicates
from facetlake.plans.catalogue import BUILD_SQL, DATASET_ID_SQL, S_SQL, SEED, _digest_sql, _signature_columns, assigned, query, read, samples

_STATES = ("completed", "rejected", "quarantined")


@query(
    f"""SELECT o_custkey AS sample_id, o_orderkey AS job_id, {list(_STATES)}[o_orderkey % 3 + 1] AS state, c_name AS filename, CASE WHEN o_orderkey % 3 = 1 THEN 'EMPTY_FILE' END AS error_code
FROM orders LEFT JOIN customer ON c_custkey = o_custkey WHERE o_orderpriority <> '5-LOW' AND o_orderstatus <> 'P' ORDER BY o_orderdate DESC, o_orderkey LIMIT 1000"""
)
def list_samples(spark: SparkSession, d: str) -> DataFrame:
    """Orders as jobs: urgent ones process a file, those pending have no sample yet."""
    k = F.col("o_orderkey")
    state = F.element_at(F.array(*map(F.lit, _STATES)), (k % 3 + 1).cast("int"))
    jobs = read(spark, d, "orders").select(k.alias("job_id"), F.when(F.col("o_orderpriority") != "5-LOW", "process").otherwise("train").alias("kind"), F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("sample_id"), F.col("o_custkey").alias("file_id"), state.alias("state"), F.when(k % 3 == 1, "EMPTY_FILE").alias("error_code"), F.col("o_orderdate").alias("created_at"))
    return listing.list_samples(jobs, read(spark, d, "customer").select(F.col("c_custkey").alias("file_id"), F.col("c_name").alias("filename")), limit=5000)


def _built(spark: SparkSession, d: str) -> tuple[dict[str, DataFrame], DataFrame]:
    clusters = near_duplicates.near_duplicate_clusters(read(spark, d, "documents"), "doc_id", *_signature_columns())
    return dataset.build(samples(spark, d), clusters, SEED), clusters


@query(
    f"""{BUILD_SQL}
SELECT 'included' AS section, 'all' AS key, count(*) AS n FROM placed HAVING count(*) > 0 UNION ALL SELECT 'split', split, count(*) FROM placed GROUP BY 2
UNION ALL SELECT 'label', split || '/' || coalesce(label::VARCHAR, 'none'), count(*) FROM placed GROUP BY 2 UNION ALL SELECT 'agreement', split, CAST(sum(coalesce(label = rule_label, false)::INTEGER) AS BIGINT) FROM placed GROUP BY 2
UNION ALL SELECT 'excluded', 'all', count(*) FROM excluded HAVING count(*) > 0 UNION ALL SELECT 'reason', split_part(reason, ':', 1), count(*) FROM excluded GROUP BY 2
UNION ALL SELECT 'families', split, count(DISTINCT family) FROM placed GROUP BY 2 UNION ALL SELECT 'groups', split, count(DISTINCT design_group) FROM placed GROUP BY 2
UNION ALL SELECT 'crossing', 'units', count(*) FROM (SELECT split_unit FROM placed GROUP BY 1 HAVING count(DISTINCT split) > 1) HAVING count(*) > 0
UNION ALL SELECT 'crossing', 'families', count(*) FROM (SELECT family FROM placed GROUP BY 1 HAVING count(DISTINCT split) > 1) HAVING count(*) > 0
UNION ALL SELECT 'near_duplicate_clusters', 'all', count(DISTINCT cluster) FROM clusters HAVING count(*) > 0"""
)
def dataset_quality(spark: SparkSession, d: str) -> DataFrame:
    built, clusters = _built(spark, d)
    return listing.quality(built["samples"], built["excluded"], clusters)




@query(
    f"""{BUILD_SQL}, own AS (SELECT {DATASET_ID_SQL} AS dataset_id, (SELECT count(*) FROM placed) AS included, (SELECT count(*) FROM excluded) AS excluded, {_digest_sql("placed", "sample_id", "label")} AS labels)
SELECT dataset_id, included, excluded, labels AS label_content_sha256, '{config_hash()}' AS configuration_hash, 'group' AS mode, {SEED}::BIGINT AS seed, '["0","1"]' AS vocabulary FROM own"""
)
def dataset_description(spark: SparkSession, d: str) -> DataFrame:
    """The description is read back by path, as its readers would."""
    built, _ = _built(spark, d)
    rows = listing.describe(built["dataset"], built["samples"], SEED, "group", ("0", "1")).withColumn("v", F.parse_json("description"))
    get = lambda path, kind: F.variant_get("v", path, kind)
    return rows.select("dataset_id", get("$.included", "long").alias("included"), get("$.excluded", "long").alias("excluded"), get("$.label_content_sha256", "string").alias("label_content_sha256"), get("$.configuration_hash", "string").alias("configuration_hash"), get("$.split_strategy.mode", "string").alias("mode"), get("$.split_strategy.seed", "long").alias("seed"), F.to_json(get("$.label_vocabulary", "variant")).alias("vocabulary"))


@query(
    f"""WITH {S_SQL}, p AS (SELECT doc_id AS sample_id, CAST(n_chars % 2 AS INTEGER) AS predicted, round(CAST(n_chars % 1000 AS DOUBLE) / 999, 4)::DOUBLE AS confidence FROM documents)
SELECT p.sample_id, 0 AS face_idx, l.quality AS ground_truth, predicted, confidence, coalesce(split, 'not_in_dataset') AS dataset_split FROM p LEFT JOIN labels l ON l.doc_id = p.sample_id LEFT JOIN assigned a ON a.sample_id = p.sample_id"""
)
def run_predictions(spark: SparkSession, d: str) -> DataFrame:
    """A guess at each document's label from its length, against what is known of it."""
    predicted = read(spark, d, "documents").select(F.col("doc_id").alias("sample_id"), F.lit(0).alias("face_idx"), (F.col("n_chars") % 2).cast("int").alias("predicted"), ((F.col("n_chars") % 1000).cast("double") / 999).alias("confidence"))
    truth = read(spark, d, "labels").select(F.col("doc_id").alias("sample_id"), F.lit(0).alias("face_idx"), F.col("quality").alias("label"))
    return listing.run_predictions(predicted, truth, assigned(spark, d).select("sample_id", "split"))
