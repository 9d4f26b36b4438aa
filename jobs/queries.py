"""The jobs as queries: each runs twice into a new folder in the cluster's shared one and gives the output as it stands then."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from facetlake.functions.constants import DEFAULT_CONFIG
from facetlake.functions.storage import shared_root
from facetlake.plans.catalogue import BUILD_SQL, CFG, DATASET_ID_SQL
from jobs import intake_stream, release_dataset


def _folder(spark: SparkSession, job: str) -> str:
    return f"{shared_root(spark)}/{job}-{uuid.uuid4().hex}"


def job1_intake_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = _folder(spark, "job1")
    for _ in range(2):
        intake_stream.run(spark, f"{sf_dir}/documents.parquet", f"{at}/out", f"{at}/checkpoint")
    return spark.read.schema(intake_stream.LEDGER).parquet(f"{at}/out/ledger").drop("batch_id")


def job2_release_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = _folder(spark, "job2")
    for _ in range(2):
        release_dataset.run(spark, f"{sf_dir}/documents.parquet", f"{sf_dir}/labels.parquet", at)
    return spark.read.schema(release_dataset.SAMPLES).parquet(f"{at}/samples")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (job1_intake_stream, job2_release_dataset)}

ORACLES = {
    "job1_intake_stream": f"""WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS content, min(lang) AS lang, min(source) AS source, min(strlen(coalesce(text, ''))) AS size_bytes, count(*) AS copies FROM documents GROUP BY 1, 2),
v AS (SELECT *, CASE WHEN size_bytes = 0 THEN 'EMPTY_FILE' WHEN size_bytes > {DEFAULT_CONFIG["ingestion"]["max_file_bytes"]} THEN 'FILE_TOO_LARGE' END AS code FROM d),
f AS (SELECT *, min(CASE WHEN code IS NULL THEN doc_id END) OVER (PARTITION BY content) AS first FROM v),
s AS (SELECT *, CASE WHEN code IS NOT NULL THEN 'rejected' WHEN doc_id IS DISTINCT FROM first THEN 'duplicate' ELSE 'accepted' END AS status FROM f)
SELECT doc_id, lang, source, content, size_bytes, copies, code, status, CASE WHEN status = 'duplicate' THEN first END AS duplicate_of,
  CASE WHEN status = 'accepted' THEN 's_' || substr(sha256(content || '|1.1.0|{CFG}|1.0.0'), 1, 24) END AS sample_id, CASE WHEN status = 'accepted' THEN content || ':1.1.0:{CFG}:1.0.0' END AS job_key FROM s""",
    "job2_release_dataset": f"""{BUILD_SQL},
rows AS (SELECT sample_id, content, family, design_group, label, reason, n_chars, split FROM placed UNION ALL SELECT sample_id, content, family, design_group, label, reason, n_chars, 'excluded' AS split FROM samples WHERE reason <> 'ok')
SELECT sample_id, content, design_group, label, reason, n_chars, {DATASET_ID_SQL} AS dataset_id, split, family FROM rows""",
}
