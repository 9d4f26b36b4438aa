"""What a service or a notebook asks for: newest samples, a dataset's quality and description, a run's predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.functions.constants import DEFAULT_CONFIG, PIPELINE_VERSION, SCHEMA_VERSION
from facetlake.functions.identity import canonical_json, config_hash
from facetlake.operators import dataset, splits

MOST_LISTED = 1000


def list_samples(jobs: DataFrame, files: DataFrame, limit: int = 200) -> DataFrame:
    """(sample_id, job_id, state, filename, error_code) of the newest processing jobs that have a sample, at most ``limit`` and never more than MOST_LISTED; the limit is the feature.

    ``jobs`` has (job_id, kind, sample_id, file_id, state, error_code, created_at), ``files`` (file_id, filename). Equally new jobs come by their id. The newest are taken first, so only they meet the files.
    """
    newest = jobs.where((F.col("kind") == "process") & F.col("sample_id").isNotNull()).orderBy(F.desc("created_at"), "job_id").limit(min(limit, MOST_LISTED))
    return newest.join(files, "file_id", "left").select("sample_id", "job_id", "state", "filename", "error_code")


def quality(samples: DataFrame, excluded: DataFrame, clusters: DataFrame) -> DataFrame:
    """(section, key, n) of a dataset's tables: sizes, reasons, samples, families and groups of each split, labels of each split, near-duplicate clusters, agreement of the rule's label, and what crosses splits.

    ``samples`` has (sample_id, family, design_group, split_unit, split, label, rule_label), ``excluded`` (sample_id, reason), ``clusters`` (part, cluster). A sample counts under every section in one
    pass; only distinct families, groups, units and clusters are grouped again.
    """
    row = lambda section, key, n: F.struct(F.lit(section).alias("section"), key.cast("string").alias("key"), n.cast("long").alias("n"))
    one, split = F.lit(1), F.col("split")
    own = F.array(row("included", F.lit("all"), one), row("split", split, one), row("label", F.concat_ws("/", split, F.coalesce(F.col("label").cast("string"), F.lit("none"))), one), row("agreement", split, F.coalesce(F.col("label") == F.col("rule_label"), F.lit(False)).cast("int")))
    reason = F.split_part("reason", F.lit(":"), F.lit(1))
    counted = samples.select(F.explode(own).alias("r")).unionAll(excluded.select(F.explode(F.array(row("excluded", F.lit("all"), one), row("reason", reason, one))).alias("r")))
    parts = [counted.groupBy("r.section", "r.key").agg(F.sum("r.n").alias("n"))]
    for section, column in (("families", "family"), ("groups", "design_group")):
        parts.append(samples.select("split", column).distinct().groupBy(F.lit(section).alias("section"), F.col("split").alias("key")).agg(F.count(column).alias("n")))
    crossing = {"units": splits.leakage(samples, "split_unit"), "families": splits.leakage(samples, "family")}
    parts += [found.groupBy(F.lit("crossing").alias("section"), F.lit(k).alias("key")).agg(F.count("key").alias("n")) for k, found in crossing.items()]
    parts.append(clusters.select("cluster").distinct().groupBy(F.lit("near_duplicate_clusters").alias("section"), F.lit("all").alias("key")).agg(F.count("cluster").alias("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def label_digest(labels: DataFrame, *columns: str) -> DataFrame:
    """One row (n, digest) over the labels of a dataset, whatever their order."""
    return dataset.content_digest(labels, *columns)


def describe(version: DataFrame, samples: DataFrame, seed: int, mode: str, vocabulary: tuple[str, ...], config: dict = DEFAULT_CONFIG) -> DataFrame:
    """(dataset_id, description): a dataset version's settings and label hash as canonical JSON, its members sorted by name.

    ``version`` is the one row of ``dataset.build``, ``samples`` its table. The samples themselves stay a table; the description names them by their digests.
    """
    digest = label_digest(samples, "sample_id", "label").select(F.col("digest").alias("labels"))
    fixed = {
        "schema": "facetlake.dataset/1.0.0",
        "pipeline_version": PIPELINE_VERSION,
        "schema_version": SCHEMA_VERSION,
        "configuration_hash": config_hash(config),
        "label_vocabulary": list(vocabulary),
        "sampling": config["pointcloud"],
        "split_strategy": {"mode": mode, "unit": "design groups, joined where near duplicates span them" if mode == "group" else "family", "seed": seed},
    }
    own = version.crossJoin(digest)  # one row each
    text = F.to_json(F.struct("dataset_id", "excluded", "included", F.col("labels").alias("label_content_sha256")))
    both = F.concat(F.substring(text, F.lit(1), F.length(text) - 1), F.lit("," + canonical_json(fixed)[1:]))
    return own.select("dataset_id", F.to_json(F.parse_json(both)).alias("description"))


def run_predictions(predicted: DataFrame, truth: DataFrame, samples: DataFrame) -> DataFrame:
    """A run's predictions with the ground truth, where there is one, and the split of each sample, "not_in_dataset" where it is in none.

    ``predicted`` has (sample_id, face_idx, predicted, confidence), ``truth`` (sample_id, face_idx, label), ``samples`` (sample_id, split).
    """
    from facetlake.sources.sinks import prediction_rows

    rows = prediction_rows(predicted, truth)
    return rows.join(samples.select("sample_id", F.col("split").alias("dataset_split")), "sample_id", "left").withColumn("dataset_split", F.coalesce("dataset_split", F.lit("not_in_dataset")))
