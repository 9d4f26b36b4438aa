"""Dataset release: documents and labels to a versioned, split dataset with its figures.

    python -m jobs.release_dataset --documents PATH --labels PATH --output FOLDER [--config jobs/release_dataset.json]

Eligible documents (not empty, labelled, the first of their content) are split by design group, groups that share near duplicates staying
together; the version's id comes from its content alone. The output is

    samples/dataset_id=/split=/family=   Parquet, one row a document; split "excluded" holds the others and why
    report/dataset_id=                   JSON, counts by section (split, family, label, reason) and key
    manifest/dataset_id=                 JSON, one row, written last: where it is, the version is whole

A run over the same tables and settings finds its manifest by a digest of what it would read and writes nothing; a run that was cut off overwrites
the partitions of its version alone. Other versions are never touched.

Defined cases: null text is empty and not eligible; a null id, family or source makes a document not eligible (status); empty tables give
a version without rows; further columns are not read.
"""

from __future__ import annotations

import hashlib
import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from facetlake.functions.identity import canonical_json
from facetlake.functions.storage import materialize, scope
from facetlake.operators import dataset, near_duplicates
from jobs import common

log = logging.getLogger("release_dataset")

DEFAULTS = {"seed": 7, "mode": "group", "label": "quality"}
SAMPLES = "sample_id long, content string, design_group string, label int, reason string, n_chars long, dataset_id string, split string, family string"
MANIFEST = "inputs string, included long, excluded long, seed long, mode string, label string, dataset_id string"


def sources(documents: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """What a release depends on, without the texts: (sample_id, content, family, design_group, n_chars, words, lines, label, has_truth)."""
    text = F.coalesce("text", F.lit(""))
    size = lambda sign: F.size(F.split(text, sign, -1)).cast("long")
    rows = documents.select(F.col("doc_id").alias("sample_id"), F.sha2(text, 256).alias("content"), F.col("lang").alias("family"), F.when(F.col("source").isNotNull(), F.concat_ws("/", "lang", "source")).alias("design_group"), F.char_length(text).cast("long").alias("n_chars"), size(" ").alias("words"), size("\n").alias("lines"))
    truth = labels.groupBy(F.col("doc_id").alias("sample_id")).agg(F.max(label).cast("int").alias("label"), F.lit(True).alias("has_truth"))
    return rows.join(truth, "sample_id", "left")


def signature() -> tuple[Column, Column, Column]:
    return F.col("n_chars"), F.col("words"), F.array("lines", F.col("words") / 10, F.col("n_chars") / 100)


def report(samples: DataFrame) -> DataFrame:
    """(section, key, n, chars) in one pass over the samples: each row counts under its split, its split with family, with label, and its reason."""
    keys = {"split": F.col("split"), "family": F.concat_ws("/", "split", "family"), "label": F.concat_ws("/", "split", F.coalesce(F.col("label").cast("string"), F.lit("none"))), "reason": F.split_part("reason", F.lit(":"), F.lit(1))}
    places = F.explode(F.array(*[F.struct(F.lit(k).alias("section"), c.alias("key")) for k, c in keys.items()]))
    return samples.select(places.alias("at"), "n_chars").groupBy("at.section", "at.key").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@scope()
def run(spark: SparkSession, documents: str, labels: str, output: str, config: str | dict | None = None) -> dict:
    """Release the tables' present content; returns the manifest, and whether this run wrote it."""
    chosen = common.settings(spark, config, DEFAULTS) if isinstance(config, str) else DEFAULTS | (config or {})
    output = output.rstrip("/")
    seen = Observation()
    docs = spark.read.parquet(documents).observe(seen, F.count(F.lit(1)).alias("documents"))
    rows = materialize(sources(docs, spark.read.parquet(labels), chosen["label"]), "sources")
    log.info("read %s from %s", seen.get, documents)
    digest = dataset.content_digest(rows, *rows.columns).first().digest
    inputs = hashlib.sha256(f"{digest}|{canonical_json(chosen)}".encode()).hexdigest()
    at = {k: f"{output}/{k}" for k in ("samples", "report", "manifest")}
    held = common.table(spark, at["manifest"], MANIFEST, "json").where(F.col("inputs") == inputs).first()
    if held:
        log.info("nothing to do: %s holds these inputs", held.dataset_id)
        return held.asDict() | {"written": False}

    usable = (F.col("n_chars") > 0) & F.col("sample_id").isNotNull() & F.col("family").isNotNull() & F.col("design_group").isNotNull()
    verdicts = materialize(dataset.eligibility(rows, usable, F.lit(True), F.col("has_truth"), F.lit(True)), "verdicts")
    clusters = materialize(near_duplicates.near_duplicate_clusters(rows.where("sample_id IS NOT NULL"), "sample_id", *signature()), "clusters")
    built = dataset.build(verdicts, clusters, chosen["seed"], chosen["mode"])
    version = built["dataset"].first()

    made = Observation()
    names = [f.split()[0] for f in SAMPLES.split(", ")]
    named = lambda frame: frame.withColumn("dataset_id", F.lit(version.dataset_id)).select(*names)
    samples = named(built["samples"]).unionByName(named(verdicts.where("reason <> 'ok'").withColumn("split", F.lit("excluded"))))
    counted = samples.observe(made, F.count(F.lit(1)).alias("samples"), F.count_if(F.col("split") != "excluded").alias("included"))
    write = lambda frame: frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    write(counted).partitionBy("dataset_id", "split", "family").parquet(at["samples"])
    stored = common.table(spark, at["samples"], SAMPLES).where(F.col("dataset_id") == version.dataset_id)
    write(report(stored).withColumn("dataset_id", F.lit(version.dataset_id)).coalesce(1)).partitionBy("dataset_id").json(at["report"])
    manifest = {"inputs": inputs, "included": version.included, "excluded": version.excluded, "seed": chosen["seed"], "mode": chosen["mode"], "label": chosen["label"], "dataset_id": version.dataset_id}
    write(spark.createDataFrame([tuple(manifest.values())], MANIFEST)).partitionBy("dataset_id").json(at["manifest"])
    log.info("wrote %s as %s to %s", made.get, version.dataset_id, output)
    return manifest | {"written": True}


if __name__ == "__main__":
    common.main("release_dataset", {"documents": "Parquet documents", "labels": "Parquet labels", "output": "folder of all versions"}, run)
