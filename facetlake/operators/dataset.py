"""Dataset versions: eligibility, split units, quality figures, and a content-derived id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetlake.functions.observed import Stages
from facetlake.functions.storage import materialize
from facetlake.operators import splits
from facetlake.operators.components import connected_components


def eligibility(samples: DataFrame, ok_status: Column, same_version: Column, has_truth: Column, complete: Column) -> DataFrame:
    """Adds ``reason``: the first of status, version, duplicate of an eligible sample, no ground truth, missing artifacts; "ok" if none.

    Of equal contents the smallest id that passes every other check survives; only larger ids are its duplicates, so the duplicate check
    stands before that for ground truth. ``samples`` has sample_id and content. The minima are written out and joined back, not windowed: a content that a third
    of the samples share is split by AQE and never meets in one task.
    """
    own = samples.withColumns({"_status": ok_status, "_version": same_version, "_truth": F.coalesce(has_truth, F.lit(False)), "_complete": complete})
    passes = F.col("_status") & F.col("_version") & F.col("_truth") & F.col("_complete")
    first = materialize(own.where(passes).groupBy("content").agg(F.min("sample_id").alias("_first")), "firsts")
    joined = own.join(first.hint("merge"), "content", "left")
    reason = F.when(~F.col("_status"), "status").when(~F.col("_version"), "version_mismatch").when(F.col("sample_id") > F.col("_first"), F.concat(F.lit("exact_duplicate_of:"), F.col("_first").cast("string"))).when(~F.col("_truth"), "no_ground_truth").when(~F.col("_complete"), "missing_artifacts").otherwise("ok")
    return joined.withColumn("reason", reason).drop("_status", "_version", "_truth", "_complete", "_first")


def reason_counts(samples: DataFrame) -> DataFrame:
    kind = F.when(F.col("reason").startswith("exact_duplicate_of:"), "exact_duplicate_of").otherwise(F.col("reason"))
    return samples.groupBy(kind.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def split_units(samples: DataFrame, clusters: DataFrame) -> DataFrame:
    """Adds ``split_unit``: groups joined wherever a near-duplicate cluster spans several; ``samples`` has sample_id and design_group, ``clusters`` part and cluster.

    The unit of joined groups is the smallest of them.
    """
    touched = samples.join(clusters.hint("merge"), samples["sample_id"] == clusters["part"]).select("cluster", "design_group").distinct()
    least = touched.groupBy("cluster").agg(F.min("design_group").alias("first"))
    joined = connected_components(touched.join(least, "cluster").select(F.col("design_group").alias("a"), F.col("first").alias("b")))
    joined = materialize(joined, "units").withColumnRenamed("node", "design_group")
    return samples.join(joined, "design_group", "left").withColumn("split_unit", F.coalesce("component", "design_group")).drop("component")


def unit_families(samples: DataFrame) -> DataFrame:
    """(unit, family): a unit that spans families has the smallest."""
    return samples.groupBy(F.col("split_unit").alias("unit")).agg(F.min("family").alias("family"))


def completeness(samples: DataFrame, parts: dict[str, Column]) -> DataFrame:
    """Share of samples that have each representation, over at least one sample."""
    shares = [F.round(F.coalesce(F.sum(c.cast("double")), F.lit(0.0)) / F.greatest(F.count(F.lit(1)), F.lit(1)), 6).alias(k) for k, c in parts.items()]
    return samples.agg(*shares)


def class_distribution(rows: DataFrame, split: str, label: str) -> DataFrame:
    return rows.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))


def split_sizes(rows: DataFrame) -> DataFrame:
    """(split, samples, families, groups): how many samples and design groups each split has, and its families in order."""
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("samples"), F.concat_ws(",", F.sort_array(F.collect_set("family"))).alias("families"), F.countDistinct("design_group").alias("groups"))


def content_digest(rows: DataFrame, *columns: str) -> DataFrame:
    """One row: the number of rows, and a SHA-256 over the sums of each row's hash in four parts, which no order of rows changes."""
    text = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]), 256)
    parts = [F.sum(F.conv(F.substring(text, 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)")).alias(f"p{i}") for i in range(8)]
    return rows.agg(F.count(F.lit(1)).alias("n"), *parts).select("n", F.sha2(F.concat_ws("|", "n", *[F.coalesce(F.col(f"p{i}"), F.lit(0)).cast("string") for i in range(8)]), 256).alias("digest"))


def build(samples: DataFrame, clusters: DataFrame, seed: int = 7, mode: str = "group", stages: Stages | None = None) -> dict[str, DataFrame]:
    """A dataset version from samples with sample_id, content, family, design_group, label and reason.

    Returns its samples with splits, the excluded ones, and one row with the dataset id, derived from content alone (excluded samples included).
    Raises where a unit, a content or a near-duplicate cluster would cross splits. ``stages`` takes the figures of each table as it is written.
    """
    stages = stages or Stages()

    def write(frame: DataFrame, name: str, **figures: Column) -> DataFrame:
        written = materialize(stages.watch(frame, name, **figures), name)
        stages.ran(name)
        return written

    samples = write(samples, "verdicts", kept=F.count_if(F.col("reason") == "ok"))
    included = write(split_units(samples.where(F.col("reason") == "ok"), clusters), "included", kept=F.count_if(F.col("split_unit") == F.col("design_group")))
    units = write(unit_families(included), "families", kept=F.count("family"))
    assigned = splits.split_by_family(units, seed) if mode == "family" else splits.split_by_group(units, seed)
    rows = write(included.join(assigned.select(F.col("unit").alias("split_unit"), "split"), "split_unit"), "samples", kept=F.count_if(F.col("split") == "train"))
    crossing = splits.leakage(rows, "split_unit").unionAll(splits.leakage(rows, "content")).unionAll(splits.leakage(rows.join(clusters.hint("merge"), rows["sample_id"] == clusters["part"]), F.col("cluster").cast("string")))
    if not crossing.isEmpty():
        raise ValueError("a unit, content or cluster crosses splits")
    excluded = samples.where(F.col("reason") != "ok").select("sample_id", "reason")
    digests = [content_digest(rows, "sample_id", "content", "split", "label"), content_digest(excluded, "sample_id", "reason")]
    version = digests[0].crossJoin(digests[1].toDF("m", "other"))  # one row each
    dataset = version.select(F.concat(F.lit("ds_"), F.substring(F.sha2(F.concat_ws("|", F.lit(str(seed)), F.lit(mode), "digest", "other"), 256), 1, 16)).alias("dataset_id"), F.col("n").alias("included"), F.col("m").alias("excluded"))
    return {"samples": rows, "excluded": excluded, "dataset": dataset}
