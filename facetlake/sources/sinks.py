"""Writers: write-once tables, superseded rows, dataset versions, failures by kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from facetlake.functions.constants import ENVIRONMENT_CODES
from facetlake.functions.storage import materialize


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def _existing(rows: DataFrame, path: str) -> DataFrame | None:
    """The table at a path, None where there is none; a table that cannot be read is an error."""
    return rows.sparkSession.read.parquet(path) if exists(rows.sparkSession, path) else None


def _slot(key: str, slots: int) -> Column:
    """The partition of a table of samples that a key falls in."""
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def write_once(rows: DataFrame, path: str, key: str, partition_by: tuple[str, ...] = (), slots: int = 64) -> DataFrame:
    """Append the rows whose key is not there yet and return them; rows already there win. The table lies in ``slots`` partitions by a hash of the key."""
    fresh, old = rows.dropDuplicates([key]), _existing(rows, path)
    if old is not None:
        fresh = fresh.join(old.select(key), key, "left_anti")
    fresh = materialize(fresh, "fresh")
    fresh.withColumn("_slot", _slot(key, slots)).repartition("_slot").write.mode("append").partitionBy(*partition_by, "_slot").parquet(path)
    return fresh


def replace_samples(rows: DataFrame, path: str, superseded: str, key: str, slots: int = 64) -> None:
    """Put rows in place of those with the same key; what they replace is kept in ``superseded`` first.

    The table lies in ``slots`` partitions, as ``write_once`` leaves it, and only those that the rows fall in are written again, by Spark's own overwrite of partitions: no reader finds the table
    absent, and a run that was cut off is made good by running it again. Rows that are there already, as they are, replace nothing.
    """
    own = rows.withColumn("_slot", _slot(key, slots))
    old = _existing(rows, path)
    if old is not None:
        touched = [r[0] for r in own.select("_slot").distinct().collect()]  # at most ``slots``
        near = old.where(F.col("_slot").isin(touched))
        gone = near.join(rows.select(key), key, "left_semi").drop("_slot")
        gone.exceptAll(rows.select(*gone.columns)).write.mode("append").parquet(superseded)
        own = materialize(near.join(rows.select(key), key, "left_anti").unionByName(own, allowMissingColumns=True), "replaced")  # its files are about to go
    own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_slot").parquet(path)


def write_dataset(built: dict[str, DataFrame], directory: str) -> dict[str, DataFrame]:
    """Store a dataset version under its id and return its tables; a version that is already there is returned untouched."""
    row = built["dataset"].first()
    spark, at = built["dataset"].sparkSession, f"{directory}/datasets/{row.dataset_id}"
    if not exists(spark, f"{at}/dataset"):
        for name in [*(k for k in built if k != "dataset"), "dataset"]:  # its own row last: where that is, all is
            built[name].write.mode("overwrite").parquet(f"{at}/{name}")
    return {name: spark.read.parquet(f"{at}/{name}") for name in built}


def write_failures(failures: DataFrame, samples: str, quarantine: str, code: str = "code") -> None:
    """Failures that the input determines go with the samples; those of the environment go to quarantine and may be tried again."""
    environment = F.col(code).isin(*ENVIRONMENT_CODES)
    failures.where(~environment).write.mode("append").parquet(samples)
    failures.where(environment).write.mode("append").parquet(quarantine)


def with_checksums(artifacts: DataFrame, content: str = "content") -> DataFrame:
    """Artifact rows with their SHA-256 and size."""
    return artifacts.withColumns({"sha256": F.sha2(content, 256), "bytes": F.octet_length(content)})


def corpus_report(results: DataFrame, file: str = "file", sha256: str = "sha256") -> DataFrame:
    """The results of files with ``duplicate_of``: the first file, by name, of the same content; null for that file itself."""
    first = materialize(results.groupBy(sha256).agg(F.min(file).alias("_first")), "firsts")
    return results.join(first, sha256, "left").withColumn("duplicate_of", F.when(F.col(file) > F.col("_first"), F.col("_first"))).drop("_first")


def corpus_summary(report: DataFrame, status: str = "status") -> DataFrame:
    """(name, n): the number of files, of duplicates, and of files in each status."""
    total = report.agg(F.count(F.lit(1)).alias("files"), F.count("duplicate_of").alias("duplicates"))
    return total.select(F.explode(F.create_map(F.lit("files"), "files", F.lit("duplicates"), "duplicates")).alias("name", "n")).unionAll(report.groupBy(F.col(status).alias("name")).agg(F.count(F.lit(1)).alias("n")))


def write_training(directory: str, run: str, history: DataFrame, predictions: DataFrame, metrics: DataFrame) -> None:
    """The tables of a training run: its epochs, one prediction per face, its figures. A run that is there is an error, as its files are its record."""
    for name, rows in (("history", history), ("predictions", predictions), ("metrics", metrics)):
        rows.write.parquet(f"{directory}/training/{run}/{name}")


def prediction_rows(predicted: DataFrame, truth: DataFrame) -> DataFrame:
    """(sample_id, face_idx, ground_truth or null, predicted, confidence to four places), one row a face."""
    return predicted.join(truth.select("sample_id", "face_idx", F.col("label").alias("ground_truth")), ["sample_id", "face_idx"], "left").select("sample_id", "face_idx", "ground_truth", "predicted", F.round("confidence", 4).alias("confidence"))
