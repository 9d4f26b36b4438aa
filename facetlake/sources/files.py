"""File discovery, corpus scans and the table readers."""

from __future__ import annotations

import re
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from facetlake.operators.intake import probe_files


def _extension(path: str = "path"):  # noqa: ANN202
    return F.lower(F.regexp_extract(path, r"(\.[^./\\]*)$", 1))


def _files(spark: SparkSession, directory: str) -> DataFrame:
    """Files directly in a directory as binaryFile rows; Spark's own listing leaves out empty ones, which intake has to see, so they are added."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "false").load(directory)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    listed = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatusIterator(at)
    empty = []
    while listed.hasNext():
        f = listed.next()
        if f.isFile() and f.getLen() == 0 and not f.getPath().getName().startswith(("_", ".")):
            empty.append((f.getPath().toString(), f.getModificationTime() / 1000, 0, bytearray()))
    rows = spark.createDataFrame(empty, "path string, seconds double, length long, content binary")
    return found.unionByName(rows.select("path", F.timestamp_seconds("seconds").alias("modificationTime"), "length", "content"))


def step_files(spark: SparkSession, directory: str) -> DataFrame:
    """Files directly in a directory whose extension is .step or .stp, in any case, by path."""
    return _files(spark, directory).where(_extension().isin(".step", ".stp")).orderBy("path")


def corpus_files(spark: SparkSession, directory: str) -> DataFrame:
    """STEP files of ``parts`` and every fixture of ``failures`` but its list of expectations and names that start with an underscore."""
    name = F.element_at(F.split("path", "/"), -1)
    failures = _files(spark, f"{directory}/failures").where((name != "expected.json") & ~name.startswith("_"))
    return step_files(spark, f"{directory}/parts").unionByName(failures)


def discover(spark: SparkSession, directory: str) -> DataFrame:
    return probe_files(corpus_files(spark, directory))


def exactly(path: str) -> str:
    """A glob for exactly this path: a file stream takes single files no other way, and folders as well."""
    path = path.rstrip("/")
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path[:-1]) + f"[{path[-1]}]"


def manifests(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Sample manifests, one JSON document a file at samples/<id>/manifest.json, by sample id."""
    return spark.read.schema(schema).option("multiLine", "true").json(f"{path}/samples/*/manifest.json").orderBy("sample_id")


def ground_truth(spark: SparkSession, directory: str, schema: StructType) -> DataFrame:
    """Side files of parts, one row a source hash; of several the last by path wins."""
    rows = spark.read.schema(schema).option("multiLine", "true").json(f"{directory}/parts/*.gt.json").withColumn("_path", F.col("_metadata.file_path"))
    last = rows.groupBy("source_sha256").agg(F.max_by(F.struct(*schema.fieldNames()), "_path").alias("row"))
    return last.select("row.*")


def manifest(samples: DataFrame, sample_id: str) -> DataFrame:
    return samples.where(F.col("sample_id") == sample_id)


class CadAdapter(Protocol):
    """What a CAD kernel has to offer: file bytes in, the typed tables of ``facetlake.schemas`` out."""

    def parse(self, files: DataFrame) -> dict[str, DataFrame]: ...


class NoKernel:
    """The adapter in place where no kernel is installed: it says so instead of making results up."""

    def parse(self, files: DataFrame) -> dict[str, DataFrame]:
        raise NotImplementedError("reading exact geometry needs a CAD kernel; supply an adapter or the typed tables themselves")
