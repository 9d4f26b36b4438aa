"""Incremental intake: every new document file once, each document with its verdict, identity and original.

    python -m jobs.intake_stream --source DOCUMENTS --output FOLDER --checkpoint FOLDER [--config jobs/intake_stream.json]

A file stream with a checkpoint takes the files that are new since the last run and ends when there are none. Its output is

    ledger/batch_id=/status=   Parquet, one row a document: accepted, duplicate (``duplicate_of`` names the accepted one) or rejected (``code``)
    report/batch_id=           JSON, documents and bytes by status, code and language

A content is accepted once: by the earliest batch that holds it and, there, the smallest id. A batch that is run again, after a
failure, overwrites its own partitions and looks at earlier batches alone, so its rows come out the same.

Defined cases: a null text is empty (EMPTY_FILE), a null id is an id like others that any other goes before, repeats of a row count in ``copies``; further
columns of the files are not read; an empty or missing ledger is no obstacle; a run without new files writes nothing.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from facetlake.functions.constants import DEFAULT_CONFIG
from facetlake.functions.identity import job_key, sample_id
from facetlake.functions.storage import materialize, scope
from facetlake.operators.intake import intake_code
from facetlake.sources.files import exactly
from jobs import common

log = logging.getLogger("intake_stream")

DEFAULTS = {"max_bytes": DEFAULT_CONFIG["ingestion"]["max_file_bytes"], "magic": "", "max_files_per_batch": 1000}
SCHEMA = "doc_id long, text string, lang string, source string"
LEDGER = "doc_id long, lang string, source string, content string, size_bytes long, copies long, code string, sample_id string, job_key string, duplicate_of long, batch_id long, status string"


def probe(docs: DataFrame, config: dict) -> DataFrame:
    """Verdict and content hash of each (id, content); the texts go no further than this."""
    text = F.coalesce("text", F.lit(""))
    size = F.octet_length(text).cast("long")
    named = docs.select("doc_id", "lang", "source", F.sha2(text, 256).alias("content"), size.alias("size_bytes"), intake_code(size, F.lit("document.txt"), F.substring(text, 1, 64), config["max_bytes"], (".txt",), config["magic"]).alias("code"))
    return named.groupBy("doc_id", "content").agg(F.min("lang").alias("lang"), F.min("source").alias("source"), F.first("size_bytes").alias("size_bytes"), F.first("code").alias("code"), F.count(F.lit(1)).alias("copies"))


def judge(probed: DataFrame, earlier: DataFrame) -> DataFrame:
    """Adds status, duplicate_of and the ids of what is accepted; ``earlier`` has content and doc_id of what was accepted before.

    The batch's own contents go through the earlier ones first, so a small batch is sent to where these are read and they are never moved. Both sides of the
    last join are written tables, so that a content which a third of the documents share is split.
    """
    own = materialize(probed.where("code IS NULL").groupBy("content").agg(F.min("doc_id").alias("first")), "contents")
    before = earlier.join(own.select("content"), "content", "left_semi").select("content", F.col("doc_id").alias("held"), F.lit(True).alias("known"))
    firsts = materialize(own.join(before, "content", "left"), "firsts")
    joined = probed.join(firsts, "content", "left")
    repeated = F.col("known") | ~F.col("doc_id").eqNullSafe(F.col("first"))
    status = F.when(F.col("code").isNotNull(), "rejected").when(repeated, "duplicate").otherwise("accepted")
    accepted = F.col("status") == "accepted"
    judged = joined.withColumn("status", status).withColumn("duplicate_of", F.when(F.col("status") == "duplicate", F.when(F.col("known"), F.col("held")).otherwise(F.col("first"))))
    return judged.withColumns({"sample_id": F.when(accepted, sample_id("content")), "job_key": F.when(accepted, job_key("content"))})


def run(spark: SparkSession, source: str, output: str, checkpoint: str, config: str | dict | None = None) -> dict:
    """Take in what is new; returns the counts of this run."""
    chosen = common.settings(spark, config, DEFAULTS) if isinstance(config, str) else DEFAULTS | (config or {})
    ledger, report = f"{output.rstrip('/')}/ledger", f"{output.rstrip('/')}/report"
    totals = {"batches": 0, "documents": 0, "rows": 0, "bytes": 0, "accepted": 0, "duplicate": 0, "rejected": 0}

    @scope()
    def batch(docs: DataFrame, number: int) -> None:
        own = docs.sparkSession
        seen, made = Observation(), Observation()
        read = docs.observe(seen, F.count(F.lit(1)).alias("rows"))
        probed = materialize(probe(read, chosen), "probed")
        earlier = common.table(own, ledger, LEDGER).where((F.col("status") == "accepted") & (F.col("batch_id") < number))
        rows = judge(probed, earlier).withColumn("batch_id", F.lit(number)).select(*(f.split()[0] for f in LEDGER.split(", ")))
        counted = rows.observe(made, F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("bytes"), *(F.count_if(F.col("status") == s).alias(s) for s in ("accepted", "duplicate", "rejected")))
        counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id", "status").parquet(ledger)
        own_rows = common.table(own, ledger, LEDGER).where(F.col("batch_id") == number)
        figures = own_rows.groupBy("batch_id", "status", "code", "lang").agg(F.count(F.lit(1)).alias("documents"), F.sum("size_bytes").alias("bytes"))
        figures.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").json(report)
        counts = made.get | seen.get
        log.info("batch %d: read %s; wrote %s", number, seen.get, made.get)
        totals["batches"] += 1
        for k, n in counts.items():
            totals[k] += n

    files = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", chosen["max_files_per_batch"]).parquet(exactly(source))
    stream = files.writeStream.queryName("intake_stream").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    try:
        stream.awaitTermination()
    finally:
        stream.stop()
    log.info("%s to %s: %s", source, ledger, totals)
    return totals


if __name__ == "__main__":
    common.main("intake_stream", {"source": "Parquet file or folder of documents", "output": "folder of the ledger and the report", "checkpoint": "folder of the stream's progress"}, run)
