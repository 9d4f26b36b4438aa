"""Queries of Spark's own mechanisms: table functions, a data source, timers in a stream, variants, observations, loops of aggregates."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetlake.functions import variants
from facetlake.functions.observed import Stages
from facetlake.functions.storage import shared_root
from facetlake.operators import cloud, dataset, near_duplicates, training
from facetlake.plans.catalogue import BUILD_SQL, F_SQL, SEED, _signature_columns, faces, query, read, samples
from facetlake.sources import part21, rowgroups
from facetlake.sources.files import exactly
from facetlake.streaming import leases

_TAG = r"""<(/?)([A-Za-z][A-Za-z0-9]*)((?:[^"''<>]|"[^"]*"|''[^'']*'')*)>"""


@query(
    f"""WITH t AS (SELECT page_id, regexp_extract_all(html, '{_TAG}', 0) AS tags FROM pages), u AS (SELECT page_id, unnest(tags) AS tag, generate_subscripts(tags, 1)::INTEGER AS position FROM t)
SELECT page_id, position, regexp_extract(tag, '{_TAG}', 1) = '/' AS closing, lower(regexp_extract(tag, '{_TAG}', 2)) AS name, regexp_extract(tag, '{_TAG}', 3) AS arguments FROM u"""
)
def page_tags(spark: SparkSession, d: str) -> DataFrame:
    return part21.tags(read(spark, d, "pages").select("page_id", "html"), "html")


@query(
    """WITH e AS (SELECT l_orderkey, '#' || l_linenumber || '=FACE_SURFACE(''it''''s; #9'',#' || l_partkey || ',#' || l_suppkey || ')' AS entity FROM lineitem)
SELECT l_orderkey, count(*) AS entities, CAST(sum(CAST(regexp_extract(entity, '^#([0-9]+)', 1) AS BIGINT)) AS BIGINT) AS ids, CAST(sum(CAST(regexp_extract(entity, ',#([0-9]+),', 1) AS BIGINT) + CAST(regexp_extract(entity, ',#([0-9]+)\\)$', 1) AS BIGINT)) AS BIGINT) AS refers FROM e GROUP BY 1"""
)
def file_instances(spark: SparkSession, d: str) -> DataFrame:
    """Orders written as exchange files, an entity a line item, and read back by the table function."""
    entity = F.format_string("#%d = face_surface ( 'it''s; #9', #%d, #%d ) ;\n/* #1=NO(); */", "l_linenumber", "l_partkey", "l_suppkey")
    files = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_join(F.collect_list(entity), "\n").alias("text"))
    found = part21.references(part21.instances(files, "text")).where("name = 'FACE_SURFACE'")
    total = F.sum(F.aggregate("refers", F.lit(0).cast("long"), lambda a, x: a + x))
    return found.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("entities"), F.sum("id").alias("ids"), total.alias("refers"))


@query("SELECT event_type, count(*) AS n, min(event_id) AS first, max(event_id) AS last, round(sum(value), 2)::DOUBLE AS total FROM events WHERE ts >= TIMESTAMP '2024-01-08' AND value > 1 GROUP BY 1")
def row_group_scan(spark: SparkSession, d: str) -> DataFrame:
    """Events from the second week on through the data source, whose row groups the filters rule out."""
    rows = rowgroups.read(spark, f"{d}/events.parquet").where((F.col("ts") >= F.lit("2024-01-08").cast("timestamp_ntz")) & (F.col("value") > 1))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first"), F.max("event_id").alias("last"), F.round(F.sum("value"), 2).alias("total"))


_STATES = ("parsing", "extracting", "completed", "normalizing", "queued")


def job_events(events: DataFrame) -> DataFrame:
    """Events as news of their user's job: its state and attempt follow from the event's number."""
    k = F.col("event_id")
    state = F.element_at(F.array(*map(F.lit, _STATES)), (k % 5 + 1).cast("int"))
    return events.select(F.col("user_id").alias("job_id"), "event_id", F.col("ts").cast("timestamp").alias("at"), state.alias("state"), (k % 4 + 1).cast("int").alias("attempt"))


@query(
    f"""WITH e AS (SELECT user_id AS job_id, event_id, epoch_us(ts) AS at, {list(_STATES)}[event_id % 5 + 1] AS state, CAST(event_id % 4 + 1 AS INTEGER) AS attempt FROM events),
n AS (SELECT *, lead("at") OVER (PARTITION BY job_id ORDER BY "at", event_id) AS after, max("at") OVER () // 1000 - 86400000 AS wall FROM e)
SELECT job_id, event_id, state, attempt, "at" + 21600000000 AS lease_expires_at, CASE WHEN attempt < 3 THEN 'queued' ELSE 'failed_terminal' END AS next_state
FROM n WHERE (after IS NULL OR after > "at" + 21600000000) AND ("at" + 21600000000) // 1000 + 1 <= wall AND state IN ('parsing', 'extracting', 'normalizing')"""
)
def lease_timers(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a stream: leases of six hours that ran out before the watermark, by timers."""
    key, rocks = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before, at = spark.conf.get(key), f"{shared_root(spark)}/leases-{uuid.uuid4().hex}"
    source = f"{d}/events.parquet"
    live = spark.readStream.schema(read(spark, d, "events").schema).parquet(exactly(source))
    spark.conf.set(key, rocks)
    try:
        stream = leases.reaped(job_events(live), lease_seconds=21600).writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start()
        stream.awaitTermination()
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(leases.REAPED).parquet(f"{at}/out")


_MANIFEST = """concat('{"conv_id":', conv_id, ',"role":', to_json(role), ',"text":', to_json("text"), ',"turn":', turn, '}')"""


@query(
    f"""SELECT conv_id, turn, CASE WHEN turn % 7 = 6 THEN NULL ELSE role END AS role, CASE WHEN turn % 7 = 6 THEN NULL ELSE "text" END AS "text", turn % 7 = 6 AS quarantined,
  CASE WHEN turn % 7 = 6 THEN NULL ELSE sha256({_MANIFEST}) END AS content FROM conversations"""
)
def manifest_variants(spark: SparkSession, d: str) -> DataFrame:
    """Turns as JSON manifests with their members in no order; every seventh one is cut off and has to be quarantined."""
    whole = F.to_json(F.struct("turn", "text", "role", "conv_id"))
    cut = F.when(F.col("turn") % 7 == 6, F.substring(whole, F.lit(1), F.length(whole) - 1)).otherwise(whole)
    rows = variants.parsed(read(spark, d, "conversations").select("conv_id", "turn", cut.alias("manifest")), "manifest")
    return rows.select("conv_id", "turn", *variants.fields({"role": ("$.role", "string"), "text": ("$.text", "string")}), variants.broken("manifest").alias("quarantined"), variants.content_hash().alias("content"))


@query(
    f"""WITH {F_SQL}, s AS (SELECT l_orderkey, face_idx, CAST(round_even(l_extendedprice / 0.01::DOUBLE, 0) AS BIGINT) AS steps FROM faces),
r AS (SELECT *, CAST(sum(steps) OVER w AS BIGINT) AS high, CAST(sum(steps) OVER (PARTITION BY l_orderkey) AS BIGINT) AS whole FROM s WINDOW w AS (PARTITION BY l_orderkey ORDER BY face_idx)),
p AS (SELECT DISTINCT l_orderkey, whole, k FROM r CROSS JOIN range(8) g(k)),
q AS (SELECT *, CAST(floor(('0x' || substr(sha256('1234|b|' || l_orderkey || '|0|' || k), 1, 12))::BIGINT / pow(16.0::DOUBLE, 12) * whole) AS BIGINT) AS step FROM p)
SELECT q.l_orderkey AS sample_id, CAST(k AS INTEGER) AS k, r.face_idx AS seg_idx, round((step - (high - steps) + 0.5) / steps, 6)::DOUBLE AS along FROM q JOIN r ON q.l_orderkey = r.l_orderkey AND step >= high - steps AND step < high"""
)
def boundary_points(spark: SparkSession, d: str) -> DataFrame:
    """Eight points on the boundary of each order, whose segments are its line items, as long as their prices."""
    own = faces(spark, d).select(F.col("l_orderkey").alias("sample_id"), F.lit(0).alias("face_idx"), F.col("face_idx").alias("seg_idx"), F.bround(F.col("l_extendedprice") / 0.01).cast("long").alias("steps"))
    found = cloud.sample_segments(own, own.select("sample_id", "face_idx").distinct().withColumn("n", F.lit(8)))
    return found.select("sample_id", "k", "seg_idx", F.round("along", 6).alias("along"))


@query(
    f"""{BUILD_SQL}
SELECT 'verdicts' AS stage, count(*) AS rows, count(*) FILTER (reason = 'ok') AS kept FROM samples UNION ALL SELECT 'included', count(*), count(*) FILTER (split_unit = design_group) FROM included
UNION ALL SELECT 'families', count(*), count(family) FROM own_units UNION ALL SELECT 'samples', count(*), count(*) FILTER (split = 'train') FROM placed"""
)
def stage_figures(spark: SparkSession, d: str) -> DataFrame:
    """What the stages of a dataset build counted while they wrote."""
    stages = Stages()
    clusters = near_duplicates.near_duplicate_clusters(read(spark, d, "documents"), "doc_id", *_signature_columns())
    dataset.build(samples(spark, d), clusters, SEED, stages=stages)
    return spark.createDataFrame([(k, f["rows"], f["kept"]) for k, f in stages.figures()], "stage string, rows long, kept long")


@query()
def softmax_regression(spark: SparkSession, d: str) -> DataFrame:
    """Labels of embeddings by twenty rounds of gradient descent over all of them; tests hold it against a loop in numpy."""
    rows = read(spark, d, "embeddings")
    shape = rows.agg(F.max("label"), F.max(F.size("embedding"))).first()
    if shape[0] is None:
        return training.classify(rows, "vec_id", "embedding", np.zeros((1, 2)))
    weights = training.softmax_regression(rows, "embedding", "label", shape[0] + 1, shape[1])
    return training.classify(rows, "vec_id", "embedding", weights).withColumn("confidence", F.round("confidence", 6))
