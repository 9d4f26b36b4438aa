"""Job state as a fold of its events: legality, latest state, leases, latencies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from facetlake.functions.constants import ERROR_CODES, IN_FLIGHT_STATES, NEXT_STATES, TERMINAL_STATES

# Upper bounds of the duration histogram, in seconds.
BUCKETS = (0.25, 0.5, 1, 2, 3, 5, 8, 13, 20, 30, 60, 120, 300)


def transitions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(a, b) for a, bs in NEXT_STATES.items() for b in bs], "src string, dst string")


def error_codes(spark: SparkSession) -> DataFrame:
    """(code, outcome, retryable, sample_status, job_state)."""
    status = lambda o: {"rejected": "rejected", "timed_out": "quarantined", "quarantined": "quarantined"}.get(o, "failed")
    return spark.createDataFrame([(c, o, r, status(o), o) for c, (o, r) in ERROR_CODES.items()], "code string, outcome string, retryable boolean, sample_status string, job_state string")


def moves(events: DataFrame, job: str, order: list, state: str) -> DataFrame:
    """Adds ``previous``: the state before, null for a job's first event."""
    return events.withColumn("previous", F.lag(state).over(Window.partitionBy(job).orderBy(*order)))


def illegal_moves(events: DataFrame, job: str, order: list, state: str, allowed: DataFrame) -> DataFrame:
    """Events whose move from the state before is not among ``allowed`` (src, dst)."""
    moved = moves(events, job, order, state).where(F.col("previous").isNotNull())
    return moved.join(allowed, (F.col("previous") == F.col("src")) & (F.col(state) == F.col("dst")), "left_anti")


def latest_state(events: DataFrame, job: str, order: list[str], state: str) -> DataFrame:
    """(job, state, events, attempts ...): the last event's state; an aggregate, so jobs with many events combine before the shuffle."""
    return events.groupBy(job).agg(F.max_by(state, F.struct(*order)).alias("state"), F.count(F.lit(1)).alias("events"), F.max(order[0]).alias("last_at"))


def fold(events: DataFrame, job: str = "job_id") -> DataFrame:
    """Jobs from events (job_id, event_id, created_at, state, attempt, worker_id): compare-and-set by ownership.

    An event of a worker that no longer owns the attempt (a later attempt has begun before it) changes nothing.
    """
    w = Window.partitionBy(job).orderBy("created_at", "event_id")
    live = events.withColumn("newest", F.max("attempt").over(w)).where(F.col("attempt") >= F.col("newest"))
    return latest_state(live, job, ["created_at", "event_id"], "state").join(live.groupBy(job).agg(F.max("attempt").alias("attempts"), F.max_by("worker_id", F.struct("created_at", "event_id")).alias("worker_id")), job)


def submit(jobs: DataFrame, submitted: DataFrame) -> DataFrame:
    """New jobs of idempotent submissions: the first by time of each (kind, key) that no job has yet."""
    first = submitted.groupBy("kind", "idempotency_key").agg(F.min_by(F.struct(*submitted.columns), F.struct("submitted_at", "job_id")).alias("row")).select("row.*")
    return first.join(jobs.select("kind", "idempotency_key"), ["kind", "idempotency_key"], "left_anti")


def reap(jobs: DataFrame, now: Column, max_attempts: int = 3) -> DataFrame:
    """Jobs in flight whose lease is over: queued again while attempts are left, else failed for good."""
    late = jobs.where(F.col("state").isin(*IN_FLIGHT_STATES) & (F.col("lease_expires_at") < now))
    return late.withColumn("next_state", F.when(F.col("attempt") < max_attempts, "queued").otherwise("failed_terminal"))


def reconcile(jobs: DataFrame, transport: DataFrame, now: Column, seconds: int = 15) -> DataFrame:
    """Queued jobs, older than the grace time, that the transport does not hold."""
    old = jobs.where((F.col("state") == "queued") & (F.col("updated_at") < now - F.make_dt_interval(secs=F.lit(seconds))))
    return old.join(transport.select("job_id"), "job_id", "left_anti")


def latencies(events: DataFrame, job: str, at: str, state: str, first: str = "parsing") -> DataFrame:
    """Seconds from a job's first claim to its last event."""
    began = F.min(F.when(F.col(state) == first, F.col(at)))
    return events.groupBy(job).agg((F.unix_micros(F.max(at).cast("timestamp")) / 1e6 - F.unix_micros(began.cast("timestamp")) / 1e6).alias("seconds")).where("seconds is not null")


def histogram(rows: DataFrame, value: str, bounds: tuple[float, ...] = BUCKETS) -> DataFrame:
    """(bound, n): how many values are at most each bound, the last one infinity; bounds without a value are kept."""
    spark = rows.sparkSession
    every = spark.createDataFrame([(i, float(b)) for i, b in enumerate((*bounds, float("inf")))], "i int, bound double")
    place = F.lit(len(bounds))
    for i in range(len(bounds) - 1, -1, -1):
        place = F.when(F.col(value) <= bounds[i], i).otherwise(place)
    counts = rows.where(F.col(value).isNotNull()).groupBy(place.alias("i")).agg(F.count(F.lit(1)).alias("k"))
    joined = every.join(counts, "i", "left")
    return joined.select("bound", F.sum(F.coalesce("k", F.lit(0))).over(Window.orderBy("i")).cast("long").alias("n"))  # as many rows as bounds


def outcome_counts(jobs: DataFrame, wall_seconds: float) -> DataFrame:
    done = jobs.where(F.col("state").isin(*TERMINAL_STATES))
    return done.groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.round(F.count(F.lit(1)) / wall_seconds * 60, 4).alias("per_minute"))
