"""Extension: job events as a stream. Event times are timestamps with a zone; events without one are cast with the session's."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """New Parquet files of events under a folder, with ``at`` as event time."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(path).withColumn("at", F.col("ts").cast("timestamp"))


def windowed_counts(events: DataFrame, window: str = "1 day", late: str = "1 day") -> DataFrame:
    """Events of each kind per tumbling window; a window is final once the watermark has passed it."""
    counted = events.withWatermark("at", late).groupBy(F.window("at", window), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return counted.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def distinct_submissions(events: DataFrame, keys: list[str], late: str = "1 day") -> DataFrame:
    """Each submission once, however often it was delivered within the watermark."""
    return events.withWatermark("at", late).dropDuplicatesWithinWatermark(keys)


class LatestState(StatefulProcessor):
    """Keeps a job's latest state by (event time, event id); emits it whenever it moves on."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", StructType([StructField("at", LongType()), StructField("event_id", LongType()), StructField("state", StringType()), StructField("events", LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        at, event, name, n = self.state.get() if self.state.exists() else (-(1 << 62), -1, None, 0)
        for pdf in rows:
            n += len(pdf)
            last = pdf.sort_values(["at", "event_id"]).iloc[-1]
            if (last["at"].value, int(last["event_id"])) > (at, event):
                at, event, name = last["at"].value, int(last["event_id"]), last["event_type"]
        self.state.update((at, event, name, n))
        yield pd.DataFrame({"user_id": [key[0]], "state": [name], "events": [n]})

    def close(self) -> None:
        pass


def latest_state(events: DataFrame) -> DataFrame:
    """(user_id, state, events) updates of every job; state lives in RocksDB, keyed, so it scales with the keys."""
    return events.groupBy("user_id").transformWithStateInPandas(LatestState(), outputStructType="user_id long, state string, events long", outputMode="Update", timeMode="None")
