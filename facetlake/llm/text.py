"""Shared helpers of the text operators."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: The white space of every contract: space and the five controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Hold Arrow batches to so many rows and bytes in this session: an executor's memory then does not depend on how long texts are."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = re.fullmatch(r"(-?\d+)b?", spark.conf.get(key).lower())
        if not now or not 0 < int(now[1]) <= most:
            spark.conf.set(key, str(most))


def give_back() -> None:
    """Return freed memory to the system at a task's end; worker processes live on and would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that the operators read, under fixed names; a null text counts as empty."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def hash_mod(id_col: str | Column, n: int) -> Column:
    """crc32 of the id written as text, modulo n; a null id counts as the empty text."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return (F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % n).cast("int")


def map_texts(docs: DataFrame, work: Callable[..., dict], schema: str | StructType, extra: tuple[str, ...] = (), arrow: bool = False) -> DataFrame:
    """Run ``work(ids, texts, *extra columns) -> {column: values}`` over Arrow batches of (doc_id, text); with ``arrow`` the texts are not made a list.

    Batches hold at most a few thousand rows, so memory follows the batch and not the partition.
    """
    chosen = docs.select("doc_id", "text", *extra)
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                out = work(*(c if arrow and k == 1 else c.to_pylist() for k, c in enumerate(part.columns)))
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in kinds], schema=kinds)
        give_back()

    return chosen.mapInArrow(run, fields)
