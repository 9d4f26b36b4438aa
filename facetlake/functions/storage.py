"""Tables that cut lineage: written once to the cluster's shared folder and read back."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_made: dict[str, SparkSession] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where it is unset, a temporary one on a local master (tests), and an error on a cluster."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        root = spark.conf.get("spark.facetlake.scratch", None)
        if not root:
            if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            root = tempfile.mkdtemp(prefix="facetlake-")
            spark.conf.set("spark.facetlake.scratch", root)
    return root.rstrip("/")


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back.

    Unlike an executor-local checkpoint this survives the loss of any executor, and every later
    plan that reads it starts from files with known sizes. Removed when the ``scope`` around it ends, or else when the driver does.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/facetlake-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    _made[path.rsplit("/", 1)[0]] = spark
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, rows: int, *keys: str, per_task: int = 1 << 20) -> DataFrame:
    """``df`` dealt by the keys to a partition for every so many of ``rows``, so that a task's share stays as it is where the input grows; never fewer than the session's own number."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // per_task)), *keys)


@contextmanager
def scope() -> Iterator[None]:
    """Tables that are made inside go when it ends: for work whose results have been written elsewhere by then."""
    before = set(_made)
    try:
        yield
    finally:
        _remove([p for p in _made if p not in before])


def _remove(paths: list[str]) -> None:
    for path in paths:
        spark = _made.pop(path)
        try:
            jvm = spark.sparkContext._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        except Exception:  # the session may be gone already, or this folder; the others are still tried
            continue


@atexit.register
def _clear() -> None:
    _remove(list(_made))
