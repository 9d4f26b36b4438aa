"""Running totals that no single task has to add up."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_total(rows: DataFrame, keys: list[str], order: str, value: str, name: str = "upto", slice_rows: int = 1 << 16) -> DataFrame:
    """Adds the sum of ``value`` over the rows of the same keys up to this one, by a whole-number order that is unique and nearly dense.

    The rows of a key are cut into slices by their order: sums of slices are totalled over the few slices, and each slice for itself, so a key of any size is
    spread over many tasks.
    """
    cut = rows.withColumn("_slice", F.floor(F.col(order) / slice_rows))
    sums = cut.groupBy(*keys, "_slice").agg(F.sum(value).alias("_sum"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_sum")
    own = F.sum(value).over(Window.partitionBy(*keys, "_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return cut.withColumn("_own", own).join(before, [*keys, "_slice"]).withColumn(name, F.col("_own") + F.col("_before")).drop("_slice", "_own", "_before")
