"""Leak-free splits of units, in an order that a hash and a seed decide."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def shuffled(seed: int, *keys: Column | str) -> Column:
    """An order that depends on the seed and the keys alone."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *keys), 256)


def _families(units: DataFrame, seed: int) -> DataFrame:
    """Families in shuffled order; there are few, so one task may rank them."""
    names = units.select("family").distinct()
    return names.withColumn("k", F.row_number().over(Window.orderBy(shuffled(seed, "family"), "family")) - 1).withColumn("families", F.count(F.lit(1)).over(Window.partitionBy()))


def split_by_group(units: DataFrame, seed: int = 7) -> DataFrame:
    """(unit, family, split): of each family's shuffled units the first is held out if there are two, the second if there are four; which of val and test comes first alternates over the shuffled families."""
    place = F.struct(shuffled(seed, "family", "unit").alias("key"), "unit")
    own = units.select("unit", "family").distinct().withColumn("place", place)
    firsts = own.groupBy("family").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    # Only the first two places of a family matter: two aggregates, so that a family of any size is never ranked in one task.
    seconds = own.join(firsts, "family").where(F.col("place") > F.col("first")).groupBy("family").agg(F.min("place").alias("second"))
    heads = firsts.join(seconds, "family", "left").join(_families(units, seed), "family")
    ranked = own.join(heads, "family").withColumn("j", F.when(F.col("place") == F.col("first"), 0).when(F.col("place") == F.col("second"), 1).otherwise(2))
    one, other = F.when(F.col("k") % 2 == 0, "val").otherwise("test"), F.when(F.col("k") % 2 == 0, "test").otherwise("val")
    split = F.when((F.col("j") == 0) & (F.col("n") >= 2), one).when((F.col("j") == 1) & (F.col("n") >= 4), other).otherwise("train")
    return ranked.select("unit", "family", split.alias("split"))


def split_by_family(units: DataFrame, seed: int = 7) -> DataFrame:
    """(unit, family, split): whole families, about a sixth of them each for test and val."""
    hold = F.greatest(F.lit(1), F.bround(F.col("families") / 6).cast("int"))
    split = F.when(F.col("k") < hold, "test").when(F.col("k") < 2 * hold, "val").otherwise("train")
    return units.select("unit", "family").distinct().join(_families(units, seed), "family").select("unit", "family", split.alias("split"))


def leakage(samples: DataFrame, key: Column | str, split: str = "split") -> DataFrame:
    """(key, splits): keys that occur in more than one split."""
    found = samples.groupBy((F.col(key) if isinstance(key, str) else key).alias("key")).agg(F.sort_array(F.collect_set(split)).alias("splits"))
    return found.where(F.size("splits") > 1)
