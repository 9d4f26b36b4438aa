"""Figures about labels, predictions, features and repeated exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetlake.functions.storage import materialize
from facetlake.operators.growth import match_in_order


def confusion_matrix(rows: DataFrame, truth: str, predicted: str, labels: list) -> DataFrame:
    """(truth, predicted, n) over all pairs of the given labels, zeros included."""
    every = rows.sparkSession.createDataFrame([(a, b) for a in labels for b in labels], f"truth {rows.schema[truth].dataType.simpleString()}, predicted {rows.schema[truth].dataType.simpleString()}")
    counts = rows.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    return every.join(counts, ["truth", "predicted"], "left").select("truth", "predicted", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def _share(part: Column, whole: Column) -> Column:
    return F.round(F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0)), 4)


def classification_report(matrix: DataFrame) -> DataFrame:
    """(label, precision, recall, f1, support), and a row "all" with accuracy as recall and the mean F1 of labels that occur."""
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)
    by_truth = matrix.groupBy(F.col("truth").alias("label")).agg(F.sum("n").alias("support"), F.sum(hit).alias("tp"))
    by_guess = matrix.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("guessed"))
    raw = by_truth.join(by_guess, "label")
    exact = F.coalesce(F.try_divide(2.0 * F.col("tp"), (F.col("support") + F.col("guessed")).cast("double")), F.lit(0.0))
    rows = raw.select(F.col("label").cast("string").alias("label"), _share(F.col("tp"), F.col("guessed")).alias("precision"), _share(F.col("tp"), F.col("support")).alias("recall"), F.round(exact, 4).alias("f1"), F.col("support").cast("long").alias("support"))
    total = raw.agg(_share(F.sum("tp"), F.sum("support")).alias("recall"), F.round(F.coalesce(F.avg(F.when(F.col("support") > 0, exact)), F.lit(0.0)), 4).alias("f1"), F.sum("support").cast("long").alias("support"))
    return rows.unionByName(total.select(F.lit("all").alias("label"), F.lit(None).cast("double").alias("precision"), "recall", "f1", "support"))


def agreement(rows: DataFrame, keys: list[str], truth: str, other: str) -> DataFrame:
    """Per key the share of rows whose two labels agree; a missing label agrees with none."""
    return rows.groupBy(*keys).agg(F.round(F.avg(F.coalesce(F.col(truth) == F.col(other), F.lit(False)).cast("double")), 6).alias("agreement"))


def class_weights(rows: DataFrame, label: str, labels: list) -> DataFrame:
    """(label, weight): one over the root of the count, 0 for absent labels, scaled to mean 1 over those present."""
    spark = rows.sparkSession
    every = spark.createDataFrame([(x,) for x in labels], f"label {rows.schema[label].dataType.simpleString()}")
    counted = every.join(rows.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")), "label", "left")
    raw = counted.withColumn("w", F.when(F.col("n") > 0, 1 / F.sqrt("n")))
    return raw.select("label", F.round(F.coalesce(F.col("w") / F.avg("w").over(Window.partitionBy()), F.lit(0.0)), 6).alias("weight"))  # as many rows as labels


def standardizer(rows: DataFrame, vector: str) -> DataFrame:
    """(dim, mean, std) by position, with the population's deviation; one where it is hardly above zero."""
    long = rows.select(F.posexplode(vector).alias("dim", "x"))
    std = F.stddev_pop(F.col("x").cast("double"))
    return long.groupBy("dim").agg(F.avg(F.col("x").cast("double")).alias("mean"), F.when(std <= 1e-6, 1.0).otherwise(std).alias("std"))


def standardize(rows: DataFrame, key: str, vector: str, fitted: DataFrame) -> DataFrame:
    """(key, dim, z); ``fitted`` has a row per dimension."""
    return rows.select(key, F.posexplode(vector).alias("dim", "x")).join(fitted, "dim").select(key, "dim", ((F.col("x") - F.col("mean")) / F.col("std")).alias("z"))


def curvature_statistics(places: DataFrame) -> DataFrame:
    """(sample_id, face_idx, curvature): over the places of a face that have a normal and a finite mean curvature, their number, the mean, least and largest mean curvature and the mean Gaussian one.

    ``places`` has (sample_id, face_idx, has_normal, mean_curvature, gaussian_curvature), one row a place inside the face; a face without a usable place has number 0 and nulls.
    """
    h = F.col("mean_curvature")
    ok = F.coalesce(F.col("has_normal"), F.lit(False)) & h.isNotNull() & ~F.isnan(h) & (F.abs(h) < float("inf"))
    mean, gauss = F.when(ok, h), F.when(ok, F.col("gaussian_curvature"))
    figures = F.struct(F.count(mean).cast("double").alias("samples"), F.avg(mean).alias("mean_curvature_mean"), F.min(mean).alias("mean_curvature_min"), F.max(mean).alias("mean_curvature_max"), F.avg(gauss).alias("gaussian_curvature_mean"))
    return places.groupBy("sample_id", "face_idx").agg(figures.alias("curvature"))


def merge_histograms(rows: DataFrame, keys: list[str], histogram: str) -> DataFrame:
    """(keys, histogram): maps of counts added up by key, as entries (kind, n), the most frequent first and of equal ones by name. Null and empty maps add nothing; keys with nothing else have no entries."""
    counts = rows.select(*keys, F.explode_outer(histogram).alias("kind", "n")).groupBy(*keys, "kind").agg(F.sum("n").alias("n"))
    entry = F.collect_list(F.when(F.col("kind").isNotNull(), F.struct((-F.col("n")).alias("less"), "kind", "n")))  # as many as there are kinds
    return counts.groupBy(*keys).agg(F.transform(F.sort_array(entry), lambda e: F.struct(e["kind"].alias("kind"), e["n"].alias("n"))).alias(histogram))


def multiset_jaccard(left: DataFrame, right: DataFrame, keys: list[str], item: str) -> DataFrame:
    """Per key, the sum of smaller over the sum of larger counts of each item on the two sides."""
    count = lambda d, n: d.groupBy(*keys, item).agg(F.count(F.lit(1)).alias(n))
    both = count(left, "a").join(count(right, "b"), [*keys, item], "full_outer").fillna(0, ["a", "b"])
    return both.groupBy(*keys).agg((F.sum(F.least("a", "b")) / F.sum(F.greatest("a", "b"))).alias("jaccard"))


def relative_spread(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Per key, (max - min) over the size of the mean; zero where the mean is."""
    mean = F.abs(F.avg(value))
    return rows.groupBy(key).agg(F.round(F.when(mean > 0, (F.max(value) - F.min(value)) / mean).otherwise(0.0), 6).alias("spread"), F.count(F.lit(1)).alias("n"))


def export_consistency(exports: DataFrame) -> DataFrame:
    """Per part over its exports (part, export, volume, area, dims, n_faces): spreads, the largest difference of a box dimension, distinct face counts."""
    spread = lambda c: F.when(F.avg(c) != 0, (F.max(c) - F.min(c)) / F.abs(F.avg(c))).otherwise(0.0)
    d = F.array_sort("dims")
    rows = exports.withColumns({f"d{i}": d[i] for i in range(3)})
    return rows.groupBy("part").agg(F.count(F.lit(1)).alias("exports"), spread("volume").alias("volume_spread"), spread("area").alias("area_spread"), F.greatest(*[F.max(f"d{i}") - F.min(f"d{i}") for i in range(3)]).alias("box_difference"), F.countDistinct("n_faces").alias("face_counts"))


def pair_scores(found: DataFrame, true: DataFrame) -> DataFrame:
    """Precision and recall of unordered pairs (a, b)."""
    norm = lambda d, n: d.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().withColumn(n, F.lit(1))
    both = norm(found, "f").join(norm(true, "t"), ["a", "b"], "full_outer").fillna(0, ["f", "t"])
    return both.agg(F.sum(F.col("f") * F.col("t")).alias("tp"), F.sum(F.col("f") * (1 - F.col("t"))).alias("fp"), F.sum((1 - F.col("f")) * F.col("t")).alias("fn")).select("tp", "fp", "fn", _share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), _share(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))


def match_features(features: DataFrame, tolerance: float = 0.05, keys: tuple[str, ...] = ("sample_id", "feature_type")) -> DataFrame:
    """Greedy one-to-one matching per sample, in order: each true feature takes the first unused predicted one of its type whose size is within tolerance.

    ``features`` has (sample_id, side "true" or "predicted", feature_type, place, size), places unique on each side of a sample; a null size fits any. Returns the keys and (true_place,
    predicted_place, size_error) with nulls for what is left; the error is null where a size is. Rounds over all samples at once, see ``growth.match_in_order``.
    """
    side = lambda s, n: features.where(F.col("side") == s).select(*keys, F.col("place").alias(f"{n}_place"), F.col("size").alias(f"{n}_size"))
    true, predicted = side("true", "true"), side("predicted", "predicted")
    fits = F.coalesce(F.abs(F.col("true_size") - F.col("predicted_size")) <= tolerance, F.lit(True))
    matched = match_in_order(true.join(predicted, [*keys]).where(fits), "true_place", "predicted_place", keys)
    both = true.join(matched, [*keys, "true_place"], "left").join(predicted, [*keys, "predicted_place"], "full_outer")
    return both.select(*keys, F.col("true_place").cast("long").alias("true_place"), F.col("predicted_place").cast("long").alias("predicted_place"), F.abs(F.col("true_size") - F.col("predicted_size")).alias("size_error"))


def feature_scores(matches: DataFrame) -> DataFrame:
    """(feature_type, tp, fp, fn, precision, recall, max_error, mean_error), the errors over matched sizes."""
    t, p = F.col("true_place").isNotNull(), F.col("predicted_place").isNotNull()
    counts = matches.groupBy("feature_type").agg(*[F.sum(c.cast("long")).alias(n) for c, n in ((t & p, "tp"), (~t & p, "fp"), (t & ~p, "fn"))], F.max("size_error").alias("max_error"), F.avg("size_error").alias("mean_error"))
    return counts.select("feature_type", "tp", "fp", "fn", _share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), _share(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"), "max_error", "mean_error")


def seed_summary(runs: DataFrame, key: str, values: list[str]) -> DataFrame:
    return runs.groupBy(key).agg(*[f(v).alias(f"{v}_{n}") for v in values for f, n in ((F.avg, "mean"), (F.stddev_pop, "std"))])


def best_epoch(history: DataFrame, run: str = "run_id", score: str = "val_macro_f1", epoch: str = "epoch") -> DataFrame:
    """The first epoch with the highest score."""
    return history.groupBy(run).agg(F.max_by(epoch, F.struct(score, -F.col(epoch))).alias("best_epoch"), F.max(score).alias(score))


def percentiles(rows: DataFrame, keys: list[str], value: str, accuracy: int = 1000) -> DataFrame:
    """Exact p50, p95 and maximum, interpolated linearly; groups of any size.

    Equal values are counted before they move. A sketch of bounded size brackets each rank; values below a bracket are only added up, and running counts go over the
    few inside, some 4 / ``accuracy`` of a group. Null and NaN values do not count; a group without others has nulls.
    """
    shares = {"p50": 0.5, "p95": 0.95}
    x = F.col(value).cast("double")
    counted = materialize(rows.select(*keys, x.alias("_x")).groupBy(*keys, F.when(~F.isnan("_x"), F.col("_x")).alias("_x")).agg(F.count(F.lit(1)).alias("_n")), "counts")
    edges = [min(max(p + d / accuracy, 0.0), 1.0) for p in shares.values() for d in (-2, 2)]
    known = rows.where(x.isNotNull() & ~F.isnan(x)).groupBy(*keys).agg(F.percentile_approx(x, edges, accuracy).alias("_edges"))
    ends = counted.where("_x IS NOT NULL").groupBy(*keys).agg(F.sum("_n").alias("_total"), F.max("_x").alias("_max"))
    whole = F.col("_total") <= 4 * accuracy  # few values: brackets would miss a rank by rounding
    brackets = F.array(*[F.struct(F.lit(k).alias("name"), (F.lit(p) * (F.col("_total") - 1)).alias("rank"), F.when(whole, float("-inf")).otherwise(F.col("_edges")[2 * i]).alias("low"), F.when(whole, float("inf")).otherwise(F.col("_edges")[2 * i + 1]).alias("high")) for i, (k, p) in enumerate(shares.items())])
    own = materialize(known.join(ends, keys).select(*keys, "_total", "_max", F.explode(brackets).alias("_b")), "brackets")
    near = counted.where("_x IS NOT NULL").join(own, keys).where(F.col("_x") <= F.col("_b.high"))
    below = near.where(F.col("_x") < F.col("_b.low")).groupBy(*keys, "_b.name").agg(F.sum("_n").alias("_below"))
    inside = near.where(F.col("_x") >= F.col("_b.low")).select(*keys, "_x", "_n", "_b.*").join(below, [*keys, "name"], "left")
    upto = F.coalesce("_below", F.lit(0)) + F.sum("_n").over(Window.partitionBy(*keys, "name").orderBy("_x"))
    placed = inside.withColumn("_upto", upto)
    at = lambda r: F.max(F.when((r >= F.col("_upto") - F.col("_n")) & (r < F.col("_upto")), F.col("_x")))
    part = F.col("rank") - F.floor("rank")
    picked = placed.groupBy(*keys, "name").agg(at(F.floor("rank")).alias("a"), at(F.ceil("rank")).alias("b"), F.max(part).alias("part"))
    exact = picked.groupBy(*keys).agg(*[F.round(F.max(F.when(F.col("name") == k, F.when(F.col("a") == F.col("b"), F.col("a")).otherwise((1 - F.col("part")) * F.col("a") + F.col("part") * F.col("b")))), 6).alias(k) for k in shares])
    every = counted.groupBy(*keys).agg(F.round(F.max("_x"), 6).alias("max"), F.coalesce(F.sum(F.when(F.col("_x").isNotNull(), F.col("_n"))), F.lit(0)).alias("n"))
    return every.join(exact, keys, "left").select(*keys, *shares, "max", "n")


def train_nearest_mean(rows: DataFrame, key: str, vector: str, label: str, is_train: str) -> DataFrame:
    """A per-face baseline: each row gets the label of the nearest class mean of the training rows (key, predicted); of equally near ones the smallest.

    The fit, a number for each dimension and for each class and dimension, is two aggregates and travels as one row; vectors stay whole and are never joined on a
    dimension. Rows without a vector get no row; without training rows nothing is predicted.
    """
    gathered = lambda *names: F.sort_array(F.collect_list(F.struct("dim", *names)))
    scale = standardizer(rows.where(is_train), vector).agg(gathered("mean", "std").alias("scale"))  # one row
    scaled = rows.where(F.col(vector).isNotNull()).select(key, label, is_train, F.col(vector).cast("array<double>").alias("_v")).join(F.broadcast(scale))
    z = scaled.select(key, label, is_train, F.zip_with("_v", "scale", lambda x, s: (x - s["mean"]) / s["std"]).alias("_z"))
    own = z.where(is_train).select(F.col(label).alias("predicted"), F.posexplode("_z").alias("dim", "z")).groupBy("predicted", "dim").agg(F.avg("z").alias("m"))
    means = own.groupBy("predicted").agg(F.transform(gathered("m"), lambda e: e["m"]).alias("m")).agg(F.sort_array(F.collect_list(F.struct("predicted", "m"))).alias("means"))  # one row
    distance = lambda c: F.aggregate(F.zip_with("_z", c["m"], lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, x: t + x)
    near = F.array_min(F.transform("means", lambda c: F.struct(distance(c).alias("d"), c["predicted"].alias("predicted"))))
    return z.join(F.broadcast(means)).select(key, near["predicted"].alias("predicted"))


def message_pass(nodes: DataFrame, arcs: DataFrame, vector: str = "h") -> DataFrame:
    """One mean-aggregation step of a graph network: each node's vector joined with the mean of its neighbours', by position."""
    sent = arcs.join(nodes.select("sample_id", F.col("face_idx").alias("src"), F.posexplode(vector).alias("dim", "x")), ["sample_id", "src"])
    mean = sent.groupBy("sample_id", F.col("dst").alias("face_idx"), "dim").agg(F.avg("x").alias("x"))
    packed = mean.groupBy("sample_id", "face_idx").agg(F.transform(F.sort_array(F.collect_list(F.struct("dim", "x"))), lambda e: e["x"]).alias("around"))
    zeros = F.transform(F.col(vector), lambda _: F.lit(0.0))
    return nodes.join(packed, ["sample_id", "face_idx"], "left").withColumn(vector, F.concat(F.col(vector), F.coalesce("around", zeros))).drop("around")
