"""Face-adjacency graphs: pair, node and global features, and the checks that a graph must pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from facetlake.functions.constants import GRAPH_SURFACES
from facetlake.functions.storage import materialize, spread

KEYS = ("sample_id",)


def adjacent_pairs(face_edge: DataFrame, half: bool = False) -> DataFrame:
    """(sample_id, src, dst, edge_idx): ordered pairs of different faces that share an edge, from rows (sample_id, face_idx, edge_idx); ``half`` leaves those with src < dst."""
    a = face_edge.select("sample_id", "edge_idx", F.col("face_idx").alias("src")).distinct()
    b = a.withColumnRenamed("src", "dst")
    return a.join(b, ["sample_id", "edge_idx"]).where("src < dst" if half else "src <> dst")


def both_ways(pairs: DataFrame) -> DataFrame:
    """Rows with src and dst, and each again with the two turned round."""
    ways = F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"))))
    return pairs.withColumn("_way", ways).withColumns({"src": F.col("_way.src"), "dst": F.col("_way.dst")}).drop("_way")


def adjacent_faces(face_edge: DataFrame) -> DataFrame:
    """(sample_id, src, dst): the ordered pairs of adjacent faces, once each. They are made distinct as unordered pairs, which is half the rows to move and to hold, in as many tasks as the input asks for."""
    rows = materialize(face_edge.select("sample_id", "face_idx", "edge_idx").distinct(), "face_edge")
    pairs = adjacent_pairs(rows, half=True).select("sample_id", "src", "dst")
    return both_ways(spread(pairs, rows.count(), "sample_id", "src", "dst").distinct())


def _unordered(arcs: DataFrame) -> DataFrame:
    """Adds ``low`` and ``high``, an arc's ends in order (null first), and whether it is ``turned``."""
    turned = F.coalesce(F.col("src") > F.col("dst"), F.col("dst").isNull() & F.col("src").isNotNull())
    return arcs.withColumns({"low": F.when(turned, F.col("dst")).otherwise(F.col("src")), "high": F.when(turned, F.col("src")).otherwise(F.col("dst")), "turned": turned})


def one_way(arcs: DataFrame, rows: int = 0) -> DataFrame:
    """(sample_id, low, high): ends of which an arc leads one way and none the other; both directions meet in one grouping. An arc may be there several times; ``rows`` says about how many there are, for the number of tasks."""
    back = F.col("turned") | F.col("src").eqNullSafe(F.col("dst"))
    ways = spread(_unordered(arcs), rows, "sample_id", "low", "high").groupBy("sample_id", "low", "high").agg(F.max(~F.col("turned")).alias("there"), F.max(back).alias("back"))
    return ways.where("there <> back").select("sample_id", "low", "high")


def pair_features(pairs: DataFrame, edges: DataFrame, face_edge: DataFrame, half: bool = False) -> DataFrame:
    """Per ordered pair: number and length of shared edges, the share of the source's boundary, and the longest edge (of equals the one with the smallest index) with its class and angle over 180, where 0 or none counts as 180.

    The class and the curve also stand as indicators (``is_convex`` to ``is_bent``), which with angle, share and number are the ten features of a pair.
    With ``half`` the pairs have src < dst and stand for both directions, which are only told apart once the edges of a pair are summed up.
    """
    own = materialize(face_edge.select("sample_id", "face_idx", "edge_idx").distinct(), "face_edge")
    total = own.join(edges.select("sample_id", "edge_idx", "length_mm"), ["sample_id", "edge_idx"]).groupBy("sample_id", F.col("face_idx").alias("src")).agg(F.sum("length_mm").alias("boundary"))
    longest = F.max_by(F.struct("edge_idx", "convexity", "dihedral_angle_deg", "curve_type"), F.struct("length_mm", -F.col("edge_idx")))
    # Few pairs share several edges, so rows are dealt as they are: partial sums would be nearly as many, and wider.
    found = spread(pairs.join(edges, ["sample_id", "edge_idx"]), own.count(), "sample_id", "src", "dst").groupBy("sample_id", "src", "dst").agg(F.count(F.lit(1)).alias("n_shared"), F.sum("length_mm").alias("shared_length"), longest.alias("main"))
    found = both_ways(found) if half else found
    angle = F.when(F.coalesce(F.col("main.dihedral_angle_deg"), F.lit(0.0)) == 0, 180.0).otherwise(F.col("main.dihedral_angle_deg")) / 180
    share = F.when(F.col("boundary") > 0, F.col("shared_length") / F.col("boundary")).otherwise(0.0)
    return found.join(total, ["sample_id", "src"]).select("sample_id", "src", "dst", "n_shared", "shared_length", F.col("main.edge_idx").alias("main_edge"), F.col("main.convexity").alias("convexity"), F.col("main.curve_type").alias("curve_type"), angle.alias("angle"), share.alias("shared_fraction"), *[c.cast("float").alias(k) for k, c in _indicators(F.col("main.convexity"), F.col("main.curve_type")).items()])


def _indicators(convexity: Column, curve: Column) -> dict[str, Column]:
    kind, form = F.coalesce(convexity, F.lit("")), F.coalesce(curve, F.lit(""))
    named = {f"is_{k}": kind == k for k in ("convex", "concave", "smooth")} | {"is_other_class": ~kind.isin("convex", "concave", "smooth")}
    return named | {"is_line": form == "line", "is_circle": form == "circle", "is_bent": ~form.isin("line", "circle")}


def graph_type(surface: Column) -> Column:
    return F.when(surface.isin(*GRAPH_SURFACES), surface).otherwise("freeform")


def convexity_fractions(face_edge: DataFrame, edges: DataFrame) -> DataFrame:
    """Per face the shares of convex, concave and smooth edges among those that are no seam, or among all if none is left."""
    rows = face_edge.select("sample_id", "face_idx", "edge_idx").distinct().join(edges.select("sample_id", "edge_idx", "convexity"), ["sample_id", "edge_idx"])
    plain = F.col("convexity") != "seam"
    base = F.greatest(F.when(F.sum(plain.cast("int")) > 0, F.sum(plain.cast("int"))).otherwise(F.count(F.lit(1))), F.lit(1))
    return rows.groupBy("sample_id", "face_idx").agg(F.count(F.lit(1)).alias("n_edges"), *[(F.sum((F.col("convexity") == k).cast("int")) / base).alias(f"{k}_fraction") for k in ("convex", "concave", "smooth")])


def node_features(faces: DataFrame, face_edge: DataFrame, edges: DataFrame, boxes: DataFrame) -> DataFrame:
    """The 25 features of every face, by name; ``boxes`` has (sample_id, surface_area_mm2, dims struct<x,y,z>)."""
    d = F.col("dims")
    half = F.sqrt(d["x"] * d["x"] + d["y"] * d["y"] + d["z"] * d["z"]) / 2
    sized = faces.join(boxes.withColumn("scale", F.when(half > 0, half).otherwise(1.0)), "sample_id")
    degree = adjacent_faces(face_edge).groupBy("sample_id", F.col("src").alias("face_idx")).agg(F.count(F.lit(1)).alias("degree"))
    rows = sized.join(convexity_fractions(face_edge, edges), ["sample_id", "face_idx"], "left").join(degree, ["sample_id", "face_idx"], "left")
    p, c, n = F.col("analytic_params"), F.col("curvature"), F.col("normal_at_centroid")
    radius = F.coalesce(p["radius"], p["minor_radius"], p["ref_radius"], F.lit(0.0))
    extents = F.sort_array(F.array(*[(F.col("bbox_max_mm")[k] - F.col("bbox_min_mm")[k]) / (2 * F.col("scale")) for k in "xyz"]), asc=False)
    zero = lambda x: F.coalesce(x, F.lit(0.0))
    named = {f"is_{k}": (graph_type(F.col("surface_type")) == k).cast("double") for k in GRAPH_SURFACES}
    named |= {"area_fraction": F.when(F.col("surface_area_mm2") > 0, F.col("area_mm2") / F.col("surface_area_mm2")).otherwise(0.0), "log_area": F.log1p("area_mm2")}
    named |= {f"normal_{k}": zero(n[k]) for k in "xyz"}
    named |= {"mean_curvature": zero(c["mean_curvature_mean"]) * F.col("scale"), "gaussian_curvature": zero(c["gaussian_curvature_mean"]) * F.col("scale") * F.col("scale"), "radius": radius / F.col("scale"), "log_radius": F.log1p(radius)}
    named |= {"reversed": (F.col("orientation") == "reversed").cast("double"), "loops": F.col("loop_count").cast("double"), "n_edges": F.coalesce("n_edges", F.lit(0)).cast("double")}
    named |= {f"{k}_fraction": zero(F.col(f"{k}_fraction")) for k in ("convex", "concave", "smooth")}
    named |= {f"extent_{i}": extents[i] for i in range(3)}
    named |= {"degree": F.coalesce("degree", F.lit(0)).cast("double")}
    return rows.select("sample_id", "face_idx", *[v.cast("float").alias(k) for k, v in named.items()])


def global_features(faces: DataFrame, edges: DataFrame, samples: DataFrame) -> DataFrame:
    """The 13 features of every sample; ``samples`` has (sample_id, volume_mm3, surface_area_mm2, dims)."""
    d = F.col("dims")
    half = F.sqrt(d["x"] * d["x"] + d["y"] * d["y"] + d["z"] * d["z"])
    extents = F.sort_array(F.array(d["x"], d["y"], d["z"]), asc=False)
    shares = [F.avg((graph_type(F.col("surface_type")) == k).cast("double")).alias(f"share_{k}") for k in GRAPH_SURFACES]
    counts = faces.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_faces"), *shares).join(edges.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n_edges")), "sample_id", "left")
    named = {"log_volume": F.log1p(F.abs("volume_mm3")), "log_area": F.log1p("surface_area_mm2")}
    named |= {f"dim_{i}": extents[i] / F.when(half > 0, half).otherwise(2.0) for i in range(3)}
    named |= {"log_faces": F.log1p("n_faces"), "log_edges": F.log1p(F.coalesce("n_edges", F.lit(0)))} | {f"share_{k}": F.col(f"share_{k}") for k in GRAPH_SURFACES}
    return samples.join(counts, "sample_id").select("sample_id", *[v.cast("float").alias(k) for k, v in named.items()])


def invariants(faces: DataFrame, pairs: DataFrame, nodes: DataFrame, face_edge: DataFrame) -> DataFrame:
    """One row a sample: the seven checks of its graph. ``pairs`` are rows (sample_id, src, dst), ``nodes`` the feature rows."""
    arcs = pairs.select("sample_id", "src", "dst")
    per_face = faces.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"), F.min("face_idx").alias("low"), F.max("face_idx").alias("high"), F.countDistinct("face_idx").alias("different"))
    per_node = nodes.groupBy("sample_id").agg(F.count(F.lit(1)).alias("nodes"), F.max(F.exists(F.array(*[F.col(c) for c, t in nodes.dtypes if t in ("float", "double")]), lambda x: F.isnan(x) | x.isNull())).alias("bad"))
    wanted = adjacent_pairs(face_edge).select("sample_id", "src", "dst")
    # Arcs and the topology's pairs are counted together by their unordered ends, each way for itself: one grouping tells what is missing, too much, twice or one way.
    every = _unordered(arcs.withColumn("wanted", F.lit(False)).unionAll(wanted.withColumn("wanted", F.lit(True))))
    ways = {n: F.count_if(w & (F.col("turned") == t)).alias(n) for n, w, t in (("have", ~F.col("wanted"), False), ("back", ~F.col("wanted"), True), ("want", F.col("wanted"), False), ("want_back", F.col("wanted"), True))}
    counts = every.groupBy("sample_id", "low", "high").agg(*ways.values())
    have, back, want, want_back = (F.col(n) for n in ways)
    here, loop = have + back > 0, F.col("low").eqNullSafe(F.col("high"))
    each = lambda f: F.sum(f(have, want).cast("int") + f(back, want_back).cast("int"))
    found = counts.groupBy("sample_id").agg(
        F.sum(have + back).alias("arcs"), F.min(F.when(here, F.least("low", "high"))).alias("least"), F.max(F.when(here, F.greatest("low", "high"))).alias("most"), F.sum(F.when(F.col("low") == F.col("high"), have)).alias("loops"),
        each(lambda h, w: h > 1).alias("twice"), F.sum(F.when(loop, 0).otherwise(F.abs(have - back))).alias("one_way"), each(lambda h, w: (w > 0) & (h == 0)).alias("missing"), each(lambda h, w: (w == 0) & (h > 0)).alias("surplus"),
    )
    rows = per_face
    for other in (per_node, found):
        rows = rows.join(other, "sample_id", "left")
    none = lambda c: F.coalesce(c, F.lit(0)) == 0
    checks = {
        "node_for_every_face": F.coalesce("nodes", F.lit(0)) == F.col("n"),
        "face_indices_dense": (F.col("low") == 0) & (F.col("high") == F.col("n") - 1) & (F.col("different") == F.col("n")),
        "ends_in_range": none(F.col("arcs")) | ((F.col("least") >= 0) & (F.col("most") < F.col("n"))),
        "no_loops": none(F.col("loops")),
        "symmetric": none(F.col("one_way")) & none(F.col("twice")),
        "same_as_topology": none(F.col("missing")) & none(F.col("surplus")),
        "finite": ~F.coalesce("bad", F.lit(False)),
    }
    return rows.select("sample_id", *[v.alias(k) for k, v in checks.items()])
