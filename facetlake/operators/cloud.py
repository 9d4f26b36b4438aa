"""Point clouds on meshes: allocation to faces, sampling, normalization, and labels from analytic tools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from facetlake.functions import vectors as v
from facetlake.functions.prefix import running_total
from facetlake.functions.storage import materialize
from facetlake.operators.intervals import contained


def allocate(faces: DataFrame, sample: str, face: str, weight: str, total: int = 4096, least: int = 8) -> DataFrame:
    """(sample, face, n): the least number for every face, the rest by largest remainder over whole-number weights.

    Where the least numbers alone exceed the total every face still gets its least. Of equal remainders the earlier face goes first.
    """
    every = Window.partitionBy(sample)
    rows = faces.select(sample, face, F.col(weight).cast("long").alias("w")).withColumns({"rest": F.greatest(F.lit(total).cast("long") - least * F.count(F.lit(1)).over(every), F.lit(0).cast("long")), "all": F.sum("w").over(every)})
    product = F.col("rest") * F.col("w")
    rows = rows.withColumns({"floor": F.when(F.col("all") > 0, F.call_function("div", product, F.col("all"))).otherwise(0), "remainder": F.when(F.col("all") > 0, product % F.col("all")).otherwise(0)})
    rows = rows.withColumn("left", F.col("rest") - F.sum("floor").over(every)).withColumn("place", F.row_number().over(every.orderBy(F.desc("remainder"), face)))
    extra = ((F.col("place") <= F.col("left")) & (F.col("all") > 0)).cast("long")
    return rows.select(sample, face, (F.lit(least) + F.col("floor") + extra).cast("long").alias("n"))


def normalization(points: DataFrame, sample: str = "sample_id") -> DataFrame:
    """(sample, centre, scale): the middle of the box, and half its diagonal (1 where that is 0)."""
    box = points.groupBy(sample).agg(*[f(c).alias(f"{n}_{c}") for c in "xyz" for f, n in ((F.min, "min"), (F.max, "max"))])
    half = F.sqrt(v.sum_of([F.pow(F.col(f"max_{c}") - F.col(f"min_{c}"), 2) for c in "xyz"])) / 2
    return box.select(sample, v.vec(*[(F.col(f"min_{c}") + F.col(f"max_{c}")) / 2 for c in "xyz"]).alias("centre"), F.when(half > 0, half).otherwise(1.0).alias("scale"))


def normalize(x: Column, centre: Column, scale: Column) -> Column:
    return (x - centre) / scale


def denormalize(x: Column, centre: Column, scale: Column) -> Column:
    return x * scale + centre


def boundary_segments(triangles: DataFrame) -> DataFrame:
    """(sample_id, face_idx, a, b): sides that one triangle of the face alone has; triangles have vertices i0, i1, i2."""
    sides = F.array(*[F.struct(F.least(F.col(p), F.col(q)).alias("a"), F.greatest(F.col(p), F.col(q)).alias("b")) for p, q in (("i0", "i1"), ("i1", "i2"), ("i2", "i0"))])
    return triangles.select("sample_id", "face_idx", F.explode(sides).alias("s")).groupBy("sample_id", "face_idx", "s.a", "s.b").agg(F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")


def sample_points(triangles: DataFrame, counts: DataFrame, seed: int = 1234) -> DataFrame:
    """Points on triangles (sample_id, face_idx, tri_idx, a, b, c structs), as many per face as ``counts`` (sample_id, face_idx, n) says, by area.

    Random numbers are hashes of seed, sample, face and point, so the same points come whatever the partitions are. Points are not moved onto the exact surface: that needs a kernel.
    """
    w = Window.partitionBy("sample_id", "face_idx").orderBy("tri_idx")
    sized = triangles.withColumn("area", v.triangle_area(F.col("a"), F.col("b"), F.col("c")))
    upto = sized.withColumn("upto", F.sum("area").over(w)).withColumn("whole", F.sum("area").over(Window.partitionBy("sample_id", "face_idx")))
    upto = upto.withColumn("low", (F.col("upto") - F.col("area")) / F.col("whole")).withColumn("high", F.col("upto") / F.col("whole"))
    wanted = counts.where("n > 0").select("sample_id", "face_idx", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("k"))
    u = lambda i: v.hash_uniform(F.lit(f"{seed}|{i}"), "sample_id", F.col("face_idx").cast("string"), F.col("k").cast("string"))
    wanted = wanted.withColumn("u", u(0)).withColumn("r1", u(1)).withColumn("r2", u(2))
    inside = wanted.join(upto, ["sample_id", "face_idx"]).where((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high")))
    p, n = v.barycentric_point(F.col("a"), F.col("b"), F.col("c"), F.col("r1"), F.col("r2")), v.unit(v.cross(v.sub(F.col("b"), F.col("a")), v.sub(F.col("c"), F.col("a"))))
    return inside.select("sample_id", "face_idx", "k", "tri_idx", p.alias("p"), n.alias("normal"))


def sample_segments(segments: DataFrame, counts: DataFrame, seed: int = 1234) -> DataFrame:
    """Points on boundary segments, by arc length: (sample_id, face_idx, k, seg_idx, along), as many per face as ``counts`` (sample_id, face_idx, n) says.

    ``segments`` has (sample_id, face_idx, seg_idx from 0, steps), its length in whole steps. A point's number, a hash of seed and point, is a step of the face's whole
    boundary, and the segment whose half-open range of steps holds it is looked up; ``along`` is the place on that segment, from 0 to 1. Segments without
    length get no point, a face whose boundary has none gets no points.
    """
    keys = ["sample_id", "face_idx"]
    segments = materialize(segments.select(*keys, "seg_idx", F.col("steps").cast("long").alias("steps")), "segments")
    upto = running_total(segments, keys, "seg_idx", "steps", "high").withColumn("low", F.col("high") - F.col("steps"))
    whole = segments.groupBy(*keys).agg(F.sum("steps").alias("whole"))
    wanted = counts.where("n > 0").join(whole, keys).where("whole > 0").select(*keys, "whole", F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("k"))
    number = v.hash_uniform(F.lit(f"{seed}|b"), F.col("sample_id").cast("string"), F.col("face_idx").cast("string"), F.col("k").cast("string"))
    wanted = wanted.withColumn("step", F.floor(number * F.col("whole")).cast("long"))
    found = contained(wanted, upto, "step", "low", "high", keys=("sample_id", "face_idx"))
    return found.select(*keys, "k", "seg_idx", ((F.col("step") - F.col("low") + 0.5) / F.col("steps")).alias("along"))


def label_faces(points: DataFrame, tools: DataFrame, faces: DataFrame, tolerance: float = 2e-3, share: float = 0.95) -> DataFrame:
    """(sample_id, face_idx, label): the tool of highest priority (hole, slot, pocket; then its place) whose boundary holds enough of a face's points; else a fillet by radius; else planar or other.

    ``points`` has (sample_id, face_idx, p), ``tools`` (sample_id, tool_idx, label, tool struct), ``faces`` (sample_id, face_idx, surface_type, radius, fillet_radii array). A part has few tools, so a point meets each of its part's.
    """
    t = F.col("tool")
    on = F.abs(v.rounded_rect_sdf(F.col("p"), t["origin"], t["u"], t["n"], t["half_u"], t["half_v"], t["corner_r"], t["t0"], t["t1"])) <= tolerance
    fits = points.join(tools, "sample_id").groupBy("sample_id", "face_idx", "tool_idx", "label").agg(F.avg(on.cast("double")).alias("fit")).where(F.col("fit") >= share)
    rank = F.array_position(F.array(F.lit("hole"), F.lit("slot"), F.lit("pocket")), F.col("label"))
    best = fits.groupBy("sample_id", "face_idx").agg(F.min_by("label", F.struct(rank, "tool_idx")).alias("by_tool"))
    fillet = F.col("surface_type").isin("cylinder", "torus") & F.exists("fillet_radii", lambda r: F.abs(r - F.col("radius")) <= 1e-3)
    label = F.coalesce("by_tool", F.when(fillet, "fillet").when(F.col("surface_type") == "plane", "planar").otherwise("other"))
    return faces.join(best, ["sample_id", "face_idx"], "left").select("sample_id", "face_idx", label.alias("label"))


def cloud_checks(points: DataFrame, faces: DataFrame, boxes: DataFrame) -> DataFrame:
    """One row a sample: every face has points, indices in range, unit normals, points on the surface, and the inverse of the normalization within 1e-4 of its scale.

    ``points`` has ``projection_ratio``, a point's distance from the exact surface over the allowed one, which whoever sampled it knows; without the column the check fails.
    """
    ratio = F.max("projection_ratio") if "projection_ratio" in points.columns else F.max(F.lit(None).cast("double"))
    per = points.groupBy("sample_id").agg(F.countDistinct("face_idx").alias("hit"), F.min("face_idx").alias("low"), F.max("face_idx").alias("top"), F.max(F.abs(v.norm(F.col("normal")) - 1)).alias("off"), ratio.alias("ratio"))
    n = faces.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"))
    back = points.join(boxes, "sample_id").groupBy("sample_id").agg(F.max(F.greatest(*[F.abs(denormalize(normalize(F.col("p")[c], F.col("centre")[c], F.col("scale")), F.col("centre")[c], F.col("scale")) - F.col("p")[c]) - 1e-4 * F.col("scale") - 1e-4 for c in "xyz"])).alias("worst"))
    rows = n.join(per, "sample_id", "left").join(back, "sample_id", "left")
    return rows.select("sample_id", (F.col("hit") == F.col("n")).alias("every_face_sampled"), ((F.col("low") >= 0) & (F.col("top") < F.col("n"))).alias("faces_in_range"), (F.col("off") <= 1e-3).alias("unit_normals"), (F.col("ratio") <= 1).alias("on_surface"), (F.col("worst") <= 0).alias("inverse_close"))


def mesh_scalars(triangles: DataFrame) -> DataFrame:
    """Extension: volume, area and centre of mass of a closed mesh, by signed tetrahedra."""
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    volume = v.dot(a, v.cross(b, c)) / 6
    mid = lambda k: volume * (a[k] + b[k] + c[k]) / 4
    sums = triangles.groupBy("sample_id").agg(F.sum(volume).alias("volume_mm3"), F.sum(v.triangle_area(a, b, c)).alias("surface_area_mm2"), *[F.sum(mid(k)).alias(f"m{k}") for k in "xyz"])
    return sums.select("sample_id", "volume_mm3", "surface_area_mm2", v.vec(*[F.col(f"m{k}") / F.col("volume_mm3") for k in "xyz"]).alias("center_of_mass_mm"))
