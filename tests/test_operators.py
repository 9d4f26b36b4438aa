"""Golden values, properties and edge cases of the operators over typed tables."""

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from facetlake.functions import vectors as v
from facetlake.functions.identity import config_hash, entity_id, quantize, sample_id
from facetlake.operators import canonical, cloud, dataset, graph, intake, jobs, metrics, near_duplicates, raster, recognize, splits
from facetlake.operators.components import connected_components
from facetlake.schemas import EDGES, FACES
from facetlake.sources import analytic
from facetlake.sources.files import NoKernel, step_files
from facetlake.sources.sinks import replace_samples, write_failures, write_once

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def test_components_have_the_smallest_member(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(200, 260)] + [(1000, x) for x in range(1001, 1100)] + [(rng.randrange(50), rng.randrange(50)) for _ in range(40)] + [(7777, 7777)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        up[b] = a
    found = connected_components(spark.createDataFrame(edges, "a long, b long").union(spark.createDataFrame([(None, 3)], "a long, b long")))
    assert {r.node: r.component for r in found.collect()} == {x: root(x) for x in up}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_golden(spark):
    rows = [("x", 1000.0, 600.0, [10.0, 10.0, 10.0]), ("y", 1000.9, 600.5, [10.0, 10.0, 10.0]), ("z", 1030.0, 600.0, [10.0, 10.0, 10.3]), ("w", 0.0, 0.0, [0.0, 0.0, 0.0]), ("v", 0.0, 0.0, [0.0, 0.0, 0.0])]
    parts = spark.createDataFrame(rows, "id string, vol double, area double, dims array<double>")
    found = near_duplicates.near_duplicate_clusters(parts, "id", F.col("vol"), F.col("area"), F.col("dims"))
    assert sorted(map(tuple, found.collect())) == [("v", "v"), ("w", "v"), ("x", "x"), ("y", "x")]


def test_band_join_loses_no_pair(spark):
    rng = random.Random(5)
    rows = [(i, 100 * 1.0009 ** rng.randrange(400), 50 * 1.0009 ** rng.randrange(40), [1.0, 2.0, 3.0]) for i in range(300)]
    parts = spark.createDataFrame(rows, "id long, vol double, area double, dims array<double>")
    distinct = near_duplicates.signatures(parts, "id", F.col("vol"), F.col("area"), F.col("dims"))
    own = {(r.volume, r.area): r.part for r in distinct.collect()}
    near = lambda x, y: abs(x - y) <= 2e-3 * max(x, y)
    want = {(own[a], own[b]) for a in own for b in own if own[a] < own[b] and near(a[0], b[0]) and near(a[1], b[1])}
    assert {tuple(r) for r in near_duplicates.near_duplicate_pairs(distinct).collect()} == want


def test_classification_report_golden(spark):
    rows = spark.createDataFrame(list(zip("aabbc", "abbba", strict=True)), "truth string, predicted string")
    matrix = metrics.confusion_matrix(rows, "truth", "predicted", ["a", "b", "c"])
    assert [r.n for r in matrix.orderBy("truth", "predicted").collect()] == [1, 1, 0, 0, 2, 0, 1, 0, 0]
    report = {r.label: r for r in metrics.classification_report(matrix).collect()}
    assert report["b"].precision == 0.6667 and report["c"].recall == 0.0 and report["all"].recall == 0.6


def test_leak_detector(spark):
    rows = spark.createDataFrame([("k", "train"), ("k", "test"), ("m", "train")], "key string, split string")
    assert [(r.key, r.splits) for r in splits.leakage(rows, "key").collect()] == [("k", ["test", "train"])]


@FEW
@given(st.dictionaries(st.integers(0, 60), st.integers(0, 5), max_size=40), st.integers(0, 3))
def test_splits_never_leak_and_repeat(spark, units, seed):
    frame = spark.createDataFrame([(f"u{u}", f"f{f}") for u, f in units.items()], "unit string, family string")
    for split in (splits.split_by_group, splits.split_by_family):
        first = sorted(map(tuple, split(frame, seed).collect()))
        assert first == sorted(map(tuple, split(frame.repartition(3), seed).collect()))
        assert len({u for u, *_ in first}) == len(first) == len(units)


@FEW
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=30), st.integers(0, 500))
def test_allocation(spark, weights, total):
    rows = spark.createDataFrame([("s", i, w) for i, w in enumerate(weights)], "s string, f int, w long")
    n = [r.n for r in cloud.allocate(rows, "s", "f", "w", total, 8).collect()]
    assert min(n) >= 8
    assert sum(n) == (max(total, 8 * len(weights)) if sum(weights) else 8 * len(weights))


def test_sdf_golden(spark):
    def sdf(point, half_u, half_v, corner, t0, t1):
        cols = [v.vec(*point), v.vec(0, 0, 0), v.vec(1, 0, 0), v.vec(0, 0, 1), *map(F.lit, (half_u, half_v, corner, t0, t1))]
        return spark.range(1).select(v.rounded_rect_sdf(*cols)).first()[0]

    cylinder = (5.0, 5.0, 5.0, 0.0, 10.0)
    assert [abs(sdf(p, *cylinder)) < 1e-9 for p in ((5, 0, 5), (0, -5, 3), (0, 0, 5), (6, 0, 5), (0, 0, 10))] == [True, True, False, False, True]
    assert sdf((0, 0, 5), *cylinder) == -5
    assert all(abs(sdf(p, 20.0, 4.0, 4.0, -1.0, 6.0)) < 1e-9 for p in ((20, 0, 0), (0, 4, 2), (16, 4, 5)))


def test_intake(spark):
    rows = [(0, "a.step", ""), (1001, "a.step", "ISO-10303-21;"), (5, "a.txt", "ISO-10303-21;"), (5, "a.step", "\x89PNG"), (5, "noext", "ISO-10303-21;"), (5, "A.STP", "  ISO-10303-21;"), (5, None, None)]
    frame = spark.createDataFrame(rows, "size long, name string, head string")
    codes = [r[0] for r in frame.select(intake.intake_code(F.col("size"), F.col("name"), F.col("head"), 1000)).collect()]
    assert codes[:6] == ["EMPTY_FILE", "FILE_TOO_LARGE", "UNSUPPORTED_EXTENSION", "NOT_STEP_CONTENT", "UNSUPPORTED_EXTENSION", None]


def test_units_entities_and_header(spark):
    texts = ["x SI_UNIT ( .MILLI. , .METRE. ) CONVERSION_BASED_UNIT('INCH'", "CONVERSION_BASED_UNIT ( 'INCH' , #1) SI_UNIT(.MILLI.,.METRE.)", "SI_UNIT($,.METRE.)", "none", None, ""]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.select(intake.detect_unit(F.col("t"))).collect()] == ["mm", "inch", "m", None, None, None]
    count = spark.range(1).select(intake.count_entities(F.lit("#1=NEXT_ASSEMBLY_USAGE_OCCURRENCE('a'); #2 = next_assembly_usage_occurrence ("), "NEXT_ASSEMBLY_USAGE_OCCURRENCE"))
    assert count.first()[0] == 2
    head = "FILE_NAME('n','t',('a'),('o'),'pre','SYS X','');FILE_SCHEMA(('AP214'));"
    assert tuple(spark.range(1).select(*intake.header_fields(F.lit(head)).values()).first()) == ("AP214", "SYS X")


def test_names_and_keys(spark):
    names = ["../../etc/passwd", "a b.step", "C:\\x\\Größe.STEP", "", "...", "n" * 200 + ".step"]
    out = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(intake.sanitize_filename(F.col("n"))).collect()]
    assert out[:5] == ["passwd", "a_b.step", "Groe.STEP", "unnamed", "unnamed"] and len(out[5]) == 128 and out[5].endswith(".step")
    bad = ["", "/a", "a/../b", "a//b", "a/", "./a", "a\\b", "a b", "..", "ok/x.json"]
    ok = [r[0] for r in spark.createDataFrame([(k,) for k in bad], "k string").select(intake.valid_storage_key(F.col("k"))).collect()]
    assert ok == [False] * 9 + [True]


def test_safe_names_of_every_page(spark):
    """Against plain Python, over the whole table."""
    import re
    import unicodedata
    from pathlib import PurePosixPath

    from facetlake.plans import catalogue

    def named(url):
        base = unicodedata.normalize("NFKD", PurePosixPath(url.replace("\\", "/")).name).encode("ascii", "ignore").decode()
        return re.sub(r"[^A-Za-z0-9._-]+", "_", base).strip("._") or "unnamed"

    pages = {r.page_id: r.url for r in catalogue.read(spark, "/root/testdata/sf0.001", "pages").select("page_id", "url").collect()}
    assert max(map(len, pages.values())) <= 128
    got = {r.page_id: r.name for r in catalogue.QUERIES["safe_names"](spark, "/root/testdata/sf0.001").collect()}
    assert got == {i: named(u) for i, u in pages.items()}
    odd = ["http://a.b/c/", "http://a.b/c/./", "a/.", "a/..", "/", ".", "x/Größe/", "日本"]
    out = [r[0] for r in spark.createDataFrame([(u,) for u in odd], "n string").select(intake.sanitize_filename(F.col("n"))).collect()]
    assert out == [named(u) for u in odd] == ["c", "c", "a", "unnamed", "unnamed", "unnamed", "Groe", "unnamed"]


def test_ids(spark):
    row = spark.range(1).select(sample_id(F.lit("a")), entity_id("F", F.lit(7)), entity_id("E", F.lit(1000)), quantize(F.lit(2.5), 1.0), quantize(F.lit(3.5), 1.0)).first()
    assert row[0].startswith("s_") and len(row[0]) == 26 and tuple(row)[1:] == ("F007", "E1000", 2, 4)
    assert config_hash() == config_hash() != config_hash({"other": 1})


def test_canonical_order_ignores_input_order(spark):
    rng = random.Random(2)
    rows = [("s", rng.randrange(5), rng.random(), i) for i in range(40)]
    keys = ["k", "x", "i"]
    orders = set()
    for _ in range(3):
        rng.shuffle(rows)
        frame = spark.createDataFrame(rows, "s string, k int, x double, i int")
        orders.add(tuple(r.i for r in canonical.canonical_order(frame, "s", [F.col(c) for c in keys]).orderBy("face_idx").collect()))
    assert len(orders) == 1


def test_unambiguous_match(spark):
    side = lambda s: spark.createDataFrame(list(enumerate(s)), "i long, f string")
    found = canonical.unambiguous_matches(side("abcc"), side("cbxa"), "f", "i", "i")
    assert {r.left_id: r.right_id for r in found.collect()} == {0: 3, 1: 1}


def test_eligibility_first_eligible_wins(spark):
    rows = [(1, "h", False, True), (2, "h", True, True), (3, "h", True, True), (4, "h", False, True), (5, "k", True, False), (6, "m", None, True)]
    frame = spark.createDataFrame(rows, "sample_id long, content string, truth boolean, complete boolean")
    found = dataset.eligibility(frame, F.lit(True), F.lit(True), F.col("truth"), F.col("complete"))
    assert [r.reason for r in found.orderBy("sample_id").collect()] == ["no_ground_truth", "ok", "exact_duplicate_of:2", "exact_duplicate_of:2", "missing_artifacts", "no_ground_truth"]


def test_dataset_id_repeats_and_follows_excluded(spark):
    rows = [(i, f"c{i}", f"f{i % 3}", f"f{i % 3}/{i % 7}", i % 2, "ok" if i % 5 else "no_ground_truth") for i in range(40)]
    frame = spark.createDataFrame(rows, "sample_id long, content string, family string, design_group string, label int, reason string")
    clusters = spark.createDataFrame([(1, 1), (2, 1)], "part long, cluster long")
    one, two = (dataset.build(f, clusters)["dataset"].first().dataset_id for f in (frame, frame.repartition(5)))
    other = dataset.build(frame.where("sample_id <> 5"), clusters)["dataset"].first().dataset_id
    assert one == two != other and one.startswith("ds_")


def test_state_machine(spark):
    allowed = jobs.transitions(spark)
    path = ["received", "validated", "queued", "parsing", "normalizing", "extracting", "validating_outputs", "completed"]
    bad = ["received", "completed", "queued", "rejected", "parsing", "parsing"]
    rows = [("good", i, s) for i, s in enumerate(path)] + [("bad", i, s) for i, s in enumerate(bad)]
    events = spark.createDataFrame(rows, "job string, at int, state string")
    assert {r.at for r in jobs.illegal_moves(events, "job", ["at"], "state", allowed).where("job = 'good'").collect()} == set()
    assert {r.at for r in jobs.illegal_moves(events, "job", ["at"], "state", allowed).collect()} == {1, 2, 4, 5}


def test_fold_ignores_a_worker_that_lost_its_job(spark):
    rows = [("j", 1, 10, "parsing", 1, "w1"), ("j", 2, 20, "failed_retryable", 1, "reaper"), ("j", 3, 30, "parsing", 2, "w2"), ("j", 4, 35, "completed", 1, "w1"), ("j", 5, 40, "extracting", 2, "w2")]
    folded = jobs.fold(spark.createDataFrame(rows, "job_id string, event_id long, created_at long, state string, attempt int, worker_id string")).first()
    assert (folded.state, folded.attempts, folded.worker_id) == ("extracting", 2, "w2")


def test_graph_golden(spark):
    fe = spark.createDataFrame([("s", 0, 0), ("s", 1, 0), ("s", 1, 1), ("s", 2, 1), ("s", 2, 2)], "sample_id string, face_idx int, edge_idx int")
    edges = spark.createDataFrame([("s", 0, 2.0, "convex", 90.0, "line"), ("s", 1, 3.0, "concave", 0.0, "circle"), ("s", 2, 5.0, "seam", None, "line")], "sample_id string, edge_idx int, length_mm double, convexity string, dihedral_angle_deg double, curve_type string")
    pairs = graph.pair_features(graph.adjacent_pairs(fe), edges, fe)
    rows = {(r.src, r.dst): r for r in pairs.collect()}
    assert set(rows) == {(0, 1), (1, 0), (1, 2), (2, 1)}
    assert rows[0, 1].angle == 0.5 and rows[1, 2].angle == 1.0 and rows[1, 0].shared_fraction == 0.4
    faces = spark.createDataFrame([("s", i) for i in range(3)], "sample_id string, face_idx int")
    assert all(graph.invariants(faces, pairs, faces.withColumn("x", F.lit(1.0)), fe).drop("sample_id").first())
    broken = graph.invariants(faces, pairs.where("src <> 0"), faces.withColumn("x", F.lit(float("nan"))), fe).first()
    assert not broken.symmetric and not broken.same_as_topology and not broken.finite


@pytest.mark.parametrize(("hole", "kind", "faces"), [(None, None, 0), ("through", "through_hole", 1), ("blind", "blind_hole", 2), ("cone", "blind_hole", 2), ("counterbore", "through_hole", 3)])
def test_recognizer_golden(spark, hole, kind, faces):
    part = analytic.box_part("p", lz=15, hole=hole, r=3, depth=5)
    f, e = analytic.tables(spark, [part])
    found = recognize.recognize(f, e).collect()
    special = [r for r in found if r.feature_type != "planar_face"]
    assert sum(r.feature_type == "planar_face" for r in found) == 6
    if hole is None:
        assert special == []
        return
    assert [(r.feature_type, len(r.face_indices), r.confidence) for r in special] == [(kind, faces, 0.95)]
    assert special[0].parameters["diameter_mm"] == 6
    if hole == "counterbore":
        assert special[0].parameters["length_mm"] == 15
    labels = recognize.face_labels(recognize.recognize(f, e), f)
    assert sum(r.label == "hole" for r in labels.collect()) == faces


def test_boss_is_no_hole(spark):
    part = analytic.Builder("boss")
    top = part.box(20, 20, 5)["+z"]
    i = part.face("cylinder", 60, (10, 10, 7), (7, 7, 5), (13, 13, 9), uv=(0, 6.283185307, 0, 4), curvature=0.17, radius=3.0, axis=(0, 0, 1), axis_origin=(10, 10, 5))
    cap = part.face("plane", 28, (10, 10, 9), (7, 7, 9), (13, 13, 9), (0, 0, 1))
    part.rim(i, top, 10, 10, 5, 3, "concave")
    part.rim(i, cap, 10, 10, 9, 3, "convex")
    kinds = {f["type"] for f in recognize.recognize_part(part.faces, part.edges)}
    assert kinds == {"planar_face", "unknown"}


def test_observations_and_schema(spark):
    f, e = analytic.tables(spark, [analytic.box_part("p", hole="through")])
    assert f.schema == FACES and e.schema == EDGES and all(c.metadata for c in FACES)
    bore = recognize.observe(f).where("surface_type = 'cylinder'").first()
    assert (bore.radius_mm, bore.concave, bore.material_side, bore.span_deg) == (4.0, True, "outside", 360.0)


def test_views_and_mesh(spark):
    from facetlake.plans.catalogue import box_mesh

    mesh = box_mesh(spark)
    scalars = {r.sample_id: r for r in cloud.mesh_scalars(mesh).collect()}
    assert abs(abs(scalars["box-2"].volume_mm3) - 8) < 1e-9 and abs(scalars["box-2"].surface_area_mm2 - 24) < 1e-9
    pixels = raster.view_pixels(mesh, resolution=48)
    assert pixels.select("face_idx").distinct().count() == 6
    worst = pixels.agg(F.max(F.abs(F.sqrt(F.col("nx") ** 2 + F.col("ny") ** 2 + F.col("nz") ** 2) - 1))).first()[0]
    assert worst < 1e-9
    assert cloud.boundary_segments(mesh.select("sample_id", "face_idx", *[F.to_json(c).alias(n) for c, n in (("a", "i0"), ("b", "i1"), ("c", "i2"))])).count() == 3 * 6 * 4


def test_metrics_small(spark):
    left, right = (spark.createDataFrame([("k", x) for x in s], "k string, i string") for s in ("aab", "abc"))
    assert metrics.multiset_jaccard(left, right, ["k"], "i").first().jaccard == 0.5
    w = {r.label: r.weight for r in metrics.class_weights(spark.createDataFrame([(0,), (0,), (0,), (0,), (1,)], "y int"), "y", [0, 1, 2]).collect()}
    assert w == {0: 0.666667, 1: 1.333333, 2: 0.0}
    found = metrics.match_features(spark.createDataFrame([("s", "true", "hole", 0, 5.0), ("s", "true", "hole", 1, 5.01), ("s", "predicted", "hole", 0, 5.0), ("s", "predicted", "slot", 1, None)], "sample_id string, side string, feature_type string, place long, size double"))
    assert sorted((r.feature_type, r.tp, r.fp, r.fn) for r in metrics.feature_scores(found).collect()) == [("hole", 1, 0, 1), ("slot", 0, 1, 0)]
    runs = spark.createDataFrame([("r", 0, 0.5), ("r", 1, 0.9), ("r", 2, 0.9)], "run_id string, epoch int, val_macro_f1 double")
    assert metrics.best_epoch(runs).first().best_epoch == 1


def test_convexity(spark):
    kind, angle = canonical.convexity(F.lit(False), F.lit(False), F.lit(2), v.vec(1, 0, 0), v.vec(0, 1, 0), v.vec(0, 0, -1))
    assert tuple(spark.range(1).select(kind, angle).first()) == ("concave", 270.0)


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a.STEP", "b.stp", "c.txt", "sub/d.step"):
        (tmp_path / name).write_text("ISO-10303-21;")
    assert [r.path.rsplit("/", 1)[1] for r in step_files(spark, str(tmp_path)).collect()] == ["a.STEP", "b.stp"]
    with pytest.raises(NotImplementedError):
        NoKernel().parse(spark.range(1))
    path, gone = str(tmp_path / "t"), str(tmp_path / "gone")
    row = lambda k, x: spark.createDataFrame([(k, x)], "id string, x int")
    assert write_once(row("a", 1), path, "id").count() == 1 and write_once(row("a", 2), path, "id").count() == 0
    replace_samples(row("a", 3), path, gone, "id")
    assert [r.x for r in spark.read.parquet(path).collect()] == [3] and [r.x for r in spark.read.parquet(gone).collect()] == [1]
    write_failures(spark.createDataFrame([("EMPTY_FILE",), ("CHILD_CRASHED",)], "code string"), str(tmp_path / "f"), str(tmp_path / "q"))
    assert spark.read.parquet(str(tmp_path / "q")).first().code == "CHILD_CRASHED"
    assert not [p.name for p in tmp_path.iterdir() if ".new-" in p.name or ".old-" in p.name]


def test_streams_match_batches(spark, tmp_path):
    from facetlake.streaming import events as stream

    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    live = stream.event_stream(spark, str(tmp_path / "in"))
    q = stream.windowed_counts(live).writeStream.outputMode("complete").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    batch = stream.windowed_counts(rows.withColumn("at", F.col("ts").cast("timestamp"))).select("start", "event_type", "n")
    assert spark.table("windows").select("start", "event_type", "n").exceptAll(batch).count() == 0 and spark.table("windows").count() == batch.count()
    q = stream.distinct_submissions(live, ["user_id"]).writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "ck2")).start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("firsts").count() == rows.select("user_id").distinct().count()


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["sample_id", "content", "family", "design_group", "label", "split"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_output_checks(spark):
    from facetlake.operators import validate
    from facetlake.plans.catalogue import box_mesh

    mesh = box_mesh(spark).where("sample_id = 'box-2'")
    faces = spark.createDataFrame([("box-2", i, 4.0) for i in range(6)], "sample_id string, face_idx int, area_mm2 double")
    corner = lambda x: F.struct(F.lit(x).alias("x"), F.lit(x).alias("y"), F.lit(x).alias("z"))
    boxed = faces.withColumns({"bbox_min_mm": corner(0.0), "bbox_max_mm": corner(2.0)})
    pixels = spark.createDataFrame([("box-2", 0, 1, 1, 0), ("box-2", 0, 1, 2, 5)], "sample_id string, view int, row int, col int, face_idx int").withColumn("p", corner(1.0))
    features = spark.createDataFrame([("box-2", [0, 1, 2]), ("box-2", [3, 4, 5])], "sample_id string, face_indices array<int>")
    good = [validate.mesh_checks(mesh, faces), validate.view_checks(pixels, boxed), validate.feature_coverage(features, faces)]
    assert tuple(validate.verdict(*good).first()) == ("box-2", [], None)
    bad = [validate.mesh_checks(mesh.where("face_idx < 5"), faces), validate.view_checks(pixels.withColumn("p", corner(9.0)), boxed), validate.feature_coverage(features.limit(1), faces)]
    row = validate.verdict(*bad).first()
    assert row.code == "OUTPUT_INVARIANT_VIOLATION" and set(row.failed) == {"every_face_triangulated", "mesh_area_close", "pixels_near_face", "every_face_assigned"}


def test_shape_decisions_and_fixtures(spark):
    from facetlake.operators import validate

    rows = [(2, True, True, None, None, None), (0, True, True, None, None, None), (1, False, False, None, None, None), (1, True, True, None, None, None), (1, True, False, False, None, None), (1, True, False, True, 0.2, 0.0), (1, True, False, True, 0.01, 1e-4)]
    frame = spark.createDataFrame(rows, "solids int, closed boolean, valid boolean, repaired boolean, dev double, dv double")
    codes = [r[0] for r in frame.select(validate.shape_code(*map(F.col, frame.columns))).collect()]
    assert codes == ["MULTI_BODY", "NO_SOLID", "NO_SOLID", None, "INVALID_GEOMETRY", "REPAIR_DEVIATION_EXCEEDED", None]
    found = analytic.failure_fixtures(spark)
    code = analytic.fixture_code(F.col("filename") == "copy_of_part.step")
    assert found.count() == 12 and [r.filename for r in found.where(~code.eqNullSafe(F.col("code"))).collect()] == []


def part_outputs(spark):
    """All outputs of two analytic boxes, made by the operators."""
    from facetlake.plans.catalogue import box_mesh

    mesh = box_mesh(spark).where("sample_id <> 'box-3'")
    ids = F.substring("sample_id", 5, 1).cast("double")
    faces = mesh.groupBy("sample_id", "face_idx").agg(*[F.struct(*[f(F.least(F.col(f"a.{k}"), F.col(f"b.{k}"), F.col(f"c.{k}")) if f is F.min else F.greatest(F.col(f"a.{k}"), F.col(f"b.{k}"), F.col(f"c.{k}"))).alias(k) for k in "xyz"]).alias(n) for f, n in ((F.min, "bbox_min_mm"), (F.max, "bbox_max_mm"))]).withColumn("area_mm2", ids * ids)
    pairs = faces.select("sample_id", F.col("face_idx").alias("src")).join(faces.select("sample_id", F.col("face_idx").alias("dst")), "sample_id").where("shiftright(src, 1) <> shiftright(dst, 1)")
    face_edge = pairs.select("sample_id", F.col("src").alias("face_idx"), (F.least("src", "dst") * 10 + F.greatest("src", "dst")).alias("edge_idx")).distinct()
    points = cloud.sample_points(mesh, faces.select("sample_id", "face_idx", F.lit(9).alias("n"))).withColumn("projection_ratio", F.lit(0.0))
    features = faces.groupBy("sample_id").agg(F.collect_list("face_idx").alias("face_indices"))
    pixels = raster.view_pixels(mesh, resolution=24).join(faces.select("sample_id", "face_idx", F.col("bbox_min_mm").alias("p")), ["sample_id", "face_idx"])
    return {"faces": faces, "face_edge": face_edge, "graph": {"pairs": pairs, "nodes": faces.select("sample_id", "face_idx", F.lit(1.0).alias("x"))}, "points": points, "triangles": mesh, "pixels": pixels, "features": features, "reread": pairs}


def test_all_output_checks(spark):
    from facetlake.operators import validate

    good = part_outputs(spark)
    assert [(r.failed, r.code) for r in validate.output_checks(**good).collect()] == [([], None)] * 2
    bad = {
        "points": (good["points"].where("face_idx <> 2"), {"every_face_sampled"}),
        "reread": (good["reread"].where("src <> 1"), {"graph_round_trip"}),
        "triangles": (good["triangles"].where("face_idx <> 5"), {"every_face_triangulated", "mesh_area_close"}),
        "features": (good["features"].withColumn("face_indices", F.array(F.lit(1))), {"every_face_assigned"}),
        "face_edge": (good["face_edge"].where("face_idx <> 0"), {"same_as_topology"}),
    }
    for name, (frame, failed) in bad.items():
        rows = validate.output_checks(**(good | {name: frame})).collect()
        assert all(set(r.failed) == failed and r.code == "OUTPUT_INVARIANT_VIOLATION" for r in rows), name
    assert all(r.failed == ["on_surface"] for r in validate.output_checks(**(good | {"points": good["points"].drop("projection_ratio")})).collect())


def test_fingerprints_do_not_depend_on_place_or_order(spark):
    """Over the typed tables themselves: a moved and reordered part has the same fingerprints and, moved back, the same order."""
    f, e = analytic.tables(spark, [analytic.box_part("s", hole="cone"), analytic.slot_part("t")])
    prints = canonical.face_fingerprints(f, canonical.neighbour_types(f))
    assert prints.where("fingerprint is null").count() == 0 and prints.columns == f.columns
    moved = f.withColumns({"centroid_mm": F.struct((F.col("centroid_mm.x") + 5).alias("x"), "centroid_mm.y", "centroid_mm.z"), "traversal_index": 100 - F.col("traversal_index")}).orderBy(F.rand(3))
    own = lambda d: sorted((r.sample_id, r.face_idx, r.fingerprint) for r in canonical.face_fingerprints(d, canonical.neighbour_types(d)).collect())
    assert own(f) == own(moved)
    cone = {r.surface_type: r.fingerprint for r in prints.where("sample_id = 's'").collect()}
    other = f.withColumn("analytic_params", F.col("analytic_params").withField("semi_angle_rad", F.lit(0.5)))
    assert {r.surface_type: r.fingerprint for r in canonical.face_fingerprints(other, canonical.neighbour_types(other)).where("sample_id = 's'").collect()}["cone"] != cone["cone"]
    ends = prints.groupBy("sample_id").agg(F.map_from_entries(F.collect_list(F.struct("face_idx", "fingerprint"))).alias("prints"))
    edges = e.join(ends, "sample_id").withColumn("fingerprint", canonical.edge_fingerprint(F.col("curve_type"), F.col("length_mm"), F.col("convexity"), F.transform("adjacent", lambda i: F.col("prints")[i]))).drop("edge_idx")
    turned = edges.withColumns({"start_mm": F.col("end_mm"), "end_mm": F.col("start_mm")}).orderBy(F.rand(5))
    first = [{(r.sample_id, r.edge_idx): r.traversal_index for r in canonical.canonical_order(d, "sample_id", canonical.edge_keys(), "edge_idx").collect()} for d in (edges, turned)]
    assert first[0] == first[1] and len(first[0]) == e.count()
    order = [r.curve_type for r in canonical.canonical_order(edges, "sample_id", canonical.edge_keys(), "edge_idx").where("sample_id = 't'").orderBy("edge_idx").collect()]
    assert order == sorted(order, key=["line", "circle"].index)


def test_slots_pockets_and_fillets(spark):
    f, e = analytic.tables(spark, [analytic.slot_part("slot", r=2.5, length=20), analytic.pocket_part("pocket", depth=4), analytic.fillet_part("fillet", r=2)])
    found = {r.sample_id: r for r in recognize.recognize(f, e).where("feature_type not in ('planar_face', 'unknown')").collect()}
    assert {k: (r.feature_type, len(r.face_indices), r.confidence) for k, r in found.items()} == {"slot": ("slot", 4, 0.95), "pocket": ("pocket", 5, 0.95), "fillet": ("fillet", 1, 0.95)}
    assert found["slot"].parameters == {"width_mm": 5.0, "length_mm": 20.0} and found["pocket"].parameters == {"depth_mm": 4.0} and found["fillet"].parameters == {"radius_mm": 2.0}


def test_small_rules(spark):
    one = spark.range(1)
    value = lambda c: one.select(c).first()[0]
    code = lambda *n: value(intake.structure_code(*map(F.lit, n)))
    assert [code(0, 1, 1, 1, 6, 0), code(1, 2, 1, 2, 6, 0), code(1, 1, 0, 1, 6, 0), code(1, 1, 1, 2, 6, 0), code(1, 1, 1, 1, 0, 0), code(1, 1, 1, 1, 6, 1), code(1, 1, 1, 1, 6, 0)] == ["STEP_NO_SHAPES", "UNSUPPORTED_ASSEMBLY", "STEP_NO_SHAPES", "MULTI_BODY", "STEP_NO_SHAPES", "UNSUPPORTED_TESSELLATED", None]
    assert value(intake.degenerate_code(F.lit(0.0), F.lit(3.0))) == "DEGENERATE_GEOMETRY" and value(intake.degenerate_code(F.lit(1.0), F.lit(3.0))) is None
    x, near, y = v.vec(1.0, 0.0, 0.0), v.vec(1.0, 0.01, 0.0), v.vec(0.0, 2.0, 0.0)
    assert value(v.parallel(x, near)) and not value(v.parallel(x, y)) and value(v.perpendicular(near, y)) is True and not value(v.perpendicular(x, near))
    pair = lambda *p: spark.createDataFrame(p, "a string, b string")
    assert tuple(metrics.pair_scores(pair(("x", "y"), ("y", "x"), ("u", "w")), pair(("y", "x"), ("p", "q"))).first()) == (1, 1, 1, 0.5, 0.5)
    runs = spark.createDataFrame([("m", 1.0), ("m", 3.0)], "model string, f double")
    assert tuple(metrics.seed_summary(runs, "model", ["f"]).first()) == ("m", 2.0, 1.0)
    done = spark.createDataFrame([("completed",), ("completed",), ("rejected",), ("parsing",)], "state string")
    assert {r.state: (r.n, r.per_minute) for r in jobs.outcome_counts(done, 120.0).collect()} == {"completed": (2, 1.0), "rejected": (1, 0.5)}
    first = spark.createDataFrame([("p", "a", 5, 1), ("p", "a", 3, 2), ("p", "b", 4, 3), ("q", "a", 1, 4)], "kind string, idempotency_key string, submitted_at long, job_id long")
    there = spark.createDataFrame([("q", "a")], "kind string, idempotency_key string")
    assert sorted(r.job_id for r in jobs.submit(there, first).collect()) == [2, 3]
    events = spark.createDataFrame([("j", "queued", 1), ("j", "parsing", 3), ("j", "completed", 8), ("k", "queued", 1)], "job string, state string, at long").withColumn("at", F.timestamp_seconds("at"))
    assert [tuple(r) for r in jobs.latencies(events, "job", "at", "state").collect()] == [("j", 5.0)]
    exports = spark.createDataFrame([("p", 1, 10.0, 4.0, [1.0, 2.0, 3.0], 6), ("p", 2, 12.0, 4.0, [1.5, 2.0, 3.0], 7)], "part string, export int, volume double, area double, dims array<double>, n_faces int")
    row = metrics.export_consistency(exports).first()
    assert abs(row.volume_spread - 2 / 11) < 1e-12 and row.area_spread == 0 and row.box_difference == 0.5 and row.face_counts == 2


def test_header_values(spark):
    cases = {"file_schema ( ( '  AP242 ' ) );": ("AP242", None), "FILE_SCHEMA(('" + "x" * 300 + "'));": ("x" * 200, None), "FILE_SCHEMA((''));FILE_NAME('a','b',('c'),('d'),'e','','');": (None, None), "FILE_NAME('a');": (None, None), "": (None, None)}
    rows = spark.createDataFrame([(k,) for k in cases], "h string").select("h", *(c.alias(k) for k, c in intake.header_fields(F.col("h")).items())).collect()
    assert {r.h: tuple(r)[1:] for r in rows} == cases
    texts = ["a\u0001bSI_UNIT($,.METRE.)", "si_unit ( .milli. , .metre. )", "#1=( LENGTH_UNIT() NAMED_UNIT(*) SI_UNIT(.MILLI.,.METRE.) );"]
    assert [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(intake.detect_unit(F.col("t"))).collect()] == ["m", "mm", "mm"]
    long = [("n" * 140 + ".abcdefgh", ".abcdefgh"), ("n" * 140 + ".abcdefghi", "n" * 8)]
    out = [r[0] for r in spark.createDataFrame([(n,) for n, _ in long], "n string").select(intake.sanitize_filename(F.col("n"))).collect()]
    assert all(len(o) == 128 and o.endswith(e) for o, (_, e) in zip(out, long, strict=True))


def test_global_extents_descend(spark):
    faces = spark.createDataFrame([("s", "plane"), ("s", "bezier")], "sample_id string, surface_type string")
    parts = spark.createDataFrame([("s", 8.0, 20.0)], "sample_id string, volume_mm3 double, surface_area_mm2 double").withColumn("dims", v.vec(2.0, 6.0, 3.0))
    row = graph.global_features(faces, spark.createDataFrame([("s",)], "sample_id string"), parts).first()
    assert [round(row[f"dim_{i}"], 4) for i in range(3)] == [round(x / 7, 4) for x in (6, 3, 2)] and row.share_plane == row.share_freeform == 0.5


def test_tables_of_files(spark, tmp_path):
    import json

    from facetlake.sources import files

    for name, text in {"parts/b.STEP": "ISO-10303-21;b", "parts/a.stp": "ISO-10303-21;a", "parts/x.txt": "x", "failures/empty.step": "", "failures/expected.json": "{}", "failures/_good.step": "ISO-10303-21;"}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    found = {r.filename: r.code for r in files.discover(spark, str(tmp_path)).collect()}
    assert found == {"a.stp": None, "b.STEP": None, "empty.step": "EMPTY_FILE"}
    for k, sha, seed in (("a", "s1", 1), ("b", "s1", 2), ("c", "s2", 3)):
        (tmp_path / "parts" / f"{k}.gt.json").write_text(json.dumps({"source_sha256": sha, "family": k, "seed": seed}, indent=1))
    from facetlake.schemas import GROUND_TRUTH

    assert {(r.source_sha256, r.family, r.seed) for r in files.ground_truth(spark, str(tmp_path), GROUND_TRUTH).collect()} == {("s1", "b", 2), ("s2", "c", 3)}
    for k in ("s_2", "s_1"):
        (tmp_path / "samples" / k).mkdir(parents=True)
        (tmp_path / "samples" / k / "manifest.json").write_text(json.dumps({"sample_id": k, "status": "completed"}, indent=1))
    rows = files.manifests(spark, str(tmp_path), spark.createDataFrame([], "sample_id string, status string").schema)
    assert [r.sample_id for r in rows.collect()] == ["s_1", "s_2"] and files.manifest(rows, "s_2").count() == 1 and files.manifest(rows, "none").count() == 0


def test_dataset_and_report_sinks(spark, tmp_path):
    from facetlake.sources import sinks

    rows = spark.createDataFrame([(i, f"c{i}", "f", f"f/{i % 4}", i % 2, "ok" if i < 8 else "status") for i in range(9)], "sample_id long, content string, family string, design_group string, label int, reason string")
    none = spark.createDataFrame([], "part long, cluster long")
    stored = [sinks.write_dataset(dataset.build(rows, none, 3), str(tmp_path)) for _ in range(2)]
    files = sorted(str(p) for p in tmp_path.rglob("*.parquet"))
    assert stored[0]["dataset"].first() == stored[1]["dataset"].first() and stored[0]["samples"].count() == 8 and stored[1]["excluded"].count() == 1
    sinks.write_dataset(dataset.build(rows, none, 3), str(tmp_path))
    assert files == sorted(str(p) for p in tmp_path.rglob("*.parquet"))
    report = sinks.corpus_report(spark.createDataFrame([("b", "1", "completed"), ("a", "1", "completed"), ("c", "2", "rejected")], "file string, sha256 string, status string"))
    assert {r.file: r.duplicate_of for r in report.collect()} == {"a": None, "b": "a", "c": None}
    assert {r.name: r.n for r in sinks.corpus_summary(report).collect()} == {"files": 3, "duplicates": 1, "completed": 2, "rejected": 1}
    faces = spark.createDataFrame([("s", 0, "hole", 0.123456), ("s", 1, "slot", 1.0)], "sample_id string, face_idx int, predicted string, confidence double")
    truth = spark.createDataFrame([("s", 0, "hole")], "sample_id string, face_idx int, label string")
    sinks.write_training(str(tmp_path), "r1", faces.limit(1), sinks.prediction_rows(faces, truth), faces.limit(1))
    assert sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/training/r1/predictions").collect()) == [("s", 0, "hole", "hole", 0.1235), ("s", 1, None, "slot", 1.0)]


def test_scratch_tables_need_a_shared_folder_on_clusters(spark):
    from types import SimpleNamespace

    from facetlake.functions.storage import shared_root

    for master, fails in (("spark://host:7077", True), ("yarn", True), ("local-cluster[2,1,1024]", True), ("local[4]", False), ("local", False)):
        fake = SimpleNamespace(sparkContext=SimpleNamespace(master=master, getConf=dict), conf=spark.conf)
        spark.conf.unset("spark.facetlake.scratch")
        if fails:
            with pytest.raises(ValueError, match="checkpoint"):
                shared_root(fake)
        else:
            assert shared_root(fake)


def test_arcs_are_told_apart_by_unordered_ends(spark):
    """Adjacent faces come once each way; one-way arcs, repeats, loops, missing and surplus arcs are found in one grouping."""
    rows = spark.createDataFrame([("p", f, e) for f, e in ((0, 0), (1, 0), (2, 1), (1, 1), (0, 2), (1, 2), (1, 2), (None, 0), (3, 3))], "sample_id string, face_idx int, edge_idx int")
    assert sorted((r.src, r.dst) for r in graph.adjacent_faces(rows).collect()) == [(0, 1), (1, 0), (1, 2), (2, 1)]
    assert {(r.src, r.dst, r.edge_idx) for r in graph.adjacent_pairs(rows, half=True).collect()} == {(0, 1, 0), (0, 1, 2), (1, 2, 1)}
    arcs = lambda *x: spark.createDataFrame([("p", *a) for a in x], "sample_id string, src int, dst int")
    assert [(r.low, r.high) for r in graph.one_way(arcs((1, 0), (0, 1), (1, 0), (2, 1), (3, 3))).collect()] == [(1, 2)]
    faces, nodes = spark.createDataFrame([("p", i) for i in range(3)], "sample_id string, face_idx int"), spark.createDataFrame([("p", i, 1.0) for i in range(3)], "sample_id string, face_idx int, x double")
    of = lambda a: graph.invariants(faces, a, nodes, rows).select("ends_in_range", "no_loops", "symmetric", "same_as_topology").first()
    whole = ((0, 1), (1, 0), (1, 2), (2, 1))
    assert tuple(of(arcs(*whole))) == (True, True, True, True)
    assert tuple(of(arcs(*whole[:3]))) == (True, True, False, False)
    assert tuple(of(arcs(*whole, (1, 0)))) == (True, True, False, True)
    assert tuple(of(arcs(*whole, (1, 1)))) == (True, False, True, False)
    assert tuple(of(arcs(*whole, (0, 2), (2, 0)))) == (True, True, True, False)
    edges = spark.createDataFrame([("p", e, float(e + 1), "convex", 90.0, "line") for e in range(4)], "sample_id string, edge_idx int, length_mm double, convexity string, dihedral_angle_deg double, curve_type string")
    both = graph.pair_features(graph.adjacent_pairs(rows), edges, rows)
    half = graph.pair_features(graph.adjacent_pairs(rows, half=True), edges, rows, half=True)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, half.select(*both.columns).collect())) and half.count() == 4
    assert graph.adjacent_faces(rows)._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression") == 1


def test_boxes_of_triangles_are_drawn_together(spark):
    """In blocks of any size the buffers are those of one triangle after another; of equal depths the first wins."""
    rng = np.random.default_rng(4)
    corners = rng.normal(0, 1, (60, 3, 3))
    corners[20] = corners[7]
    cam = raster.camera(1, np.zeros(3), 1.5)
    owner, depth = raster.rasterize(corners, cam, 48)
    for most in (1, 700):
        again = raster.rasterize(corners, cam, 48, most=most)
        assert (again[0] == owner).all() and (again[1] == depth).all()
    want, far = np.full((48, 48), -1), np.full((48, 48), np.inf)
    for t in range(60):
        own, d = raster.rasterize(corners[t : t + 1], cam, 48)
        nearer = (own >= 0) & (d < far)
        want[nearer], far[nearer] = t, d[nearer]
    assert (want == owner).all() and (far == depth).all() and 20 not in owner


def test_components_send_no_table_through_the_driver(spark):
    """However small the minima are, no join of the rounds broadcasts them."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)], "a long, b long")
    found = connected_components(edges)
    assert {r.component for r in found.collect()} == {0}
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
