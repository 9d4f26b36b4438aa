"""Table functions, the row-group source, lease timers, variants, boundary points, stage figures, gradient rounds."""

import datetime
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetlake.functions import variants
from facetlake.functions.observed import Stages
from facetlake.functions.prefix import running_total
from facetlake.functions.storage import materialize
from facetlake.operators import cloud, training
from facetlake.sources import part21, rowgroups
from facetlake.sources.files import exactly
from facetlake.streaming import leases


def test_exchange_files_as_rows(spark):
    text = "HEADER;\n#1 = POINT('a;#7 ''b''',(0.,1.));\n/* #2=NO(); */#3=line(#1,\n #4);#5=(A()B(#3));#6 = BROKEN('x;\n#7=LAST();"
    rows = spark.createDataFrame([("f", text), ("null", None), ("none", ""), ("odd", "'/* #1=A(); */' #2=B(#1);")], "file string, text string")
    got = [(r.file, r.position, r.id, r.name, r.arguments, r.refers) for r in part21.references(part21.instances(rows, "text")).orderBy("file", "position").collect()]
    assert got == [("f", 1, 1, "POINT", "'a;#7 ''b''',(0.,1.)", []), ("f", 2, 3, "LINE", "#1,\n #4", [1, 4]), ("f", 3, 5, None, "A()B(#3)", [3]), ("f", 4, 7, "LAST", "", []), ("odd", 1, 1, "A", "", []), ("odd", 2, 2, "B", "#1", [1])]
    pages = spark.createDataFrame([(1, "<P class='a>b'>x < y<br/></p>"), (2, None)], "page long, html string")
    assert [(r.page, r.position, r.closing, r.name, r.arguments) for r in part21.tags(pages, "html").orderBy("position").collect()] == [(1, 1, False, "p", " class='a>b'"), (1, 2, False, "br", "/"), (1, 3, True, "p", "")]


def test_exchange_files_take_linear_time(spark):
    import time

    for text in ("#1=A(" + "'" * 400_001, "#1" * 200_000, "#1=A((((" + "(" * 400_000, "<a " * 150_000, "<a b='" * 80_000):
        began = time.process_time()
        sum(1 for _ in part21.Instances.func().eval(text)), sum(1 for _ in part21.Tags.func().eval(text))
        assert time.process_time() - began < 3, text[:10]


def test_row_groups_are_skipped(spark, tmp_path):
    rows = spark.range(10_000).selectExpr("id", "id % 7 AS k", "CAST(id AS STRING) AS s", "CASE WHEN id >= 5000 THEN id END AS late", "array(id, id) AS pair", "CAST(timestamp_seconds(id) AS TIMESTAMP_NTZ) AS at").coalesce(1)
    path = str(tmp_path / "t")
    rows.write.option("parquet.block.size", 8192).option("parquet.page.size", 1024).option("parquet.block.size.row.check.min", 100).parquet(path)
    table = rowgroups.read(spark, path)
    reader = rowgroups.Reader(path, rowgroups.RowGroups({"path": path}).schema())
    groups = len(reader.partitions())
    assert groups > 5
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, IsNotNull, LessThan, StringContains

    every, counts = GreaterThanOrEqual((rowgroups.NUMBER,), 0), {}
    for name, filters in {"range": [GreaterThanOrEqual(("id",), 9000)], "both": [GreaterThanOrEqual(("id",), 4000), LessThan(("id",), 4100)], "one": [EqualTo(("id",), 17)], "some": [In(("id",), (3, 9999))], "never": [EqualTo(("id",), -1)], "not null": [IsNotNull(("late",))], "unknown": [StringContains(("s",), "9")], "wrong type": [EqualTo(("id",), "x")]}.items():
        left = list(reader.pushFilters([every, *filters]))
        assert left == [every, *filters]  # Spark applies them to the rows
        counts[name] = len(reader.partitions())
        list(reader.pushFilters(filters))
        assert len(reader.partitions()) == groups  # a plan that does not come from ``read`` skips nothing
    assert counts["range"] < groups / 4 and counts["both"] <= 2 and counts["one"] == 1 and counts["some"] == 2 and counts["never"] == 0 and counts["not null"] < groups and counts["unknown"] == counts["wrong type"] == groups
    assert dict(table.drop(rowgroups.NUMBER).dtypes) == dict(rows.dtypes)
    few = table.where("id >= 9990")
    assert sorted(tuple(r)[:-1] for r in few.where("k = 3").collect()) == sorted(tuple(r) for r in rows.where("id >= 9990 AND k = 3").collect())
    assert few.rdd.getNumPartitions() < groups == table.rdd.getNumPartitions()
    assert table.where("id < 0").collect() == [] and few.count() == 10 and table.count() == 10_000  # one frame, several plans
    assert few.alias("a").join(table.where("id < 9995").alias("b"), "id").count() == 5
    with pytest.raises(Exception, match="FileNotFound|no data files"):
        rowgroups.read(spark, str(tmp_path / "missing")).count()


def test_lease_timers_are_the_batch_reaper(spark, tmp_path):
    """Files that arrive one a batch, out of order within the allowed delay; the last files only move the watermark; one event comes too late."""
    rng = random.Random(3)
    base = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    events = [(rng.randrange(6), i, base + datetime.timedelta(seconds=i * 40 + rng.randrange(-900, 900)), rng.choice(["parsing", "extracting", "completed", "queued"]), rng.randrange(1, 5)) for i in range(300)]
    events += [(1, 900, events[10][2], "parsing", 1), (1, 901, events[10][2], "parsing", 1)]  # ties
    schema = "job_id long, event_id long, at timestamp, state string, attempt int"
    at = str(tmp_path / "in")
    for n in range(0, len(events), 60):
        spark.createDataFrame(events[n : n + 60], schema).coalesce(1).write.mode("append").parquet(at)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")

    def run():
        live = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(at)
        q = leases.reaped(live, lease_seconds=300, late="1 hour").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start()
        q.awaitTermination()
        return {tuple(r) for r in spark.read.schema(leases.REAPED).parquet(str(tmp_path / "out")).collect()}

    def batch(rows):
        wall = max(e[2] for e in rows).timestamp() * 1000 // 1 - 3_600_000
        return {tuple(r) for r in leases.reaped_by(spark.createDataFrame(rows, schema), F.lit(int(wall)), lease_seconds=300).collect()}

    try:
        first = run()
        assert first == batch(events) and len(first) > 20 and {r[5] for r in first} == {"queued", "failed_terminal"}
        more = [(7, 1000, base + datetime.timedelta(days=1), "parsing", 1)]
        spark.createDataFrame([*more, (2, 1001, base, "parsing", 1)], schema).coalesce(1).write.mode("append").parquet(at)
        assert run() == batch([*events, *more])  # what is before the watermark changes nothing
    finally:
        spark.conf.set(key, before)


def test_exactly_names_files_and_folders(spark, tmp_path):
    odd = tmp_path / "a{b}[c]"
    spark.range(3).coalesce(1).write.parquet(str(odd))
    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "a{b}[cc]"))
    file = next(str(p) for p in odd.iterdir() if p.name.startswith("part-"))
    assert spark.read.parquet(exactly(str(odd))).count() == 3 == spark.read.parquet(exactly(file)).count()


def test_variants(spark):
    texts = [(1, '{"b": 1, "a": {"y": [1, 2.50, null], "x": "é\\n"}}'), (2, '{"a":{"x":"é\\u000a","y":[1,2.5,null]},"b":1}'), (3, '{"a": '), (4, None), (5, '"text"'), (6, '{"b": "one"}'), (7, "")]
    rows = variants.parsed(spark.createDataFrame(texts, "id long, manifest string"), "manifest")
    got = {r.id: r for r in rows.select("id", *variants.fields({"b": ("$.b", "int"), "y": ("$.a.y[1]", "double"), "x": ("$.a.x", "string")}), variants.broken("manifest").alias("broken"), variants.canonical().alias("text"), variants.content_hash().alias("hash")).collect()}
    assert got[1].hash == got[2].hash and got[1].text == '{"a":{"x":"é\\n","y":[1,2.5,null]},"b":1}'
    assert (got[1].b, got[1].y, got[1].x) == (1, 2.5, "é\n")
    assert {i: r.broken for i, r in got.items()} == {1: False, 2: False, 3: True, 4: False, 5: False, 6: False, 7: True}
    assert got[6].b is None and got[4].text is None is got[3].hash and got[5].text == '"text"'


def test_running_totals_over_slices(spark):
    rows = [(k, i, (i * 7 + k) % 11) for k in range(3) for i in range(100 * k)]
    got = {(r.k, r.i): r.upto for r in running_total(spark.createDataFrame(rows, "k long, i long, v long"), ["k"], "i", "v", slice_rows=16).collect()}
    total, want = defaultdict(int), {}
    for k, i, v in rows:
        total[k] += v
        want[k, i] = total[k]
    assert got == want


def test_boundary_points_follow_length(spark):
    segments = spark.createDataFrame([("s", 0, 0, 100), ("s", 0, 1, 0), ("s", 0, 2, 300), ("s", 1, 0, 0), ("t", 0, 0, 5)], "sample_id string, face_idx int, seg_idx int, steps long")
    counts = spark.createDataFrame([("s", 0, 4000), ("s", 1, 5), ("t", 0, 0), ("u", 0, 3)], "sample_id string, face_idx int, n long")
    got = cloud.sample_segments(segments, counts).collect()
    assert len(got) == 4000 == len({r.k for r in got}) and {(r.sample_id, r.face_idx) for r in got} == {("s", 0)}
    share = sum(r.seg_idx == 0 for r in got) / 4000
    assert abs(share - 0.25) < 0.03 and {r.seg_idx for r in got} == {0, 2} and all(0 < r.along < 1 for r in got)
    assert abs(sum(r.along for r in got) / 4000 - 0.5) < 0.03


def test_stages_count_what_is_written(spark):
    stages = Stages()
    rows = materialize(stages.watch(spark.range(10), "one", even=F.count_if(F.col("id") % 2 == 0)), "one")
    stages.ran("one")
    stages.watch(rows, "never")
    assert stages.figures() == [("one", {"rows": 10, "even": 5})]
    with pytest.raises(ValueError, match="watched"):
        stages.watch(rows, "one")


def test_gradient_rounds_are_the_loop(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 5))
    y = (x @ rng.normal(size=(5, 3))).argmax(1)
    odd = [(1000, None, 1), (1001, [1.0], 1), (1002, [0.0] * 5, 9), (1003, [0.0] * 5, None), (1004, [float("nan")] * 5, 1), (1005, [None] * 5, 1)]
    rows = spark.createDataFrame([(i, list(map(float, v)), int(c)) for i, (v, c) in enumerate(zip(x, y))] + odd, "id long, v array<double>, c int").repartition(7)
    got = training.softmax_regression(rows, "v", "c", 3, 5, rounds=15)
    w, one = np.zeros((3, 6)), np.c_[x, np.ones(300)]
    for _ in range(15):
        p = np.exp(one @ w.T)
        p = p / p.sum(1, keepdims=True) - np.eye(3)[y]
        w = w - 0.5 * (p.T @ one / 300 + 1e-3 * np.c_[w[:, :-1], np.zeros(3)])
    assert np.allclose(got, w, atol=1e-10)
    out = {r.id: (r.predicted, r.confidence) for r in training.classify(rows, "id", "v", got).collect()}
    assert np.mean([out[i][0] == c for i, c in enumerate(y)]) > 0.9 and out[1000] == out[1001] == out[1005] == (None, None)
    assert not training.softmax_regression(rows.limit(0), "v", "c", 3, 5).any()
    with pytest.raises(ValueError, match="weights"):
        training.softmax_regression(rows, "v", "c", 1 << 12, 1 << 12)


def test_even_thinning_is_linspace(spark):
    from facetlake.operators.validate import evenly

    sizes = (1, 2, 399, 400, 401, 402, 797, 799, 800, 1000, 1197, 3991, 12345)
    rows = spark.createDataFrame([(n,) for n in sizes], "n long").select("n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
    got = defaultdict(list)
    for r in rows.where(evenly(F.col("k"), F.col("n"), 400)).collect():
        got[r.n].append(r.k)
    assert {n: sorted(v) for n, v in got.items()} == {n: np.unique(np.linspace(0, n - 1, min(400, n)).astype(int)).tolist() for n in sizes}


def test_curvature_and_merged_histograms(spark):
    from facetlake.operators import metrics

    inf, nan = float("inf"), float("nan")
    places = [(0, True, 1.0, 2.0), (0, True, 3.0, 4.0), (0, False, 9.0, 9.0), (0, True, inf, 1.0), (0, True, nan, 1.0), (0, None, 5.0, 5.0), (0, True, None, 5.0), (1, False, 1.0, 1.0)]
    rows = spark.createDataFrame([("s", *p) for p in places], "sample_id string, face_idx int, has_normal boolean, mean_curvature double, gaussian_curvature double")
    assert {r.face_idx: tuple(r.curvature) for r in metrics.curvature_statistics(rows).collect()} == {0: (2.0, 2.0, 1.0, 3.0, 3.0), 1: (0.0, None, None, None, None)}
    maps = [("a", {"x": 1, "y": 2}), ("a", {"x": 1}), ("a", None), ("b", {}), ("c", {"z": 1, "b": 1, "w": 5})]
    found = metrics.merge_histograms(spark.createDataFrame(maps, "k string, h map<string,long>"), ["k"], "h")
    assert {r.k: [tuple(e) for e in r.h] for r in found.collect()} == {"a": [("x", 2), ("y", 2)], "b": [], "c": [("w", 5), ("b", 1), ("z", 1)]}


def test_part_keys_and_ranges(spark):
    from facetlake.operators import intake, lineage

    names = spark.createDataFrame([("nist_ctc_01_asme1_ap203.stp",), ("NIST_STC_06_asme1_ap242-e2.STP",), ("nist_ftc_06_asme1_rc.stp",), ("nist_ctc_1.stp",), (None,)], "name string")
    assert [tuple(r) for r in names.select(*intake.part_key(F.col("name"))).collect()] == [("ctc_01", "ctc:ap203"), ("ftc_06", "stc:ap242-e2"), ("ftc_06", "ftc:rc"), ("nist_ctc_1.stp", "?"), (None, "?")]
    rows = [("good", 0, 0, 3), ("good", 1, 3, 4), ("gap", 0, 0, 3), ("gap", 1, 4, 5), ("late", 0, 1, 2)]
    frame = spark.createDataFrame([(*r, r[3] - r[2]) for r in rows], "s string, i int, start long, end long, n long")
    assert {r.s: tuple(r)[1:] for r in lineage.range_checks(frame, "s", "i", "n").collect()} == {"good": (2, True, True, True), "gap": (2, False, True, False), "late": (1, True, False, False)}


def test_nearest_mean_against_numpy(spark):
    from facetlake.operators import metrics

    rng = np.random.default_rng(7)
    x, y = np.c_[rng.normal(size=(60, 3)), np.full(60, 2.0)], rng.integers(0, 3, 60)
    rows = [(i, list(map(float, v)), int(c), i % 4 > 0) for i, (v, c) in enumerate(zip(x, y))] + [(99, None, 1, True)]
    got = {r.id: r.predicted for r in metrics.train_nearest_mean(spark.createDataFrame(rows, "id long, v array<double>, c int, t boolean"), "id", "v", "c", "t").collect()}
    t = np.arange(60) % 4 > 0
    std = x[t].std(0)
    z = (x - x[t].mean(0)) / np.where(std <= 1e-6, 1, std)
    means = np.array([z[t & (y == c)].mean(0) for c in range(3)])
    assert got == {i: int(((z[i] - means) ** 2).sum(1).argmin()) for i in range(60)}
