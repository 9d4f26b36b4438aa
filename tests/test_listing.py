"""Listings, a dataset's quality and description, predictions: odd cases and small truths."""

import json

from pyspark.sql import functions as F

from facetlake.operators import dataset, listing


def test_newest_samples(spark):
    rows = [(i, "process", f"s{i}", i % 3, "completed", None, i // 2) for i in range(10)] + [(20, "train", "s", 0, "completed", None, 99), (21, "process", None, 0, "rejected", "EMPTY_FILE", 99)]
    jobs = spark.createDataFrame(rows, "job_id long, kind string, sample_id string, file_id long, state string, error_code string, created_at long")
    files = spark.createDataFrame([(0, "a.step"), (1, "b.step")], "file_id long, filename string")
    got = {(r.job_id, r.filename) for r in listing.list_samples(jobs, files, limit=3).collect()}
    assert got == {(8, None), (9, "a.step"), (6, "a.step")}
    assert listing.list_samples(jobs.limit(0), files).collect() == []
    assert listing.MOST_LISTED == 1000 and listing.list_samples(jobs, files, limit=10**6).count() == 10


def version(spark, rows):
    samples = spark.createDataFrame(rows, "sample_id long, content string, family string, design_group string, label int, rule_label int, reason string")
    clusters = spark.createDataFrame([(0, 0), (1, 0)], "part long, cluster long")
    return dataset.build(samples, clusters), clusters


def test_quality_and_description(spark):
    rows = [(i, f"c{i}", "fa", f"g{i % 6}", i % 2, 0, "ok") for i in range(12)] + [(50, "c0", "fa", "g0", 1, 1, "exact_duplicate_of:0"), (51, "x", "fb", "g9", None, None, "no_ground_truth")]
    built, clusters = version(spark, rows)
    got = {(r.section, r.key): r.n for r in listing.quality(built["samples"], built["excluded"], clusters).collect()}
    assert got["included", "all"] == 12 and got["excluded", "all"] == 2 and got["reason", "exact_duplicate_of"] == 1 == got["reason", "no_ground_truth"] == got["near_duplicate_clusters", "all"]
    assert sum(n for (s, _), n in got.items() if s == "split") == 12 == sum(n for (s, _), n in got.items() if s == "label") and sum(n for (s, _), n in got.items() if s == "agreement") == 6
    assert sum(n for (s, _), n in got.items() if s == "groups") == 6 and ("crossing", "units") not in got and got["crossing", "families"] == 1
    text = listing.describe(built["dataset"], built["samples"], 7, "group", ("hole", "slot")).first().description
    own = json.loads(text)
    assert text == json.dumps(own, sort_keys=True, separators=(",", ":")) and own["label_vocabulary"] == ["hole", "slot"] and own["dataset_id"] == built["dataset"].first().dataset_id and own["included"] == 12
    changed, _ = version(spark, [(*r[:4], 1 - r[4] if r[0] == 3 else r[4], *r[5:]) for r in rows])
    other = json.loads(listing.describe(changed["dataset"], changed["samples"], 7, "group", ("hole", "slot")).first().description)
    assert other["label_content_sha256"] != own["label_content_sha256"] and other["dataset_id"] != own["dataset_id"]


def test_predictions_with_truth_and_split(spark):
    predicted = spark.createDataFrame([("a", 0, 1, 0.123456), ("b", 0, 0, 1.0)], "sample_id string, face_idx int, predicted int, confidence double")
    truth = spark.createDataFrame([("a", 0, 2)], "sample_id string, face_idx int, label int")
    samples = spark.createDataFrame([("b", "val")], "sample_id string, split string")
    got = {tuple(r) for r in listing.run_predictions(predicted, truth, samples).select("sample_id", "ground_truth", "predicted", "confidence", F.col("dataset_split")).collect()}
    assert got == {("a", 2, 1, 0.1235, "not_in_dataset"), ("b", None, 0, 1.0, "val")}


def test_replaced_rows_rewrite_their_own_partitions_alone(spark, tmp_path):
    from pathlib import Path

    from facetlake.sources import sinks

    path, gone = str(tmp_path / "t"), str(tmp_path / "gone")
    sinks.write_once(spark.createDataFrame([(f"k{i}", i) for i in range(200)], "id string, x long"), path, "id", slots=16)
    before = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    new = spark.createDataFrame([("k7", 70), ("new", 1), ("k8", 8)], "id string, x long")
    for _ in range(2):  # again, as after a run that was cut off
        sinks.replace_samples(new, path, gone, "id", slots=16)
        table = {r.id: r.x for r in spark.read.parquet(path).collect()}
        assert table == {f"k{i}": i for i in range(200)} | {"k7": 70, "new": 1}
        assert [(r.id, r.x) for r in spark.read.parquet(gone).collect()] == [("k7", 7)]
    after = {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    assert len(before.keys() & after.keys()) >= 12
    sinks.replace_samples(new, str(tmp_path / "fresh"), gone, "id")
    assert spark.read.parquet(str(tmp_path / "fresh")).count() == 3
