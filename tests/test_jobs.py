"""Jobs: runs over growing copies, reruns, odd rows, and the command line."""

import hashlib
import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from jobs import intake_stream, queries, release_dataset
from tests.test_catalogue import cells, tables  # noqa: F401

SF, ROOT = "/root/testdata/sf0.001", Path(__file__).resolve().parent.parent
DOCS = "doc_id long, text string, lang string, source string, sample_id string, status string"


def put(spark, folder, rows, name):
    """One more file in a folder of documents, with clashing columns beside the four that are read."""
    made = f"{folder}-{name}"
    spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS).coalesce(1).write.parquet(made)
    os.makedirs(folder, exist_ok=True)
    part = next(p for p in os.listdir(made) if p.startswith("part-"))
    shutil.copy(f"{made}/{part}", f"{folder}/{name}.parquet")


def ledger(spark, at):
    rows = spark.read.schema(intake_stream.LEDGER).parquet(f"{at}/ledger").collect()
    return {(r.batch_id, r.doc_id, r.content[:8]): (r.status, r.code, r.duplicate_of, r.copies) for r in rows}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()[:8]


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, tables, name):  # noqa: F811
    frame, other = queries.QUERIES[name](spark, SF), tables.sql(queries.ORACLES[name])
    assert sorted(frame.columns) == sorted(other.columns)
    assert cells(frame.columns, [tuple(r) for r in frame.collect()]) == cells(other.columns, other.fetchall())


def test_intake_takes_only_what_is_new(spark, tmp_path):
    docs, out, mark = f"{tmp_path}/docs", f"{tmp_path}/out", f"{tmp_path}/mark"
    run = lambda: intake_stream.run(spark, docs, out, mark, {"max_bytes": 40})
    put(spark, docs, [(5, "one", "en", "a"), (3, "one", "en", "a"), (3, "one", "en", "a"), (7, None, "fr", "b"), (8, "", None, None), (9, "é" * 21, "fr", "b"), (None, "two", "en", "a"), (None, "only", "en", "a"), (6, "two", "en", "a")], "one")
    first = run()
    want = {
        (0, 5, sha("one")): ("duplicate", None, 3, 1),
        (0, 3, sha("one")): ("accepted", None, None, 2),
        (0, 7, sha("")): ("rejected", "EMPTY_FILE", None, 1),
        (0, 8, sha("")): ("rejected", "EMPTY_FILE", None, 1),
        (0, 9, sha("é" * 21)): ("rejected", "FILE_TOO_LARGE", None, 1),
        (0, None, sha("two")): ("duplicate", None, 6, 1),
        (0, None, sha("only")): ("accepted", None, None, 1),
        (0, 6, sha("two")): ("accepted", None, None, 1),
    }
    assert ledger(spark, out) == want
    assert first == {"batches": 1, "documents": 8, "rows": 9, "bytes": 3 + 3 + 0 + 0 + 42 + 3 + 4 + 3, "accepted": 3, "duplicate": 2, "rejected": 3}
    stamps = {p: p.stat().st_mtime_ns for p in Path(out).rglob("*.parquet")}
    assert run()["batches"] == 0 and ledger(spark, out) == want
    put(spark, docs, [(1, "one", "en", "a"), (2, "new", "en", "a"), (4, "only", "en", "a")], "two")
    second = run()
    assert (second["batches"], second["rows"], second["accepted"]) == (1, 3, 1)
    assert ledger(spark, out) == want | {(1, 1, sha("one")): ("duplicate", None, 3, 1), (1, 2, sha("new")): ("accepted", None, None, 1), (1, 4, sha("only")): ("duplicate", None, None, 1)}
    assert {p: p.stat().st_mtime_ns for p in stamps} == stamps  # what was written stays as it was
    figures = {(r.batch_id, r.status, r.code): r.n for r in spark.read.json(f"{out}/report").groupBy("batch_id", "status", "code").agg(F.sum("documents").alias("n")).collect()}
    assert figures == {(0, "accepted", None): 3, (0, "duplicate", None): 2, (0, "rejected", "EMPTY_FILE"): 2, (0, "rejected", "FILE_TOO_LARGE"): 1, (1, "accepted", None): 1, (1, "duplicate", None): 2}


def test_intake_repeats_a_batch_that_failed(spark, tmp_path):
    """The driver is lost after the ledger's rows were written and before the batch was marked done."""
    docs, out, mark = f"{tmp_path}/docs", f"{tmp_path}/out", f"{tmp_path}/mark"
    put(spark, docs, [(2, "a", "en", "s"), (1, "a", "en", "s")], "one")
    intake_stream.run(spark, docs, out, mark)
    put(spark, docs, [(0, "a", "en", "s"), (4, "b", "en", "s")], "two")
    intake_stream.run(spark, docs, out, mark)
    want = ledger(spark, out)
    for name in ("1", ".1.crc"):
        os.remove(f"{mark}/commits/{name}")
    again = intake_stream.run(spark, docs, out, mark)
    assert again["batches"] == 1 and ledger(spark, out) == want and want[(1, 0, sha("a"))] == ("duplicate", None, 1, 1)


def test_release_is_repeatable_and_versions_stand_side_by_side(spark, tmp_path):
    docs, labels, out = f"{tmp_path}/docs", f"{tmp_path}/labels", f"{tmp_path}/out"
    text = lambda i: f"text {i} " + "w " * (40 * i)  # noqa: E731  # lengths far apart: near duplicates would join their groups
    rows = [(i, text(i), ("en", "de")[i % 2], f"s{i % 12}") for i in range(60)]
    odd = [(60, None, "en", "s1"), (61, text(1), "de", "s1"), (62, "no language", None, "s1"), (63, "no source", "en", None), (None, "no id", "en", "s1"), (64, "no label", "en", "s1")]
    put(spark, docs, rows + odd, "one")
    spark.createDataFrame([(i, i % 2) for i in range(64)] + [(3, 0)], "doc_id long, quality int").write.parquet(labels)
    first = release_dataset.run(spark, docs, labels, out)
    table = spark.read.schema(release_dataset.SAMPLES).parquet(f"{out}/samples")
    got = {r.sample_id: (r.split, r.reason) for r in table.collect()}
    assert len(got) == 66 and first["written"] and first["included"] == 60
    assert {i: got[i] for i in (60, 61, 62, 63, None, 64)} == {60: ("excluded", "status"), 61: ("excluded", "exact_duplicate_of:1"), 62: ("excluded", "status"), 63: ("excluded", "status"), None: ("excluded", "status"), 64: ("excluded", "no_ground_truth")}
    assert {got[i][0] for i in range(60)} == {"train", "val", "test"}
    figures = {(r.section, r.key): r.n for r in spark.read.json(f"{out}/report").collect()}
    assert figures[("split", "excluded")] == 6 and figures[("reason", "ok")] == 60 and sum(n for (s, _), n in figures.items() if s == "label") == 66
    stamps = {p: p.stat().st_mtime_ns for p in Path(out).rglob("part-*")}
    assert release_dataset.run(spark, docs, labels, out) == first | {"written": False}
    assert {p: p.stat().st_mtime_ns for p in Path(out).rglob("part-*")} == stamps
    # without its manifest a version counts as cut off: the same rows are written over
    shutil.rmtree(f"{out}/manifest")
    again = release_dataset.run(spark, docs, labels, out)
    assert again == first and {r.sample_id: (r.split, r.reason) for r in table.sparkSession.read.schema(release_dataset.SAMPLES).parquet(f"{out}/samples").collect()} == got
    put(spark, docs, [(70, "one more text", "en", "s3")], "two")
    spark.createDataFrame([(70, 1)], "doc_id long, quality int").write.mode("append").parquet(labels)
    third = release_dataset.run(spark, docs, labels, out)
    assert third["written"] and third["dataset_id"] != first["dataset_id"]
    assert {r.dataset_id: r["count"] for r in spark.read.schema(release_dataset.SAMPLES).parquet(f"{out}/samples").groupBy("dataset_id").count().collect()} == {first["dataset_id"]: 66, third["dataset_id"]: 67}


def test_jobs_leave_no_tables_between_their_stages(spark, tmp_path):
    from facetlake.functions import storage

    docs, labels = f"{tmp_path}/docs", f"{tmp_path}/labels"
    put(spark, docs, [(i, f"text {i}", "en", "a") for i in range(5)], "one")
    spark.createDataFrame([(i, 1) for i in range(5)], "doc_id long, quality int").write.parquet(labels)
    before = set(storage._made)
    intake_stream.run(spark, docs, f"{tmp_path}/a", f"{tmp_path}/b")
    release_dataset.run(spark, docs, labels, f"{tmp_path}/c")
    assert set(storage._made) == before
    with storage.scope():
        kept = storage.materialize(spark.range(3)).inputFiles()
    assert set(storage._made) == before and not any(os.path.exists(p.removeprefix("file://")) for p in kept)


def test_empty_tables(spark, tmp_path):
    docs, labels = f"{tmp_path}/docs", f"{tmp_path}/labels"
    spark.createDataFrame([], DOCS).write.parquet(docs)
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(labels)
    assert intake_stream.run(spark, docs, f"{tmp_path}/a", f"{tmp_path}/b")["documents"] == 0
    made = release_dataset.run(spark, docs, labels, f"{tmp_path}/c")
    assert (made["included"], made["excluded"]) == (0, 0) and not release_dataset.run(spark, docs, labels, f"{tmp_path}/c")["written"]


def test_command_line(tmp_path):
    call = [sys.executable, "-m", "jobs.intake_stream", "--master", "local[2]", "--source", f"{SF}/documents.parquet", "--output", f"{tmp_path}/out", "--checkpoint", f"{tmp_path}/mark", "--config", str(ROOT / "jobs/intake_stream.json")]
    done = subprocess.run(call, cwd=ROOT, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
    assert json.loads(done.stdout.strip().splitlines()[-1])["batches"] == 1 and "wrote" in done.stderr
