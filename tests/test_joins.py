"""Joins without a plain key, growth, matching and percentiles against brute force, with hot keys and odd values."""

import random
import statistics
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from facetlake.operators import growth, intervals, metrics, nearest

INF, NAN = float("inf"), float("nan")


@pytest.mark.parametrize("rows_per_cell", [1 << 20, 20])
def test_containment(spark, rows_per_cell):
    """Short and long ranges, endless ones, empty ones, a third of the points in one place, nulls; cells split or not."""
    rng = random.Random(1)
    points = [(i, rng.choice([5.0, round(rng.uniform(-50, 1000), 1), round(rng.uniform(0, 20), 1)])) for i in range(600)] + [(600, None), (601, NAN), (602, -1e300), (603, INF)]
    ranges = [(i, a := round(rng.uniform(-60, 1000), 1), a + rng.choice([0.5, 1, 3, 400, 0, -2])) for i in range(200)] + [(200, -INF, 0.0), (201, 5.0, INF), (202, None, 3.0), (203, 5.0, 5.1), (204, 4.9, 5.0), (205, -1e301, 1e301)]
    p, r = spark.createDataFrame(points, "i long, at double"), spark.createDataFrame(ranges, "k long, low double, high double")
    found = intervals.contained(p, r, "at", "low", "high", rows_per_cell=rows_per_cell)
    want = {(i, k) for i, x in points for k, a, b in ranges if None not in (x, a, b) and a <= x < b}
    rows = [(x.i, x.k) for x in found.select("i", "k").collect()]
    assert set(rows) == want and len(rows) == len(want)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_containment_with_keys_and_empty_sides(spark):
    p = spark.createDataFrame([("a", 1), ("a", 9), ("b", 1), (None, 1)], "g string, at long")
    r = spark.createDataFrame([("a", 0, 5, "x"), ("b", 2, 9, "y"), ("a", 9, 10, "z"), ("c", 0, 99, "w"), (None, 0, 9, "v")], "g string, low long, high long, name string")
    assert {(x.g, x["at"], x.name) for x in intervals.contained(p, r, "at", "low", "high", ("g",)).collect()} == {("a", 1, "x"), ("a", 9, "z")}
    far = spark.createDataFrame([(0, 10, 1), (0, 2**62, 2), (-(2**62), 5, 3), (999, 1000, 4)] + [(i, i + 2, 5) for i in range(1000)], "low long, high long, k long")
    counts = intervals.contained(spark.range(1000).withColumnRenamed("id", "at"), far, "at", "low", "high", rows_per_cell=100).groupBy("k").count()
    assert {r.k: r["count"] for r in counts.collect()} == {1: 10, 2: 1000, 3: 5, 4: 1, 5: 1999}
    assert intervals.contained(p.limit(0), r, "at", "low", "high").drop("g").collect() == [] == intervals.contained(p, r.limit(0).drop("g"), "at", "low", "high").collect()


def test_nearest_of_another_group(spark):
    """Clumps, far points, copies and ties."""
    rng = np.random.default_rng(3)
    clumps = np.concatenate([rng.normal(0, 1e-3, (150, 3)), rng.normal(5, 1, (150, 3)), rng.uniform(-1000, 1000, (20, 3)), np.repeat([[7.0, 7.0, 7.0]], 80, 0), rng.integers(0, 4, (60, 3))])
    rows = [(i, f"g{rng.integers(0, 3) if i > 150 else 0}", *map(float, x)) for i, x in enumerate(clumps)]
    odd = [(9000, None, 0.0, 0.0, 0.0), (9001, "g1", None, 0.0, 0.0), (9002, "g1", NAN, 0.0, 0.0), (None, "g1", 0.0, 0.0, 0.0)]
    table = spark.createDataFrame(rows + odd, "id long, label string, x double, y double, z double")
    got = {r.id: (r.other, r.distance2) for r in nearest.nearest_other(table, "id", ["x", "y", "z"], "label").collect()}
    want = {}
    for i, g, *a in rows:
        d, j = min(((a[0] - b[0]) * (a[0] - b[0]) + (a[1] - b[1]) * (a[1] - b[1]) + (a[2] - b[2]) * (a[2] - b[2]), j) for j, h, *b in rows if h != g)
        want[i] = (j, d)
    assert got == want
    assert nearest.nearest_other(table.where("label = 'g0'"), "id", ["x", "y", "z"], "label").collect() == []
    assert nearest.nearest_other(table.limit(0), "id", ["x", "y", "z"], "label").collect() == []


def slow_growth(arcs, start, wall, allowed, most):
    members, open_nodes = set(), [n for n in start if n not in wall]
    while open_nodes:
        n = open_nodes.pop()
        if n in members:
            continue
        if not allowed(n) or len(members) >= most:
            return None
        members.add(n)
        open_nodes += [b for b in arcs[n] if b not in wall]
    return sorted(members)


def test_growth(spark):
    rng = random.Random(4)
    arcs = defaultdict(set)
    for _ in range(60):
        a, b = rng.randrange(60), rng.randrange(60)
        arcs[a].add(b)
        arcs[b].add(a)
    for b in range(100, 400):  # a node with very many neighbours
        arcs[99].add(b)
        arcs[b].add(99)
    starts = {g: {rng.randrange(60), rng.randrange(60)} for g in range(80)} | {80: {99}, 81: {150}, 82: {1000}}
    walls = {g: {rng.randrange(60) for _ in range(rng.randrange(6))} for g in range(81)} | {81: {99}, 83: {5}}
    starts[83] = {5}
    nodes = [(n, n % 7) for n in range(400)]
    rule = lambda g: lambda n: n < 400 and n % 7 != g % 5 + 2
    frame = lambda d: spark.createDataFrame([(g, n) for g, s in d.items() for n in s], "growth long, node long")
    found = growth.grow(spark.createDataFrame([(a, b) for a, s in arcs.items() for b in s], "src long, dst long"), frame(starts), frame(walls), spark.createDataFrame(nodes, "node long, kind long"), spark.createDataFrame([(g, g % 5 + 2) for g in starts], "growth long, bad long"), F.col("kind") != F.col("bad"))
    got = {r.growth: r.members for r in found.collect()}
    assert got == {g: slow_growth(arcs, s, walls.get(g, ()), rule(g), growth.MOST) for g, s in starts.items()}
    assert got[80] is None and got[83] == [] and any(got.values())


def slow_matches(pairs):
    free, out = {p for _, p in pairs}, set()
    for t in sorted({t for t, _ in pairs}):
        p = min((p for x, p in pairs if x == t and p in free), default=None)
        if p is not None:
            free.remove(p)
            out.add((t, p))
    return out


def test_matching_is_what_the_loop_gives(spark):
    rng = random.Random(6)
    groups = {g: {(rng.randrange(9), rng.randrange(9)) for _ in range(rng.randrange(30))} for g in range(40)}
    groups[40] = {(t, p) for t in range(7) for p in range(7)}  # all compete for all
    rows = spark.createDataFrame([(g, t, p) for g, s in groups.items() for t, p in s], "g long, left long, right long")
    got = defaultdict(set)
    for r in growth.match_in_order(rows, group=("g",)).collect():
        got[r.g].add((r.left, r.right))
    assert {g: s for g, s in got.items() if s} == {g: m for g, s in groups.items() if (m := slow_matches(s))}
    assert growth.match_in_order(rows.limit(0), group=("g",)).collect() == []


def test_feature_errors(spark):
    rows = [("s", "true", "hole", 0, 5.0), ("s", "true", "hole", 1, 5.01), ("s", "true", "hole", 2, None), ("s", "predicted", "hole", 0, 5.02), ("s", "predicted", "hole", 1, 5.0), ("s", "predicted", "slot", 0, None), ("t", "true", "hole", 0, 1.0)]
    found = metrics.match_features(spark.createDataFrame(rows, "sample_id string, side string, feature_type string, place long, size double"))
    got = {(r.sample_id, r.feature_type, r.true_place, r.predicted_place, None if r.size_error is None else round(r.size_error, 3)) for r in found.collect()}
    assert got == {("s", "hole", 0, 0, 0.02), ("s", "hole", 1, 1, 0.01), ("s", "hole", 2, None, None), ("s", "slot", None, 0, None), ("t", "hole", 0, None, None)}
    scores = {r.feature_type: (r.tp, r.fp, r.fn, r.max_error and round(r.max_error, 3)) for r in metrics.feature_scores(found).collect()}
    assert scores == {"hole": (2, 0, 2, 0.02), "slot": (0, 1, 0, None)}


def test_percentiles_of_groups_large_and_small(spark):
    rng = random.Random(8)
    values = {"big": [rng.gauss(0, 1) for _ in range(5000)], "ties": [float(rng.randrange(3)) for _ in range(4500)], "two": [1.0, 2.0], "one": [3.0], "none": [None, NAN], "hot": [7.0] * 6000 + [8.0]}
    rows = spark.createDataFrame([(k, x) for k, s in values.items() for x in s], "k string, x double")
    got = {r.k: (r.p50, r.p95, r["max"], r.n) for r in metrics.percentiles(rows, ["k"], "x", accuracy=500).collect()}
    for k, s in values.items():
        s = [x for x in s if x is not None and x == x]
        want = (round(float(np.percentile(s, 50)), 6), round(float(np.percentile(s, 95)), 6), round(max(s), 6), len(s)) if s else (None, None, None, 0)
        assert got[k] == pytest.approx(want, abs=2e-6), k
    assert statistics.median(values["two"]) == got["two"][0]


def test_near_duplicates_of_any_sign(spark):
    from facetlake.operators import near_duplicates

    rng = random.Random(9)
    value = lambda: rng.choice([0.0, 1.0, -1.0, 1.0015, -1.0015, 0.999, -50.0, -50.05, 1e-12, -1e-12, 1e9, 1.001e9])
    parts = [(i, value(), value(), [1.0, 2.0, rng.choice([3.0, 3.2])]) for i in range(150)]
    distinct = near_duplicates.signatures(spark.createDataFrame(parts, "id long, v double, a double, d array<double>"), "id", F.col("v"), F.col("a"), F.col("d"))
    rows = [(r.part, r.volume, r.area) for r in distinct.collect()]
    close = lambda x, y: abs(x - y) <= 2e-3 * max(abs(x), abs(y))
    want = {(a, b) for a, v, x in rows for b, w, y in rows if a < b and close(v, w) and close(x, y)}
    assert {tuple(r) for r in near_duplicates.near_duplicate_pairs(distinct).collect()} == want and want


def test_crowded_cells_are_split_by_pairs(spark, monkeypatch):
    """A cell of few points and many ranges is split too, and whole-numbered ranges that end with a cell stay out of the next one; no row is lost."""
    monkeypatch.setattr(intervals, "PAIRS", 1 << 10)
    monkeypatch.setattr(intervals, "LEAST_POINTS", 8)
    points = spark.range(200).select((F.col("id") % 10).alias("at"), F.col("id").alias("i"), F.lit("g").alias("g"))
    ranges = spark.range(300).select(F.lit(0).cast("long").alias("low"), F.lit(10).cast("long").alias("high"), F.col("id").alias("k"), F.lit("g").alias("g"))
    assert intervals.hot_parts(points, ranges, ["g"], 1 << 20).first()._parts == 25
    assert intervals.hot_parts(points, ranges.limit(1), ["g"], 1 << 20).isEmpty()
    for keys, r in (((), ranges.drop("g")), (("g",), ranges)):
        found = intervals.contained(points, r, "at", "low", "high", keys)
        assert found.count() == found.select("i", "k").distinct().count() == 60_000
        assert "_salt" in found._jdf.queryExecution().optimizedPlan().toString()


def test_few_rows_that_make_many_pairs_are_dealt_over_tasks(spark, monkeypatch):
    """Two thousand points and three hundred ranges are few bytes, but their pairs are made by as many tasks as the pairs ask for."""
    monkeypatch.setattr(intervals, "PAIRS", 1 << 10)
    monkeypatch.setattr(intervals, "LEAST_POINTS", 8)
    points = spark.range(2000).select((F.col("id") % 10).alias("at"), F.col("id").alias("i"), F.lit("g").alias("g"))
    ranges = spark.range(300).select(F.lit(0).cast("long").alias("low"), F.lit(10).cast("long").alias("high"), F.col("id").alias("k"), F.lit("g").alias("g"))
    for keys, r in (((), ranges.drop("g")), (("g",), ranges)):
        found = intervals.contained(points, r, "at", "low", "high", keys)
        made = [x["count"] for x in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(made) == found.select("i", "k").distinct().count() == 600_000
        assert len(made) > 20 and max(made) < 120_000
