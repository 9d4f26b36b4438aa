"""Sentence spans as their query runs them, and the classifier's parts, each against a plain version of its own."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from facetlake.llm import nbsvm, sentence_spans


def plain_cuts(words):
    """A word is a cut if some window of successive words has no smaller hash than its own."""
    h = [zlib.crc32(w) * 0x9E3779B1 % 2**32 for w in words]
    n, size = len(words), sentence_spans.WINDOW
    return [i for i in range(n) if any(h[i] == min(h[a : a + size]) for a in range(max(0, i - size + 1), min(i, n - size) + 1))]


def plain_removal(rows):
    """Every span of sentences and every run of words from cut to cut, by its words; all places but the first lose theirs."""
    texts = [(-(1 << 63) if i is None else i, t) for i, t in rows]
    places = defaultdict(list)
    for n, (i, t) in enumerate(texts):
        own = [s.encode().split() for s in sentence_spans.sentences(t)]
        ends = np.cumsum([0, *(len(s) for s in sentence_spans.sentences(t))]).tolist()
        for a in range(len(own) - 2):
            if sum(map(len, own[a : a + 3])) >= sentence_spans.MIN_WORDS:
                places["span", tuple(map(tuple, own[a : a + 3]))].append((i, n, a, ends[a], ends[a + 3]))
        words, begins = t.encode().split(), [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", t)]
        cuts = plain_cuts(words)
        for a in cuts:
            b = next((c for c in cuts if c >= a + sentence_spans.RUN), None)
            if b is not None:
                places["run", tuple(words[a:b])].append((i, n, a, begins[a], begins[b]))
    gone = defaultdict(set)
    for found in places.values():
        first = min(i for i, *_ in found)
        for i, n, a, low, high in found:
            if i != first or any(m == n and b < a for _, m, b, *_ in found):
                gone[n].update(range(low, high))
    out = []
    for n, (i, t) in enumerate(texts):
        ends = np.cumsum([len(s) for s in sentence_spans.sentences(t)]).tolist()
        kept = "".join(c for k, c in enumerate(t) if k not in gone[n])
        out.append((i, len({next(k for k, e in enumerate(ends) if p < e) for p in gone[n]}), len(gone[n]), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def removed(frame):
    out = sentence_spans.span_dedup(frame, run_words=sentence_spans.RUN).collect()
    return sorted((-(1 << 63) if r.doc_id is None else r.doc_id, r.n_removed, r.removed_chars, r.kept_sha256) for r in out)


def test_spans_and_runs_are_removed_and_nothing_else(spark, docs, rows):
    short = [(i, t) for i, t in rows if len(t) < 6000]
    got = removed(docs.where(F.coalesce(F.length("text"), F.lit(0)) < 6000))
    assert got == plain_removal(short) and sum(n for _, _, n, _ in got) > 1000


def test_runs_on_texts_of_few_words(spark):
    """Few different words, so that runs repeat within texts and across them in every way."""
    rng = random.Random(14)
    pieces = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(rng.randint(20, 45))) for _ in range(6)]
    rows = [(i % 35, rng.choice((" ", ". ", "\n")).join(rng.choice(pieces) for _ in range(rng.randint(0, 4)))) for i in range(50)] + [(None, pieces[0]), (None, pieces[1]), (99, " ".join("x" for _ in range(80)))]
    assert removed(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)) == plain_removal(rows)


def test_class_log_count_ratios():
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 40, 7)).astype(np.int32) for _ in range(30)]
    labels = np.array([i % 2 for i in range(30)])
    model = nbsvm.fit(rows, labels)
    counts = {k: Counter(int(x) for r, y in zip(rows, labels) if y == k for x in r) for k in (0, 1)}
    total = {k: sum(c.values()) + (1 << nbsvm.BITS) for k, c in counts.items()}
    want = [math.log((counts[1][x] + 1) / total[1]) - math.log((counts[0][x] + 1) / total[0]) for x in range(60)]
    assert np.allclose(model.ratio[:60], want, atol=1e-5)


def test_the_curve_over_the_margins_is_the_best_one():
    """Against steps downhill on the cross-entropy with the same smoothed targets."""
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 200)
    rows = [np.unique(np.r_[rng.integers(0, 60, 6), 60 + k if rng.random() < 0.7 else 62]).astype(np.int32) for k in y]
    model = nbsvm.fit(rows, y)
    held = [i for i in range(200) if i % 5 == 0]
    m, t = np.array([model.margin(rows[i]) for i in held]), y[held]
    goal = np.where(t == 1, (t.sum() + 1) / (t.sum() + 2), 1 / ((1 - t).sum() + 2))
    a = b = 0.0
    for _ in range(200_000):
        p = 1 / (1 + np.exp(-(a * m + b)))
        a, b = a - 0.02 * ((p - goal) * m).sum(), b - 0.02 * (p - goal).sum()
    assert abs(a - model.slope) < 1e-2 and abs(b - model.shift) < 1e-2


def test_the_rows_of_the_fit_are_those_of_smallest_rank(spark):
    ids = list(range(200))
    docs = spark.createDataFrame([(i, f"w{i} v{i % 7}") for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3 % 2) for i in ids], "doc_id long, quality int")
    rank = {r.id: r.h for r in spark.range(200).select("id", F.xxhash64("id").alias("h")).collect()}
    chosen = []
    for k in (0, 1):
        chosen += sorted((rank[i], i, k) for i in ids if i % 3 % 2 == k and zlib.crc32(str(i).encode()) % 5)[:20]
    chosen.sort()
    want = nbsvm.fit([nbsvm.features(f"w{i} v{i % 7}") for _, i, _ in chosen], np.array([k for *_, k in chosen]))
    got = nbsvm.train(docs, labels, sample_rows=40)
    assert np.array_equal(got.weight, want.weight) and (got.slope, got.shift, got.bias) == (want.slope, want.shift, want.bias)
