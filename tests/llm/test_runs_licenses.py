"""Periodic runs and licence scans against brute force, on real texts and odd cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

from facetlake.llm import license_scan, word_runs


def brute_runs(w):
    """Every period, every place; the smallest period of a stretch by trying the smaller ones."""
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if size >= max(6, 4 * q) and not any(w[i : i + size - p] == w[i + p : i + size] for p in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_refinement_finds_all_runs():
    rng = random.Random(5)
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(1, 6)):
            n, letters, w = rng.choice([0, 1, 5, 8, 20, 60, 150]), rng.choice([1, 2, 2, 3, 6]), []
            while len(w) < n:
                if w and rng.random() < 0.4:
                    w += w[-rng.randint(1, min(12, len(w))) :] * rng.randint(1, 7)
                else:
                    w.append(str(rng.randrange(letters)))
            texts.append(word_runs.stretched(w[:n], rng.randrange(10**6) * 10) if rng.random() < 0.5 else w[:n])
        assert word_runs.find_runs(texts) == [brute_runs(t) for t in texts]


def test_a_fibonacci_word_and_long_periods():
    a, b = ["x"], ["x", "y"]
    while len(b) < 400:
        a, b = b, b + a
    texts = [b, b * 5, ["u", *b[:90] * 4], [str(i) for i in range(900)] * 4, ["z"] * 5, ["z"] * 6]
    assert word_runs.find_runs(texts) == [brute_runs(t) for t in texts]


def brute_document(i, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    h, n = zlib.crc32(b"" if i is None else str(i).encode()), len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
    runs = brute_runs(w)
    drop = {k for s, size, q in runs for k in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest("".join(f"{s},{size},{q}\n" for s, size, q in runs)), digest(" ".join(x for k, x in enumerate(w) if k not in drop)))


def by_row(r):
    return tuple((x is not None, x) for x in r)


def test_word_runs(docs, rows):
    got = [tuple(r) for r in word_runs.word_runs(docs, stretch=True).select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()]
    short = {i for i, t in rows if len(t.split()) < 3000}
    want = [brute_document(i, t) for i, t in rows if i in short]
    assert sorted((r for r in got if r[0] in short), key=by_row) == sorted(want, key=by_row)
    assert len(got) == len(rows) and any(r[1] for r in got)
    assert {r[:6] for r in got if r[0] == 100003 and zlib.crc32(b"100003") % 10} == {(100003, 1, 0, 9000, 3, 3000000)}


def test_collapse_and_empty_tables(spark, empty):
    docs = spark.createDataFrame([(1, "a b a b a b a b c"), (2, None), (2, "one\ttwo")], "doc_id long, text string")
    got = {(r.doc_id, r.text, tuple(map(tuple, r.runs))) for r in word_runs.collapse_runs(docs).collect()}
    assert got == {(1, "a b c", ((0, 8, 2),)), (2, "", ()), (2, "one two", ())}
    assert word_runs.word_runs(empty).collect() == [] == license_scan.scan_licenses(empty).collect()


# ---- licences


def test_statistics_are_the_longest_matches():
    rng = random.Random(2)
    for _ in range(120):
        seqs = [[rng.randrange(3) for _ in range(rng.randint(1, 12))] for _ in range(rng.randint(1, 4))]
        text = [rng.randrange(4) for _ in range(30)]
        a = license_scan.Automaton(seqs)
        states, lengths = a.statistics(text)
        for i, (state, n) in enumerate(zip(states, lengths)):
            places = lambda m: [(k, j) for k, s in enumerate(seqs) for j in range(len(m), len(s) + 1) if s[j - len(m) : j] == m]
            assert n == max(m for m in range(i + 2) if not m or places(text[i + 1 - m : i + 1]))
            assert not n or a.ends[state] == places(text[i + 1 - n : i + 1])


PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


def brute_base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text))
    places = [(k, label) for p, label in PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
    return len(w), len(places), min((k for k, _ in places), default=None), max((k for k, _ in places), default=None), ",".join(sorted({x for _, x in places}))


def test_license_scan(spark, docs, rows):
    odd = [(1, "CC BY cc-by ccby CC--BY."), (1, "CC BY cc-by ccby CC--BY."), (2, "All rights\nreserved all RIGHTS reserved, general public LICENSE"), (3, "é cc by cc byİ"), (4, "cc by " * 5000), (5, "general public general public license")]
    more = spark.createDataFrame(odd, "doc_id long, text string")
    got = license_scan.digest(license_scan.scan_licenses(docs.select("doc_id", "text").unionByName(more))).collect()
    want = sorted(((i, *brute_base(t)) for i, t in [*rows, *odd]), key=by_row)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=by_row) == want
    for r in got:
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))


def test_templates_are_found_whole_cut_and_changed(spark):
    rng = random.Random(3)
    docs, want = [], defaultdict(set)
    for k, (label, text) in enumerate(license_scan.TEMPLATES):
        words = text.split()
        docs.append((k, "some words before. " + text.upper() + " and after"))
        want[k].add(label)
        if len(words) > 30:
            for c in range(3):  # comment signs at line starts, a word changed, a tail cut off
                w = list(words)
                w[rng.randrange(10, len(w) - 10)] = "xyzzy"
                lines = [" ".join(w[i : i + 9]) for i in range(0, len(w) - 2, 9)]
                docs.append((100 * (c + 1) + k, "\n".join(f" * {x}" for x in lines)))
                want[100 * (c + 1) + k].add(label)
    clean = ["you may obtain a copy of the book, subject to the following conditions, in compliance with the law", "licensed under the terms of another agreement", "this program is free", "licensed under the zope license version 2 0"]
    docs += [(10000 + k, t) for k, t in enumerate(clean)]
    got = {r.doc_id: {s.label for s in r.spans} for r in license_scan.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {i: want[i] for i, _ in docs}
