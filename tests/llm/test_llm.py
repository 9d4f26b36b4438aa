"""Each operator against a brute-force version, an exact round trip or held-out accuracy, on real texts and odd cases."""

import hashlib
import math
import random
import re
import struct
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from facetlake.llm import bpe, ctw, exact_dedup, nbsvm, packing, pii, quality_rules, sentence_spans, simhash, suffix_dedup
from tests.llm.tree import Tree

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def key(i):
    return -(1 << 63) if i is None else i


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(bpe.vocabulary_path())


def sorted_rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=lambda r: tuple((x is not None, x) for x in r))


# ---- 1


def test_ctw_scores(spark, docs, rows):
    out = ctw.score_texts(docs).collect()
    counts, ends = Counter(), 0
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1:
            counts.update(t.encode().lower().split())
            ends += 1
    total, distinct = sum(counts.values()) + ends, len(counts) + 1
    term = lambda c: math.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
    want = defaultdict(list)
    for i, t in rows:
        words = t.encode().lower().split()
        want[i].append((len(words) + 1, sum(counts[w] > 0 for w in words) + 1, total, round(sum(term(counts[w]) for w in words) + term(ends), 6)))
    got = defaultdict(list)
    for r in out:
        got[r.doc_id].append((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)))
        assert r.score < 0 and math.isfinite(r.score)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    held = [r for r in out if r.held_out and r.n_tokens > 50]
    assert sum(r.bits_per_byte for r in held) / len(held) < 3


def test_ctw_rare_words_are_looked_up(docs):
    columns = ("doc_id", "n_known", "train_tokens")
    few, all_ = ctw.score_texts(docs, words=50), ctw.score_texts(docs)
    assert sorted_rows(few, *columns, F.round("base_score", 6)) == sorted_rows(all_, *columns, F.round("base_score", 6))


def brute_tree(texts, depth):
    """Weighted mixture by plain recursion over dictionaries, every context kept."""
    counts = defaultdict(lambda: [0, 0])
    children = defaultdict(set)
    pad = [254] * 7
    for t in texts:
        seq = pad + list(t) + [255]
        for p in range(7, len(seq)):
            for d in range(depth + 1):
                context = tuple(seq[p - 1 - j] for j in range(d))
                for j in range(8):
                    node = (context, (1 << j) | seq[p] >> (8 - j))
                    counts[node][seq[p] >> (7 - j) & 1] += 1
                    if d:
                        children[context[:-1], node[1]].add(node)
    kt = lambda a, b: math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.log(math.pi) - math.lgamma(a + b + 1)
    weighted = {}
    for node in sorted(counts, key=lambda n: -len(n[0])):
        own = kt(*counts[node])
        weighted[node] = own if len(node[0]) == depth else math.log(0.5) + np.logaddexp(own, sum(weighted[c] for c in children[node]))

    def predict(context, bits, bit):
        mixed, rest = 0.0, 1.0
        for d in range(depth + 1):
            node = (context[:d], bits)
            if node not in counts:
                # the path leaves the tree: what is left of the weight falls to the empty "other" branch
                return mixed + rest * 0.5
            a, b = counts[node]
            p = ((b if bit else a) + 0.5) / (a + b + 1)
            share = 1.0 if d == depth else math.exp(math.log(0.5) + kt(a, b) - weighted[node])
            mixed, rest = mixed + rest * share * p, rest * (1 - share)
        return mixed

    def score(t):
        seq, out = pad + list(t) + [255], 0.0
        for p in range(7, len(seq)):
            context = tuple(seq[p - 1 - j] for j in range(depth))
            out += sum(math.log10(predict(context, (1 << j) | seq[p] >> (8 - j), seq[p] >> (7 - j) & 1)) for j in range(8))
        return out

    return score


def test_ctw_tree_is_the_weighted_mixture():
    texts = [b"abracadabra abra", b"banana bandana", b"", b"abab" * 10]
    keys, n = ctw._count(ctw.strings(texts)[0])
    levels = [ctw.nodes_of(*ctw._count(keys >> np.uint64(8 * (ctw.DEPTH - d)), n), d) for d in range(ctw.DEPTH + 1)]
    tree, score = Tree(levels), brute_tree(texts, ctw.DEPTH)
    probe = [*texts, b"abrand", b"zzz", b"band abra"]
    assert np.allclose(tree.score(probe), [score(t) for t in probe], atol=1e-4)


def test_ctw_scores_do_not_depend_on_the_cache(spark, docs, rows):
    """Every training context counts, also what the tasks are not handed."""
    training = [t.encode() for i, t in rows if zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1]
    keys, n = ctw._count(ctw.strings(training)[0])
    tree = Tree([ctw.nodes_of(*ctw._count(keys >> np.uint64(8 * (ctw.DEPTH - d)), n), d) for d in range(ctw.DEPTH + 1)])
    want = defaultdict(list)
    for (i, _), x in zip(rows, tree.score([t.encode() for _, t in rows]), strict=True):
        want[i].append(x)
    got = defaultdict(list)
    for r in ctw.score_texts(docs, nodes=500).collect():
        got[r.doc_id].append(r.score)
    assert got.keys() == want.keys() and all(np.allclose(sorted(got[i]), sorted(want[i]), rtol=1e-4, atol=1e-2) for i in want)
    whole, parted = (sorted_rows(ctw.score_texts(docs, part_bytes=n), "doc_id", "n_known", "train_tokens", F.round("score", 3)) for n in (ctw.PART_BYTES, 100_000))
    assert whole == parted  # adding up in parts changes nothing
    in_parts = sorted_rows(ctw.score_texts(docs, nodes=500, ask_most=300), "doc_id", "n_known", "train_tokens", F.round("score", 1))
    assert in_parts == sorted_rows(ctw.score_texts(docs, nodes=500), "doc_id", "n_known", "train_tokens", F.round("score", 1))  # nor do questions in parts
    none = ctw.score_texts(spark.createDataFrame([(i, "abc") for i in range(200)], "doc_id long, text string").where(F.crc32(F.col("doc_id").cast("string")) % 5 == 1)).collect()
    assert none and all(abs(r.bits_per_byte - 8) < 1e-6 for r in none)


def test_ctw_rows_may_come_in_another_order_each_time(docs, rows):
    """A task that reads its rows anew can get them in another order; passes meet by id and text."""
    restless = docs.mapInPandas(lambda parts: (p.sample(frac=1) for p in parts), docs.schema)
    columns = ("doc_id", "held_out", "n_tokens", "n_known", F.round("base_score", 4), F.round("score", 1))
    got = sorted_rows(ctw.score_texts(restless), *columns)
    assert got == sorted_rows(ctw.score_texts(docs), *columns) and len(got) == len(rows)


# ---- 2


def brute_spans(rows, size, least):
    places = defaultdict(list)
    parts = [(key(i), sentence_spans.sentences(t)) for i, t in rows]
    for n, (i, s) in enumerate(parts):
        words = [x.encode().split() for x in s]
        for a in range(len(s) - size + 1):
            if sum(map(len, words[a : a + size])) >= least:
                places[tuple(tuple(w) for w in words[a : a + size])].append((i, a, n))
    gone = defaultdict(set)
    for found in places.values():
        first = min(found)[:2]
        for i, a, n in found:
            earlier = any(m == n and b < a for _, b, m in found)
            if i != first[0] or earlier:
                gone[n].update(range(a, a + size))
    return [(i, len(s), len(gone[n]), hashlib.sha256("".join(x for k, x in enumerate(s) if k not in gone[n]).encode()).hexdigest()) for n, (i, s) in enumerate(parts)]


def test_sentence_spans(docs, rows):
    out = sentence_spans.span_dedup(docs)
    got = [(key(r.doc_id), r.n_sentences, r.n_removed, r.kept_sha256) for r in out.collect()]
    # rows that repeat an id are one document, so both rows of id 100003 drop what repeats inside them
    assert sorted(got) == sorted(brute_spans(rows, sentence_spans.SIZE, sentence_spans.MIN_WORDS))
    assert any(n for _, _, n, _ in got)


def test_rows_of_one_id_lose_only_their_own_spans(spark):
    """One id over several texts, null ids too: a row loses what its own text shares, and nothing else."""
    text = lambda k: " ".join(f"{w} {w}a {w}b {w}c {w}d." for w in (f"w{k}x{i}" for i in range(6)))
    rows = [(1, text(1)), (5, text(1)), (5, text(2)), (5, text(1) + "\n" + text(3)), (None, text(4)), (None, text(5)), (7, text(5)), (8, text(2)), (5, text(2))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for bits in (1 << 27, 64):  # also with a full filter
        found = sentence_spans.repeated_sentences(frame, max_bits=bits).collect()
        assert sorted((key(r.found_key), tuple(r.starts)) for r in found) == [(5, (0, 1, 2, 3)), (5, (0, 1, 2, 3)), (7, (0, 1, 2, 3)), (8, (0, 1, 2, 3))]
    for run_words in (0, sentence_spans.RUN):
        got = Counter((r.doc_id, r.text) for r in sentence_spans.span_dedup(frame, run_words=run_words).collect())
        assert all(got[r] for r in [(1, text(1)), (5, text(2)), (None, text(4)), (None, text(5))]) and got[5, text(2)] == 2
        assert got[5, ""] == 1 and got[7, ""] == 1 and got[8, ""] == 1 and got[5, text(3)] == 1


def test_passage_of_three_sentences_is_found(spark):
    words = lambda n, k: " ".join(f"w{k}x{i}" for i in range(n))
    passage = f"{words(20, 1)}. {words(20, 2)}. {words(15, 3)}. "
    frame = spark.createDataFrame([(i, f"{words(10, 10 + i)}. {passage}{words(9, 50 + i)}.") for i in range(6)], "doc_id long, text string")
    out = {r.doc_id: r for r in sentence_spans.span_dedup(frame).collect()}
    assert out[0].n_removed == 0 and all(out[i].n_removed == 3 and "w2x1 " not in out[i].text and out[i].from_ids == [0] for i in range(1, 6))


def test_every_passage_of_over_fifty_words_is_found(spark, tmp_path):
    """As the query runs it: short lines, one long sentence, and cuts inside sentences on both sides."""
    from facetlake.llm.queries import queries

    r = random.Random(5)
    words = lambda n: [f"w{r.randrange(10**9)}" for _ in range(n)]
    shapes = {"lines": lambda w: "\n" + "".join(f"{a} {b}\n" for a, b in zip(w[::2], w[1::2], strict=True)), "one": lambda w: " " + " ".join(w) + " ", "two": lambda w: " " + " ".join(w[:25]) + ". " + " ".join(w[25:]) + " "}
    rows, passages = [], {}
    for k in range(60):
        passages[k] = w = words(52)
        text = shapes[list(shapes)[k % 3]](w)
        rows += [(2 * k + i, " ".join(words(30)) + text + " ".join(words(30)) + ".") for i in range(2)]
    rows += [(1000 + i, " ".join(words(200))) for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {x.doc_id: x for x in queries()["op2_sentence_spans"](spark, str(tmp_path)).collect()}
    texts = dict(rows)
    for k, w in passages.items():
        first, other = out[2 * k], out[2 * k + 1]
        assert first.n_removed == 0 and first.text == texts[2 * k]
        lost = {x.rstrip(".") for x in texts[2 * k + 1].split()} - {x.rstrip(".") for x in other.text.split()}
        assert other.n_removed > 0 and other.from_ids == [2 * k] and len(lost) >= sentence_spans.RUN and lost <= set(w)
        assert len(texts[2 * k + 1]) - len(other.text) == other.removed_chars
    assert all(out[1000 + i].n_removed == 0 for i in range(20))


# ---- 3


def test_bpe_equals_the_library(docs, rows, tokenizer):
    want = []
    for (i, t), e in zip(rows, tokenizer.encode_batch([t for _, t in rows], add_special_tokens=False), strict=True):
        want.append((i, len(e.ids), hashlib.sha256(struct.pack(f"<{len(e.ids)}I", *e.ids)).hexdigest(), hashlib.sha256(tokenizer.decode(e.ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted_rows(bpe.encode_decode(docs), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=lambda r: tuple((x is not None, x) for x in r))


def test_bpe_on_random_texts_and_a_small_table(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_PIECES", 500)
    rng = random.Random(4)
    texts = ["".join(rng.choice(" \n\tabé'sre12.!<|endoftext|>🙂日 \x1c") for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    coder = bpe.Encoder(bpe.vocabulary_path())
    ids = coder.encode_batch(texts)
    assert ids == [struct.pack(f"<{len(e.ids)}I", *e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [coder.decode(x) for x in ids] == texts
    assert 0 < coder.stats["failed"] < coder.stats["words"]


def test_bpe_exact_merging_agrees():
    coder = bpe.Encoder(bpe.vocabulary_path())
    rng = random.Random(6)
    words = [bytes(rng.choice(b" abcdetrh\xc3\xa9") for _ in range(rng.randint(1, 24))) for _ in range(500)]
    assert [coder.merge(w) for w in words] == [coder.exact(w) for w in words]


# ---- 4


def brute_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts, marked = Counter(windows), set()
    for i, w in enumerate(windows):
        if counts[w] > 1:
            marked |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACE.sub("", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(marked)


def test_quality_rules(docs, rows):
    out = quality_rules.quality_rules(docs, sample_rows=60)
    want = []
    for i, t in rows:
        s = brute_rules(t)
        failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
        named = dict(zip(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), s, strict=True))
        want.append((i, *s, failed, not failed and not any(r(t, named) for r in quality_rules.RULES.values())))
    assert sorted_rows(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept") == sorted(want, key=lambda r: tuple((x is not None, x) for x in r))


def test_rules_equal_their_sql(spark, docs, tmp_path):
    """On the odd cases and on real documents, a rule being broken in each of its ways by some text."""
    import duckdb

    from facetlake.llm.queries import oracle_sql

    good = " ".join(f"word{i} and" for i in range(40))
    extra = [good + " #" * 60, "x " * 200 + good, "Lorem ipsumdolorsitametconsectetur" * 90, (good + "\n") * 4, " ".join(["12345"] * 30 + [str(i) for i in range(90)]), good.upper(), good + " " + " ".join("y" * 50 for _ in range(9)), "\n".join(f"- {w}" for w in good.split()), "\n".join(f"{w} …" for w in good.split()), good]
    rows = docs.select("doc_id", "text").unionAll(spark.createDataFrame(list(enumerate(extra, 500_000)), "doc_id long, text string"))
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    found = con.sql(oracle_sql()["op4_quality_rules"])
    out = quality_rules.quality_rules(rows).drop("failed_rule")
    assert set(found.columns) == set(out.columns)
    order = lambda r: tuple((x is not None, x) for x in r)
    assert sorted((tuple(r) for r in found.select(*out.columns).fetchall()), key=order) == sorted((tuple(r) for r in out.collect()), key=order)


def test_rule_order_prefers_rejections_per_cost():
    slow = lambda t, s: sum(range(20000)) < 0
    measured = quality_rules.measure(["word " * 20 + " ".join(f"w{i}" for i in range(60)), "too short"] * 5, {"slow_never": slow, "quick_always": lambda t, s: True, "slow_always": lambda t, s: sum(range(20000)) > 0})
    assert {k: n for k, (_, n) in measured.items()} == {"slow_never": 0, "quick_always": 5, "slow_always": 5}
    assert quality_rules.order_rules(measured) == ["quick_always", "slow_always", "slow_never"]


def test_rules_are_measured_on_rows_from_all_over(spark, empty):
    """A rule that only texts at the table's end break comes first; whole texts count, also what is far behind their start."""
    good = " ".join(f"word{i}" for i in range(60))
    late = good + " ".join(f" x{i}" for i in range(6000)) + " #" * 2000
    frame = spark.createDataFrame([(i, good if i < 300 else late) for i in range(400)], "doc_id long, text string").repartition(4, "doc_id")
    assert quality_rules.sampled_order(frame, 100)[0] == "symbols"
    assert sorted(quality_rules.sampled_order(empty.select("doc_id", "text"))) == sorted(quality_rules.RULES)


# ---- 5


def test_exact_groups(docs, rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[hashlib.sha256(SPACE.sub(" ", t).encode()).hexdigest()].append(i)
    out = exact_dedup.exact_groups(docs)
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    want = [(i, least(ids), len(ids), sha) for sha, ids in groups.items() for i in ids]
    assert sorted_rows(out, "doc_id", "keep_id", "group_size", "text_sha256") == sorted(want, key=lambda r: tuple((x is not None, x) for x in r))
    assert out.where("kept").count() == len(groups) == out.where("kept").select("text_sha256").distinct().count()


def test_exact_dedup_keeps_one_row_of_each(docs, rows):
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(SPACE.sub(" ", r.text or "") for r in kept.collect()) == sorted({SPACE.sub(" ", t) for _, t in rows})


def test_exact_dedup_with_a_full_filter(docs):
    small = exact_dedup.exact_groups(docs, max_bits=64)
    assert sorted_rows(small, "doc_id", "keep_id", "group_size", "text_sha256") == sorted_rows(exact_dedup.exact_groups(docs), "doc_id", "keep_id", "group_size", "text_sha256")


def test_drop_rows(docs, rows):
    named = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    twice = named.groupBy("doc_id", "text_key").count().where("count > 1")
    lost = named.where("doc_id % 3 = 0 or doc_id is null")
    for bits in (1 << 27, 64):
        kept = exact_dedup.drop_rows(docs, lost, twice.where("doc_id % 3 <> 0"), max_bits=bits)
        assert kept.columns == docs.columns
        assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == sorted({(i, t) for i, t in rows if i is not None and i % 3})


# ---- 6


def brute_fingerprint(text):
    words = text.encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(values, radius):
    label = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(values):
            for j in range(i):
                if label[i] != label[j] and (a ^ values[j]).bit_count() <= radius:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def test_simhash(docs, rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    label = components(prints, 4)
    least = {}
    for (i, _), c in zip(rows, label, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = [(i, f"{p:016x}", least.get(c)) for (i, _), p, c in zip(rows, prints, label, strict=True)]
    got = sorted_rows(simhash.near_duplicates(docs, tile=16), "doc_id", "fingerprint", "component_id")
    assert got == sorted(want, key=lambda r: tuple((x is not None, x) for x in r))


def test_forests_keep_components():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 60, dtype=np.uint64)
    points = np.unique(np.concatenate([base, *(base ^ (np.uint64(1) << rng.integers(0, 64, 60).astype(np.uint64)) for _ in range(5))]))
    dense = np.unique(np.array([0xABC ^ 1 << i ^ 1 << j for i in range(30) for j in range(40)], np.uint64))
    for values in (points, dense):
        want = components([int(x) for x in values], 4)
        where = {int(x): k for k, x in enumerate(values)}
        for limit in (1, 1 << 30):
            simhash.DENSE = limit
            up = list(range(len(values)))

            def root(i, up=up):
                while up[i] != i:
                    i = up[i]
                return i

            for a, b in simhash.forest_of(values, None, 4):
                i, j = sorted((root(where[a]), root(where[b])))
                up[j] = i
            assert [root(i) for i in range(len(values))] == want
    simhash.DENSE = 1 << 18


def test_near_dedup_keeps_the_smallest(docs):
    out = simhash.near_duplicates(docs)
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in out.collect() if r.doc_id == r.component_id or (r.doc_id is None and r.component_id is None)}


def test_near_dedup_keeps_one_row_of_each_class(spark):
    """Also where ids are null or repeated, with the same or another text."""
    words = [f"w{i}" for i in range(400)]
    a, b, c = " ".join(words), " ".join([*words[:-1], "other"]), " ".join(reversed(words))
    assert (brute_fingerprint(a) ^ brute_fingerprint(b)).bit_count() <= 4 < (brute_fingerprint(a) ^ brute_fingerprint(c)).bit_count()
    rows = [(5, a), (5, a), (5, b), (7, a), (None, b), (5, c), (None, "alone of all"), (None, "alone of all"), (9, None), (9, ""), (3, "quite another text of seven words")]
    kept = simhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    got = [(r.doc_id, r.text or "") for r in kept]
    assert sorted(got, key=str) == sorted([next(x for x in got if x in ((5, a), (5, b))), (5, c), (None, "alone of all"), (9, ""), (3, rows[-1][1])], key=str)


def test_tiles_of_any_size_give_the_same_classes(spark):
    rng = np.random.default_rng(6)
    base = rng.integers(-(1 << 62), 1 << 62, 300)
    values = np.unique(np.concatenate([base, base ^ (1 << rng.integers(0, 62, 300)), base ^ (7 << rng.integers(0, 58, 300))]))
    frame = spark.createDataFrame([(int(x),) for x in values], "fp long")
    label = components([int(x) & (1 << 64) - 1 for x in values], 4)
    want = Counter(Counter(label).values())
    for tile in (20, 1 << 17):
        edges = {tuple(r) for r in simhash.links(frame, 4, tile).collect()}
        up = {int(x): int(x) for x in values}

        def root(x, up=up):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in edges:
            up[root(a)] = root(b)
        assert Counter(Counter(root(int(x)) for x in values).values()) == want


# ---- 7


def test_pii_base(docs, rows):
    out = {(r.doc_id, r.base_sha256) for r in pii.find_pii(docs).collect()}
    email, card = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]([\x20-]?[0-9])+")
    ip, phone = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

    def check(d):
        total = 0
        for k, c in enumerate(reversed(d)):
            x = int(c) * (1 + k % 2)
            total += x - 9 if x > 9 else x
        return total % 10 == 0

    want = set()
    for i, t in rows:
        spans = [("email", *m.span()) for m in email.finditer(t)]
        spans += [("ip", *m.span()) for m in ip.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
        spans += [("card", *m.span()) for m in card.finditer(t) if 13 <= len(d := re.sub("[^0-9]", "", m[0])) <= 19 and check(d)]
        spans += [("phone", *m.span()) for m in phone.finditer(t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        want.add((i, hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()))
    assert out == want


def test_pii_field_on_unseen_sentences_and_clean_text():
    field = pii.trained()
    right = wrong = total = 0
    for text, gold in pii._sentences(120, 321):
        chunks = [m.span() for m in pii._CHUNK.finditer(text)]
        found = set(field.decode(pii.Lattice(text, chunks)))
        right, wrong, total = right + len(found & set(gold)), wrong + len(found - set(gold)), total + len(gold)
    assert right >= 0.97 * total and wrong <= 0.03 * total
    for clean in ("In 1999, 12 of 345 cost 3.50 at 10:30.", "See 1.2.3 and 2023-05-06, or page 1000000.", "a@b", ""):
        assert pii.all_spans(clean, field) == ([], [])
    text = "call (606) 555-7814 or +1 (269) 555-3296 4524132264652876, password=135299847ac0e0f0dc"
    base, every = pii.all_spans(text, field)
    assert [k for k, *_ in every] == ["card", "phone", "phone", "secret"] and set(base) <= set(every)
    assert pii.mask(text, every) == "call <phone> or <phone> <card>, <secret>"


def test_pii_across_line_ends_in_texts_of_any_length():
    field = pii.trained()
    for wrapped in ("please call\n(415)\n555-0132 today", "so api_key:\n9f86d081884c7d659a2feaa0c55ad015a3bf4f1b it was", "the iban\nDE44 5001\n0517 5407 3249 31 is hers"):
        found = pii.all_spans(wrapped, field)[1]
        assert found
        for around in ("calm words stand here\n" * 20, "calm words stand here\n" * 300):
            shifted = [(k, a + len(around), b + len(around)) for k, a, b in found]
            assert pii.all_spans(around + wrapped + "\n" + around, field)[1] == shifted


def test_field_decodes_the_best_of_all_segmentations():
    """Against enumeration of every way to cut and name a few chunks, with arbitrary weights."""
    rng = np.random.default_rng(4)
    texts = ["call 555 now", "a 12 34 b", "1 2 3 4", "token: abcdefghijkl x", "no trigger here", "x [at] y [dot] com 7"]
    for text in texts:
        field = pii.Field()
        field.weights += rng.normal(0, 1, field.weights.shape)
        field.moves += rng.normal(0, 1, field.moves.shape)
        x = pii.Lattice(text, [m.span() for m in pii._CHUNK.finditer(text)])
        scores = field._scores(x)

        def every(at, before, x=x, scores=scores, field=field):  # (score, entities) of all segmentations from chunk ``at`` on
            if at == x.n:
                yield 0.0, []
                return
            for j in range(at + 1, x.n + 1):
                for i, s in scores[j]:
                    if i == at:
                        for y in np.flatnonzero(np.isfinite(s)).tolist():
                            for rest, found in every(j, y):
                                yield s[y] + field.moves[before, y] + rest, [*([(at, j, y)] if y else []), *found]

        best = max(every(0, 0), key=lambda r: r[0])
        assert field.decode(x) == best[1], text


def test_secrets_of_letters_and_long_stretches():
    field = pii.trained()
    kinds = lambda t: [k for k, *_ in pii.all_spans(t, field)[1]]
    assert kinds("my password=correcthorsebattery is") == ["secret"] and kinds("use token: abcdefghijklmnop for it") == ["secret"]
    assert kinds("the secret: nobody knew, and token values are fine; a password is needed") == []
    numbers = " ".join(str(1000 + k % 9000) for k in range(3000))  # one stretch that no gap divides
    found = pii.all_spans(f"{numbers} then password=correcthorsebattery {numbers}", field)[1]
    assert ("secret", len(numbers) + 6, len(numbers) + 34) in found


def test_added_spans_on_documents():
    """Planted data of the documents: secrets by their form, card numbers wherever they stand."""
    import duckdb

    texts = [r[0] for r in duckdb.sql("select text from '/root/testdata/sf0.1/documents.parquet' where text is not null and doc_id % 4 = 0").fetchall()]
    field, hit, total = pii.trained(), Counter(), Counter()
    for t in texts:
        want = [("secret", *m.span(1)) for m in re.finditer(r"(?:token|password|secret|api_key) ?[=:] ?[\"']?(\w{12,})", t)]
        want += [("card", *m.span()) for m in re.finditer(r"(?<![\d-])(?:\d{16}|\d{4}(?:[ -]\d{4}){3})(?!\d)", t) if pii.luhn(re.sub(r"\D", "", m[0]))]
        every = pii.all_spans(t, field)[1] if want else []
        for k, a, b in want:
            total[k] += 1
            hit[k] += any(x <= a and b <= y for _, x, y in every)
    assert total["secret"] > 20 and total["card"] > 20 and all(hit[k] >= 0.9 * total[k] for k in total), (hit, total)


def test_field_gradient_is_that_of_the_likelihood():
    text, gold = pii._sentences(1, 5)[0]
    x = pii.Lattice(text, [m.span() for m in pii._CHUNK.finditer(text)])
    field = pii.Field()
    rng = np.random.default_rng(0)
    field.weights += rng.normal(0, 0.3, field.weights.shape)
    field.moves += rng.normal(0, 0.3, field.moves.shape)

    def likelihood():
        scores = field._scores(x)
        alpha = np.full((x.n + 1, len(field.moves)), -np.inf)
        alpha[0, 0] = 0
        for j in range(1, x.n + 1):
            for i, s in scores[j]:
                alpha[j] = np.logaddexp(alpha[j], np.logaddexp.reduce(alpha[i][:, None] + field.moves, axis=0) + s)
        at, before, own = 0, 0, 0.0
        starts = {i: (j, y) for i, j, y in gold}
        while at < x.n:
            j, y = starts.get(at, (at + 1, 0))
            own += field.moves[before, y] + next(s for i, s in scores[j] if i == at and np.isfinite(s[y]))[y]
            at, before = j, y
        return own - np.logaddexp.reduce(alpha[x.n])

    w, m = field.gradient(x, gold)
    for values, g, place in ((field.weights, w, (0, 0)), (field.weights, w, np.unravel_index(np.abs(w).argmax(), w.shape)), (field.moves, m, (0, 0)), (field.moves, m, (0, 1))):
        values[place] += 1e-5
        up = likelihood()
        values[place] -= 2e-5
        down = likelihood()
        values[place] += 1e-5
        assert abs((up - down) / 2e-5 - g[place]) < 1e-4


def test_mask_pii(docs, rows):
    out = pii.mask_pii(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert not [r for r in out.collect() if r.text and pii.base_spans(r.text)]
    assert out.where("text is null").count() == 1 and out.where("text is not null and n_chars <> length(text)").count() == 0


# ---- 8


def test_quality_classifier_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = nbsvm.score_quality(docs, nbsvm.train(docs, labels)).join(labels, "doc_id")
    held = out.where("held_out").collect()
    assert sum(r.predicted == r.quality for r in held) >= 0.93 * len(held)
    assert all(r.predicted == 1 for r in held if r.quality == 1)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out.collect())


def test_quality_classifier_odd_cases(spark, docs, rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (None, 0, 0), (3, None, 0), (3, 1, None)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        out = nbsvm.score_quality(docs, nbsvm.train(docs, labels)).collect()
        assert len(out) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in out)


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(0, 50, 8) + 50 * (i % 2)).astype(np.int32) for i in range(60)]
    y = np.array([i % 2 for i in range(60)])
    model = nbsvm.fit(rows, y)
    assert all((model.margin(x) > 0) == bool(k) for x, k in zip(rows, y, strict=True))


def test_dual_coordinate_descent_is_exact():
    """Against a slow solver of the same dual problem: projected gradient steps, and the gap between primal and dual."""
    rng = np.random.default_rng(2)
    rows = [np.unique(rng.integers(0, 30, 6)).astype(np.int32) for _ in range(24)]
    y = np.where(rng.random(24) < 0.5, 1.0, -1.0)
    ratio, cost = rng.normal(0, 1, 30), 0.7
    dense = np.zeros((24, 31))
    for i, x in enumerate(rows):
        v = ratio[x]
        dense[i, x] = v / np.sqrt(v @ v)
    dense[:, 30] = 1.0
    q = (dense @ dense.T) * y[:, None] * y[None, :]
    alpha = np.zeros(24)
    top = np.linalg.eigvalsh(q)[-1]
    for _ in range(60000):
        alpha = np.clip(alpha - (q @ alpha - 1) / top, 0, cost)
    slow = dense.T @ (alpha * y)
    weight, bias = nbsvm.fit_svm(rows, np.arange(24), y, ratio, cost, epochs=4000, stop=1e-10)
    assert np.allclose(np.append(weight, bias), slow, atol=1e-4)
    primal = lambda w: 0.5 * w @ w + cost * np.maximum(0, 1 - y * (dense @ w)).sum()
    assert primal(np.append(weight, bias)) - (alpha.sum() - 0.5 * alpha @ q @ alpha) < 1e-4


def test_packed_features_and_repeated_ids(spark):
    r = random.Random(3)
    long = bytes(r.randrange(256) for _ in range(120_000)).decode("latin-1")
    for text in ("", "a", "some words", long):
        x = nbsvm.features(text)
        assert np.array_equal(nbsvm.unpacked(nbsvm.packed(x)), x) and len(nbsvm.packed(x)) <= 1 << nbsvm.BITS - 3
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame([(i, f"{'good fine' if i % 2 else 'bad poor'} text {i}") for i in ids for _ in range(3)] + [(ids[0], "zzz " * 1000)] * 500, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    once = spark.createDataFrame([(i, f"{'good fine' if i % 2 else 'bad poor'} text {i}") for i in ids], "doc_id long, text string")
    a, b = nbsvm.train(docs, labels), nbsvm.train(once, labels)
    assert np.array_equal(a.weight, b.weight) and a.bias == b.bias
    out = nbsvm.score_quality(docs, a)
    assert out.count() == docs.count() and {r.predicted for r in out.where("doc_id % 2 = 1").collect()} == {1}


# ---- 9


def brute_strings(rows, size=50):
    seen, out = {}, []
    for i, t in sorted(rows, key=lambda r: key(r[0])):
        raw = t.encode()
        mark = bytearray(len(raw))
        for a in range(len(raw) - size + 1):
            first = seen.setdefault(raw[a : a + size], key(i))
            if first < key(i):
                mark[a : a + size] = b"\1" * size
        kept = bytes(x for x, m in zip(raw, mark, strict=True) if not m)
        runs = sum(1 for k, m in enumerate(mark) if m and (k == 0 or not mark[k - 1]))
        out.append((i, len(raw), sum(mark), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def test_substring_dedup(docs, rows):
    assert sorted_rows(suffix_dedup.substring_dedup(docs), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_strings(rows)


def test_substring_dedup_on_repetitive_texts(spark):
    rng = random.Random(8)
    pieces = ["".join(rng.choice("ab") for _ in range(rng.randint(20, 90))) for _ in range(12)]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))) for i in range(80)] + [(500 + i, "abc" * n) for i, n in enumerate((10, 17, 400, 700))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted_rows(suffix_dedup.substring_dedup(frame), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_strings(rows)


def test_rows_of_one_id_lose_only_their_own_bytes(spark):
    """One id over several texts, null ids, repeated rows; also with a bucket's anchors in several parts."""
    rng = random.Random(11)
    text = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    p, q, r = text(240), text(243), text(70)
    rows = [(1, p), (5, p), (5, q), (5, q + p), (5, q), (None, r), (None, q[:100]), (7, r + text(20)), (8, p[30:150] + q)]
    rows += [(100 + i, text(40) + rng.choice((p, q, r))[:90] + text(30)) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for part_bytes, hot in ((suffix_dedup.PART_BYTES, suffix_dedup.HOT_DOCUMENTS), (2000, suffix_dedup.HOT_DOCUMENTS), (suffix_dedup.PART_BYTES, 3), (2000, 3)):
        got = sorted_rows(suffix_dedup.substring_dedup(frame, part_bytes=part_bytes, hot_documents=hot), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
        assert got == brute_strings(rows)


def test_a_phrase_in_every_document_is_no_one_bucket_s_work(spark):
    """One phrase with other words around it in each document, null ids too: same result, and no bucket gets a share of the segments that grows with the documents."""
    rng = random.Random(12)
    text = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    # A phrase whose hash is so small that it is the anchor of whatever holds it.
    phrase = min((text(30) for _ in range(500)), key=lambda p: suffix_dedup._substring_hashes(np.frombuffer(p.encode(), np.uint8), suffix_dedup.ANCHOR).min())
    longer = text(20) + phrase + text(20)
    rows = [(None if i % 3 == 0 else i, text(60) + (longer if i % 10 == 0 else phrase) + text(60)) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want, most = brute_strings(rows), {}
    assert sum(r[2] > 0 for r in want) > 20
    buckets = suffix_dedup.BUCKETS
    for hot in (1 << 30, 50):
        assert sorted_rows(suffix_dedup.substring_dedup(frame, hot_documents=hot), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
        keyed = suffix_dedup._keyed(frame, "doc_id", "text")
        held = keyed.select("row_key", "text").mapInArrow(suffix_dedup._send_anchors(buckets, 1), "bucket int, part int, ids binary, docs binary, which binary").groupBy("bucket").applyInArrow(suffix_dedup._shared_anchors(hot), "row_key long, anchor int, hot long")
        lists = held.groupBy("row_key").agg(F.collect_list("anchor").alias("shared"), F.collect_list("hot").alias("hot"))
        sent = keyed.join(lists, "row_key").select("doc_key", "text_key", "shared", "hot", "text").mapInArrow(suffix_dedup._send_segments(buckets), "bucket int, doc_key long, text_key long, ranges binary, anchors binary, docs binary, texts binary, which binary, starts binary, ends binary, bytes binary")
        most[hot] = sent.groupBy("bucket").agg(F.sum(F.octet_length("anchors") / 4).alias("n")).agg(F.max("n")).first()[0]
    assert most[1 << 30] > 300 and most[50] < 120


def test_substring_dedup_moves_little(spark):
    """Copies of whole texts send no segments, windows of hot anchors send their hash alone, and texts are moved once; nulls, repeated ids and short copies too."""
    rng = random.Random(13)
    text = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    phrase = min((text(30) for _ in range(500)), key=lambda p: suffix_dedup._substring_hashes(np.frombuffer(p.encode(), np.uint8), suffix_dedup.ANCHOR).min())
    once = [(i, text(60) + phrase + text(60)) for i in range(100)] + [(100, "short"), (101, ""), (102, None)]
    rows = [(i + 200 * k, t or "") for k in range(6) for i, t in once] + [(None, once[7][1]), (8, once[9][1]), (8, text(200)), (5000, once[8][1]), (5000, once[8][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want, columns = brute_strings(rows), ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    for some in (frame, frame.where("doc_id < 5000 and doc_id <> 8")):  # with ids that repeat, and without
        got = suffix_dedup.substring_dedup(some, hot_documents=20)
        got.collect()
        assert got._jdf.queryExecution().executedPlan().toString().count("ReusedExchange") >= 2
    assert sorted_rows(suffix_dedup.substring_dedup(frame, hot_documents=20), *columns) == want
    named, copies, total = suffix_dedup._named(frame, "doc_id", "text")
    assert copies.count() == 5 * 100 + 1 + 1 + 2 and total == sum(len(t) for _, t in rows)  # the first of the null id's text, the eighth's that the ninth has, and two rows of one id
    alone = named.join(copies, F.col("row_key") == F.col("copy_key"), "left_anti")
    held = alone.mapInArrow(suffix_dedup._send_anchors(256, 1), "bucket int, part int, ids binary, docs binary, which binary").groupBy("bucket").applyInArrow(suffix_dedup._shared_anchors(20), "row_key long, anchor int, hot long")
    lists = held.groupBy("row_key").agg(F.collect_list("anchor").alias("shared"), F.collect_list("hot").alias("hot"))
    sent = alone.join(lists, "row_key").select(F.col("row_key").alias("doc_key"), F.lit(0).alias("text_key"), "shared", "hot", "text").mapInArrow(suffix_dedup._send_segments(256), "bucket int, doc_key long, text_key long, ranges binary, anchors binary, docs binary, texts binary, which binary, starts binary, ends binary, bytes binary")
    n, size = sent.agg(F.sum(F.octet_length("anchors") / 4), F.sum(F.octet_length("bytes"))).first()
    assert n > 1000 and size <= 20 * n


def test_packed_numbers():
    for numbers in ([], [5], [-(1 << 63), (1 << 63) - 1, 0, -1], list(range(10**6, 10**6 + 5000, 3)), [random.Random(i).getrandbits(63) for i in range(100)]):
        assert suffix_dedup._unpack(suffix_dedup._pack(np.array(numbers, np.int64))).tolist() == numbers
    assert len(suffix_dedup._pack(np.arange(7, 40_007, 2))) < 200


def test_index_interval_of_each_window():
    rng = random.Random(9)
    texts = ["".join(rng.choice("ab") for _ in range(60)).encode() for _ in range(5)] * 3
    texts = [t[rng.randint(0, 9) :] for t in texts]
    docs = np.array([rng.randint(0, 5) for _ in texts])
    found = suffix_dedup.RunLengthIndex(texts, docs).stream(docs)
    for t, d, at in zip(texts, docs, found, strict=True):
        want = [a for a in range(len(t) - 49) if any(e < d and t[a : a + 50] in u for u, e in zip(texts, docs, strict=True))]
        assert at.tolist() == want


# ---- 10


def test_packing(docs, rows, tokenizer):
    out = packing.pack(docs).collect()
    want = Counter()
    for e in tokenizer.encode_batch([t for _, t in rows], add_special_tokens=False):
        want[tuple(e.ids + [0])] += 1
    by_id = defaultdict(list)
    for (i, _), e in zip(rows, tokenizer.encode_batch([t for _, t in rows], add_special_tokens=False), strict=True):
        by_id[i].append(e.ids + [0])
    tokens = Counter()
    for r in out:
        ids = by_id[r.doc_id][0][r.start : r.start + r.length]
        assert r.length >= 1 and r.doc_tokens == len(by_id[r.doc_id][0]) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))
        tokens[r.doc_id] += r.length
    assert tokens == {i: sum(map(len, x)) for i, x in by_id.items()}
    for i, texts in by_id.items():  # every id lies in exactly one piece (of each of the rows with that doc_id)
        covered = Counter(k for r in out if r.doc_id == i for k in range(r.start, r.start + r.length))
        assert set(covered.values()) == {len(texts)} and len(covered) == len(texts[0])
    sequences = defaultdict(list)
    for r in out:
        sequences[r.sequence_id].append((r.offset, r.length))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
        padding += 0 if at & (at - 1) == 0 else 1024 - at
    assert padding == 0


def test_packing_with_other_capacities(spark, docs, rows, tokenizer):
    """Small sequences, so that there are full runs, ranks over several tasks and items of every length."""
    want = Counter(len(e.ids) + 1 for e in tokenizer.encode_batch([t for _, t in rows], add_special_tokens=False))
    for capacity in (8, 24):
        out = packing.pack(docs, capacity=capacity).collect()
        sequences = defaultdict(list)
        for r in out:
            sequences[r.sequence_id].append((r.offset, r.length))
        for pieces in sequences.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at == capacity or at & (at - 1) == 0
        assert sum(r.length for r in out) == sum(n * k for n, k in want.items())


def test_price_is_the_best_pattern():
    rng = random.Random(12)
    for _ in range(30):
        capacity = rng.randint(6, 14)
        lengths = sorted(rng.sample(range(1, capacity + 1), rng.randint(1, 5)))
        duals = np.array([rng.uniform(-1, 4) for _ in lengths])
        costs = np.array([packing.padded(s, capacity) for s in range(capacity + 1)], np.float64)

        def every(k, room):  # all patterns of the lengths from k on
            if k == len(lengths):
                yield {}
                return
            for n in range(room // lengths[k] + 1):
                for rest in every(k + 1, room - n * lengths[k]):
                    yield {k: n, **rest} if n else rest

        value = lambda p: sum(duals[j] * n for j, n in p.items()) - costs[sum(lengths[j] * n for j, n in p.items())]
        worth, pattern = packing.price(duals, np.array(lengths), costs)
        assert abs(worth - max(value(p) for p in every(0, capacity) if p)) < 1e-9 and abs(worth - value(pattern)) < 1e-9


def test_program_covers_its_items():
    rng = random.Random(2)
    counts = Counter(rng.randint(1, 500) for _ in range(3000))
    solution = packing.solve(counts)
    covered = Counter()
    for pattern, use in solution:
        assert sum(x * k for x, k in pattern.items()) <= 1024
        for x, k in pattern.items():
            covered[x] += k * use
    assert all(abs(covered[x] - n) < 1e-6 * n + 1e-6 for x, n in counts.items())
    cost = sum(packing.padded(sum(x * k for x, k in p.items()), 1024) * u for p, u in solution)
    assert cost <= 1.002 * sum(x * n for x, n in counts.items())
    assert packing.solve({}) == [] and packing.solve({600: 5})


# ---- all


@pytest.mark.parametrize("apply", [ctw.score_texts, sentence_spans.span_dedup, bpe.encode_decode, quality_rules.quality_rules, exact_dedup.exact_groups, exact_dedup.exact_dedup, simhash.near_duplicates, simhash.near_dedup, pii.find_pii, pii.mask_pii, suffix_dedup.substring_dedup, packing.pack])
def test_empty_table(empty, apply):
    assert apply(empty).count() == 0


def test_quality_on_an_empty_table(spark, empty, docs):
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    for learned in (empty, docs):
        model = nbsvm.train(learned, labels)
        assert nbsvm.score_quality(empty, model).count() == 0
        kept = nbsvm.keep_quality(empty, model)
        assert kept.count() == 0 and kept.columns == empty.columns


@pytest.mark.parametrize("case", ["empty", "odd"])
def test_pipeline_on_odd_tables(spark, docs, tokenizer, tmp_path, case):
    """An empty table; and nulls, repeated ids and rows, very long texts and columns named like the operators' own."""
    import corpus_pipeline

    odd = docs.where("doc_id is null or doc_id >= 100000 or doc_id < 40").drop("persisted")
    odd = odd.unionByName(odd.where("doc_id < 5").withColumn("text", F.concat("text", F.lit(" and some other words"))))
    frame = odd.limit(0) if case == "empty" else odd
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 2, None) for i in range(30)] + [(None, 1, 0), (3, None, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, rows = rows, stage(spark, rows, str(tmp_path))
        assert rows.columns == before.columns, name
        kept = rows.collect()
        assert len(kept) <= before.count() and (case == "empty") <= (not kept)
        if name == "exact_dedup":
            assert len({SPACE.sub(" ", r.text or "") for r in kept}) == len(kept)
        if name == "simhash_near_dedup":
            label = components([brute_fingerprint(r.text or "") for r in kept], 4)
            assert len(set(label)) == len(kept)
    want = Counter()
    for r in rows.collect():
        want[r.doc_id] += len(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id] += r.length
    assert got == want and (case == "empty") == (not got)


def test_pipeline(spark, tokenizer):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    texts, kept = {r.doc_id: r.text for r in docs.collect()}, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, d)
        assert docs.columns == before.columns, name
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    scores = {r.doc_id: r.predicted for r in nbsvm.score_quality(spark.read.parquet(f"{d}/documents.parquet"), nbsvm.train(spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet"))).collect()}
    assert set(kept["quality_classifier"]) == {i for i, p in scores.items() if p}
    first = {}
    for i in sorted(kept["quality_classifier"]):
        first.setdefault(SPACE.sub(" ", texts[i]), i)
    assert set(kept["exact_dedup"]) == set(first.values())
    ids = sorted(kept["exact_dedup"])
    label = components([brute_fingerprint(texts[i]) for i in ids], 4)
    assert set(kept["simhash_near_dedup"]) == {ids[k] for k in set(label)}
    field = pii.trained()
    assert kept["pii"] == {i: pii.mask(texts[i], pii.all_spans(texts[i], field)[1]) for i in kept["simhash_near_dedup"]}
    total = Counter()
    for r in corpus_pipeline.run(spark, d).collect():
        total[r.doc_id] += r.length
    assert total == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept["pii"].items()}


def test_pii_patterns_are_the_contract_s_and_take_linear_time():
    email, ip = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    rng = random.Random(1)
    for _ in range(30000):
        text = "".join(rng.choice("a1.@-_% +2.@é") for _ in range(rng.randint(0, 30)))
        assert list(pii._emails(text)) == [m.span() for m in email.finditer(text)]
        assert [m.span() for m in pii._IP.finditer(text)] == [m.span() for m in ip.finditer(text)]
    field, n = pii.trained(), 1_000_000
    for text in ("a" * n + " x@y.com", "a" * n + "@", "1" * n + " .", "." * n + "@1", "+" * n + "1@", "1." * (n // 2) + "@", "a@" * (n // 2), "+1" + "(" * n, "password=" * (n // 9)):
        began = time.process_time()
        pii.all_spans(text, field)
        assert time.process_time() - began < 2, text[:20]


def test_pii_added_spans_overlap_no_base_span():
    field = pii.trained()
    text = " ".join(f"a{i}@b.c.d 10.0.{i % 256}.1 x password={i}abcdef{i}, +1 555 010 {i:04}" for i in range(300))
    base, every = pii.all_spans(text, field)
    added = sorted((a, b) for s in every if s not in base for _, a, b in [s])
    assert added and all(b <= c for (_, b), (c, _) in zip(added, added[1:]))
    assert not any(a < d and c < b for a, b in added for _, c, d in base)


def test_a_full_table_of_pieces_keeps_what_came_again(monkeypatch, tokenizer):
    rng = random.Random(21)
    often = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    texts = [" ".join(rng.choice(often) if rng.random() < 0.7 else "".join(rng.choice("hijklmnop") for _ in range(9)) for _ in range(30)) for _ in range(200)]
    monkeypatch.setattr(bpe, "MOST_PIECES", 600)
    monkeypatch.setattr(bpe, "TOGETHER", 20)
    e, sizes = bpe.Encoder(bpe.vocabulary_path()), []
    for at in range(0, 200, 20):
        got = e.encode_batch(texts[at : at + 20])
        assert [np.frombuffer(c, "<u4").tolist() for c in got] == [x.ids for x in tokenizer.encode_batch(texts[at : at + 20], add_special_tokens=False)]
        sizes.append(len(e.index))
        assert len(e.index) == len(e.held) == len(e.piece_at) == len(e.piece_n) and list(e.index.values()) == list(range(len(e.index)))
    assert sizes != sorted(sizes) and sum(w in e.index for w in often) > 40
