"""Code length of texts by context-tree weighting over binary-decomposed bytes.

A text is its UTF-8 bytes and an end mark; a byte is eight binary decisions, most significant first. The decision's node is the last
d bytes (d = 0 to ``DEPTH``) and the bits so far. Each node has a Krichevsky-Trofimov estimate; its weighted probability is the
half-and-half mixture of that estimate and the product over the contexts one byte longer, so a prediction mixes the estimates of all
depths by their posterior weights.

The corpus is counted whole and every context keeps its own node, whatever the size: tasks count the (byte, context) strings of their texts, buckets by
the three nearest bytes add them up and hold whole subtrees below depth 2. A bucket weighs its subtrees; their sums weigh the top (depths 0 to 2, at most
2^24 nodes as there are bytes, however long the corpus), and a prediction is that of the top mixed with that of the subtree. Tasks are handed the
probabilities of the most frequent strings, at most ``NODES // 2`` of them, as a cache; all other strings are asked for by a shuffle in their bucket,
so scores do not depend on the cache's size. Word counts for the base score go the same way: the ``WORDS`` most frequent are handed out, and the others are looked up.

Defined cases: null text is empty (one end token); a null id hashes as the empty text; repeated rows count repeatedly; with no training text every bit
costs one bit; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetlake.functions.storage import materialize
from facetlake.llm.text import give_back, hash_mod, id_text

DEPTH, NODES, WORDS = 6, 1 << 21, 1 << 18
#: Bytes of text whose counts are added up together before those of a whole bucket are.
PART_BYTES = 8 << 30
#: Questions, as places in texts, that a bucket takes in one piece, and the rows of a list of buckets with more that is broadcast.
ASK_MOST, MOST_HOT = 64 << 20, 100_000
_NO_ID = -(1 << 63)
#: Buckets at least, those of the short strings, text bytes a bucket, text bytes worked on at once, and distinct strings that a task holds.
BUCKETS, SHALLOW, BUCKET_BYTES, FLUSH_BYTES, HELD = 256, 16, 32 << 20, 5 << 20, 6_000_000
_PAD, _END = 0xFE, 0xFF  # bytes that UTF-8 never has
_MIX = np.uint64(0x9E3779B97F4A7C15)


def strings(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(string, text) of every byte and end mark: the byte, then its DEPTH predecessors, nearest first, as one number."""
    pad = bytes([_PAD]) * (8 - 1)
    raw = b"".join(x for t in texts for x in (pad, t, b"\xff"))
    n = len(raw) - 7
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys = np.ndarray((n,), "<u8", raw, strides=(1,)) >> np.uint64(8 * (7 - DEPTH))
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lengths + 8)[7:]
    real = (keys >> np.uint64(8 * DEPTH)) != _PAD
    return keys[real], owner[real]


def _count(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often (or with what sum) each occurs."""
    if weights is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, weights = keys[order], weights[order]
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if weights is None:
        return keys[at], np.diff(np.concatenate([at, [len(keys)]]))
    return keys[at], np.add.reduceat(weights, at) if len(at) else weights


def nodes_of(keys: np.ndarray, counts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, zeros, ones) at one depth, from strings of that depth; a node is its context and the bits so far behind a leading one."""
    width = np.uint64(8 * depth)
    symbol, context = keys >> width, (keys & ((np.uint64(1) << width) - np.uint64(1))) << np.uint64(8)
    node = np.concatenate([context | np.uint64(1 << j) | symbol >> np.uint64(8 - j) for j in range(8)])
    bit = np.concatenate([symbol >> np.uint64(7 - j) & np.uint64(1) for j in range(8)]).astype(bool)
    n = np.tile(counts, 8)
    both, total = _count(node << np.uint64(1) | bit, n)
    node, ones = both >> np.uint64(1), (both & np.uint64(1)).astype(bool)
    at = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(node) else np.zeros(0, np.int64)
    if not len(at):
        return node, total, total
    return node[at], np.add.reduceat(np.where(ones, 0, total), at), np.add.reduceat(np.where(ones, total, 0), at)


def _flushes(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    held, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.append(row)
            size += len(row[1]) + 64
            if size >= FLUSH_BYTES:
                yield held
                held, size = [], 0
    if held:
        yield held


_COUNTED = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
_STRINGS, _TOKENS, _DOCS = 0, 1, 2


def word_bucket(word: bytes, buckets: int) -> int:
    return xxhash.xxh64_intdigest(word) % buckets


def deep_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of strings by the three nearest bytes of their contexts."""
    return ((((keys >> np.uint64(8 * (DEPTH - 3))) & np.uint64(0xFFFFFF)) * _MIX) >> np.uint64(32)) % np.uint64(buckets)


def _split(part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(part, kind="stable")
    cut = np.flatnonzero(np.diff(part[order])) + 1
    for group in np.split(order, cut) if len(order) else []:
        yield int(part[group[0]]), group


def _count_texts(buckets: int):
    def messages(held: list, words: dict[bytes, int]) -> Iterator[tuple]:
        """Empties ``held``; slices are copied one by one, so that a task holds little more than its distinct strings."""
        keys, n = map(np.concatenate, zip(*held, strict=True))
        held.clear()
        keys, n = _count(keys, n)
        for b, g in _split(deep_bucket(keys, buckets).astype(np.int32)):
            yield _STRINGS, b, keys[g].tobytes(), n[g].tobytes()
        short, m = _count(keys >> np.uint64(8 * (DEPTH - 2)), n)
        del keys, n
        near = buckets + (((short & np.uint64(0xFFFF)) * _MIX) >> np.uint64(32)) % np.uint64(SHALLOW)
        for b, g in _split(near.astype(np.int32)):
            yield _STRINGS, b, short[g].tobytes(), m[g].tobytes()
        by: dict[int, list] = defaultdict(list)
        for w, c in words.items():
            by[word_bucket(w, buckets)].append((w, c))
        for b, x in by.items():
            yield _TOKENS, b, b" ".join(w for w, _ in x), np.array([c for _, c in x], np.int64).tobytes()

    def packed(held: list, words: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
        out = messages(held, words)
        while some := list(islice(out, 64)):
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*some, strict=True), _COUNTED, strict=True)], schema=_COUNTED)
        give_back()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        words: Counter = Counter()
        for rows in _flushes(batches):
            raw = [t.encode() for _, t in rows]
            held.append(_count(strings(raw)[0]))
            for t in raw:
                words.update(t.lower().split())
            size += len(held[-1][0])
            if size >= HELD or len(words) >= HELD // 8:
                yield from packed(held, words)
                size = 0
                words = Counter()
        if held:
            yield from packed(held, words)
        give_back()

    return run


def _bins(counts: np.ndarray) -> np.ndarray:
    """How many counts are at least 1, 2, 4, ..."""
    return np.array([np.count_nonzero(counts >= 1 << k) for k in range(48)], np.int64)


def _add_up(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        kind, bucket = table["kind"][0].as_py(), table["bucket"][0].as_py()
        counts = np.concatenate([np.frombuffer(x, np.int64) for x in table["counts"].to_pylist()])
        if kind == _TOKENS:
            total: dict[bytes, int] = {}
            at = 0
            for packed in table["keys"].to_pylist():
                for w in packed.split(b" "):
                    total[w] = total.get(w, 0) + int(counts[at])
                    at += 1
            n = np.fromiter(total.values(), np.int64, len(total))
            keys, bins = b" ".join(total), _bins(n)
        else:
            numbers, n = _count(np.concatenate([np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()]), counts)
            bins = _bins(n if bucket < buckets else n[:0])
            keys = numbers.tobytes()
        give_back()
        return pa.table({"kind": pa.array([kind], pa.int32()), "bucket": pa.array([bucket], pa.int32()), "keys": pa.array([keys], pa.binary()), "counts": pa.array([n.tobytes()], pa.binary()), "bins": pa.array([bins.tolist()], pa.list_(pa.int64()))})

    return run


def _depths(keys: np.ndarray, counts: np.ndarray, shallow: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The strings of a bucket at each depth that it answers for."""
    own = 2 if shallow else DEPTH
    for depth in range(own, -1 if shallow else 2, -1):
        yield (depth, *_count(keys >> np.uint64(8 * (own - depth)), counts))


def _near_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All nodes of depths 0 to 2, from the buckets of short strings."""
    schema = pa.schema([("depth", pa.int32()), ("nodes", pa.binary()), ("zeros", pa.binary()), ("ones", pa.binary())])
    for batch in batches:
        for keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            out = [(depth, *(x.tobytes() for x in nodes_of(k, m, depth))) for depth, k, m in _depths(np.frombuffer(keys, np.uint64), np.frombuffer(counts, np.int64), True)]
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """For x > 0, by Stirling's series seven further on."""
    y, down = x + 7, np.ones_like(x)
    for i in range(7):
        down *= x + i
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - np.log(down)


def log_kt(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return log_gamma(zero + 0.5) + log_gamma(one + 0.5) - np.log(np.pi) - log_gamma(zero + one + 1.0)


def _places(nodes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the wanted nodes stand, and which are there at all."""
    if not len(nodes):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(nodes, wanted), len(nodes) - 1)
    return at, nodes[at] == wanted


def _node(keys: np.ndarray, length: int, depth: int, j: int) -> np.ndarray:
    """The node that decides bit j of strings with contexts of ``length`` bytes, at a depth."""
    context = (keys >> np.uint64(8 * (length - depth))) & np.uint64((1 << 8 * depth) - 1)
    return context << np.uint64(8) | np.uint64(1 << j) | keys >> np.uint64(8 * length + 8 - j)


def _weigh(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], below: np.ndarray | None) -> tuple[list, list, list, list]:
    """By level, of nodes whose contexts are all there: weighted log-probability, what the levels so far give to bit 1, the weight that is left below, and the prediction where the path ends."""
    parent = [np.zeros(0, np.int64)] + [np.searchsorted(levels[d - 1][0], (levels[d][0] >> np.uint64(16)) << np.uint64(8) | levels[d][0] & np.uint64(255)) for d in range(1, len(levels))]
    weighted, share = [None] * len(levels), [None] * len(levels)
    for d in range(len(levels) - 1, -1, -1):
        own = log_kt(levels[d][1].astype(np.float64), levels[d][2].astype(np.float64))
        if d < len(levels) - 1:
            below = np.bincount(parent[d + 1], weighted[d + 1], len(own))
        if below is None:
            weighted[d], share[d] = own, np.ones_like(own)
        else:
            weighted[d] = np.logaddexp(own, below) + np.log(0.5)
            share[d] = np.exp(np.log(0.5) + own - weighted[d])
    mixed, left, ends = [], [], []
    for d, (_, zero, one) in enumerate(levels):
        before, rest = (mixed[-1][parent[d]], left[-1][parent[d]]) if d else (np.zeros(len(zero)), np.ones(len(zero)))
        mixed.append(before + rest * share[d] * (one + 0.5) / (zero + one + 1))
        left.append(rest * (1 - share[d]))
        ends.append(mixed[d] + left[d] * 0.5)
    return weighted, mixed, left, ends


class Top:
    """Depths 0 to 2, weighted with what the buckets' subtrees sum up to below each node of depth 2."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]], nodes: np.ndarray, sums: np.ndarray):
        below = np.zeros(len(levels[2][0]))
        below[np.searchsorted(levels[2][0], nodes)] = sums
        _, mixed, left, self.ends = _weigh(levels, below)
        self.nodes, self.mixed, self.left = [k for k, *_ in levels], mixed[2], left[2]

    def log10_of(self, keys: np.ndarray, subtree: np.ndarray) -> np.ndarray:
        """log10 probability of distinct, ordered strings; ``subtree`` has their subtrees' predictions of each bit."""
        short = keys >> np.uint64(8 * (DEPTH - 2))
        new = np.concatenate([[True], short[1:] != short[:-1]])
        short, back, total = short[new], np.cumsum(new) - 1, np.zeros(len(keys))
        for j in range(8):
            given, left = np.full(len(short), 0.5), np.zeros(len(short))
            for d in range(3):
                at, ok = _places(self.nodes[d], _node(short, 2, d, j))
                given[ok] = (self.mixed if d == 2 else self.ends[d])[at[ok]]
                if d == 2:
                    left[ok] = self.left[at[ok]]
            p = np.clip(given[back] + left[back] * subtree[j], 1e-12, 1 - 1e-12)
            total += np.log10(np.where(keys >> np.uint64(8 * DEPTH + 7 - j) & np.uint64(1), p, 1 - p))
        return total


class Subtrees:
    """All nodes of depths 3 to DEPTH of a bucket."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        levels = [nodes_of(k, m, depth) for depth, k, m in _depths(keys, counts, False)][::-1]
        self.nodes = [k for k, *_ in levels]
        weighted, _, _, self.ends = _weigh(levels, None)
        self.weighted = weighted[0]

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """(node of depth 2, sum of the weighted log-probabilities of its contexts here)."""
        return _count((self.nodes[0] >> np.uint64(16)) << np.uint64(8) | self.nodes[0] & np.uint64(255), self.weighted)

    def predict(self, keys: np.ndarray) -> np.ndarray:
        """Predictions of each bit of distinct strings, by the deepest node that is there."""
        out = np.full((8, len(keys)), 0.5)
        for j in range(8):
            left = np.arange(len(keys))
            for d in range(DEPTH, 2, -1):
                at, ok = _places(self.nodes[d - 3], _node(keys[left], DEPTH, d, j))
                out[j, left[ok]] = self.ends[d - 3][at[ok]]
                left = left[~ok]
                if not len(left):
                    break
        return out


_WEIGHED = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("numbers", pa.binary())])


def _weigh_buckets(least: int):
    """Sums below the nodes of depth 2, in SHALLOW parts, and as part -1 the strings seen ``least`` times with their subtrees' predictions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keys, counts = np.frombuffer(raw, np.uint64), np.frombuffer(n, np.int64)
                subtrees = Subtrees(keys, counts)
                nodes, sums = subtrees.sums()
                out = [(b, nodes[g].tobytes(), sums[g].tobytes()) for b, g in _split((((nodes >> np.uint64(8)) * _MIX >> np.uint64(32)) % np.uint64(SHALLOW)).astype(np.int64))]
                often = keys[counts >= least]
                out.append((-1, often.tobytes(), subtrees.predict(often).astype(np.float32).tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _WEIGHED, strict=True)], schema=_WEIGHED)
        give_back()

    return run


def _add_sums(table: pa.Table) -> pa.Table:
    keys, sums = _count(np.concatenate([np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()]), np.concatenate([np.frombuffer(x, np.float64) for x in table["numbers"].to_pylist()]))
    return pa.table({"part": table["part"][:1], "keys": pa.array([keys.tobytes()], pa.binary()), "numbers": pa.array([sums.tobytes()], pa.binary())})


class Words:
    """Base model: the counts of frequent words, all others to be looked up."""

    def __init__(self, known: dict[bytes, int], total: int, distinct: int, complete: bool):
        self.known, self.total, self.distinct, self.complete = known, total, distinct, complete

    def term(self, count: np.ndarray | int) -> np.ndarray | float:
        return np.log10((np.asarray(count) + 0.5) / (self.total + 0.5 * (self.distinct + 1)))


_ASKED = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("flush", pa.int64()), ("rows", pa.binary()), ("keys", pa.binary()), ("times", pa.binary()), ("known", pa.binary()), ("base", pa.binary()), ("score", pa.binary())])
_ANSWERS = pa.schema([("flush", pa.int64()), ("rows", pa.binary()), ("tokens", pa.binary()), ("known", pa.binary()), ("base", pa.binary()), ("score", pa.binary()), ("docs", pa.binary())])


def packed_keys(keys: np.ndarray) -> bytes:
    """Ordered numbers as differences, byte by byte, which compress well."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def _score_texts(cache, words, buckets: int):
    """Per flush of texts what the cache and the frequent words give, and the strings and words to ask for, with the rows (counted from the flush's least) that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (cached, values), base = cache.value, words.value
        get, end = base.known.get, float(base.term(base.end))
        for rows in _flushes(batches):
            raw = [r[1].encode() for r in rows]
            row = np.array([r[0] for r in rows], np.int64)
            first = int(row.min())
            row = row - first
            small = np.uint16 if row.max() < 1 << 16 else np.int64
            keys, owner = strings(raw)
            order = np.argsort(keys)
            keys, owner = keys[order], owner[order]
            at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            times, keys = np.diff(np.concatenate([at, [len(keys)]])), keys[at]
            place, ok = _places(cached, keys)
            here = np.repeat(ok, times)
            score = np.bincount(owner[here], np.repeat(values[place[ok]], times[ok]), len(rows))
            keys, times, owner = keys[~ok], times[~ok], row[owner[~here]].astype(small)
            bucket = deep_bucket(keys, buckets).astype(np.uint16 if buckets < 1 << 16 else np.int64)
            owner, out, done = owner[np.argsort(np.repeat(bucket, times), kind="stable")], [], 0
            for b, g in _split(bucket):
                n = int(times[g].sum())
                out.append((_STRINGS, b, first, owner[done : done + n].tobytes(), packed_keys(keys[g]), times[g].astype(np.uint32).tobytes(), None, None, None))
                done += n
            n_tokens, n_known, sums, rare = [], [], [], defaultdict(list)
            for r, t in zip(row.tolist(), raw, strict=True):
                own = t.lower().split()
                counts = np.fromiter((get(w, 0) for w in own), np.int64, len(own))
                missing = np.flatnonzero(counts == 0)
                n_tokens.append(len(own) + 1)
                n_known.append(len(own) - len(missing) + (base.end > 0))
                sums.append(float(base.term(counts[counts > 0]).sum()) + end)
                if base.complete:  # what is not in a complete table was never seen
                    sums[-1] += len(missing) * float(base.term(0))
                else:
                    for w, k in Counter(own[i] for i in missing.tolist()).items():
                        rare[word_bucket(w, buckets)].append((w, r, k))
            out += [(_TOKENS, b, first, np.array([r for _, r, _ in x], small).tobytes(), b" ".join(w for w, *_ in x), np.array([k for *_, k in x], np.uint32).tobytes(), None, None, None) for b, x in rare.items()]
            docs = np.array([r[2:] for r in rows], np.int64).tobytes()  # who the rows are: id and text
            out.append((_DOCS, first % buckets, first, row.tobytes(), docs, np.array(n_tokens, np.int64).tobytes(), np.array(n_known, np.int64).tobytes(), np.array(sums, np.float64).tobytes(), score.tobytes()))
            for at in range(0, len(out), 64):
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out[at : at + 64], strict=True), _ASKED, strict=True)], schema=_ASKED)
        give_back()

    return run


def _rows_of(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint16 if len(raw) == 2 * n else np.int64).astype(np.int64)


def _look_up(top, total: int, distinct: int):
    base = Words({}, total, distinct, False)

    def words(asked: pa.Table, counted: pa.Table) -> Iterator[tuple]:
        known: dict[bytes, int] = {}
        for packed, counts in zip(counted["keys"].to_pylist(), counted["counts"].to_pylist(), strict=True):
            known.update(zip(packed.split(b" "), np.frombuffer(counts, np.int64).tolist(), strict=True))
        for flush, rows, packed, times in zip(*(asked[c].to_pylist() for c in ("flush", "rows", "keys", "times")), strict=True):
            c, k = np.array([known.get(w, 0) for w in packed.split(b" ")], np.int64), np.frombuffer(times, np.uint32).astype(np.int64)
            row, back = np.unique(_rows_of(rows, len(k)), return_inverse=True)
            yield flush, row.astype(np.int32).tobytes(), None, np.bincount(back, k * (c > 0), len(row)).astype(np.int64).tobytes(), np.bincount(back, k * base.term(c), len(row)).tobytes(), None, None

    def bytes_(asked: pa.Table, counted: pa.Table) -> Iterator[tuple]:
        empty = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        subtrees = Subtrees(*(np.concatenate([e, *(np.frombuffer(x, e.dtype) for x in counted[c].to_pylist())]) for c, e in zip(("keys", "counts"), empty, strict=True)))
        every = np.zeros(0, np.uint64)
        for at in range(0, asked.num_rows, 64):
            every = np.unique(np.concatenate([every, *map(unpacked_keys, asked["keys"][at : at + 64].to_pylist())]))
        values = np.concatenate([top.value.log10_of(k, subtrees.predict(k)) for k in np.split(every, range(1 << 17, len(every), 1 << 17))])
        for at in range(asked.num_rows):
            flush, rows, packed, times = (asked[c][at].as_py() for c in ("flush", "rows", "keys", "times"))
            times = np.frombuffer(times, np.uint32).astype(np.int64)
            rows = _rows_of(rows, int(times.sum()))
            sums = np.bincount(rows, np.repeat(values[np.searchsorted(every, unpacked_keys(packed))], times))
            row = np.flatnonzero(sums)  # a string's logarithm is below 0
            yield flush, row.astype(np.int32).tobytes(), None, None, None, sums[row].astype(np.float32).tobytes(), None

    def run(asked: pa.Table, counted: pa.Table) -> pa.Table:
        if not asked.num_rows:
            return _ANSWERS.empty_table()
        kind = asked["kind"][0].as_py()
        if kind == _DOCS:
            whole = [pa.array([np.frombuffer(x, np.int64).astype(np.int32).tobytes() for x in asked["rows"].to_pylist()], pa.binary())]
            return pa.table([asked["flush"], *whole, *(asked[c] for c in ("times", "known", "base", "score", "keys"))], schema=_ANSWERS)
        out = list((words if kind == _TOKENS else bytes_)(asked, counted))
        give_back()
        return pa.table([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), _ANSWERS, strict=True)], schema=_ANSWERS)

    return run


def _add_answers(table: pa.Table) -> pa.Table:
    """The rows of a flush, with all that was answered added up."""
    n = 1 + max(int(np.frombuffer(r, np.int32).max()) for r, t in zip(table["rows"].to_pylist(), table["tokens"].to_pylist(), strict=True) if t is not None)
    there, sums = np.zeros(n, bool), {c: np.zeros(n, kind) for c, kind in (("tokens", np.int64), ("known", np.int64), ("base", np.float64), ("score", np.float64))}
    for rows, *own in zip(*(table[c].to_pylist() for c in ("rows", *sums)), strict=True):
        row = np.frombuffer(rows, np.int32)
        there[row] = True
        for total, x in zip(sums.values(), own, strict=True):
            if x is not None:
                total[row] += np.frombuffer(x, total.dtype if len(x) == 8 * len(row) else np.float32)
    row = np.flatnonzero(there)
    docs = np.zeros((n, 2), np.int64)
    for rows, own in zip(table["rows"].to_pylist(), table["docs"].to_pylist(), strict=True):
        if own is not None:
            docs[np.frombuffer(rows, np.int32)] = np.frombuffer(own, np.int64).reshape(-1, 2)
    return pa.table({"doc_key": pa.array(docs[row, 0]), "text_key": pa.array(docs[row, 1]), "n_tokens": pa.array(sums["tokens"][row]), "n_known": pa.array(sums["known"][row]), "base_score": pa.array(sums["base"][row]), "score": pa.array(sums["score"][row])})


def _asked_in_parts(spark: SparkSession, asked: DataFrame, counted: DataFrame, added: DataFrame, least: int, most: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of the look-up with what they meet on. Buckets whose strings are asked for more than ``most`` times have their questions dealt to parts, each with the bucket's counts.

    How often a string is asked for is taken from how often it was counted, up to twice that; strings that the cache holds are never asked for.
    """
    own = [F.lit(0).cast("long")] + [(F.col("bins")[k] - F.col("bins")[k + 1]) * (2 << k) for k in range(47) if 1 << k < least]
    load = added.where(F.col("kind") == _STRINGS).groupBy("kind", "bucket").agg(F.sum(reduce(lambda a, b: a + b, own)).alias("n"))
    hot = materialize(load.where(F.col("n") > most).select("kind", "bucket", F.ceil(F.col("n") / most).cast("int").alias("parts")), "hot")
    n = hot.count()
    if not n:
        return asked, counted, ["kind", "bucket"]
    hot = F.broadcast(hot) if n <= MOST_HOT else hot
    parts = F.coalesce("parts", F.lit(1))
    dealt = asked.join(hot, ["kind", "bucket"], "left").withColumn("part", F.pmod(F.xxhash64("flush"), parts).cast("int")).select("part", *_ASKED.names)
    copied = counted.join(hot, ["kind", "bucket"], "left").select(F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "kind", "bucket", "keys", "counts")
    return dealt, copied, ["kind", "bucket", "part"]


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", nodes: int = NODES, words: int = WORDS, part_bytes: int = PART_BYTES, ask_most: int = ASK_MOST) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, and bits_per_byte (of the text's bytes and end mark)."""
    spark = docs.sparkSession
    rows = id_text(docs, id_col, text_col).withColumns({"held_out": hash_mod("doc_id", 5) == 1, "doc_key": F.coalesce("doc_id", F.lit(_NO_ID)), "text_key": F.xxhash64("text")})
    ids = materialize(rows.select("doc_id", "held_out", "doc_key", "text_key", F.octet_length("text").alias("bytes")), "ids")
    rows = rows.withColumn("row_no", F.monotonically_increasing_id())  # numbers within one pass alone: passes meet by id and text
    size = ids.agg(F.sum("bytes"), F.count(F.when(~F.col("held_out"), 1))).first()
    buckets, trained = int(max(BUCKETS, (size[0] or 0) // BUCKET_BYTES)), int(size[1])
    counted = rows.where("not held_out").select("row_no", "text").mapInArrow(_count_texts(buckets), "kind int, bucket int, keys binary, counts binary")
    sums, parts = "kind int, bucket int, keys binary, counts binary, bins array<long>", int((size[0] or 0) // part_bytes)
    if parts > 1:  # a bucket's messages are added up in parts first, so that a frequent context's bucket is no larger than its distinct strings times the parts
        counted = counted.withColumn("part", F.pmod(F.spark_partition_id(), F.lit(parts))).groupBy("kind", "bucket", "part").applyInArrow(_add_up(buckets), sums).drop("bins")
    added = materialize(counted.groupBy("kind", "bucket").applyInArrow(_add_up(buckets), sums), "counted")
    sizes = {int(r.kind): r for r in added.groupBy("kind").agg(*(F.sum(F.col("bins")[k]).alias(f"b{k}") for k in range(48))).collect()}
    fit = lambda kind, most: next((1 << k for k in range(48) if sizes[kind][f"b{k}"] <= most), 1 << 48) if kind in sizes else 1

    # The top comes in parts; so do the frequent strings' predictions, which are mixed with it here.
    levels: list[tuple[list, list, list]] = [([], [], []) for _ in range(3)]
    lines = added.where(F.col("kind") == _STRINGS)
    deep = lines.where(F.col("bucket") < buckets)
    for r in lines.where(F.col("bucket") >= buckets).select("keys", "counts").mapInArrow(_near_nodes, "depth int, nodes binary, zeros binary, ones binary").toLocalIterator():
        for own, x in zip(levels[r.depth], (np.frombuffer(bytes(r.nodes), np.uint64), np.frombuffer(bytes(r.zeros), np.int64), np.frombuffer(bytes(r.ones), np.int64)), strict=True):
            own.append(x)
    joined = []
    for k, z, o in levels:
        key = np.concatenate([np.zeros(0, np.uint64), *k])
        node, zero = _count(key, np.concatenate([np.zeros(0, np.int64), *z]))
        joined.append((node, zero, _count(key, np.concatenate([np.zeros(0, np.int64), *o]))[1]))
    weighed = materialize(deep.select("keys", "counts").mapInArrow(_weigh_buckets(fit(_STRINGS, nodes // 2)), "part int, keys binary, numbers binary"), "weighed")
    below = [(np.frombuffer(bytes(r["keys"]), np.uint64), np.frombuffer(bytes(r["numbers"]), np.float64)) for r in weighed.where("part >= 0").groupBy("part").applyInArrow(_add_sums, "part int, keys binary, numbers binary").toLocalIterator()]
    top = Top(joined, np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in below)]), np.concatenate([np.zeros(0), *(x for _, x in below)]))
    often, values = [np.zeros(0, np.uint64)], [np.zeros(0, np.float32)]
    for r in weighed.where("part < 0").select("keys", "numbers").toLocalIterator():
        if r["keys"]:
            often.append(np.frombuffer(bytes(r["keys"]), np.uint64))
            values.append(top.log10_of(often[-1], np.frombuffer(bytes(r["numbers"]), np.float32).reshape(8, -1)).astype(np.float32))
    keys, value = np.concatenate(often), np.concatenate(values)
    order = np.argsort(keys)
    cache, shared_top = spark.sparkContext.broadcast((keys[order], value[order])), spark.sparkContext.broadcast(top)

    tokens = added.where(F.col("kind") == _TOKENS)
    least = fit(_TOKENS, words)

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n = np.frombuffer(counts, np.int64)
                own = [(w, c) for w, c in zip(keys.split(b" ") if len(n) else [], n.tolist(), strict=True) if c >= least]
                yield pa.RecordBatch.from_arrays([pa.array([b" ".join(w for w, _ in own)], pa.binary()), pa.array([np.array([c for _, c in own], np.int64).tobytes()], pa.binary()), pa.array([int(n.sum())], pa.int64()), pa.array([len(n)], pa.int64())], names=["words", "counts", "total", "distinct"])

    known, total, distinct = {}, trained, 1 if trained else 0  # the end mark is a token too
    for r in tokens.select("keys", "counts").mapInArrow(frequent, "words binary, counts binary, total long, distinct long").toLocalIterator():
        if r.counts:
            known.update(zip(bytes(r.words).split(b" "), np.frombuffer(bytes(r.counts), np.int64).tolist(), strict=True))
        total, distinct = total + r.total, distinct + r.distinct
    base = Words(known, total, distinct, complete=least == 1)
    base.end = trained
    shared = spark.sparkContext.broadcast(base)

    asked = rows.select("row_no", "text", "doc_key", "text_key").mapInArrow(_score_texts(cache, shared, buckets), "kind int, bucket int, flush long, rows binary, keys binary, times binary, known binary, base binary, score binary")
    counted = added.where((F.col("kind") == _TOKENS) | (F.col("bucket") < buckets)).select("kind", "bucket", "keys", "counts")
    asked, counted, on = _asked_in_parts(spark, asked, counted, added, fit(_STRINGS, nodes // 2), ask_most)
    answers = asked.groupBy(*on).cogroup(counted.groupBy(*on)).applyInArrow(_look_up(shared_top, total, distinct), "flush long, rows binary, tokens binary, known binary, base binary, score binary, docs binary")
    scored = answers.groupBy("flush").applyInArrow(_add_answers, "doc_key long, text_key long, n_tokens long, n_known long, base_score double, score double")
    out = ids.hint("merge").join(scored.dropDuplicates(["doc_key", "text_key"]), ["doc_key", "text_key"])  # repeated rows have one answer
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score", (-F.col("score") / F.lit(float(np.log10(2))) / (F.col("bytes") + 1)).alias("bits_per_byte"))
