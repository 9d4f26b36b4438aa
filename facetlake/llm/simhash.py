"""SimHash near-duplicates: 64-bit fingerprints compared exactly, tile by tile.

Fingerprints that differ in at most ``radius`` bits have popcounts, of the whole and of any part, that differ by at most
``radius`` in all. Distinct fingerprints are dealt into tiles by bands of ``radius`` + 1 popcounts of their two halves; only tiles of the same or
of neighbouring bands meet, and inside a pair the popcounts of the four quarters skip all blocks beyond the radius. Blocks are compared with
numpy exclusive-or and bit counts. Each tile pair hands on a spanning forest of its links, never all pairs, and
a distributed loop joins the forests into components.

Work grows with the square of the distinct fingerprints, divided by what the popcounts skip. A tile holds some ``tile``
fingerprints, a band with more being dealt into several by hash. A tile goes once to each pair that it is in, so what moves is the fingerprints times
the tiles of nine bands: larger tiles move less and hold more.

Defined cases: null text is empty; a text with no word has fingerprint zero and links like any other; equal fingerprints
are one node; a null id is never the smallest of its class unless alone; an empty table gives an empty result; other columns are not read.
Of a class the row with the smallest id stays, then that with the smallest hash of its text; a null id is larger than all others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.functions.storage import materialize
from facetlake.llm.exact_dedup import drop_rows
from facetlake.llm.text import give_back, id_text, map_texts
from facetlake.operators.components import connected_components

TILE, DENSE = 1 << 17, 1 << 18
#: Comparisons that are in memory at once.
CELLS = 1 << 21


def fingerprint(text: str, size: int = 4) -> int:
    """Bit i is 1 where more than half of the shingles' XXH64 values (seed 42) have it set."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        h = np.array([digest(joined, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        n = len(words) - size + 1
        h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), ends[size - 1 :].tolist(), strict=True)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 8192):  # bit i of the little-endian bytes is bit i of the number
        counts += np.unpackbits(h[at : at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = counts * 2 > len(h)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp): the fingerprint as a signed 64-bit integer, and a hash of the text that tells rows of one id apart."""

    def work(ids: list, texts: list, keys: list) -> dict:
        return {"doc_id": ids, "text_key": keys, "fp": np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)}

    return map_texts(id_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text")), work, "doc_id long, text_key long, fp long", ("text_key",))


def _quarters(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view("<u2").reshape(-1, 4)).astype(np.int64)


class _Forest:
    """Union-find over positions, by smaller index."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = i = up[up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)
            self.edges.append((i, j))


def _link(forest: _Forest, rows: np.ndarray, cols: np.ndarray, near: np.ndarray) -> None:
    """Join what the block links. In a dense block labels spread by minima, so a large group costs its members and not its pairs."""
    if np.count_nonzero(near) <= 8 * sum(near.shape):
        for i, j in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
            forest.join(int(rows[i]), int(cols[j]))
        return
    label, none = np.arange(len(rows)), len(rows)
    while True:
        down = np.where(near, label[:, None], none).min(0)
        new = np.minimum(label, np.where(near, down[None, :], none).min(1))
        if (new == label).all():
            break
        label = new
    for i in np.flatnonzero(label < np.arange(len(rows))).tolist():
        forest.join(int(rows[i]), int(rows[label[i]]))
    for j in np.flatnonzero(down < none).tolist():
        forest.join(int(rows[down[j]]), int(cols[j]))


def forest_of(a: np.ndarray, b: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """A spanning forest of the links within ``a``, or between ``a`` and ``b``: pairs of values."""
    both = a if b is None else np.concatenate([a, b])
    forest = _Forest(len(both))
    own, other = np.arange(len(a)), np.arange(len(a)) if b is None else len(a) + np.arange(len(b))
    quarters = _quarters(both)

    def blocks(at: np.ndarray) -> list[np.ndarray]:
        if len(own) * len(other) <= DENSE:
            return [at]
        order = at[np.lexsort(quarters[at].T)]
        cut = np.flatnonzero((quarters[order][1:] != quarters[order][:-1]).any(1)) + 1
        return np.split(order, cut)

    def meet(x: np.ndarray, y: np.ndarray, same: bool) -> None:
        step = max(1, CELLS // max(1, len(y)))
        for at in range(0, len(x), step):
            part = x[at : at + step]
            near = np.bitwise_count(both[part][:, None] ^ both[y][None, :]) <= radius
            if same:
                near &= part[:, None] < y[None, :]
            if near.any():
                _link(forest, part, y, near)

    left, right = blocks(own), blocks(other)
    low = np.array([quarters[x[0]] for x in right])
    whole = len(left) == len(right) == 1
    for k, x in enumerate(left):
        # All blocks within the radius at once; of a tile with itself, those from its own block on.
        near = [0] if whole else np.flatnonzero(np.abs(low - quarters[x[0]]).sum(1) <= radius).tolist()
        if b is None:
            meet(x, x, True)
            near = [m for m in near if m > k]
        if near:
            meet(x, np.concatenate([right[m] for m in near]), False)
    return [(int(both[i]), int(both[j])) for i, j in forest.edges]


def links(distinct: DataFrame, radius: int = 4, tile: int = TILE) -> DataFrame:
    """(a, b): a spanning forest, per tile pair, of the links between distinct fingerprints."""
    band = lambda shift: F.floor(F.bit_count(F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(0xFFFFFFFF))) / F.lit(radius + 1)).cast("int")
    keyed = distinct.select("fp", band(32).alias("p"), band(0).alias("q"))
    sizes = materialize(keyed.groupBy("p", "q").agg(F.ceil(F.count(F.lit(1)) / F.lit(tile)).cast("int").alias("parts")), "sizes")  # at most 33 * 33 rows
    dealt = keyed.join(F.broadcast(sizes), ["p", "q"]).withColumn("s", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    packed = materialize(dealt.groupBy("p", "q", "s").agg(F.collect_list("fp").alias("fps")), "tiles")
    near = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    there = F.broadcast(sizes.select(F.col("p").alias("p2"), F.col("q").alias("q2"), F.col("parts").alias("parts2")))
    sent = packed.withColumn("by", F.explode(near)).withColumns({"p2": F.col("p") + F.col("by.i"), "q2": F.col("q") + F.col("by.j")}).join(there, ["p2", "q2"]).withColumn("s2", F.explode(F.sequence(F.lit(0), F.col("parts2") - 1)))
    key = ["p", "q", "s", "p2", "q2", "s2"]
    one = sent.where("struct(p, q, s) < struct(p2 as p, q2 as q, s2 as s)").select(*key, F.col("fps").alias("left"))
    two = sent.where("struct(p, q, s) > struct(p2 as p, q2 as q, s2 as s)").select(*[F.col(k).alias(n) for n, k in zip(key, [*key[3:], *key[:3]], strict=True)], F.col("fps").alias("right"))
    pairs = packed.select(F.col("fps").alias("left"), F.lit(None).cast("array<long>").alias("right")).unionAll(one.join(two, key).select("left", "right"))

    def run(frames):
        for frame in frames:
            out = [e for x, y in zip(frame["left"], frame["right"], strict=True) for e in forest_of(np.asarray(x, np.int64).view(np.uint64), None if y is None else np.asarray(y, np.int64).view(np.uint64), radius)]
            yield pd.DataFrame({k: np.array([e[i] for e in out], np.uint64).view(np.int64) for i, k in enumerate("ab")})
        give_back()

    return pairs.mapInPandas(run, "a long, b long")


def classes(docs: DataFrame, radius: int = 4, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """(doc_id, text_key, fp, component, least) of every row: its class and the smallest id in it, with the least hash of a text."""
    prints = materialize(fingerprints(docs, id_col, text_col), "prints")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    distinct = materialize(prints.groupBy("fp").agg(least.alias("least")), "distinct")
    linked = materialize(connected_components(links(distinct, radius, tile)), "linked")
    member = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    heads = materialize(member.groupBy("component").agg(F.min("least").alias("least")), "heads")
    own = materialize(member.select("fp", "component").join(heads, "component"), "classes")
    return prints.join(own, "fp")


def near_duplicates(docs: DataFrame, radius: int = 4, id_col: str = "doc_id", text_col: str = "text", tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id (smallest doc_id reachable)."""
    rows = classes(docs, radius, id_col, text_col, tile)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("least.doc_id").alias("component_id"))


def near_dedup(docs: DataFrame, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` of each class, with all its columns."""
    rows = materialize(classes(docs, radius, id_col, text_col).select("doc_id", "text_key", (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("text_key") == F.col("least.text_key"))).alias("stays")), "verdicts")
    same = rows.where("stays").groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return drop_rows(docs, rows.where("not stays").select("doc_id", "text_key"), same, id_col, text_col)
