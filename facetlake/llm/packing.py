"""Packing by cutting-stock column generation.

Every document is its token ids and id 0. Full runs of the capacity are sequences of their own; what is left of each document is an
item of 1 to capacity - 1 tokens. A linear program over the histogram of item lengths covers all items with patterns (sums of lengths
up to the capacity) at the least padded length: a sequence costs the capacity, or its own fill where that is a power of two. A
knapsack by dynamic programming prices new patterns. Patterns are rounded down, then up where their items are left, and the program is solved again
over what is left, up to ``ROUNDS`` times; patterns without padding are dealt to documents by their rank within a length. The items that remain are laid
end to end, cut at the capacity, and the last tokens are cut into powers of two. The place of a rank follows from the histogram alone.

A task ranks the items of each length among its own as it encodes them; counts by (length, task) give the ranks' bases. So no window holds
documents, and a document's tokens move only where the bases are too many to be broadcast. Sequence ids are unique, not dense.

Defined cases: null text is empty and is the single id 0; null ids and repeated rows are packed like any other; an empty table gives
an empty result; other columns are not read. Texts of any length are packed; more than 2**22 tasks are refused with an error.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from facetlake.functions.storage import materialize
from facetlake.llm.bpe import encoder, vocabulary_path
from facetlake.llm.text import give_back, id_text

CAPACITY, END = 1024, 0
#: The program stops within this share of the least possible cost (all tokens), or after so many columns.
GAP, COLUMNS = 1e-3, 1500
#: Programs solved over what the ones before left.
ROUNDS = 6
#: Ids of whole sequences are behind WHOLE: the task, then the place in it. Ids of patterns and the rest are below.
WHOLE, IN_TASK, TASKS = 1 << 62, 40, 1 << 22


def padded(fill: int, capacity: int) -> int:
    """Tokens that a sequence takes with its padding."""
    return fill if fill & (fill - 1) == 0 else capacity


def price(duals: np.ndarray, lengths: np.ndarray, costs: np.ndarray) -> tuple[float, dict[int, int]]:
    """The pattern with the largest dual value less cost: an unbounded knapsack over exact fills."""
    capacity = len(costs) - 1
    best, take = np.full(capacity + 1, -np.inf), np.zeros(capacity + 1, np.int64)
    best[0] = 0.0
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    for s in range(1, capacity + 1):
        if k := upto[s]:
            value = best[s - lengths[:k]] + duals[:k]
            take[s] = j = int(value.argmax())
            best[s] = value[j]
    gain = best - costs
    gain[0] = -np.inf
    s = int(gain.argmax())
    worth, pattern = float(gain[s]), {}
    while s > 0:
        j = int(take[s])
        pattern[j] = pattern.get(j, 0) + 1
        s -= int(lengths[j])
    return worth, pattern


def start(lengths: np.ndarray, need: np.ndarray, capacity: int) -> tuple[list[dict[int, int]], np.ndarray, list[int]]:
    """A first basis: fill a sequence from the longest item on, use that pattern until a length is exhausted, and go on without that length.

    Each pattern holds the length that it exhausts and none exhausted before, so the patterns are independent.
    """
    place = {int(x): j for j, x in enumerate(lengths)}
    left, open_ = need.copy(), np.zeros(capacity + 1, bool)
    open_[lengths] = True
    basis, use, order = [], [], []
    for _ in range(len(lengths)):
        some = np.zeros(capacity + 1, bool)
        some[lengths[left > 0]] = True
        some &= open_
        candidates = np.flatnonzero(some if some.any() else open_)
        top = int(candidates[-1])
        fill, room = [top], capacity - top
        while room and some.any():
            fit = np.flatnonzero(some[: room + 1])
            if not len(fit):
                break
            if some[room]:
                fill.append(room)
                break
            pairs = fit[some[room - fit]]  # two items that fill the room exactly
            if len(pairs):
                fill += [int(pairs[-1]), room - int(pairs[-1])]
                break
            fill.append(int(fit[-1]))
            room -= int(fit[-1])
        pattern: dict[int, int] = {}
        for x in fill:
            pattern[place[x]] = pattern.get(place[x], 0) + 1
        times, out = min((left[j] / k, j) for j, k in pattern.items())
        for j, k in pattern.items():
            left[j] = max(0.0, left[j] - times * k)
        left[out] = 0.0
        open_[lengths[out]] = False
        basis.append(pattern)
        use.append(times)
        order.append(out)
    return basis, np.array(use), order


def invert(basis: list[dict[int, int]], order: list[int]) -> np.ndarray:
    """Inverse of the first basis, whose rows in the order of exhaustion are triangular, by substitution."""
    m = len(basis)
    rows: dict[int, list[tuple[int, int]]] = {}
    for i, pattern in enumerate(basis):
        for j, k in pattern.items():
            rows.setdefault(j, []).append((i, k))
    inverse = np.zeros((m, m))
    for i, j in enumerate(order):
        own = np.zeros(m)
        own[j] = 1.0
        for h, k in rows[j]:
            if h < i:
                own -= k * inverse[h]
        inverse[i] = own / basis[i][j]
    return inverse


def solve(counts: dict[int, int], capacity: int = CAPACITY, gap: float = GAP, columns: int = COLUMNS) -> list[tuple[dict[int, int], float]]:
    """Patterns {length: times} with their fractional number of uses, by the revised simplex method."""
    lengths = np.array(sorted(k for k, n in counts.items() if n > 0), np.int64)
    m = len(lengths)
    if not m:
        return []
    need = np.array([counts[int(x)] for x in lengths], np.float64)
    costs = np.array([padded(s, capacity) for s in range(capacity + 1)], np.float64)
    cost_of = lambda p: costs[sum(int(lengths[j]) * k for j, k in p.items())]
    # einsum, not BLAS: threads of a BLAS library can lock up in a driver that has forked.
    basis, use, order = start(lengths, need, capacity)
    inverse = invert(basis, order)
    cost = np.array([cost_of(p) for p in basis])
    least = float((need * lengths).sum())
    for _ in range(columns):
        if float((cost * use).sum()) <= least * (1 + gap):
            break
        worth, pattern = price(np.einsum("i,ij->j", cost, inverse), lengths, costs)
        if worth <= 1e-7:
            break
        step = sum(k * inverse[:, j] for j, k in pattern.items())
        up = step > 1e-9
        if not up.any():
            break
        ratio = np.where(up, use / np.where(up, step, 1), np.inf)
        out = int(ratio.argmin())
        theta = ratio[out]
        use = np.maximum(use - theta * step, 0)
        use[out] = theta
        row = inverse[out] / step[out]
        inverse -= step[:, None] * row[None, :]
        inverse[out] = row
        basis[out], cost[out] = pattern, cost_of(pattern)
    return [({int(lengths[j]): k for j, k in p.items()}, float(u)) for p, u in zip(basis, use, strict=True) if u > 1e-9]


def rounded(left: dict[int, int], capacity: int = CAPACITY, gap: float = GAP, columns: int = COLUMNS) -> list[tuple[dict[int, int], int]]:
    """Patterns without padding and whole numbers of their uses; takes their items out of ``left``.

    A pattern that pads gives its items to the rest, where cutting saves the padding.
    """
    out = []
    for _ in range(ROUNDS):
        found = len(out)
        exact = [(p, u) for p, u in solve(left, capacity, gap, columns) if padded(fill := sum(x * k for x, k in p.items()), capacity) == fill]
        for up in (0, 1):  # down first, then once more where the items are left
            for pattern, use in sorted(exact, key=lambda x: x[1] % 1, reverse=True) if up else exact:
                n = min([up or int(use + 1e-6), *(left[x] // k for x, k in pattern.items())])
                if n > 0:
                    out.append((pattern, n))
                    for x, k in pattern.items():
                        left[x] -= n * k
        if len(out) == found:
            break
    return out


class Plan:
    """Where the items of each length go: (sequence, offset, length) pieces by rank."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY, gap: float = GAP, columns: int = COLUMNS):
        self.capacity, left, slots, base = capacity, dict(counts), {}, 0
        for pattern, n in rounded(left, capacity, gap, columns):
            at = 0
            for x in sorted(pattern, reverse=True):
                for _ in range(pattern[x]):
                    slots.setdefault(x, []).append((n, base, at))
                    at += x
            base += n
        # per length: ranks below upto[i] go to sequence first[i] + (rank - the one before), at offset[i]
        self.upto = {x: np.cumsum([n for n, *_ in s]) for x, s in slots.items()}
        self.first = {x: [b for _, b, _ in s] for x, s in slots.items()}
        self.offset = {x: [a for *_, a in s] for x, s in slots.items()}
        self.base, self.start, at = base, {}, 0
        for x in sorted(left):
            self.start[x] = at
            at += left[x] * x
        self.total = at

    def place(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        upto = self.upto.get(length)
        packed = int(upto[-1]) if upto is not None else 0
        if rank < packed:
            i = int(np.searchsorted(upto, rank, side="right"))
            return [(self.first[length][i] + rank - (int(upto[i - 1]) if i else 0), self.offset[length][i], length)]
        at, out = self.start[length] + (rank - packed) * length, []
        full = self.total // self.capacity * self.capacity
        while length:
            if at < full:
                s, off, room = at // self.capacity, at % self.capacity, self.capacity - at % self.capacity
            else:  # the last tokens: sequences of the powers of two that make up their number
                s, low, rest = self.total // self.capacity, full, self.total - full
                while at >= low + (size := 1 << rest.bit_length() - 1):
                    s, low, rest = s + 1, low + size, rest - size
                off, room = at - low, low + size - at
            n = min(length, room)
            out.append((self.base + s, off, n))
            at, length = at + n, length - n
        return out


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    # The number of the task: the upper bits of an increasing id.
    rows = id_text(docs, id_col, text_col).select("doc_id", "text", F.shiftrightunsigned(F.monotonically_increasing_id(), 33).alias("task"))
    schema = pa.schema([("doc_id", pa.int64()), ("task", pa.int64()), ("n", pa.int64()), ("item", pa.int32()), ("rank", pa.int64()), ("whole", pa.int64()), ("crcs", pa.list_(pa.int64())), ("tail", pa.binary())])

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, size, end = encoder(path or vocabulary_path()), 4 * capacity, END.to_bytes(4, "little")
        seen, whole = [0] * capacity, 0
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            coded = tokenizer.encode_batch(batch.column("text"))
            for i, task, c in zip(batch.column("doc_id").to_pylist(), batch.column("task").to_pylist(), coded, strict=True):
                if task >= TASKS:
                    raise ValueError(f"more than {TASKS} tasks: sequence ids would meet")
                c += end
                full, item = len(c) // size, len(c) % size // 4
                tail = np.frombuffer(c[full * size :], "<u4")
                row = (i, task, len(c) // 4, item, seen[item], WHOLE + (task << IN_TASK) + whole, [zlib.crc32(c[a : a + size]) for a in range(0, full * size, size)], tail.astype("<u2" if tokenizer.size <= 1 << 16 else "<u4").tobytes())  # two bytes hold an id
                seen[item] += 1
                whole += full
                for x, v in zip(out, row, strict=True):
                    x.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, schema, strict=True)], schema=schema)
        give_back()

    coded = materialize(rows.mapInArrow(tokens, "doc_id long, task long, n long, item int, rank long, whole long, crcs array<long>, tail binary"), "tokens")
    classes = materialize(coded.where("item > 0").groupBy("item", "task").agg(F.count(F.lit(1)).alias("docs")), "classes")
    before = Window.partitionBy("item").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as tasks, not documents
    bases = materialize(classes.select("item", "task", F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("base")), "bases")
    plan = Plan({int(r["item"]): int(r["docs"]) for r in classes.groupBy("item").agg(F.sum("docs").alias("docs")).collect()}, capacity)  # fewer rows than the capacity
    ranked = coded.join(bases, ["item", "task"], "left").select("doc_id", "n", "crcs", "tail", "whole", (F.col("rank") + F.coalesce("base", F.lit(0))).alias("rank"))
    shared = docs.sparkSession.sparkContext.broadcast(plan)
    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    pieces_schema = pa.schema([(k, pa.int64()) for k in names])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        for batch in batches:
            out: list[tuple] = []
            for i, n, crcs, tail, whole, rank in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                full = n // capacity
                out += [(i, c * capacity, capacity, crc, n, whole + c, 0) for c, crc in enumerate(crcs)]
                if item := n % capacity:
                    at, ids = full * capacity, tail if len(tail) == 4 * item else np.frombuffer(tail, "<u2").astype("<u4").tobytes()
                    for s, offset, length in plan.place(item, rank):
                        low = at - full * capacity
                        out.append((i, at, length, zlib.crc32(ids[4 * low : 4 * (low + length)]), n, s, offset))
                        at += length
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out, strict=True)] if out else [pa.array([], pa.int64())] * len(names), schema=pieces_schema)
        give_back()

    return ranked.mapInArrow(pieces, ", ".join(f"{k} long" for k in names))
