"""Periodic runs of words by Crochemore's partition refinement.

Positions of a text are held in classes: two share a class of level k where the k words from them on are equal. Level k + 1 follows
from level k by the smaller-half strategy: of the pieces that a class came apart into, all but a largest one part the classes of
the positions before them, so a position takes part at most log n times. Members of a class are linked in text order; two
neighbours at a distance equal to the level start a square whose root is primitive, and squares of one period at consecutive
starts are one run. All texts of a batch are refined together, a level a step, as numpy arrays.

A run has to be at least ``COPIES`` periods long, so a period is at most n // COPIES. Distances to neighbours only grow from level to level:
a position both of whose neighbours are farther off than that can start no square any more and leaves its class, and with it the
positions whose words would run into it. That changes no result and ends the refinement of texts that merely repeat words.

Defined cases: null text is empty, it has no words and no runs; a null id counts as the empty text where ids decide something; repeated rows
are handled one by one; a text of any length is one piece of work, its memory grows with its words; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from itertools import count

import numpy as np
from pyspark.sql import DataFrame

from facetlake.llm.text import id_text, map_texts

COPIES, LEAST = 4, 6

SCHEMA = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, n_dropped long"


class _Classes:
    """Classes of equal factors at one level, refined level by level. Slot ``end`` stands for 'no position'."""

    def __init__(self, words: np.ndarray, text: np.ndarray, most: np.ndarray):
        """``words``: ids, -1 at the end of each text; ``text``: the number of each position's text; ``most``: each text's longest period."""
        self.end = len(words)
        self.most = most[text]
        order = np.flatnonzero(words >= 0)
        key = text[order] * (int(words.max(initial=0)) + 1) + words[order]
        by = np.argsort(key, kind="stable")
        order, key = order[by], key[by]
        near = (key[1:] == key[:-1]) & (np.diff(order) <= self.most[order[1:]])
        kept = np.zeros(len(order), bool)
        kept[1:] |= near
        kept[:-1] |= near
        order, key = order[kept], key[kept]
        first = np.ones(len(order), bool)
        first[1:] = key[1:] != key[:-1]
        self.cls = np.full(self.end + 1, -1, np.int64)
        self.cls[order] = np.cumsum(first) - 1
        self.place = np.zeros(self.end + 1, np.int64)  # of a position in ``perm``, where classes are neighbouring slices
        self.place[order] = np.arange(len(order))
        self.perm = order
        self.start = np.flatnonzero(first)
        self.size = np.diff(np.append(self.start, len(order)))
        self.used = len(self.start)
        self.next = np.full(self.end + 1, self.end, np.int64)
        self.prev = self.next.copy()
        tail = np.flatnonzero(~first)
        self.next[order[tail - 1]] = order[tail]
        self.prev[order[tail]] = order[tail - 1]
        self.mark = np.zeros(self.end + 1, bool)
        self.due: dict[int, list[np.ndarray]] = {}
        self.level = 1
        self.small = order  # members of the classes that part others
        dead = np.ones(self.end, bool)
        dead[order] = False
        self.dead = np.flatnonzero(dead)
        self.hopeless = order[:0]
        self._look(order)

    def _look(self, touched: np.ndarray) -> None:
        """Note at which level the next member of each will start a square, and who can start none any more."""
        ahead, behind, most = self.next[touched], self.prev[touched], self.most[np.minimum(touched, self.end - 1)]
        step = ahead - touched
        far = (ahead == self.end) | (step > most)
        self.hopeless = touched[far & ((behind == self.end) | (touched - behind > most)) & (self.cls[touched] >= 0)]
        ok = ~far & (step >= self.level)
        at, step = touched[ok], step[ok]
        if len(at):
            by = np.argsort(step, kind="stable")
            at, step = at[by], step[by]
            cut = np.flatnonzero(np.diff(step)) + 1
            for d, part in zip(step[np.append(0, cut)].tolist(), np.split(at, cut)):
                self.due.setdefault(d, []).append(part)

    def squares(self) -> np.ndarray:
        """Starts of the squares whose period is the level, as found so far."""
        noted = self.due.pop(self.level, None)
        if noted is None:
            return self.perm[:0]
        at = np.unique(np.concatenate(noted))
        return at[(self.next[at] == at + self.level) & (self.cls[at] >= 0)]

    def done(self) -> bool:
        return not (len(self.small) or len(self.dead) or len(self.hopeless))

    def refine(self) -> None:
        """From this level to the next."""
        cls, perm, place, mark, end = self.cls, self.perm, self.place, self.mark, self.end
        gone = np.concatenate([self.dead - 1, self.hopeless])  # position 0's predecessor is -1, the slot ``end``
        gone = np.unique(gone[cls[gone] >= 0])
        mark[gone] = True
        moved = self.small - 1
        ok = (cls[moved] >= 0) & ~mark[moved]
        mark[gone] = False
        by_next = np.concatenate([cls[self.small[ok]], np.full(len(gone), -1)])
        moved = np.concatenate([moved[ok], gone])
        self.level += 1
        if not len(moved):
            self.small = self.dead = self.hopeless = moved
            return
        own = cls[moved]
        by = np.argsort(own * (end + 1) + moved)
        moved, own, by_next = moved[by], own[by], by_next[by]
        # out of the links of their classes, chain by chain
        head = np.ones(len(moved), bool)
        head[1:] = self.next[moved[:-1]] != moved[1:]
        left, right = self.prev[moved[head]], self.next[moved[np.append(head[1:], True)]]
        self.next[left] = right
        self.prev[right] = left
        # to the front of the slices of their classes
        new = np.ones(len(moved), bool)
        new[1:] = own[1:] != own[:-1]
        first = np.flatnonzero(new)
        classes, counts = own[first], np.diff(np.append(first, len(moved)))
        rank = np.arange(len(moved)) - np.repeat(first, counts)
        front = np.repeat(self.start[classes], counts) + rank
        mark[moved] = True
        holder = perm[front]
        stay = holder[~mark[holder]]
        mark[moved] = False
        at = place[moved]
        vacant = at[at >= np.repeat(self.start[classes] + counts, counts)]
        perm[vacant] = stay
        place[stay] = vacant
        by = np.argsort(own * (self.used + 1) + by_next + 1, kind="stable")
        moved, own, by_next = moved[by], own[by], by_next[by]
        perm[front] = moved
        place[moved] = front
        self.start[classes] += counts
        self.size[classes] -= counts
        # pieces: positions of one class whose successors share a class
        new[1:] |= by_next[1:] != by_next[:-1]
        first = np.flatnonzero(new)
        sizes = np.diff(np.append(first, len(moved)))
        alive = (sizes > 1) & (by_next[first] >= 0)
        ids = np.full(len(first), -1)
        ids[alive] = self.used + np.arange(alive.sum())
        self._room(self.used + int(alive.sum()))
        self.start[ids[alive]] = front[first[alive]]
        self.size[ids[alive]] = sizes[alive]
        lives = np.repeat(alive, sizes)
        cls[moved] = np.repeat(ids, sizes)
        self.next[moved] = self.prev[moved] = end
        linked = np.flatnonzero(~new & lives)
        self.next[moved[linked - 1]] = moved[linked]
        self.prev[moved[linked]] = moved[linked - 1]
        # what is left of a class; a single position dies
        rest = self.size[classes]
        single = perm[self.start[classes[rest == 1]]]
        cls[single] = -1
        self.next[single] = self.prev[single] = end
        rest = np.where(rest > 1, rest, 0)
        # of a class's pieces and its rest, a largest one does not part others
        of = np.searchsorted(classes, own[first])
        live = np.where(alive, sizes, 0)
        by = np.lexsort((live, of))
        largest = by[np.append(of[by][1:] != of[by][:-1], True)]  # one for each class, in their order
        spared = np.zeros(len(first), bool)
        spared[largest[live[largest] > rest]] = True
        parts = moved[np.repeat(alive & ~spared, sizes)]
        small = np.flatnonzero((rest > 0) & (live[largest] > rest))
        many = rest[small]
        slots = np.repeat(self.start[classes[small]] - np.cumsum(many) + many, many) + np.arange(many.sum())
        self.small = np.concatenate([parts, perm[slots]])
        self.dead = np.concatenate([moved[~lives], single])
        self._look(np.concatenate([moved[lives], left[(left < end) & (cls[left] >= 0)], right[(right < end) & (cls[right] >= 0)]]))

    def _room(self, n: int) -> None:
        if n > len(self.start):
            more = np.zeros(max(n, 2 * len(self.start)) - len(self.start), np.int64)
            self.start, self.size = np.append(self.start, more), np.append(self.size, more)
        self.used = n


def find_runs(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """For each list of words its runs as (start, length, period), by start, then period."""
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1
    total = int(lengths.sum() + len(texts))
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not total:
        return found
    words, seen, numbers = np.full(total, -1, np.int64), {}, count()
    for b, t in zip(begins.tolist(), texts):
        words[b : b + len(t)] = np.fromiter(map(seen.setdefault, t, numbers), np.int64, len(t))
    text = np.repeat(np.arange(len(texts)), lengths + 1)
    classes = _Classes(words, text, lengths // COPIES)
    starts, periods = [], []
    last = int((lengths // COPIES).max(initial=0))
    while True:
        at = classes.squares()
        starts.append(at)
        periods.append(np.full(len(at), classes.level))
        if classes.level >= last or classes.done():
            break
        classes.refine()
    at, period = np.concatenate(starts), np.concatenate(periods)
    if not len(at):
        return found
    new = np.ones(len(at), bool)  # by period, then start, as the levels gave them
    new[1:] = (period[1:] != period[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    length = np.diff(np.append(first, len(at))) - 1 + 2 * period[first]
    long = length >= np.maximum(LEAST, COPIES * period[first])
    at, period, length = at[first][long], period[first][long], length[long]
    for i in np.lexsort((period, at)).tolist():
        t = int(text[at[i]])
        found[t].append((int(at[i] - begins[t]), int(length[i]), int(period[i])))
    return found


def stretched(words: list, key: int) -> list:
    """The contract's texts: one in ten goes on in copies of a stretch of its own from some word on."""
    n, g = len(words), key // 10
    if key % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without what any run holds after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def _batch(ids: list, texts: list, stretch: bool) -> dict:
    words = [t.encode().split() for t in texts]
    if stretch:
        words = [stretched(w, zlib.crc32(b"" if i is None else str(i).encode())) for i, w in zip(ids, words)]
    out: dict[str, list] = {k.split()[0]: [] for k in SCHEMA.split(", ")}
    for i, w, runs in zip(ids, words, find_runs(words)):
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        kept = collapsed(w, runs)
        listed = "".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()
        row = (i, len(w), len(runs), *best, best[1] and 1000 * best[1] // best[2], hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(), len(w) - len(kept))
        for column, value in zip(out.values(), row):
            column.append(value)
    return out


def word_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stretch: bool = False) -> DataFrame:
    """One row for each document: how many runs, the longest, and digests of all runs and of the words that stay.

    With ``stretch`` some texts are first made periodic from a word on, as their id says (see ``stretched``).
    """
    return map_texts(id_text(docs, id_col, text_col), lambda ids, texts: _batch(ids, texts, stretch), SCHEMA)


def _spans(ids: list, texts: list) -> dict:
    words = [t.encode().split() for t in texts]
    runs = find_runs(words)
    return {"doc_id": ids, "runs": [[{"start": a, "length": n, "period": q} for a, n, q in r] for r in runs], "text": [" ".join(map(bytes.decode, collapsed(w, r))) for w, r in zip(words, runs)]}


def collapse_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each document: its runs, and its text with one period of each run left and single spaces between words."""
    return map_texts(id_text(docs, id_col, text_col), _spans, "doc_id long, runs array<struct<start:long,length:long,period:long>>, text string")
