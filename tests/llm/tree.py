"""The whole weighted tree in one place, as the operator never holds it: what its buckets have to add up to."""

import numpy as np

from facetlake.llm.ctw import _MIX, DEPTH, log_kt, strings


class Tree:
    """Weighted tree: for every node the mixed log10 probability of both bits where a context's path ends there."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.nodes = [k for k, *_ in levels]
        zero, one = [z.astype(np.float64) for _, z, _ in levels], [o.astype(np.float64) for _, _, o in levels]
        parent = [np.zeros(0, np.int64)]
        for d in range(1, len(levels)):
            up = (self.nodes[d] >> np.uint64(16)) << np.uint64(8) | self.nodes[d] & np.uint64(255)
            parent.append(np.searchsorted(self.nodes[d - 1], up))
        last = len(levels) - 1
        weighted, share, other = [None] * len(levels), [None] * len(levels), [None] * len(levels)
        for d in range(last, -1, -1):
            own = log_kt(zero[d], one[d])
            if d == last:
                weighted[d], share[d], other[d] = own, np.ones_like(own), np.full_like(own, 0.5)
                continue
            size = len(own)
            z, o = (x[d] - np.bincount(parent[d + 1], x[d + 1], size) for x in (zero, one))  # contexts that were too rare, as one branch
            z, o = np.maximum(z, 0), np.maximum(o, 0)
            below = np.bincount(parent[d + 1], weighted[d + 1], size) + log_kt(z, o)
            weighted[d] = np.logaddexp(own, below) + np.log(0.5)
            share[d] = np.exp(np.log(0.5) + own - weighted[d])
            other[d] = (o + 0.5) / (z + o + 1)
        self.zero_log, self.one_log = [], []
        mixed, rest = np.zeros(len(zero[0])), np.ones(len(zero[0]))
        for d in range(len(levels)):
            kt = (one[d] + 0.5) / (zero[d] + one[d] + 1)
            if d:
                mixed, rest = (mixed + rest * share[d - 1] * before)[parent[d]], (rest * (1 - share[d - 1]))[parent[d]]
            p = np.clip(mixed + rest * (share[d] * kt + (1 - share[d]) * other[d]), 1e-12, 1 - 1e-12)
            self.zero_log.append(np.log10(1 - p).astype(np.float32))
            self.one_log.append(np.log10(p).astype(np.float32))
            before = kt
        self.child, self._starts = [], []
        for level in self.nodes:
            places = []
            for bit in (0, 1):  # where the node one bit longer stands, -1 if it is not in the tree
                prefix = level & np.uint64(255)
                wanted = level - prefix + prefix * np.uint64(2) + np.uint64(bit)
                at = np.minimum(np.searchsorted(level, wanted), max(0, len(level) - 1))
                ok = (prefix < 128) & (level[at] == wanted) if len(level) else np.zeros(0, bool)
                places.append(np.where(ok, at, -1).astype(np.int32))
            self.child.append(np.stack(places))
            root = np.flatnonzero((level & np.uint64(255)) == 1)
            hashes = (level[root] >> np.uint64(8)) * _MIX + _MIX
            order = np.argsort(hashes)
            bits = max(1, int(len(root)).bit_length())
            first = np.searchsorted(hashes[order] >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
            self._starts.append((root[order].astype(np.int32), hashes[order], bits, first.astype(np.int32)))
        self.size, self.nodes = sum(map(len, self.nodes)), None

    def log10_of(self, keys: np.ndarray) -> np.ndarray:
        """log10 probability of each distinct, ordered string's byte after its context."""
        total, place, back = np.zeros(0), None, None
        value = held = None
        for d in range(len(self.child)):
            k = keys >> np.uint64(8 * (DEPTH - d))
            new = np.concatenate([[True], k[1:] != k[:-1]])
            at = np.flatnonzero(new)
            if place is None:
                act = np.arange(len(at))
                total = np.full(len(at), 8 * np.log10(0.5))
                own, seen = np.full((8, len(at)), np.log10(0.5), np.float32), np.ones((8, len(at)), bool)
            else:  # a string whose context was not in the level above has its value already
                up = back[at]
                total, from_ = total[up], place[up]
                act = np.flatnonzero(from_ >= 0)
                own, seen = value[:, from_[act]], held[:, from_[act]]
            k = k[at[act]]
            width = np.uint64(8 * d)
            symbol, context = (k >> width).astype(np.int64), k & ((np.uint64(1) << width) - np.uint64(1))
            i = self._find(d, context)
            some = np.flatnonzero(seen[0] & (i >= 0))  # a node is in the tree only if its parents in context and in bits are
            i, seen = i[some], np.zeros_like(seen)
            for j in range(8):
                bit = symbol[some] >> (7 - j) & 1
                seen[j, some] = True
                own[j, some] = np.where(bit == 1, self.one_log[d][i], self.zero_log[d][i])
                if j < 7:
                    i = self.child[d][bit, i]
                    some, i = some[i >= 0], i[i >= 0]
            stay = np.flatnonzero(seen[0])
            value, held = own[:, stay], seen[:, stay]
            total[act[stay]] = value.sum(0, dtype=np.float64)
            place = np.full(len(at), -1)
            place[act[stay]] = np.arange(len(stay))
            back = np.cumsum(new) - 1
        return total[back]

    def _find(self, depth: int, context: np.ndarray) -> np.ndarray:
        """Places of the contexts' first nodes in the level, -1 for those that are not in it."""
        root, hashes, bits, first = self._starts[depth]
        found = np.full(len(context), -1)
        if not len(root):
            return found
        key = context * _MIX + _MIX
        low = key >> np.uint64(64 - bits)
        at, end = first[low], first[low + np.uint64(1)]
        left = np.flatnonzero(at < end)
        while len(left):
            same = hashes[at[left]] == key[left]
            found[left[same]] = root[at[left[same]]]
            left = left[~same]
            at[left] += 1
            left = left[at[left] < end[left]]
        return found

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of every text with its end mark."""
        keys, owner = strings(texts)
        if not len(keys):
            return np.zeros(len(texts))
        order = np.argsort(keys)
        keys = keys[order]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        values = np.repeat(self.log10_of(keys[at]), np.diff(np.concatenate([at, [len(keys)]])))
        return np.bincount(owner[order], values, len(texts))
