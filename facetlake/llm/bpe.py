"""Byte-level BPE encoding and decoding: speculate, verify, and merge exactly only what fails.

A text is cut at spaces that a word follows; no token crosses such a cut, so a cut piece has the same ids wherever it
stands. New pieces are split into words by the tokenizer's published pattern. For each new word, greedy longest match
proposes tokens, and all adjacent pairs of all new words are checked at once: a sequence is what merging gives if
and only if every adjacent pair, merged alone, gives those two tokens again (and each token gives itself). Words with a pair that
fails are merged exactly. Pair verdicts and pieces are kept in bounded tables; the one of pieces, when full, keeps what several batches have held.

Arrow cuts a batch and numbers its distinct pieces; only those are looked up one by one. The ids of known pieces lie in one array,
from which a batch's are gathered at once; decoding gathers the bytes of ids likewise.

Defined cases: null text is empty and has no ids; special tokens in a text become their ids, as the
tokenizers library does by default; texts of any length are encoded whole; null ids, repeated rows and empty
tables pass through; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame

from facetlake.llm.text import id_text, map_texts

# Fixed value: the published word pattern of this tokenizer family.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORDS = regex.compile(PATTERN)
_CUT = regex.compile(r" (?=\S)")
_SIGNS = frozenset(".,;:!?")
_WHITE = frozenset(chr(c) for c in range(0x3001) if regex.match(r"\s", chr(c)))  # the pattern's own white space; str.isspace() knows other characters
MOST_PIECES, PAIR_BITS = 700_000, 20
#: Texts that are encoded together, and what stands for a piece that no cut precedes, or for an unknown one.
TOGETHER, ODD, UNKNOWN = 1000, -1, -2


def _byte_letters() -> dict[str, int]:
    """The letters by which vocabularies of byte-level BPE write bytes: printable ones stand for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(odd)}


class Encoder:
    """Encodes and decodes with one vocabulary file of the tokenizers library (byte-level BPE)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        as_bytes = lambda s: bytes(letters[c] for c in s)
        vocab = spec["model"]["vocab"]
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.ids = {as_bytes(k): v for k, v in vocab.items() if k not in self.special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.ranks = {(vocab[a], vocab[b]): (i, vocab[a + b]) for i, (a, b) in enumerate(merges)}
        self.bytes = {v: k for k, v in self.ids.items()} | {v: k.encode() for k, v in self.special.items()}
        self.size = max(self.bytes) + 1
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.cut_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        # Where ids follow the order of merges, the installed core merges a word by the same rule, only faster.
        self.exact = self.merge
        if all(v == 256 + i for i, v in self.ranks.values()) and sorted(self.single) == list(range(256)):
            self.exact = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=self.ids, special_tokens={})._core_bpe.encode_single_piece
        own = {v: self.exact(k) == [v] for k, v in self.ids.items()}
        self.sound = np.zeros(self.size, bool)
        self.sound[[v for v, ok in own.items() if ok]] = True
        self.forget()
        spelled = [self.bytes.get(i, b"") for i in range(self.size)]
        self.letters, (self.letter_at, self.letter_n) = np.frombuffer(b"".join(spelled), np.uint8), _places(spelled)
        self.pairs = np.full(1 << PAIR_BITS, -1)
        self._build_trie()
        self.words: dict[str, bytes] = {}
        self.stats = {"words": 0, "failed": 0}

    def merge(self, word: bytes) -> list[int]:
        """Exact merging, lowest rank first and leftmost on ties, with a heap: n log n in the word's length."""
        ids = [self.single[b] for b in word]
        n = len(ids)
        if n < 2:
            return ids
        after, before, ranks = [*range(1, n), -1], [*range(-1, n - 1)], self.ranks
        heap = [(r[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := ranks.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = ranks[a, b][1], -1
            after[i] = k = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                if r := ranks.get((ids[i], ids[k])):
                    heapq.heappush(heap, (r[0], i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (r := ranks.get((ids[h], ids[i]))):
                heapq.heappush(heap, (r[0], h, ids[h], ids[i]))
        return [x for x in ids if x >= 0]

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of all words at once: (index of the word, token), in order.

        All words step through the trie of the vocabulary together, a byte at a time; a word that finds no next node
        hands out its longest token so far and starts again behind it.
        """
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words) + b"\0", np.uint8).astype(np.int64)
        end = np.cumsum(lengths)
        start = end - lengths
        who = np.flatnonzero(lengths)
        at, stop, begin = start[who], end[who], start[who]
        node, best, best_end = np.zeros(len(who), np.int64), np.zeros(len(who), np.int64), begin.copy()
        owners, tokens = [], []
        while len(who):
            node = np.where(at < stop, self._next(node, text[at]), -1)
            here = np.where(node >= 0, self.node_token[node], -1)
            at = at + 1
            longer = here >= 0
            best = np.where(longer, here, best)
            best_end = np.where(longer, at, best_end)
            stuck = node < 0
            if stuck.any():
                owners.append(who[stuck])
                tokens.append(best[stuck])
                at = np.where(stuck, best_end, at)
                node = np.where(stuck, 0, node)
                left = at < stop
                if not (left | ~stuck).all():
                    keep = left | ~stuck
                    who, at, stop, node, best, best_end = (x[keep] for x in (who, at, stop, node, best, best_end))
        if not owners:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        owner, token = np.concatenate(owners), np.concatenate(tokens)
        order = np.argsort(owner, kind="stable")
        return owner[order], token[order]

    def _build_trie(self) -> None:
        """The vocabulary as a trie whose steps (node * 256 + byte -> node) are in one open hash table."""
        child: dict[int, int] = {}
        token = [-1]
        for word, t in self.ids.items():
            n = 0
            for b in word:
                m = child.get(n * 256 + b)
                if m is None:
                    child[n * 256 + b] = m = len(token)
                    token.append(-1)
                n = m
            token[n] = t
        self.node_token = np.array(token, np.int64)
        keys, values = np.fromiter(child, np.int64, len(child)), np.fromiter(child.values(), np.int64, len(child))
        bits = max(10, int(len(keys) * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        self.step_key, self.step_to, self.probes = np.full((1 << bits) + 64, -1), np.full((1 << bits) + 64, -1), 0
        while len(keys):
            slot = self._slot(keys) + self.probes
            free = self.step_key[slot] < 0
            put, first = np.unique(slot[free], return_index=True)
            self.step_key[put], self.step_to[put] = keys[free][first], values[free][first]
            left = self.step_key[slot] != keys
            keys, values = keys[left], values[left]
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def _next(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        key = node * 256 + byte
        slot = self._slot(key)
        out = np.where(self.step_key[slot] == key, self.step_to[slot], -1)
        wait = np.flatnonzero((out < 0) & (self.step_key[slot] >= 0))
        for k in range(1, self.probes):
            if not len(wait):
                break
            s = slot[wait] + k
            out[wait] = np.where(self.step_key[s] == key[wait], self.step_to[s], -1)
            wait = wait[(out[wait] < 0) & (self.step_key[s] >= 0)]
        return out

    def compatible(self, pairs: np.ndarray) -> np.ndarray:
        """For each pair (left * size + right): whether merging the two tokens' bytes gives them back."""
        slot = ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - PAIR_BITS)).view(np.int64)
        found = self.pairs[slot]
        ok = (found & 1).astype(bool)
        new = np.flatnonzero(found >> 1 != pairs)
        if len(new):
            unknown, back = np.unique(pairs[new], return_inverse=True)
            verdict = np.fromiter((self.exact(self.bytes[a] + self.bytes[b]) == [a, b] for a, b in zip((unknown // self.size).tolist(), (unknown % self.size).tolist(), strict=True)), bool, len(unknown))
            ok[new] = verdict[back]
            self.pairs[slot[new]] = pairs[new] << 1 | ok[new]  # the table holds one pair a slot; a pair pushed out is worked out again
        return ok

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        owner, token = self.propose(words)
        failed = np.zeros(len(words), bool)
        failed[owner[~self.sound[token]]] = True
        inner = owner[1:] == owner[:-1]
        where = owner[1:][inner]
        failed[where[~self.compatible(token[:-1][inner] * self.size + token[1:][inner])]] = True
        self.stats["words"] += len(words)
        self.stats["failed"] += int(failed.sum())
        coded = token.astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(owner, minlength=len(words)))).tolist()
        out = [coded[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        for i in np.flatnonzero(failed).tolist():
            ids = self.exact(words[i])
            out[i] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def forget(self) -> None:
        """Empty the table of pieces: piece -> number, and by number where its ids lie in ``flat`` and how many they are. Number 0 has no ids; then come the special tokens."""
        self.index: dict[str | bytes | int, int] = {b"": 0} | {v: k for k, v in enumerate(self.special.values(), 1)}
        self.flat, self.piece_at, self.piece_n = np.array([*self.special.values()], np.uint32), np.arange(-1, len(self.special)), np.ones(len(self.index), np.int64)
        self.piece_at[0] = self.piece_n[0] = 0
        self.held = np.zeros(len(self.index), np.int32)  # by number, how many batches have held the piece

    def make_room(self) -> None:
        """Empty the table but for pieces that more than one batch has held, where these are at most half of what fits."""
        often = np.flatnonzero(self.held > 1)
        often = often[often > len(self.special)]
        if len(often) > MOST_PIECES // 2:
            often = often[:0]
        ids, ends = gather(self.flat, self.piece_at, self.piece_n, often)
        names, sizes = list(self.index), self.piece_n[often]  # in the order of their numbers
        kept = [names[k] for k in often.tolist()]
        self.forget()
        self._number(kept, ids, ends - sizes, sizes)
        self.held[-len(kept) or len(self.held) :] = 1

    def _number(self, pieces: list[str | bytes], ids: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        """The next numbers for pieces whose ids lie in ``ids``."""
        self.index.update(zip(pieces, range(len(self.index), len(self.index) + len(pieces)), strict=True))
        self.piece_at, self.piece_n = np.concatenate([self.piece_at, len(self.flat) + at]), np.concatenate([self.piece_n, n])
        self.flat, self.held = np.concatenate([self.flat, ids]), np.concatenate([self.held, np.zeros(len(pieces), np.int32)])

    def learn(self, pieces: list[str | bytes]) -> None:
        """Encode pieces that are not known yet, all their new words together."""
        if len(self.words) > MOST_PIECES // 8:
            self.words.clear()
        plain, ended, other = [], [], []
        for p in pieces:  # letters alone are one word; most of the rest are letters and one sign
            (plain if isinstance(p, str) and p.isalpha() else ended if isinstance(p, str) and p[-1:] in _SIGNS and p[:-1].isalpha() else other).append(p)
        known, words = self.index, self.words
        stems = {p[:-1] for p in ended}
        plain += [p for p in stems.difference(plain) if p not in known]
        split = [_WORDS.findall(_text(p)) for p in other]
        new = list({w for x in split for w in x if w not in words}.union(x for x in _SIGNS if x not in words))
        coded = self.encode_words([*(b" " + p.encode() for p in plain), *(w.encode() for w in new)])
        own = dict(zip(plain, coded, strict=False))
        words.update(zip(new, coded[len(plain) :], strict=True))
        held = list(stems.difference(own))  # stems that the table has already
        flat, ends = gather(self.flat, self.piece_at, self.piece_n, np.fromiter(map(known.__getitem__, held), np.int64, len(held)))
        raw, ends = flat.astype("<u4", copy=False).tobytes(), (4 * ends).tolist()
        stem = own | dict(zip(held, (raw[a:b] for a, b in zip([0, *ends], ends, strict=False)), strict=True))
        coded = [*own.values(), *(stem[p[:-1]] + words[p[-1]] for p in ended), *(b"".join(map(words.__getitem__, x)) for x in split)]
        at, n = _places(coded)
        self._number([*own, *ended, *other], np.frombuffer(b"".join(coded), "<u4"), at // 4, n // 4)

    def cut(self, text: str) -> list[str | bytes]:
        """Pieces that are encoded independently: the first as bytes, the others as text without the space before them. Where white space follows a space there is no cut."""
        if not text:
            return []
        at = [0, *(m.start() for m in _CUT.finditer(text)), len(text)]
        head, *rest = (text[a:b] for a, b in zip(at, at[1:], strict=False))
        return [*([head.encode()] if head else []), *(x[1:] for x in rest)]

    def encode_batch(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        for at in range(0, len(texts), TOGETHER):
            ids, ends = self._encode_some(texts.slice(at, TOGETHER))
            coded, ends = memoryview(ids.astype("<u4", copy=False)).cast("B"), (4 * ends).tolist()
            out += [bytes(coded[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
        return out

    def _parts(self, text: str) -> list[str | bytes | int]:
        """Pieces of a text, special tokens as their ids."""
        own, at = [], 0
        while self.cut_special and (found := self.cut_special.search(text, at)):
            own += self.cut(text[at : found.start()])
            own.append(self.special[found.group()])
            at = found.end()
        return own + self.cut(text[at:])

    def _encode_some(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one behind the other, and where each text's end."""
        cut = pc.split_pattern(texts, " ")
        places, numbered = cut.offsets.to_numpy().astype(np.int64), cut.values.dictionary_encode()
        names, which = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy()  # no scalar for each name on the way
        numbers = self._known(names)
        # No cut precedes an empty piece or one that starts with white space, so its text is cut anew; so is one with a special token.
        own = (numbers == ODD)[which]
        own[places[:-1]] = False
        careful = np.zeros(len(texts), bool)
        careful[np.searchsorted(places, np.flatnonzero(own), side="right") - 1] = True
        for token in self.special:
            careful |= pc.match_substring(texts, token).to_numpy(zero_copy_only=False)
        heads = [p.encode() for p in cut.values.take(pa.array(places[:-1])).to_pylist()]
        anew = {int(k): self._parts(texts[int(k)].as_py()) for k in np.flatnonzero(careful)}
        others = set(heads).union(*anew.values())
        new = [names[k] for k in np.flatnonzero(numbers == UNKNOWN).tolist()] + [p for p in others if p not in self.index]
        if len(self.index) + len(new) > MOST_PIECES:
            self.make_room()
            numbers = self._known(names)
            new = [names[k] for k in np.flatnonzero(numbers == UNKNOWN).tolist()] + [p for p in others if p not in self.index]
        if new:
            self.learn(list(dict.fromkeys(new)))
            some = np.flatnonzero(numbers == UNKNOWN)
            numbers[some] = [self.index[names[k]] for k in some.tolist()]
        index = self.index
        self.held[numbers[numbers >= 0]] += 1
        pieces = numbers[which]
        pieces[places[:-1]] = np.fromiter(map(index.__getitem__, heads), np.int64, len(heads))
        if anew:
            parts = [pieces[a:b] for a, b in zip(places, places[1:], strict=False)]
            for k, x in anew.items():
                parts[k] = np.fromiter(map(index.__getitem__, x), np.int64, len(x))
            pieces, places = np.concatenate(parts), np.cumsum([0, *map(len, parts)])
        ids, ends = gather(self.flat, self.piece_at, self.piece_n, pieces)
        return ids, np.concatenate([[0], ends])[places[1:]]

    def _known(self, names: list[str]) -> np.ndarray:
        """The pieces' numbers, ODD or UNKNOWN; the table never holds an odd piece."""
        numbers = np.fromiter(map(self.index.get, names, repeat(UNKNOWN)), np.int64, len(names))
        some = np.flatnonzero(numbers == UNKNOWN)
        numbers[some] = [ODD if not (p := names[k]) or p[0] in _WHITE else UNKNOWN for k in some.tolist()]
        return numbers

    def decode(self, ids: bytes) -> str:
        """The text of ids as little-endian unsigned 32-bit integers; broken UTF-8 becomes the replacement character."""
        return gather(self.letters, self.letter_at, self.letter_n, np.frombuffer(ids, "<u4"))[0].tobytes().decode("utf-8", "replace")


def _places(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Where each part begins in their join, and its length."""
    n = np.fromiter(map(len, parts), np.int64, len(parts))
    return np.cumsum(n) - n, n


def gather(flat: np.ndarray, at: np.ndarray, n: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts ``which`` of ``flat``, one behind the other, and where each ends; so many at a time that places never take more than a few megabytes."""
    out = [flat[:0]]
    for k in range(0, len(which), 1 << 17):
        some = which[k : k + (1 << 17)]
        size = n[some]
        behind = np.cumsum(size)
        out.append(flat[np.repeat(at[some] - behind + size, size) + np.arange(behind[-1])])
    return np.concatenate(out), np.cumsum(n[which])


def _text(piece: str | bytes) -> str:
    return " " + piece if isinstance(piece, str) else piece.decode()


@cache
def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    return Encoder(path)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def encode_decode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; with ``with_ids`` also the ids and the decoded text.

    Without ``path`` each worker asks the installed tokenizer package for its own copy of the vocabulary.
    """

    def work(ids: list, texts: pa.Array) -> dict:
        e = encoder(path or vocabulary_path())
        coded = e.encode_batch(texts)
        decoded = [e.decode(c) for c in coded]
        out = {"doc_id": ids, "n_tokens": [len(c) // 4 for c in coded], "ids_sha256": [hashlib.sha256(c).hexdigest() for c in coded], "decoded_sha256": [hashlib.sha256(d.encode()).hexdigest() for d in decoded]}
        return out | ({"ids": [np.frombuffer(c, "<u4").tolist() for c in coded], "decoded": decoded} if with_ids else {})

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<long>, decoded string" if with_ids else "")
    return map_texts(id_text(docs, id_col, text_col), work, schema, arrow=True)
