"""Personal data by a semi-Markov conditional random field over whole candidate spans, on top of fixed patterns.

A text is cut into chunks at white space. A candidate is a run of one to ``LONGEST`` chunks that holds a digit, an at sign or a
spelled-out one, or a word like password with a sign behind it; its features describe the span as a whole (its digits, checksum, grouping, shape, the word before it). Dynamic programming over
segments chooses boundaries and types together; an entity has at most ``LONGEST`` chunks, everything else is single chunks of
type "other". Weights are fitted by maximum likelihood (forward-backward over segments) on sentences made from
templates, once per driver. Every stretch of chunks that candidates reach is decoded whole, however long: segments are scored as the program
comes to their end, and only the best scores and their origins are kept. Between such stretches every chunk is "other".

The contract's patterns always stay; what the field finds beside them is added where it overlaps none of them.

Defined cases: null text is empty and has no span; null ids and repeated rows are handled like any other; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.llm.text import give_back, id_text, map_texts, small_batches

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "id_number")
LONGEST = 6

# The contract's patterns, so that no stretch of text is gone over again from each of its characters: what stands before an at sign is found
# from the sign back, and an address of digits begins where a run of digits does, as the runs behind a later start are the same.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"@[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else (int(d) * 2 - 9 if d > "4" else int(d) * 2) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`` in one pass: no match holds two at signs."""
    end = 0
    for m in _HOST.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            end = m.end()
            yield start, end


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The contract's spans by kind, then start."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        if "." in text:
            out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_small, m.group().split(".")))]
        out += [("card", *m.span()) for m in _CARD.finditer(text) if m.end() - m.start() >= 13 and 13 <= len(d := _NOT_DIGIT.sub("", m.group())) <= 19 and luhn(d)]
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return out


_CHUNK = re.compile(r"\S+")
_KEYS = r"password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key"
_TRIGGER = re.compile(r"[0-9@]|[\[({]at[\])}]")
_SIGN, _ASKS = re.compile(r"[=:]"), re.compile(rf"(?i)\b(?:{_KEYS})\s?$")
_LEFT, _RIGHT = "\"'`<[{,;:", "\"'`>]},;:.!?"
_SHAPES = {
    "email": re.compile(r"[\w.%+-]+@[\w-]+(\.[\w-]+)+"),
    "email_spelled": re.compile(r"[\w.%+-]+ ?[\[({]at[\])}] ?[\w-]+( ?([\[({]dot[\])}]|\.|dot) ?[\w-]+)+"),
    "ip": re.compile(r"(25[0-5]|2[0-4]\d|1?\d?\d)(\.(25[0-5]|2[0-4]\d|1?\d?\d)){3}"),
    "ip6": re.compile(r"([0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}"),
    "phone_plus": re.compile(r"(\+|00)\d[\d ().-]{6,}\d"),
    "phone_paren": re.compile(r"\(\d{2,4}\) ?\d{3}[ .-]?\d{3,4}"),
    "phone_groups": re.compile(r"(1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}"),
    "id_groups": re.compile(r"\d{3}-\d{2}-\d{4}"),
    "iban": re.compile(r"[A-Z]{2}\d{2}( ?[A-Z0-9]{4}){2,7}( ?[A-Z0-9]{1,4})?"),
    "number": re.compile(r"[-+$€£]?\d[\d,]*(\.\d+)?[%€$]?"),
    "date": re.compile(r"\d{1,4}[-/.]\d{1,2}[-/.]\d{1,4}"),
    "time": re.compile(r"\d{1,2}:\d{2}(:\d{2})?"),
    "key_value": re.compile(rf"(?i)({_KEYS}) ?[=:] ?\S{{6,}}"),
    "key_long_value": re.compile(rf"(?i)({_KEYS}) ?[=:] ?\S{{12,}}"),
    "hex": re.compile(r"(?i)[0-9a-f]{16,}"),
    "mixed": re.compile(r"(?=\S*\d)(?=\S*[A-Za-z])[\w+/=-]{16,}"),
}
_BEFORE = {
    "asks_secret": re.compile(r"(?i)\W*(password|passwd|pwd|secret|token|key|api[_-]?key)\W*"),
    "asks_phone": re.compile(r"(?i)\W*(call|tel|phone|mobile|fax|cell)\W*"),
    "asks_id": re.compile(r"(?i)\W*(ssn|iban|passport|account)\W*"),
}


@cache
def _features() -> dict[str, int]:
    names = ["always", *(f"chunks={n}" for n in range(1, LONGEST + 1)), *(f"shape={k}" for k in _SHAPES), *(f"before={k}" for k in _BEFORE), "digits=0", "digits<7", "digits<10", "digits<13", "digits<20", "digits>19", "luhn", "letters", "no_shape", "part_of_larger", "edge_sign"]
    return {k: i for i, k in enumerate(names)}


def span_features(text: str, chunks: list[tuple[int, int]], i: int, j: int) -> list[int]:
    """Features of chunks i to j - 1 taken as one span."""
    a, b = trim(text, chunks[i][0], chunks[j - 1][1])
    span, ids = " ".join(text[a:b].split()), _features()
    digits = _NOT_DIGIT.sub("", span)
    n = len(digits)
    names = ["always", f"chunks={j - i}", "digits=0" if not n else next((f"digits<{k}" for k in (7, 10, 13, 20) if n < k), "digits>19")]
    shapes = [f"shape={k}" for k, p in _SHAPES.items() if p.fullmatch(span)]
    names += shapes or ["no_shape"]
    if 13 <= n <= 19 and luhn(digits) and not re.search(r"[^0-9 -]", span):
        names.append("luhn")
    if any(c.isalpha() for c in span):
        names.append("letters")
    if i and (before := [f"before={k}" for k, p in _BEFORE.items() if p.fullmatch(text[slice(*chunks[i - 1])]) or (i > 1 and text[slice(*chunks[i - 1])] in "=:" and p.fullmatch(text[slice(*chunks[i - 2])]))]):
        names += before
    digit_end = lambda k: text[chunks[k][0] : chunks[k][1]].strip(_LEFT + _RIGHT + "()+-").isdigit()
    if (i and digit_end(i - 1)) or (j < len(chunks) and digit_end(j)):
        names.append("part_of_larger")
    if a != chunks[i][0] or b != chunks[j - 1][1]:
        names.append("edge_sign")
    return [ids[k] for k in names]


def trim(text: str, a: int, b: int) -> tuple[int, int]:
    """A span without the quotes and stops around it."""
    while a < b and text[a] in _LEFT:
        a += 1
    while b > a and text[b - 1] in _RIGHT:
        b -= 1
    if text[a : a + 1] == "(" and ")" not in text[a:b]:
        a += 1
    if text[b - 1 : b] == ")" and "(" not in text[a:b]:
        b -= 1
    return a, b


def _asked(text: str) -> Iterator[int]:
    """Where words like password begin that have a sign behind them: from each sign back, as signs are rare."""
    for m in _SIGN.finditer(text):
        low = max(0, m.start() - 16)  # longer than any of the words
        if found := _ASKS.search(text[low : m.start()]):
            yield low + found.start()


def triggered(text: str) -> bool:
    return bool(_TRIGGER.search(text)) or next(_asked(text), None) is not None


def hot_chunks(text: str, chunks: list[tuple[int, int]]) -> list[int]:
    """Chunks in which a trigger begins."""
    begins = [a for a, _ in chunks]
    return sorted({bisect_right(begins, at) - 1 for at in chain((m.start() for m in _TRIGGER.finditer(text)), _asked(text))}) if chunks else []


class Lattice:
    """The candidate segments of a run of chunks, by their end: features of each chunk alone, and (start, features) of candidates."""

    def __init__(self, text: str, chunks: list[tuple[int, int]], hot: list[int] | None = None, keep: bool = False):
        self.kept: dict[int, tuple] | None = {} if keep else None  # fitting goes over a sentence again and again
        self.text, self.chunks, self.n = text, chunks, len(chunks)
        self.hot_before = np.zeros(self.n + 1, np.int64)
        self.hot_before[1:] = np.cumsum(np.isin(np.arange(self.n), hot_chunks(text, chunks) if hot is None else hot))

    def ending(self, j: int) -> tuple[list[int], list[tuple[int, list[int]]]]:
        """Features of chunk j - 1 alone, and the candidates that end behind it."""
        if self.kept is None:
            return self._ending(j)
        if j not in self.kept:
            self.kept[j] = self._ending(j)
        return self.kept[j]

    def _ending(self, j: int) -> tuple[list[int], list[tuple[int, list[int]]]]:
        own = span_features(self.text, self.chunks, j - 1, j)
        starts = [i for i in range(j - 1, max(j - LONGEST, 0) - 1, -1) if self.hot_before[i] < self.hot_before[j]]
        return own, [(i, own if i == j - 1 else span_features(self.text, self.chunks, i, j)) for i in starts]


class Field:
    """Weights of (type, feature) and of (type before, type); type 0 is "other"."""

    def __init__(self) -> None:
        self.weights = np.zeros((len(KINDS) + 1, len(_features())))
        self.moves = np.zeros((len(KINDS) + 1, len(KINDS) + 1))

    def _ending(self, x: Lattice, j: int) -> list[tuple[int, np.ndarray]]:
        """(start, scores of the types that the segment can have) of the segments that end behind chunk j - 1."""
        own, candidates = x.ending(j)
        s = np.full(len(KINDS) + 1, -np.inf)
        s[0] = self.weights[0, own].sum()
        out = [(j - 1, s)]
        for i, f in candidates:
            s = self.weights[:, f].sum(1)
            s[0] = -np.inf
            out.append((i, s))
        return out

    def _scores(self, x: Lattice) -> list[list[tuple[int, np.ndarray]]]:
        return [[], *(self._ending(x, j) for j in range(1, x.n + 1))]

    def decode(self, x: Lattice) -> list[tuple[int, int, int]]:
        """The best segmentation's entities: (first chunk, chunk behind, type)."""
        k = len(KINDS) + 1
        best = np.full((x.n + 1, k), -np.inf)
        best[0, 0] = 0
        come = np.zeros((x.n + 1, k, 2), np.int32)  # start of the best last segment, and the type before it
        for j in range(1, x.n + 1):
            for i, s in self._ending(x, j):
                into = best[i][:, None] + self.moves
                who = into.argmax(0)
                value = into[who, np.arange(k)] + s
                better = value > best[j]
                best[j, better], come[j, better, 0], come[j, better, 1] = value[better], i, who[better]
        j, y, out = x.n, int(best[x.n].argmax()), []
        while j:
            i, before = come[j, y].tolist()
            if y:
                out.append((i, j, y))
            j, y = i, before
        return out[::-1]

    def gradient(self, x: Lattice, gold: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Of the log-likelihood of ``gold`` entities: observed less expected features."""
        scores, k = self._scores(x), len(KINDS) + 1
        alpha, beta = np.full((x.n + 1, k), -np.inf), np.full((x.n + 1, k), -np.inf)
        alpha[0, 0], beta[x.n] = 0, 0
        for j in range(1, x.n + 1):
            for i, s in scores[j]:
                alpha[j] = np.logaddexp(alpha[j], np.logaddexp.reduce(alpha[i][:, None] + self.moves, axis=0) + s)
        for j in range(x.n, 0, -1):
            for i, s in scores[j]:
                beta[i] = np.logaddexp(beta[i], np.logaddexp.reduce(self.moves + (s + beta[j])[None, :], axis=1))
        z = np.logaddexp.reduce(alpha[x.n])
        w, m = np.zeros_like(self.weights), np.zeros_like(self.moves)
        single, features = [], {}
        for j in range(1, x.n + 1):
            own, candidates = x.ending(j)
            single.append(own)
            features |= {(i, j): f for i, f in candidates}
            for i, s in scores[j]:
                p = np.exp(alpha[i][:, None] + self.moves + (s + beta[j])[None, :] - z)
                m -= p
                q = p.sum(0)
                if np.isfinite(s[0]):
                    w[0, single[i]] -= q[0]
                else:
                    w[:, features[i, j]] -= q[:, None]
        at, before, own = 0, 0, {(i, j): y for i, j, y in gold}
        starts = {i: (j, y) for (i, j), y in own.items()}
        while at < x.n:
            j, y = starts.get(at, (at + 1, 0))
            w[y, features[at, j] if y else single[at]] += 1
            m[before, y] += 1
            at, before = j, y
        return w, m


def _sentences(n: int, seed: int) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Template sentences with their entities (first chunk, chunk behind, type)."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 4)))
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    letters = lambda k: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(k))
    hexa = lambda k: "".join(r.choice("0123456789abcdef") for _ in range(k))

    def card() -> str:
        d = r.choice("3456") + num(14)
        d += next(c for c in "0123456789" if luhn(d + c))
        return r.choice([d, " ".join(d[i : i + 4] for i in range(0, 16, 4)), "-".join(d[i : i + 4] for i in range(0, 16, 4))])

    ip = lambda: ".".join(str(r.randint(0, 255)) for _ in range(4))
    host = lambda: f"{word()}{r.choice(['', num(1)])}.{r.choice(['com', 'org', 'example.com', 'net', 'de'])}"
    made = {
        "email": [lambda: f"{word()}.{num(2)}@{host()}", lambda: f"{word()}@{host()}", lambda: f"{word()} [at] {word()} [dot] com", lambda: f"{word()} (at) {word()}.org"],
        "ip": [ip, lambda: ":".join(hexa(4) for _ in range(8))],
        "card": [card],
        "phone": [lambda: f"+1 ({num(3)}) 555-{num(4)}", lambda: f"({num(3)}) {num(3)}-{num(4)}", lambda: f"{num(3)}-{num(3)}-{num(4)}", lambda: f"+49 {num(3)} {num(7)}", lambda: f"{num(3)}.{num(3)}.{num(4)}", lambda: f"0044 {num(4)} {num(6)}"],
        "secret": [lambda: f"password={hexa(r.randint(12, 20))}", lambda: f'token = "{hexa(40)}"', lambda: f"api_key: {word()}{num(4)}{hexa(16)}", lambda: f"secret={word()}{num(6)}", lambda: f"password={letters(r.randint(12, 24))}", lambda: f"token: {letters(r.randint(12, 24))}"],
        "id_number": [lambda: f"{num(3)}-{num(2)}-{num(4)}", lambda: f"DE{num(2)} {num(4)} {num(4)} {num(4)} {num(4)} {num(2)}", lambda: f"GB{num(2)}ABCD{num(14)}"],
    }
    plain = [lambda: num(r.randint(1, 6)), lambda: f"19{num(2)}", lambda: f"{num(2)}.{num(2)}", lambda: f"${num(3)}.{num(2)}", lambda: f"{num(2)}%", lambda: f"20{num(2)}-0{num(1)}-1{num(1)}", lambda: f"1{num(1)}:{num(2)}", lambda: f"v{num(1)}.{num(1)}", lambda: f"{num(1)}.{num(1)}.{num(1)}", lambda: f"@{word()}", lambda: f"{word()}{num(2)}", lambda: f"{num(3)} {num(3)}", lambda: f"({num(1)})", lambda: num(12), lambda: f"{num(9)}", lambda: f"{num(2)}/{num(2)}", lambda: f"secret: {word()}", lambda: f"password: {word()}"]
    out = []
    for _ in range(n):
        parts, gold, at = [], [], 0
        for _ in range(r.randint(2, 4)):
            for _ in range(r.randint(1, 3)):
                w = word() + r.choice(["", "", "", ",", "."])
                parts.append(w)
                at += 1
            kind = r.choice([None, *KINDS])
            piece = r.choice(plain if kind is None else made[kind])()
            size = len(piece.split())
            if kind:
                gold.append((at, at + size, KINDS.index(kind) + 1))
            parts.append(piece + r.choice(["", "", ".", ","]))
            at += size
        out.append((" ".join([*parts, word()]), gold))
    return out


@cache
def trained(sentences: int = 400, epochs: int = 4, seed: int = 11) -> Field:
    """Maximum likelihood by AdaGrad with a small Gaussian prior."""
    field = Field()
    data = [(Lattice(t, [m.span() for m in _CHUNK.finditer(t)], keep=True), g) for t, g in _sentences(sentences, seed)]
    sums = [np.full_like(field.weights, 1e-2), np.full_like(field.moves, 1e-2)]
    order = random.Random(seed)
    for _ in range(epochs):
        order.shuffle(data)
        for x, gold in data:
            for values, g, s in zip((field.weights, field.moves), field.gradient(x, gold), sums, strict=True):
                g = g - 1e-3 * values
                s += g * g
                values += 0.5 * g / np.sqrt(s)
    return field


def added_spans(text: str, field: Field, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """What the field finds that overlaps no span of ``base``."""
    out, last = [], -1
    taken: list[list[int]] = []  # disjoint, in order
    for a, b in sorted((a, b) for _, a, b in base):
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(b, taken[-1][1])
        else:
            taken.append([a, b])
    chunks = [m.span() for m in _CHUNK.finditer(text)]
    hot = hot_chunks(text, chunks)
    k = 0
    while k < len(hot):
        m = k
        while m + 1 < len(hot) and hot[m + 1] - hot[m] < 2 * LONGEST:
            m += 1
        low, high = max(0, hot[k] - LONGEST), min(len(chunks), hot[m] + LONGEST + 1)
        part = chunks[low:high]
        for i, j, y in field.decode(Lattice(text, part, [h - low for h in hot[k : m + 1]])):
            a, b = trim(text, part[i][0], part[j - 1][1])
            before = bisect_left(taken, [b]) - 1  # the last one that begins before the span's end
            if a < b and a >= last and (before < 0 or taken[before][1] <= a):
                out.append((KINDS[y - 1], a, b))
                last = b
        k = m + 1
    return out


def all_spans(text: str, field: Field) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, all spans), each by kind as listed, then start."""
    base = base_spans(text)
    every = base + added_spans(text, field, base) if triggered(text) else base
    return base, sorted(every, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans."""
    field = trained()

    def work(ids: list, texts: list) -> dict:
        found = [all_spans(t, field) for t in texts]
        counts = {f"n_{k}": [sum(s[0] == k for s in base) for base, _ in found] for k in BASE_KINDS}
        return {"doc_id": ids, **counts, "base_sha256": [hashlib.sha256(_written(base).encode()).hexdigest() for base, _ in found], "spans": [_written(every) for _, every in found]}

    return map_texts(id_text(docs, id_col, text_col), work, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span, or chain of overlapping spans, replaced by the kind of its first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask_pii(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with masked texts and, where there is such a column, their new lengths; null texts stay null."""
    field = trained()
    small_batches(docs.sparkSession)

    def masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = [t if t is None or not triggered(t) else mask(t, all_spans(t, field)[1]) for t in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
        give_back()

    out = docs.mapInArrow(masked, docs.schema)
    if length_col and length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        out = out.withColumn(length_col, F.length(text_col).cast(kind))
    return out.select(*docs.columns)
