"""Substring dedup over sliding sentence spans.

A sentence ends at a full stop, question mark or exclamation mark (also their full-width forms) before white space, or at a line's end. Every run
of ``size`` consecutive sentences with at least ``min_words`` words is hashed to 128 bits, white space counted as one space. Over all
documents the first place of each hash (smallest doc_id, then position) stays; every sentence that another place of
it covers is removed, all judged on the input.

With ``run_words``, runs of words are hashed beside them, for passages of short or long sentences or that start and end inside sentences. A word is a
cut if its hash is the least of some ``WINDOW`` successive words, so cuts are at most ``WINDOW`` words apart and depend on the words around them only;
a run reaches from a cut to the first cut at least ``run_words`` words on. Of a passage's L words those from WINDOW to L - WINDOW have the same cuts wherever it
stands, so with L >= run_words + 4 WINDOW - 3 (51 for ``RUN``) it holds a run that is hashed in each of its places. The words of
another place are removed with the white space behind each; a sentence that loses words counts as removed.

Spans are grouped after map-side counting; the repeated ones, written out, meet the spans in a join of plain exchanges, so that AQE
splits a span that a large share of the documents holds. A Bloom filter of the repeated spans, bounded in size, lets the other spans of the
table pass by that join; where it is full, more of them are moved and the result is the same.

A row is known by its id and a hash of its text, so what one row loses leaves other rows with its id alone.

Defined cases: null text is empty; a text with fewer sentences than ``size`` keeps them all; rows that repeat an id keep what they share with each other
and lose what smaller ids hold or what repeats within them; null ids are one id that sorts first; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.functions.storage import materialize
from facetlake.llm.exact_dedup import flag_ids
from facetlake.llm.text import give_back, id_text, map_texts

SIZE, MIN_WORDS, NO_ID = 3, 12, -(1 << 63)
RUN, WINDOW = 18, 9
#: Bits of the filter of repeated spans at most, a broadcast of a quarter as many bytes.
MAX_BITS = 1 << 26
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
# One leading class, so that the search skips to it; the marks of the first kind need white space behind them.
_ENDS = re.compile(r"[.!?\n。！？](?:(?<=[.!?])[\x20\x09-\x0D]+|(?<![.!?])[\x20\x09-\x0D]*)")


def sentences(text: str) -> list[str]:
    """Sentences with the white space that follows them; joined they are the text."""
    at = [0, *(m.end() for m in _ENDS.finditer(text)), len(text)]
    parts = [text[a:b] for a, b in zip(at, at[1:], strict=False) if a < b]
    if len(parts) > 1 and not parts[0].strip():
        parts[:2] = [parts[0] + parts[1]]
    return parts


def span_hashes(text: str, size: int, min_words: int) -> list[tuple[int, bytes]]:
    """(position of the first sentence, 128-bit hash) of every span."""
    words = [s.encode().split() for s in sentences(text)]
    if len(words) < size:
        return []
    counts = np.cumsum([0, *map(len, words)])
    joined = [b" ".join(w) for w in words]
    digest = xxhash.xxh3_128_digest
    return [(i, digest(b"\n".join(joined[i : i + size]))) for i in range(len(words) - size + 1) if counts[i + size] - counts[i] >= min_words]


def word_runs(words: list[bytes], least: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the runs of at least so many words from cut to cut, and the words behind their last."""
    if len(words) < least + WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) * np.uint32(0x9E3779B1)
    low = h[: len(h) - WINDOW + 1].copy()
    for k in range(1, WINDOW):
        np.minimum(low, h[k : len(h) - WINDOW + 1 + k], out=low)
    cut = np.zeros(len(h), bool)
    for k in range(WINDOW):
        cut[k : len(low) + k] |= h[k : len(low) + k] == low
    at = np.flatnonzero(cut)
    end = np.searchsorted(at, at + least)
    some = end < len(at)
    return at[some], at[end[some]]


def run_hashes(text: str, least: int) -> list[tuple[int, bytes]]:
    """(-1 - position of the first word, 128-bit hash) of every run of words."""
    words = text.encode().split()
    first, end = word_runs(words, least)
    joined, digest = b" ".join(words), xxhash.xxh3_128_digest
    begins = np.concatenate([[0], np.flatnonzero(np.frombuffer(joined, np.uint8) == 32) + 1, [len(joined) + 1]])
    return [(x, digest(joined[a:b])) for x, a, b in zip((-1 - first).tolist(), begins[first].tolist(), (begins[end] - 1).tolist(), strict=True)]


def without(text: str, parts: list[str], starts: list[int], size: int, run_words: int) -> tuple[str, int]:
    """The text without the spans and runs that start at ``starts``, and how many sentences that takes from."""
    gone = {k for a in starts if a >= 0 for k in range(a, a + size)}
    own = {-1 - a for a in starts if a < 0}
    if not own:
        return ("".join(x for k, x in enumerate(parts) if k not in gone) if gone else text), len(gone)
    lengths = np.array([len(x) for x in parts])
    behind = np.cumsum(lengths)
    drop = np.zeros(len(text), bool)
    drop[: behind[-1]] = np.repeat(np.isin(np.arange(len(parts)), list(gone)), lengths)
    begins = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    for a, b in zip(*(x.tolist() for x in word_runs(text.encode().split(), run_words)), strict=True):
        if a in own:
            drop[begins[a] : begins[b]] = True
    hit = np.unique(np.searchsorted(behind, np.flatnonzero(drop), side="right"))
    edges = np.flatnonzero(np.diff(drop, prepend=True, append=True)).tolist()
    return "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)), len(hit)


def spans(docs: DataFrame, size: int = SIZE, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", run_words: int = 0) -> DataFrame:
    """(doc_key, text_key, at, h1, h2, again) of every span of every row, runs of words with ``at`` below 0; ``again`` marks what the row itself holds further up."""
    schema = pa.schema([("doc_key", pa.int64()), ("text_key", pa.int64()), ("at", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("again", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                counts, at, hashes, again = [], [], [], []
                for t in part.column("text").to_pylist():
                    found, seen = span_hashes(t, size, min_words) + (run_hashes(t, run_words) if run_words else []), set()
                    own = [x for _, x in found]
                    counts.append(len(found))
                    at += [x for x, _ in found]
                    hashes += own
                    if len(set(own)) == len(own):
                        again += [False] * len(own)
                        continue
                    for x in own:
                        again.append(x in seen)
                        seen.add(x)
                h = np.frombuffer(b"".join(hashes), np.int64).reshape(-1, 2)
                keys = [pa.array(np.repeat(part.column(c).to_numpy(), counts)) for c in ("doc_key", "text_key")]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(at, pa.int32()), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(again, pa.bool_())], schema=schema)
        give_back()

    return _keyed(docs, id_col, text_col).select("doc_key", "text_key", "text").mapInArrow(run, "doc_key long, text_key long, at int, h1 long, h2 long, again boolean")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_text(docs, id_col, text_col).select("doc_id", "text", F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_key"), F.xxhash64("text").alias("text_key"))


def repeated_sentences(docs: DataFrame, size: int = SIZE, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", run_words: int = 0, max_bits: int = MAX_BITS) -> DataFrame:
    """(found_key, found_text, starts, from_ids): where non-first repeated spans start in a row, and the documents that hold them first."""
    every = materialize(spans(docs, size, min_words, id_col, text_col, run_words), "spans")
    once = every.where("not again")
    first = materialize(once.groupBy("h1", "h2").agg(F.min("doc_key").alias("first_key"), F.max("doc_key").alias("last_key")).where("last_key > first_key").drop("last_key"), "repeated")
    some = flag_ids(once.withColumn("sha", F.col("h1")), first.select("h1"), max_bits).where("candidate")
    others = some.join(first.hint("merge"), ["h1", "h2"]).where("doc_key > first_key").select("doc_key", "text_key", "at", "first_key")
    found = others.unionAll(every.where("again").select("doc_key", "text_key", "at", F.col("doc_key").alias("first_key")))
    return found.groupBy(F.col("doc_key").alias("found_key"), F.col("text_key").alias("found_text")).agg(F.sort_array(F.collect_set("at")).alias("starts"), F.sort_array(F.collect_set("first_key")).alias("from_ids"))


def span_dedup(docs: DataFrame, size: int = SIZE, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text", run_words: int = 0) -> DataFrame:
    """doc_id, n_sentences, n_removed, removed_chars, n_spans, from_ids, kept_sha256 and the remaining text."""
    found = materialize(repeated_sentences(docs, size, min_words, id_col, text_col, run_words), "found")
    rows = _keyed(docs, id_col, text_col).withColumn("sha", F.xxhash64("doc_key", "text_key"))
    # Only documents that lose something are joined; the texts of the others do not move.
    flagged = flag_ids(rows, found.select(F.xxhash64("found_key", "found_text").alias("row_key")))
    some = flagged.where("candidate").join(found.hint("merge"), (F.col("doc_key") == F.col("found_key")) & (F.col("text_key") == F.col("found_text")), "left").select("doc_id", "text", "starts", "from_ids")
    none = F.lit(None)
    rows = flagged.where("not candidate").select("doc_id", "text", none.cast("array<int>").alias("starts"), none.cast("array<long>").alias("from_ids")).unionAll(some)

    def work(ids: list, texts: list, starts: list, sources: list) -> dict:
        out: dict[str, list] = {k: [] for k in ("doc_id", "n_sentences", "n_removed", "removed_chars", "n_spans", "from_ids", "kept_sha256", "text")}
        for i, t, at, ids_from in zip(ids, texts, starts, sources, strict=True):
            parts = sentences(t)
            kept, n = without(t, parts, at or [], size, run_words)
            for k, v in {"doc_id": i, "n_sentences": len(parts), "n_removed": n, "removed_chars": len(t) - len(kept), "n_spans": len(at or ()), "from_ids": ids_from or [], "kept_sha256": hashlib.sha256(kept.encode()).hexdigest(), "text": kept}.items():
                out[k].append(v)
        return out

    return map_texts(rows, work, "doc_id long, n_sentences long, n_removed long, removed_chars long, n_spans long, from_ids array<long>, kept_sha256 string, text string", ("starts", "from_ids"))
