"""Quality classifier: a linear support-vector model over naive-Bayes features.

A text's features are the indicators of its byte n-grams (1 to ``ORDERS``), hashed. Each is scaled by the log-ratio of
its smoothed shares in the two classes; texts are scaled to length one; a linear hinge-loss model is fitted by dual
coordinate descent, and its margin becomes a probability by a logistic fit on labelled texts that the model has not seen.

The fit takes at most ``sample_rows`` labelled texts (those with the smallest hash of the id, the rarer class
up to half of them), one of each id; all texts are scored, whole. A text comes to the driver as its features, as numbers or as a bit map, whichever is
smaller: never more than 2**BITS / 8 bytes, however long it is.

Defined cases: null text is empty and gets the score of no feature; null labels and ids without a text
are not learned from; of several labels for an id the smallest counts, and of several texts the first in order of characters; without both classes the score is the smoothed share of label 1; null ids are scored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from facetlake.llm.text import give_back, hash_mod, id_text, map_texts, small_batches

ORDERS, BITS, SAMPLE_ROWS = 4, 18, 4000


def dot(a: np.ndarray, b: np.ndarray) -> float:
    """Without BLAS, whose threads are of no use here."""
    return float(np.einsum("i,i->", a, b))


def features(text: str) -> np.ndarray:
    """Sorted distinct hashed n-grams of the text's bytes."""
    raw = np.frombuffer(text.encode(), np.uint8).astype(np.uint64)
    grams, value = [], raw
    for n in range(1, ORDERS + 1):
        if len(raw) < n:
            break
        value = raw if n == 1 else value[:-1] << np.uint64(8) | raw[n - 1 :]
        grams.append(((value + np.uint64(n << 40)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS))
    return np.unique(np.concatenate(grams).astype(np.int32)) if grams else np.zeros(0, np.int32)


def packed(x: np.ndarray) -> bytes:
    """Features as numbers, or as a bit map where that is smaller."""
    if 32 * len(x) < 1 << BITS:
        return x.astype("<i4").tobytes()
    on = np.zeros(1 << BITS, bool)
    on[x] = True
    return np.packbits(on).tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(np.frombuffer(raw, np.uint8))).astype(np.int32) if 8 * len(raw) == 1 << BITS else np.frombuffer(raw, "<i4")


class Packed:
    """Rows of features that are kept packed and opened one at a time."""

    def __init__(self, rows: list[bytes]):
        self.rows = rows

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> np.ndarray:
        return unpacked(self.rows[i])

    def __iter__(self) -> Iterator[np.ndarray]:
        return map(unpacked, self.rows)


class Model:
    """Weights of the scaled indicators, and the logistic curve over the margin."""

    def __init__(self, ratio: np.ndarray, weight: np.ndarray, bias: float, slope: float, shift: float):
        self.ratio, self.weight, self.bias, self.slope, self.shift = ratio, weight, bias, slope, shift

    def margin(self, x: np.ndarray) -> float:
        r = self.ratio[x]
        size = np.sqrt(dot(r, r))
        return dot(r, self.weight[x]) / size + self.bias if size else self.bias

    def score(self, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -30, 30))))


def fit_svm(rows: Sequence[np.ndarray], of: np.ndarray, y: np.ndarray, ratio: np.ndarray, cost: float, epochs: int, seed: int = 7, stop: float = 1e-3) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss over the rows ``of``; the bias is one more feature with value one."""
    weight, bias, alpha = np.zeros(len(ratio)), 0.0, np.zeros(len(of))
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(of)):
            x = rows[of[i]]
            v = ratio[x].astype(np.float64)
            v /= np.sqrt(dot(v, v)) or 1.0
            gradient = y[i] * (dot(weight[x], v) + bias) - 1
            new = min(max(alpha[i] - gradient / (1.0 + dot(v, v)), 0.0), cost)
            step = (new - alpha[i]) * y[i]
            if step:
                weight[x] += step * v
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < stop * cost:
            break
    return weight, bias


def fit(rows: Sequence[np.ndarray], labels: np.ndarray, cost: float = 10.0, epochs: int = 30) -> Model:
    share = (labels.sum() + 1) / (len(labels) + 2)
    prior = float(np.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32), 0.0, 1.0, prior)
    counts = {k: np.ones(1 << BITS) for k in (0, 1)}
    for x, k in zip(rows, labels.tolist(), strict=True):
        counts[k][x] += 1
    ratio = np.log((counts[1] / counts[1].sum()) / (counts[0] / counts[0].sum())).astype(np.float32)
    y = np.where(labels == 1, 1.0, -1.0)
    fold = np.arange(len(rows)) % 5 == 0
    train = np.flatnonzero(~fold) if len(rows) >= 20 else np.arange(len(rows))
    weight, bias = fit_svm(rows, train, y[train], ratio, cost, epochs)
    model = Model(ratio, weight.astype(np.float32), bias, 2.0, 0.0)
    if len(rows) >= 20 and len(set(labels[fold].tolist())) == 2:
        m, t = np.array([model.margin(rows[i]) for i in np.flatnonzero(fold)]), labels[fold]
        n1, n0 = t.sum(), (1 - t).sum()
        goal = np.where(t == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))  # smoothed targets keep the curve finite
        a, b = 2.0, 0.0
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(a * m + b, -30, 30)))
            g, h = p - goal, p * (1 - p) + 1e-9
            aa, ab, bb = dot(h, m * m) + 1e-6, dot(h, m), float(h.sum()) + 1e-6
            ga, gb, det = dot(g, m), float(g.sum()), aa * bb - ab * ab
            step = np.array([(bb * ga - ab * gb) / det, (aa * gb - ab * ga) / det])
            a, b = a - step[0], b - step[1]
            if np.abs(step).max() < 1e-8:
                break
        if np.isfinite([a, b]).all() and a > 0:
            model.slope, model.shift = float(a), float(b)
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on labelled rows whose crc32(id) mod 5 is not 0."""
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(F.min(label_col).cast("int").alias("label"))
    known = known.where(hash_mod("doc_id", 5) != 0).withColumn("rank", F.xxhash64("doc_id"))
    halves = [known.where(F.col("label") == k).orderBy("rank", "doc_id").limit(n) for k, n in ((0, sample_rows // 2), (1, sample_rows // 2))]
    chosen = F.broadcast(halves[0].unionAll(halves[1]))  # at most sample_rows short rows
    rows = id_text(docs, id_col, text_col).join(chosen, "doc_id").groupBy("doc_id", "label", "rank").agg(F.min("text").alias("text"))

    def work(ids: list, texts: list, label: list, rank: list) -> dict:
        return {"doc_id": ids, "label": label, "rank": rank, "x": [packed(features(t)) for t in texts]}

    # At most sample_rows rows of bounded size.
    found = sorted(map_texts(rows, work, "doc_id long, label int, rank long, x binary", ("label", "rank")).toLocalIterator(), key=lambda r: (r.rank, r.doc_id))
    return fit(Packed([bytes(r.x) for r in found]), np.array([r.label for r in found], np.int64))


def score_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    rows = id_text(docs, id_col, text_col).withColumn("held_out", hash_mod("doc_id", 5) == 0)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 * 2**BITS floats

    def work(ids: list, texts: list, held: list) -> dict:
        m = shared.value
        scores = [m.score(features(t)) for t in texts]
        return {"doc_id": ids, "held_out": held, "score": scores, "predicted": [int(s >= 0.3) for s in scores]}

    return map_texts(rows, work, "doc_id long, held_out boolean, score double, predicted int", ("held_out",))


def keep_quality(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model accepts, with all their columns, in one pass over the texts."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            yield batch.filter(pa.array([m.score(features(t.as_py() or "")) >= 0.3 for t in texts], pa.bool_()))
        give_back()

    return docs.mapInArrow(run, docs.schema)
