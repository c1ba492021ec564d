"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Wang, Manning: Baselines and Bigrams (ACL 2012).  A text is the set of its hashed n-grams of lower-cased code points.  Each
hashed n-gram's log-count ratio comes from counts over all labelled training texts; a logistic regression on the
ratio-scaled presences is fitted on a bounded sample of them.  A presence counts once however long the text is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.arrays import POWERS, releasing, text_slices
from ratewright.llm.lineage import shuffle_partitions
from ratewright.llm.winnowing import _POINT_VALUE, code_points

ORDERS = (4, 5)
BITS = 19  # hashed n-grams
RANGES = 64  # in which their counts are exchanged
SMOOTHING = 20.0  # pseudo-documents, split as the classes are, so that an unseen n-gram has ratio 0
LEAST_RATIO = 1.0  # n-grams with a smaller absolute log-count ratio are left out
PENALTY = 5.0  # L2, over the number of sampled texts
SAMPLE = 3000  # training texts of each label at most for the regression


def gram_buckets(text: str, orders=ORDERS) -> np.ndarray:
    """Hashed n-grams of a text, repeats included."""
    points = code_points(text.lower())
    n = len(points)
    if n < min(orders):
        return np.zeros(0, np.int64)
    up, down = POWERS.get(n)
    prefix = np.zeros(n + 1, np.uint64)
    value = _POINT_VALUE[points & 0xFFFF]
    if (far := points >> 16).any():
        value = value + far.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
    np.cumsum(value * up[:n], out=prefix[1:])
    out = []
    for k in orders:
        if n >= k:
            h = (prefix[k:] - prefix[:-k]) * down[: n - k + 1]
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            out.append((h >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(out)


@releasing
def _count_batches(batches):
    """Per task: documents with each hashed n-gram, by label, in RANGES packed rows."""
    counts = np.zeros((2, 1 << BITS), np.int32)
    for batch in batches:
        for part in text_slices(batch, 1):
            for label, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                counts[label, np.unique(gram_buckets(text or ""))] += 1
    width = (1 << BITS) // RANGES
    bodies = [np.ascontiguousarray(counts[:, r * width : (r + 1) * width]).tobytes() for r in range(RANGES)] if counts.any() else []
    for r, body in enumerate(bodies):
        yield pa.RecordBatch.from_arrays([pa.array([r], pa.int32()), pa.array([body], pa.binary())], names=["range", "body"])


def _ratios(clean, toxic, clean_n: int, toxic_n: int, smoothing: float):
    share = toxic_n / max(clean_n + toxic_n, 1)
    return np.log(((toxic + smoothing * share) / toxic_n) / ((clean + smoothing * (1 - share)) / clean_n))


def _ratio_batches(clean_n: int, toxic_n: int, smoothing: float):
    @releasing
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for r, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(body, np.int32).reshape(2, -1)
                total[r] = part.astype(np.int64) if r not in total else total[r] + part
        for r, (clean, toxic) in total.items():
            ratio = _ratios(clean, toxic, clean_n, toxic_n, smoothing)
            at = np.flatnonzero(np.abs(ratio) >= LEAST_RATIO)
            yield pa.RecordBatch.from_arrays([pa.array(at + r * len(ratio)), pa.array(ratio[at])], names=["gram", "ratio"])

    return run


class ToxicityModel:
    """Weights of hashed n-grams (ratio times coefficient) and an intercept."""

    def __init__(self, gram: np.ndarray, weight: np.ndarray, intercept: float):
        self.gram, self.weight, self.intercept, self._table = gram, weight, intercept, None

    def __getstate__(self):
        return self.gram, self.weight, self.intercept

    def __setstate__(self, state):
        self.gram, self.weight, self.intercept = state
        self._table = None

    def score(self, text: str) -> float:
        if self._table is None:
            self._table = np.zeros(1 << BITS, np.float32)
            self._table[self.gram] = self.weight
        buckets = gram_buckets(text)
        held = np.unique(buckets[self._table[buckets] != 0])
        z = self.intercept + float(self._table[held].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def _sample_batches(gram: np.ndarray):
    @releasing
    def run(batches):
        table = np.full(1 << BITS, -1, np.int32)
        table[gram] = np.arange(len(gram), dtype=np.int32)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                held = table[np.unique(gram_buckets(text or ""))]
                rows.append(held[held >= 0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], names=["label", "grams"])

    return run


def _logistic(rows: list[np.ndarray], label: np.ndarray, ratio: np.ndarray, rounds: int = 300, penalty: float | None = None) -> tuple[np.ndarray, float]:
    """Class-balanced L2-penalised logistic regression on ratio-scaled presences, by accelerated gradient descent from weights 0."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    value = ratio[at]
    balance = np.where(label == 1, 0.5 / max((label == 1).sum(), 1), 0.5 / max((label == 0).sum(), 1))
    square = np.bincount(owner, value * value, len(rows))
    penalty = penalty or PENALTY / max(len(rows), 1)
    step = 1 / (0.25 * float((balance * (square + 1)).sum()) + penalty)
    w, b = np.zeros(len(ratio)), 0.0
    pw, pb = w.copy(), b
    for i in range(rounds):
        m = i / (i + 3)
        yw, yb = w + m * (w - pw), b + m * (b - pb)
        z = np.bincount(owner, value * yw[at], len(rows)) + yb
        g = balance * (1 / (1 + np.exp(-z)) - label)
        pw, pb = w, b
        w = yw - step * (np.bincount(at, value * g[owner], len(ratio)) + penalty * yw)
        b = yb - step * float(g.sum())
    return w * ratio, b


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> ToxicityModel:
    """Fit on the rows of `docs` that `labels` (id, 0/1) names; null labels are ignored, of repeated ones the highest counts.

    All training texts are counted; `sample` of each label at most (by a hash of the id) enter the regression.  The driver gets the
    n-grams whose ratio is large enough (at most 2**BITS) and the sample's.  Without both labels the score is the share of label 1.
    """
    known = labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("_label"))
    n = {r[0]: r[1] for r in known.groupBy("_label").count().collect()}
    if not (n.get(0) and n.get(1)):
        share = (n.get(1, 0) + 0.5) / (sum(n.values()) + 1) if n else 0.0
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # labels grow with the texts, so they are never broadcast; hashing them spares sorting the texts
    counted = texts.join(known.hint("shuffle_hash"), "_id").select("_label", "_text").mapInArrow(_count_batches, "range int, body binary")
    ratios = counted.repartition(min(RANGES, shuffle_partitions(docs)), "range").mapInArrow(_ratio_batches(n[0], n[1], SMOOTHING), "gram long, ratio double").toPandas().sort_values("gram")
    gram, ratio = ratios["gram"].to_numpy(), ratios["ratio"].to_numpy()
    chosen = [known.where(F.col("_label") == y).orderBy(F.xxhash64("_id"), "_id").limit(sample) for y in (0, 1)]
    rows = texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "_id").select("_label", "_text")  # at most 2 x sample rows
    got = rows.mapInArrow(_sample_batches(gram), "label int, grams array<int>").toPandas()
    if not len(gram) or got["label"].nunique() < 2:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), float(np.log(n[1] / n[0])))
    weight, intercept = _logistic([np.asarray(g, np.int64) for g in got["grams"]], got["label"].to_numpy(), ratio)
    return ToxicityModel(gram, weight, intercept)


def _score_batches(model: ToxicityModel):
    @releasing
    def run(batches):
        for batch in batches:
            at = batch.num_columns - 1
            out = [model.score(t or "") for part in text_slices(batch, at) for t in part.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=[*batch.schema.names, "_score"])

    return run


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = 0.7, score_col: str = "score", predicted_col: str = "predicted") -> DataFrame:
    """All rows and columns of `docs`, and the score (0 to 1) and 1 if it reaches the threshold.  A null or empty text scores as no n-grams do."""
    rest = [c for c in docs.columns if c != text_col]
    ordered = docs.select(*rest, text_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema) + ", _score double"
    out = ordered.mapInArrow(_score_batches(model), schema)
    return out.select(*docs.columns, F.col("_score").alias(score_col), (F.col("_score") >= threshold).cast("int").alias(predicted_col))


def fold(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 3 (a null id: 0)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3
