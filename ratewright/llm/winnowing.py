"""Document fingerprints by winnowing.

Schleimer, Wilkerson, Aiken: Winnowing - Local Algorithms for Document Fingerprinting (SIGMOD 2003).  Every k-gram of code
points is hashed by a rolling polynomial; of each window of `w` consecutive hashes the smallest is chosen, the rightmost of
equal ones, and its position is kept.  Two texts that share `w + k - 1` consecutive code points share a chosen hash.
Gram and window are the same for all texts.  A text of fewer grams than a window has is one window; a text shorter than a gram is one gram.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewright.llm.arrays import POWERS, releasing, text_slices
from ratewright.llm.lineage import shuffle_partitions

GRAM, WINDOW = 8, 16
_LEAST = -(1 << 63)
_POINT_VALUE = np.random.Generator(np.random.PCG64(8191)).integers(1, 2**63, 1 << 16, dtype=np.uint64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), "<u4")


def winnow(points: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen 32-bit hashes and their positions, in text order; none for an empty text."""
    n = len(points)
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.int32)
    gram = min(gram, n)
    up, down = POWERS.get(n)
    prefix = np.zeros(n + 1, np.uint64)
    value = _POINT_VALUE[points & 0xFFFF]
    if (far := points >> 16).any():
        value = value + far.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25)
    np.cumsum(value * up[:n], out=prefix[1:])
    h = (prefix[gram:] - prefix[:-gram]) * down[: n - gram + 1]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h &= np.uint64(0xFFFFFFFF00000000)
    m = len(h)
    h |= np.uint64(0xFFFFFFFF) - np.arange(m, dtype=np.uint64)  # of equal hashes the rightmost is the smallest
    window, span = min(window, m), 1
    while span < window:
        step = min(span, window - span)
        h = np.minimum(h[:-step], h[step:])
        span += step
    h = h[np.r_[True, h[1:] != h[:-1]]]
    return (h >> np.uint64(32)).astype(np.uint32), (np.uint64(0xFFFFFFFF) - (h & np.uint64(0xFFFFFFFF))).astype(np.int32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard likeness of two sorted sets of hashes; two empty ones are alike."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    both = np.sort(np.concatenate((a, b)))
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(both) - common)


@releasing
def _fingerprint_batches(batches):
    for batch in batches:
        marks, at = [], []
        for text in batch.column(1).to_pylist():
            h, p = winnow(code_points(text or ""))
            marks.append(h.tobytes().hex())
            at.append(p)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(marks, pa.string()), pa.array(at, pa.list_(pa.int32()))], names=["id", "fingerprint", "positions"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint, positions): the chosen hashes as hex, eight digits each (little-endian), and where they start."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(_fingerprint_batches, f"id {kind}, fingerprint string, positions array<int>")


@releasing
def _neighbour_batches(batches):
    """Rows come by bucket, each bucket's own rows by descending id and then the first row of what follows (own = false)."""
    out: list[tuple] = []

    def row(held, following):
        who, text, points, (h, p), seen = held
        _, other, other_points, _, other_seen = following
        n = len(points)
        cut = n // 3
        edited = np.concatenate((points[: n - cut], other_points[:cut]))
        eh, _ = winnow(edited)
        sha = hashlib.sha256((text[: n - cut] + other[:cut]).encode()).hexdigest()
        out.append((who, n, sha, h.tobytes().hex(), eh.tobytes().hex(), likeness(seen, np.unique(eh)), likeness(seen, other_seen), p))

    def flush():
        cols = list(zip(*out, strict=True)) if out else [()] * 8
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.list_(pa.int32())]
        names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "positions"]
        batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)
        out.clear()
        return batch

    held = bucket = None
    for batch in (part for whole in batches for part in text_slices(whole, 3)):
        for b, own, who, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if not own and held is None:
                continue  # this bucket's successor has been met already
            points = code_points(text or "")
            marks = winnow(points)
            now = (who, text or "", points, marks, np.unique(marks[0]))
            if held is not None:
                row(held, now)
            held = now if own else None
            bucket = b
            if len(out) >= 2000:
                yield flush()
    assert held is None, f"bucket {bucket} lacks its successor"
    yield flush()


def with_edited_neighbour(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, positions.

    The next document is the one that follows by descending id (then by a hash of the text; null ids come last); the first
    follows the last.  The edited text is the text with its last third replaced by as many first code points of the next one.
    Null texts are empty.  One row alone is its own next.  An empty table gives an empty result.

    Texts are exchanged once, by ranges of ids; a range gets one more row, the first of the range that follows.  The rows of an id that
    fills several ranges (null, say) are dealt out by the hash of their text.
    """
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST)).alias("rank_id"), F.col(id_col).cast("long").alias("who"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumn("tie", F.xxhash64("text"))
    buckets = 3 * shuffle_partitions(docs)
    quantiles = base.select(F.col("rank_id").cast("double")).approxQuantile("rank_id", [i / buckets for i in range(1, buckets)], 0.2 / buckets)
    base = base.withColumn("bucket", _bucket(quantiles))
    # by descending (order, -tie): the first row of each bucket; at most `buckets` rows reach the driver
    heads = base.groupBy("bucket").agg(F.max_by(F.struct("rank_id", "tie"), F.struct("rank_id", -F.col("tie").cast("decimal(20,0)"))).alias("head")).collect()
    heads = sorted((r["bucket"], r["head"]["rank_id"], r["head"]["tie"]) for r in heads)
    if not heads:
        return base.limit(0).mapInArrow(_neighbour_batches, _NEIGHBOUR_SCHEMA)
    # the head of a bucket follows the bucket above it; the highest head follows the lowest bucket
    to = docs.sparkSession.createDataFrame([(*h, heads[(i + 1) % len(heads)][0]) for i, h in enumerate(heads)], "bucket int, rank_id long, tie long, above int")
    extra = base.join(F.broadcast(to), ["bucket", "rank_id", "tie"]).select(F.col("above").alias("bucket"), F.lit(False).alias("own"), "rank_id", "who", "text", "tie")
    rows = base.select("bucket", F.lit(True).alias("own"), "rank_id", "who", "text", "tie").unionByName(extra)
    sent = rows.repartition(shuffle_partitions(docs), "bucket").sortWithinPartitions("bucket", F.desc("own"), F.desc("rank_id"), "tie")
    return sent.select("bucket", "own", "who", "text").mapInArrow(_neighbour_batches, _NEIGHBOUR_SCHEMA)


_NEIGHBOUR_SCHEMA = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, positions array<int>"


def _bucket(quantiles: list[float]) -> Column:
    """A number that rises with (rank_id, -tie): the quantiles below rank_id, and for an id that is several of them its share of the text hashes."""
    times = Counter(quantiles)
    parts = max(times.values(), default=1) + 2
    out = F.expr(_bucket_case(sorted(times))) * parts
    share = (F.col("tie").cast("double") + float(1 << 63)) / float(1 << 64)
    for value, n in times.items():
        if n > 1 and (abs(value) < 1 << 53 or value == _LEAST):  # ids that a double tells apart
            part = F.least(F.floor(share * n), F.lit(n - 1))
            out = F.when(F.col("rank_id") == F.lit(int(value)), out + (F.lit(n) - part).cast("int")).otherwise(out)
    return out.cast("int")


def _bucket_case(cuts: list[float], first: int = 0) -> str:
    """SQL for the number of cuts below `rank_id`, as a balanced tree of comparisons."""
    if not cuts:
        return str(first)
    mid = len(cuts) // 2
    return f"IF(rank_id > {cuts[mid]!r}D, {_bucket_case(cuts[mid + 1 :], first + mid + 1)}, {_bucket_case(cuts[:mid], first)})"
