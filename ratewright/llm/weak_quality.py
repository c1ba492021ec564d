"""Quality without hand labels: a weak-label model and a hashed linear scorer.

Overlapping heuristic labellers vote good (1), bad (-1) or abstain (0).  Expectation-maximisation over the counts of vote
patterns (at most 3**labellers rows, whatever the corpus) estimates how each labeller votes on good and on bad documents
(Dawid, Skene 1979), and gives each pattern a posterior.  Posterior labels of a bounded sample then train a logistic scorer
on hashed word-form features, which judges every whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.arrays import mix, prefix_hash, releasing, row_chunks, span_hash, text_column, words

LABELLERS = ("capitals", "symbols", "repetition", "bare_marks", "stutter", "lines", "endings", "prose")
BITS = 12  # hashed features
SAMPLE = 6000  # texts at most whose posterior labels train the scorer
PRIOR_GOOD = 0.7  # where EM starts
# where EM starts for a labeller that votes (good, bad): P(bad, abstain, good) on bad and on good documents
START = {
    (True, True): ((0.6, 0.3, 0.1), (0.1, 0.3, 0.6)),
    (True, False): ((0.05, 0.45, 0.5), (0.02, 0.2, 0.78)),
    (False, True): ((0.2, 0.79, 0.01), (0.005, 0.985, 0.01)),
    (False, False): ((0.01, 0.98, 0.01), (0.01, 0.98, 0.01)),
}
FIRMNESS = 0.2  # in documents, as a share of all

_UPPER, _LETTER, _SYMBOL, _ALNUM, _END = (np.zeros(256, bool) for _ in range(5))
_UPPER[0x41:0x5B] = True
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SYMBOL[[ord(c) for c in "#$%&*!@^~=+<>|\\{}[]_"]] = True
_END[[ord(c) for c in ".!?"]] = True


def _ratio(a, b):
    return a / np.maximum(b, 1)


def describe(data: np.ndarray, offsets: np.ndarray):
    """Votes (rows x labellers), the hashed form of each word and each row's first word."""
    start, end, first = words(data, offsets)
    rows = len(offsets) - 1
    n = np.diff(first)
    if not len(start):
        return np.zeros((rows, len(LABELLERS)), np.int8), np.zeros(0, np.int64), first

    def per_byte(mask):
        return np.r_[0, np.cumsum(mask[data])]

    upper, letter, symbol, alnum = map(per_byte, (_UPPER, _LETTER, _SYMBOL, _ALNUM))
    row = np.repeat(np.arange(rows), n)

    def per_row(of_word):
        return np.bincount(row, of_word, rows)

    w_upper, w_letter, w_symbol, w_alnum = (x[end] - x[start] for x in (upper, letter, symbol, alnum))
    h = span_hash(prefix_hash(data), start, end)
    same = np.r_[False, (h[1:] == h[:-1]) & (row[1:] == row[:-1])]
    keyed = mix(h + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(keyed, kind="stable")
    again = np.zeros(len(h), bool)
    again[order[1:]] = keyed[order[1:]] == keyed[order[:-1]]
    bare, ends = w_alnum == 0, _END[data[end - 1]]
    # a line is a word run up to a newline; its hash is the sum of its words' hashes
    breaks = np.r_[0, np.cumsum(data == 0x0A)]
    line = np.cumsum(np.r_[True, (breaks[start[1:]] > breaks[end[:-1]]) | (row[1:] != row[:-1])]) - 1
    at = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
    line_hash, line_row = np.add.reduceat(h, at), row[at]
    lines = np.bincount(line_row, minlength=rows)
    line_key = mix(line_hash + line_row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    line_order = np.argsort(line_key, kind="stable")
    twice = np.zeros(len(at), bool)
    twice[line_order[1:]] = line_key[line_order[1:]] == line_key[line_order[:-1]]

    capitals, symbols = _ratio(per_row(w_upper), per_row(w_letter)), _ratio(per_row(w_symbol), per_row(end - start))
    repeated, bare_share, stutter, ended = (_ratio(per_row(x), n) for x in (again, bare, same, ends))
    line_share = _ratio(np.bincount(line_row, twice, rows), lines)
    some, many = n >= 5, n >= 30
    votes = np.stack(
        [
            -(some & (capitals > 0.5)).astype(np.int8),
            -(some & (symbols > 0.05)).astype(np.int8),
            -(many & (repeated > 0.9)).astype(np.int8),
            -(some & (bare_share > 0.15)).astype(np.int8),
            -(some & (stutter > 0.15)).astype(np.int8),
            -((lines >= 4) & (line_share > 0.3)).astype(np.int8),
            -(many & (ended < 0.004)).astype(np.int8),
            (some & (ended > 0.01) & (capitals < 0.3) & (symbols < 0.02) & (bare_share < 0.05) & (stutter < 0.03) & (line_share <= 0.3) & ((repeated <= 0.9) | ~many)).astype(np.int8),
        ],
        axis=1,
    )
    shape = 4 * (w_upper == w_letter) + 2 * (w_upper > 0) + (w_symbol > 0)
    shape = (shape * 2 + bare) * 2 + same
    shape = ((shape * 2 + again) * 2 + ends) * 4 + np.minimum((end - start) // 4, 3)
    return votes, shape, first


def _features(shape: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word its hashed form, and its form joined to the next word's (a row's last word: to none)."""
    if not len(shape):
        return shape, shape
    follow = np.r_[shape[1:], -1]
    last = first[1:][first[1:] > first[:-1]] - 1
    follow[last] = -1
    one = mix(shape.astype(np.uint64)) >> np.uint64(64 - BITS)
    two = mix((shape.astype(np.uint64) << np.uint64(20)) + (follow + 2).astype(np.uint64) + np.uint64(1 << 50)) >> np.uint64(64 - BITS)
    return one.astype(np.int64), two.astype(np.int64)


@releasing
def _vote_batches(batches):
    for batch in batches:
        data, offs = text_column(batch.column(1))
        for a, b in row_chunks(offs):
            votes, _, _ = describe(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            code = ((votes.astype(np.int64) + 1) * 3 ** np.arange(len(LABELLERS))).sum(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(code.astype(np.int32))], names=["id", "votes"])


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over vote patterns (rows of -1, 0, 1): posterior of good per pattern, P(vote | class) as [class, labeller, vote + 1], P(good)."""
    k = patterns.shape[1]
    table = np.empty((2, k, 3))
    for labeller in range(k):
        good, bad = (patterns[:, labeller] == 1).any(), (patterns[:, labeller] == -1).any()
        table[:, labeller] = START[(bool(good), bool(bad))]
    # what a labeller that only calls documents bad does on good ones is held near its start: it is meant to be precise
    firm = (table[1, :, 0] < 0.01)[:, None] * table[1] * FIRMNESS * counts.sum()
    prior = PRIOR_GOOD
    at = patterns + 1
    for _ in range(rounds):
        log = np.stack([np.log(table[y][np.arange(k), at]).sum(axis=1) + np.log(prior if y else 1 - prior) for y in (0, 1)])
        good = 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))
        for y, share in ((1, good * counts), (0, (1 - good) * counts)):
            for v in range(3):
                table[y, :, v] = (share[:, None] * (at == v)).sum(axis=0) + 1.0 + (firm[:, v] if y else 0.0)
            table[y] /= table[y].sum(axis=1, keepdims=True)
        prior = float(np.clip((good * counts).sum() / max(counts.sum(), 1), 0.01, 0.99))
    return good, table, prior


def _unpack_votes(codes: np.ndarray) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(len(LABELLERS)) % 3 - 1


@releasing
def _sample_batches(batches):
    for batch in batches:
        data, offs = text_column(batch.column(1))
        for a, b in row_chunks(offs):
            _, shape, first = describe(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            one, two = _features(shape, first)
            keys, shares = [], []
            for i, j in zip(first[:-1], first[1:], strict=True):
                grams, n = np.unique(np.concatenate((one[i:j], two[i:j])), return_counts=True)
                keys.append(grams.astype(np.int32))
                shares.append(n / max(j - i, 1))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(keys, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float64()))], names=["good", "grams", "shares"])


def fit_scorer(rows, good: np.ndarray, rounds: int = 400, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression of posterior labels on shares of hashed forms: weights and intercept."""
    owner = np.repeat(np.arange(len(good)), [len(g) for g, _ in rows])
    at = np.concatenate([g for g, _ in rows]) if rows else np.zeros(0, np.int64)
    value = np.concatenate([s for _, s in rows]) if rows else np.zeros(0)
    w, b, pw, pb, n = np.zeros(1 << BITS), 0.0, np.zeros(1 << BITS), 0.0, max(len(good), 1)
    square = float(np.bincount(owner, value * value, len(good)).max()) if len(value) else 1.0
    step = 1 / (0.25 * (square + 1) + penalty)
    for i in range(rounds):
        m = i / (i + 3)
        yw, yb = w + m * (w - pw), b + m * (b - pb)
        g = (1 / (1 + np.exp(-(np.bincount(owner, value * yw[at], len(good)) + yb))) - good) / n
        pw, pb = w, b
        w = yw - step * (np.bincount(at, value * g[owner], 1 << BITS) + penalty * yw)
        b = yb - step * float(g.sum())
    return w, b


def _score_batches(weight: np.ndarray, intercept: float):
    @releasing
    def run(batches):
        for batch in batches:
            data, offs = text_column(batch.column(1))
            for a, b in row_chunks(offs):
                votes, shape, first = describe(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                one, two = _features(shape, first)
                total = np.r_[0.0, np.cumsum(weight[one] + weight[two])]
                n = np.diff(first)
                z = intercept + (total[first[1:]] - total[first[:-1]]) / np.maximum(n, 1)
                code = ((votes.astype(np.int64) + 1) * 3 ** np.arange(len(LABELLERS))).sum(axis=1)
                score = np.where(n > 0, 1 / (1 + np.exp(-np.clip(z, -500, 500))), 0.0)  # a wordless text is worth nothing
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(code.astype(np.int32)), pa.array(score)], names=["id", "votes", "score"])

    return run


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, threshold: float = 0.5) -> DataFrame:
    """(id_col, posterior, score, keep) per row: the label model's P(good), the scorer's, and whether the score reaches the threshold.

    Vote patterns are counted over all rows.  The scorer is fitted on the `sample` rows with the least hash of id and text.  A null,
    empty or wordless text has score 0 and is not kept; without any rows the result is empty.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    votes = texts.mapInArrow(_vote_batches, f"id {kind}, votes int")
    counted = votes.groupBy("votes").count().toPandas().sort_values("votes")  # at most 3**8 rows
    codes = counted["votes"].to_numpy(np.int64)
    good, _, _ = label_model(_unpack_votes(codes), counted["count"].to_numpy(float)) if len(codes) else (np.zeros(0), None, 0.0)
    names = docs.sparkSession.createDataFrame([(int(c), float(p)) for c, p in zip(codes, good, strict=True)], "votes int, posterior double")
    h = F.xxhash64("id", "text")  # the sample's largest hash is found without the texts
    last = texts.select(h.alias("_h")).orderBy("_h").limit(sample).agg(F.max("_h")).first()[0]
    some = texts.where(h <= F.lit(last)) if last is not None else texts.limit(0)
    weight, intercept = np.zeros(1 << BITS), 0.0
    if len(codes):
        both = some.mapInArrow(_both_batches(dict(zip(codes.tolist(), good.tolist(), strict=True))), "good double, text string")
        got = both.mapInArrow(_sample_batches, "good double, grams array<int>, shares array<double>").toPandas()
        rows = [(np.asarray(g, np.int64), np.asarray(s)) for g, s in zip(got["grams"], got["shares"], strict=True)]
        weight, intercept = fit_scorer(rows, got["good"].to_numpy())
    scored = texts.mapInArrow(_score_batches(weight, intercept), f"id {kind}, votes int, score double")
    out = scored.join(F.broadcast(names), "votes", "left")  # at most 3**8 rows
    return out.select(F.col("id").alias(id_col), "posterior", "score", (F.col("score") >= threshold).alias("keep"))


def _both_batches(posterior: dict[int, float]):
    @releasing
    def rows(batches):
        for batch in batches:
            votes = np.concatenate([p.column(1).to_numpy() for p in _vote_batches([batch])]) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([posterior[int(c)] for c in votes], pa.float64()), batch.column(1)], names=["good", "text"])

    return rows

