"""Packing tokenised documents into fixed-size sequences by a configuration linear program.

The program's only input is the histogram of piece lengths (at most `capacity` numbers, whatever the corpus).  Its
variables are patterns of lengths that fit a sequence; multiplicative weights price the lengths, a knapsack dynamic
program finds the best pattern for the prices, and the averaged pattern counts are rounded down.  What the rounding
leaves is a smaller program, and at last packed by best fit, also on the histogram.  The prices give a lower bound too.  The pieces themselves are ranked within their length by Spark and
look their place up in the (small) table of patterns.
"""

from __future__ import annotations

import json
import math
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewright.llm.arrays import prefix_hash, releasing, row_chunks, span_hash, text_column, words
from ratewright.llm.lineage import cut, shuffle_partitions

CACHE_WORDS, CACHE_STEMS = 100_000, 200_000  # two generations of each; only speed depends on them
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_STEM_AND_MARKS = re.compile(rb"([a-z\x80-\xff]+)([!-&(-/:-@]+)")  # a word of letters, then ASCII marks but no apostrophe


class _Generations:
    """A dictionary of bounded size: what was not used since the last generation is forgotten."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None and (found := self.old.get(key)) is not None:
            self.young[key] = found
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.young, self.old = {}, self.young
        self.young[key] = value


class WordTokenizer:
    """Token ids of texts, from a vocabulary whose pre-tokeniser drops white space and whose normaliser lower-cases.

    Such a tokeniser never joins letters across white space, so each distinct word of a chunk is encoded once and remembered.  Where
    the vocabulary file says (as `FOLDING` states) that a run of letters and a run of marks are tokenised apart, the letters are
    remembered alone, and letters that normalisation would not change go to the merge model directly.
    """

    FOLDING = ("NFC", "Replace", "Lowercase")
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.inner = Tokenizer.from_file(path)
        self.inner.no_truncation()
        setting = json.loads(self.inner.to_str())
        steps = (setting.get("normalizer") or {}).get("normalizers") or []
        if tuple(x["type"] for x in steps) != self.FOLDING:
            raise ValueError("the vocabulary must fold case and drop white space")
        first, *rest = setting["pre_tokenizer"].get("pretokenizers", [{}])
        self.apart = first.get("pattern") == {"Regex": self.SPLIT} and [x["type"] for x in rest] == ["ByteLevel"]
        level, model = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False), self.inner.model

        class Letters(dict):
            def __missing__(self, point):
                self[point] = "".join(x for x, _ in level.pre_tokenize_str(chr(point)))
                return self[point]

        self.letters, self.model = Letters(), model
        self.words, self.stems = _Generations(CACHE_WORDS), _Generations(CACHE_STEMS)

    def _encode(self, word: bytes) -> bytes:
        return np.array(self.inner.encode(word.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def _stem(self, stem: bytes) -> bytes:
        ids = self.stems.get(stem)
        if ids is None:
            text = stem.decode()
            if text.isalpha() and text.islower() and unicodedata.is_normalized("NFC", text):
                ids = struct.pack(f"<{len(t := self.model.tokenize(text.translate(self.letters)))}I", *(x.id for x in t))
            else:
                ids = self._encode(stem)
            self.stems.put(stem, ids)
        return ids

    def word(self, word: bytes) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if not self.apart:
                ids = self._encode(word)
            elif (m := _STEM_AND_MARKS.fullmatch(word)) and m[1].decode(errors="replace").isalpha():
                ids = self._stem(m[1]) + self._stem(m[2])
            else:
                ids = self._stem(word)
            self.words.put(word, ids)
        return ids

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of rows of UTF-8 bytes, and where each row's begin (rows + 1 entries)."""
        data = _LOWER[data]
        start, end, first = words(data, offsets)
        if not len(start):
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        code, kinds = pd.factorize(span_hash(prefix_hash(data), start, end))
        at = np.zeros(len(kinds), np.int64)
        at[code[::-1]] = np.arange(len(code))[::-1]
        raw = data.tobytes()
        ids = [self.word(raw[a:b]) for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat, place = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(size) - size
        many = size[code]
        ends = np.cumsum(many)
        out = flat[np.repeat(place[code] - (ends - many), many) + np.arange(int(ends[-1]))]
        return out, np.r_[0, ends][first]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _piece_batches(path: str, capacity: int, end_id: int, with_ids: bool):
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, end, width = _tokenizer(path), np.array([end_id], "<u4").tobytes(), 4 * capacity
        for batch in batches:
            data, offs = text_column(batch.column(1))
            for a, b in row_chunks(offs):
                row, piece, length, crc, bodies = [], [], [], [], []
                ids, first = tokenizer.encode(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
                for i in range(a, b):
                    body = ids[first[i - a] : first[i - a + 1]].tobytes() + end
                    for k, at in enumerate(range(0, len(body), width)):
                        part = body[at : at + width]
                        row.append(i)
                        piece.append(k)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            bodies.append(np.frombuffer(part, "<u4").astype(np.int32))
                piece = np.array(piece, np.int32)
                out = [batch.column(0).take(pa.array(row)), pa.array(piece), pa.array(piece.astype(np.int64) * capacity), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = ["id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    out, names = [*out, pa.array(bodies, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(out, names=names)

    return run


def tokenized_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): the ids of each text and `end_id`, cut every `capacity` ids.

    A null or empty text is one piece of one id.  Repeated rows give repeated pieces.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(id_col, text_col).mapInArrow(_piece_batches(vocabulary, capacity, end_id, with_ids), schema)


def _highest_prices(price: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Unbounded knapsack: for each room up to `capacity` the highest price of a multiset of `lengths` (sorted) that fits."""
    best = np.zeros(capacity + 1)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    value = np.empty(len(lengths))
    for c in range(1, capacity + 1):
        n = fitting[c]
        best[c] = best[c - 1]
        if n:
            v = value[:n]
            np.take(best, c - lengths[:n], out=v)
            v += price[:n]
            best[c] = max(best[c], v.max())
    return best


def _pattern(best: np.ndarray, price: np.ndarray, lengths: np.ndarray, lead: np.ndarray, slack: float) -> dict[int, int]:
    """number -> count of a pattern whose price is within `slack` of best[-1]; of lengths that allow it that of the highest `lead` is taken."""
    out: dict[int, int] = {}
    c = len(best) - 1
    while n := int(np.searchsorted(lengths, c, side="right")):
        loss = best[c] - (best[c - lengths[:n]] + price[:n])
        fine = np.flatnonzero(loss <= slack)
        if not len(fine):
            break
        k = int(fine[lead[fine].argmax()])
        slack -= max(float(loss[k]), 0.0)
        out[k] = out.get(k, 0) + 1
        c -= int(lengths[k])
    return out


PATTERNS, SLACK = 16, 0.0002  # patterns taken at one table of prices; share of the highest price that each may lack


def configuration_program(lengths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int, rate: float) -> tuple[dict[tuple, float], float]:
    """Multiplicative weights for the program min sum(x) with sum(x[p] * p[s]) >= demand[s]: (pattern -> x, a lower bound of the sum).

    A length's price is its weight over its demand; the weights start so that prices are the lengths.  Each round the knapsack finds the
    highest price of a pattern, and PATTERNS patterns of that price (up to SLACK) are used for an even share of the sequences; after each
    the weights of its lengths fall by exp(-rate * share of the demand that was filled).  The average of the rounds is the program's
    solution.  Any prices bound the sum from below, by the price of all demand over the highest price of a pattern; the best such bound is
    returned.
    """
    volume = float((lengths * demand).sum()) / capacity
    weight, chosen, bound = lengths * demand, {}, 0.0
    for _ in range(rounds):
        weight /= weight.max()
        price = weight / demand
        best = _highest_prices(price, lengths, capacity)
        bound = max(bound, float(weight.sum() / best[-1]))
        for _ in range(PATTERNS):
            pattern = _pattern(best, price, lengths, weight / demand / lengths, SLACK * best[-1])
            rows, count = np.array(list(pattern)), np.array(list(pattern.values()), float)
            use = min(max(volume / rounds / PATTERNS, 1.0), float((demand[rows] / count).min()))
            weight[rows] *= np.exp(-rate * use * count / demand[rows])
            key = tuple(sorted(((int(lengths[k]), n) for k, n in pattern.items()), reverse=True))
            chosen[key] = chosen.get(key, 0.0) + use
    return chosen, bound


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[tuple, int]]:
    """Best fit, longest first, on counts: (pattern, how often)."""
    groups: dict[int, list[tuple[tuple, int]]] = {}
    for size in sorted(left, reverse=True):
        n = left[size]
        while n:
            room = min((c for c in groups if c >= size), default=capacity)
            times = room // size
            held, many = groups[room].pop() if room in groups else ((), max(1, n // times))
            if room in groups and not groups[room]:
                del groups[room]
            if n < times:
                times = n
            use = min(many, n // times)
            if use < many and held:
                groups.setdefault(room, []).append((held, many - use))
            groups.setdefault(room - size * times, []).append((((size, times),) if not held else (*held, (size, times)), use))
            n -= use * times
    return [x for g in groups.values() for x in g]


def solve_with_bound(histogram: dict[int, int], capacity: int = 4096, rounds: int = 60, rate: float = 6.0) -> tuple[list[tuple[tuple, int]], int]:
    """(patterns, bound): (pattern, how often) that together hold each length exactly as often as `histogram` says, where a pattern is
    ((length, count), ...), and a number of sequences below which no packing can go.

    The program's solution is rounded down, most used patterns first, and never holds a length too often; the rest is a smaller program, solved
    with half as many rounds, and what is left after three such programs is packed by best fit.
    """
    out = [(((capacity, 1),), histogram[capacity])] if histogram.get(capacity) else []
    left, bound = {s: n for s, n in histogram.items() if n and s < capacity}, histogram.get(capacity, 0)
    for turn in range(3):
        if not left or turn and sum(s * n for s, n in left.items()) < 2 * capacity:
            break
        lengths = np.array(sorted(left), np.int64)
        demand = np.array([left[int(s)] for s in lengths], float)
        chosen, least = configuration_program(lengths, demand, capacity, rounds >> turn, rate)
        if not turn:
            bound += math.ceil(least - 1e-6)
        for pattern, x in sorted(chosen.items(), key=lambda item: (-item[1], item[0])):
            n = min([int(x + 1e-9), *(left.get(s, 0) // k for s, k in pattern)])
            if n > 0:
                out.append((pattern, n))
                for s, k in pattern:
                    left[s] -= n * k
        left = {s: n for s, n in left.items() if n}
    return out + _best_fit(left, capacity), bound


def solve_patterns(histogram: dict[int, int], capacity: int = 4096, rounds: int = 60, rate: float = 6.0) -> list[tuple[tuple, int]]:
    """The patterns of `solve_with_bound`."""
    return solve_with_bound(histogram, capacity, rounds, rate)[0]


def _places(patterns: list[tuple[tuple, int]]):
    """Per (length, first rank): count in a sequence, first sequence, offset of the first - sorted for binary search."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, n in patterns:
        offset = 0
        for size, count in pattern:
            rows.append((size, rank.get(size, 0), count, sequence, offset))
            rank[size] = rank.get(size, 0) + n * count
            offset += size * count
        sequence += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return table, (table[:, 0] << 48) + table[:, 1]


def _place_batches(patterns):
    table, keys = _places(patterns)

    @releasing
    def run(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            row = table[np.searchsorted(keys, (length << 48) + rank, side="right") - 1] if len(length) else table[:0]
            k = rank - row[:, 1]
            keep = [i for i, name in enumerate(batch.schema.names) if name != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(row[:, 3] + k // np.maximum(row[:, 2], 1)), pa.array(row[:, 4] + k % np.maximum(row[:, 2], 1) * length)],
                names=[*(batch.schema.names[i] for i in keep), "sequence_id", "offset"],
            )

    return run


def pack(pieces: DataFrame, capacity: int = 4096, rounds: int = 60) -> DataFrame:
    """`pieces` (with a `length` from 1 to `capacity`) and each piece's sequence_id and offset, gapless from 0.

    Only the length histogram (at most `capacity` rows) reaches the driver.  A length that a third of all pieces have is ranked in
    as many parts as there are shuffle partitions.  An empty table gives an empty result.
    """
    histogram = {int(r[0]): int(r[1]) for r in pieces.groupBy("length").count().collect()}
    if any(not 0 < s <= capacity for s in histogram):
        raise ValueError("piece lengths must lie between 1 and the capacity")
    order = [c for c in pieces.columns if c != "ids"]
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(shuffle_partitions(pieces))))
    counts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("length", "_salt").orderBy(*order)
    ranked = salted.withColumn("_rank", F.row_number().over(within).cast("long")).join(base, ["length", "_salt"])
    ranked = ranked.select(*pieces.columns, (F.col("_rank") - 1 + F.col("_base")).alias("_rank"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return ranked.mapInArrow(_place_batches(solve_patterns(histogram, capacity, rounds)), schema)


def pack_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack `docs`: one row per piece.  The pieces are checkpointed, so texts are tokenised once."""
    return pack(cut(tokenized_pieces(docs, vocabulary, id_col, text_col, capacity, end_id, with_ids)), capacity)
