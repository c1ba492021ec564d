"""Exact removal of byte strings that occur twice, by suffix arrays of shards.

1. Winnowing picks one anchor (a 32-byte gram) for every string of `length` bytes, from its content alone, so equal
   strings have equal anchors at the same place.  A run of string starts with one anchor is a *cell*; its bytes are its
   starts' strings.  Cells with equal bytes are counted, not repeated: two copies of a cell settle all of its strings.
2. Different cells with one anchor may still share strings.  Their bytes go to a shard of that anchor (large groups of
   cells to several).  A shard sorts its suffixes by Larsson-Sadakane refinement in numpy: ranks by 5 bytes, doubled with
   the rank further on, re-sorting only groups that are not single.  It stops at depth `length`, where runs of
   neighbours with a common prefix of at least `length` bytes (what Kasai's pass would mark) are the groups themselves.
3. The shards of a divided anchor each send the sorted hashes of the distinct strings that they hold; these are merged by
   binary search, a hash range at a time.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.arrays import mix, prefix_hash, releasing, row_chunks, span_hash, text_column
from ratewright.llm.lineage import cut, shuffle_partitions

GRAM = 32
CELLS = 1000  # of one anchor in one shard
PARTS_A_RANGE = 2  # the strings of a divided anchor are merged in hash ranges, each of about as many strings as so many parts hold
_BITS = 21  # a shard's chunk holds fewer than 2**21 bytes, so that two ranks and a place fit 63 bits
_CELL = "id long, mark int, anchor long, cell long, first int, last int, times int, known boolean, runs binary"


def _cells(data: np.ndarray, prefix: np.ndarray, length: int):
    """(anchor hash, cell hash, first start, last start, anchor place) of a text of at least `length` bytes."""
    grams = span_hash(prefix, np.arange(len(data) - GRAM + 1), np.arange(GRAM, len(data) + 1))
    window = length - GRAM + 1
    key = (grams & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - np.arange(len(grams), dtype=np.uint64))
    span = 1
    while span < window:
        step = min(span, window - span)
        key = np.minimum(key[:-step], key[step:])
        span += step
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    last = np.r_[first[1:], len(key)] - 1
    at = (np.uint64(0xFFFFFFFF) - (key[first] & np.uint64(0xFFFFFFFF))).astype(np.int64)
    cell = mix(span_hash(prefix, first, last + length) + (at - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return grams[at], cell, first, last, at


def _cell_batches(length: int):
    """Cells of a partition's texts.  A cell that a chunk of texts holds more than once is settled at once: it is sent on a single time,
    with its `times` and as `known`, and the bytes that it covers go with its documents, one row (without an anchor) each."""

    @releasing
    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.compute.is_valid(batch.column(0)))
            ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offs = text_column(batch.column(2))
            for a, b in row_chunks(offs):
                out = []
                for i in range(a, b):
                    if offs[i + 1] - offs[i] >= length:
                        text = data[offs[i] : offs[i + 1]]
                        cells = _cells(text, prefix_hash(text), length)
                        out.append((np.full(len(cells[0]), i), *cells[:4]))
                if not out:
                    continue
                row, anchor, cell, first, last = (np.concatenate(c) for c in zip(*out, strict=True))
                _, place, group, count = np.unique(cell ^ mix(anchor), return_index=True, return_inverse=True, return_counts=True)
                times, known = count[group], count[group] > 1
                sent = ~known
                sent[place] = True
                settled = []
                at = np.flatnonzero(known)
                for i in np.unique(row[at]):
                    own = at[row[at] == i] if len(at) < 1000 else at[np.searchsorted(row[at], i) : np.searchsorted(row[at], i, side="right")]
                    settled.append((ids[i], marks[i], _merged(first[own], last[own] + length)))
                n, m = int(sent.sum()), len(settled)
                none = lambda k, t: pa.nulls(k, t)
                columns = {
                    "id": pa.array(np.r_[ids[row[sent]], np.array([x[0] for x in settled], np.int64)]),
                    "mark": pa.array(np.r_[marks[row[sent]], np.array([x[1] for x in settled], np.int32)].astype(np.int32)),
                    "anchor": pa.chunked_array([pa.array(anchor[sent].view(np.int64)), none(m, pa.int64())]).combine_chunks(),
                    "cell": pa.chunked_array([pa.array(cell[sent].view(np.int64)), none(m, pa.int64())]).combine_chunks(),
                    "first": pa.array(np.r_[first[sent], np.zeros(m, np.int64)].astype(np.int32)),
                    "last": pa.array(np.r_[last[sent], np.zeros(m, np.int64)].astype(np.int32)),
                    "times": pa.array(np.r_[times[sent], np.zeros(m, np.int64)].astype(np.int32)),
                    "known": pa.array(np.r_[known[sent], np.ones(m, bool)]),
                    "runs": pa.chunked_array([none(n, pa.binary()), pa.array([x[2] for x in settled], pa.binary())]).combine_chunks(),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _merged(start: np.ndarray, end: np.ndarray) -> bytes:
    """Ranges in order of their starts as packed ranges that don't touch."""
    end = np.maximum.accumulate(end)
    fresh = np.r_[True, start[1:] > end[:-1]]
    return np.stack([start[fresh], end[np.r_[fresh[1:], True]]], axis=1).astype(np.int32).tobytes()


def depth_ranks(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Ranks of the suffixes at `starts`, equal just where their first `length` bytes are: Larsson-Sadakane refinement stopped at that depth.

    `text` has fewer than 2**21 bytes; every start has `length` bytes after it.
    """
    n, mask = len(text), (1 << _BITS) - 1
    padded = np.r_[text.astype(np.int64), np.zeros(5, np.int64)]
    key = np.zeros(n, np.int64)
    for j in range(5):
        key = (key << 8) | padded[j : n + j]
    rank = np.zeros(n, np.int64)
    order = np.sort((key << _BITS) | np.arange(n))
    head = order >> _BITS
    fresh = np.r_[True, head[1:] != head[:-1]]
    group = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rank[order & mask] = group
    alone = fresh & np.r_[fresh[1:], True]
    active, depth = (order & mask)[~alone], 5
    while depth < length and len(active):
        step = min(depth, length - depth)
        order = np.sort((rank[active] << (2 * _BITS)) | (rank[np.minimum(active + step, n - 1)] << _BITS) | active)
        place, old, pair = order & mask, order >> (2 * _BITS), order >> _BITS
        index = np.arange(len(order))
        in_old = np.r_[True, old[1:] != old[:-1]]
        fresh = np.r_[True, pair[1:] != pair[:-1]]
        old_first = np.maximum.accumulate(np.where(in_old, index, 0))
        new_first = np.maximum.accumulate(np.where(fresh, index, 0))
        new = old + new_first - old_first
        alone = fresh & np.r_[fresh[1:], True]
        rank[place] = new
        active, depth = place[~alone], depth + step
    return rank[starts]


def _runs(starts: np.ndarray, length: int) -> bytes:
    """Sorted starts as packed [from, to) byte ranges that their strings cover."""
    if not len(starts):
        return b""
    gap = np.r_[True, np.diff(starts) > length]
    return np.stack([starts[gap], starts[np.r_[gap[1:], True]] + length], axis=1).astype(np.int32).tobytes()


def _shard_batches(length: int):
    """Rows by (anchor, part): anchor, part, cell, copies, ranges, bytes.  Out: each cell's runs of repeated strings and, for the parts
    of a divided anchor, the sorted hashes of the strings that the part holds, in so many ranges."""

    def settle(rows):
        sizes = np.array([len(r[5]) for r in rows])
        text = np.frombuffer(b"".join(r[5] for r in rows), np.uint8)
        base = np.cumsum(sizes) - sizes
        counts = np.maximum(sizes - length + 1, 0)
        owner = np.repeat(np.arange(len(rows)), counts)
        starts = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts) + base[owner]
        rank = depth_ranks(text, starts, length)
        again = np.bincount(rank, minlength=len(text))[rank] > 1
        cuts = np.r_[0, np.cumsum(counts)]
        out = []
        for i, r in enumerate(rows):
            own = slice(cuts[i], cuts[i + 1])
            runs = _runs((starts[own] - base[i])[again[own]], length)
            if runs:
                out.append((r[2], r[0], r[2], runs, None))  # by its cell, so that a hot anchor's runs are spread
        if any(r[4] for r in rows):
            hashes = span_hash(prefix_hash(text), starts, starts + length)
            cells = np.array([r[2] for r in rows], np.int64)
            parts = {}
            for i, r in enumerate(rows):
                if r[4]:
                    parts.setdefault((r[0], r[1], r[4]), []).append(np.arange(cuts[i], cuts[i + 1]))
            for (anchor, _, ranges), at in parts.items():
                at = np.concatenate(at)
                at = at[np.unique(rank[at], return_index=True)[1]]  # one start of each string that the part holds
                at = at[np.argsort(hashes[at], kind="stable")]
                place = np.where(again[at], -1, starts[at] - base[owner[at]])  # -1: no answer is needed
                number = ((hashes[at] >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
                edges = np.r_[np.flatnonzero(np.r_[True, number[1:] != number[:-1]]), len(at)] if len(at) else [0]
                for i, j in zip(edges[:-1], edges[1:], strict=True):
                    body = b"".join((np.int64(j - i).tobytes(), hashes[at[i:j]].tobytes(), cells[owner[at[i:j]]].tobytes(), place[i:j].astype(np.int64).tobytes()))
                    out.append((anchor ^ (int(number[i]) << 20), anchor, None, None, body))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["key", "anchor", "cell", "runs", "strings"])

    @releasing
    def run(batches):
        rows, size, group = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                if row[:2] != group and size > 1_000_000:
                    yield from settle(rows)
                    rows, size = [], 0
                group = row[:2]
                rows.append(row)
                size += len(row[5])
        if rows:
            yield from settle(rows)

    return run


def _merge_batches(length: int):
    """Rows (key, anchor, cell, runs, strings) by key: runs pass; the sorted hashes of one anchor's parts are merged by binary search; starts whose string another part holds are runs."""

    def settle(anchor, bodies):
        if len(bodies) < 2:
            return
        parts = []
        for body in bodies:
            n = int(np.frombuffer(body, np.int64, 1)[0])
            parts.append(tuple(np.frombuffer(body, kind, n, 8 + 8 * n * i) for i, kind in enumerate((np.uint64, np.int64, np.int64))))
        order = np.sort(np.concatenate([h for h, _, _ in parts]))
        found: dict[int, list] = {}
        for hashes, cells, places in parts:
            low, high = np.searchsorted(order, hashes, "left"), np.searchsorted(order, hashes, "right")
            hit = np.flatnonzero((high - low > 1) & (places >= 0))
            hit = hit[np.argsort(cells[hit], kind="stable")]
            start = np.flatnonzero(np.r_[True, cells[hit][1:] != cells[hit][:-1]]) if len(hit) else hit
            for i, j in zip(start, np.r_[start[1:], len(hit)], strict=False):
                found.setdefault(int(cells[hit[i]]), []).append(places[hit[i:j]])
        out = [(anchor, c, _runs(np.sort(np.concatenate(x)), length)) for c, x in found.items()]
        if out:
            yield rows(*zip(*out, strict=True))

    def rows(anchors, cells, runs):
        return pa.RecordBatch.from_arrays([pa.array(anchors, pa.int64()), pa.array(cells, pa.int64()), pa.array(runs, pa.binary())], names=["anchor", "cell", "runs"])

    @releasing
    def run(batches):
        group, bodies = None, []
        for batch in batches:
            done = pa.compute.is_valid(batch.column(3))
            passed, rest = batch.filter(done), batch.filter(pa.compute.invert(done))
            if passed.num_rows:
                yield rows(passed.column(1), passed.column(2), passed.column(3))
            for key, anchor, body in zip(*(rest.column(i).to_pylist() for i in (0, 1, 4)), strict=True):
                if (key, anchor) != group:
                    if bodies:
                        yield from settle(group[1], bodies)
                    group, bodies = (key, anchor), []
                bodies.append(body)
        if bodies:
            yield from settle(group[1], bodies)

    return run


def _body_batches(length: int):
    """Documents with the cells to be read from them: anchor, cell, ..., bytes."""

    @releasing
    def run(batches):
        for batch in batches:
            wanted = batch.column(batch.num_columns - 1)
            data, offs = text_column(batch.column(2))
            out = []
            for i, cells in enumerate(wanted.to_pylist()):
                for c in cells or ():
                    out.append((c["anchor"], c["part"], c["cell"], c["copies"], c["ranges"], data[offs[i] + c["first"] : offs[i] + c["last"] + length].tobytes()))
            if out:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["anchor", "part", "cell", "copies", "ranges", "body"])

    return run


@releasing
def _rewrite(batches):
    for batch in batches:
        data, offs = text_column(batch.column(2))
        out = []
        for i, runs in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
            text = data[offs[i] : offs[i + 1]]
            if not runs:
                out.append((len(text), 0, 0, text.tobytes()))
                continue
            change = np.zeros(len(text) + 1, np.int32)
            for r in runs:
                spans = np.frombuffer(r["runs"], np.int32).reshape(-1, 2) + r["first"]
                np.add.at(change, spans[:, 0], 1)
                np.add.at(change, spans[:, 1], -1)
            gone = np.cumsum(change[:-1]) > 0
            spans = int((gone & ~np.r_[False, gone[:-1]]).sum())
            out.append((len(text), int(gone.sum()), spans, text[~gone].tobytes()))
        cols = list(zip(*out, strict=True)) if out else [()] * 4
        sha = [hashlib.sha256(x).hexdigest() for x in cols[3]]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(sha, pa.string()), pa.array(cols[3], pa.binary())],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
        )


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, kept): each text without the bytes of any `length`-byte string that starts twice or more.

    Strings lie in one text and are judged on the input.  Null texts are empty; repeated rows are two documents (both lose what they
    share), as are rows that share an id; rows with a null id are returned as they are and count for nothing.  `kept` is binary: a cut
    may fall inside a character.
    """
    if not 2 * GRAM <= length <= 2000:
        raise ValueError(f"strings must have {2 * GRAM} to 2000 bytes, so that a shard's chunk fits its packed ranks")
    n = shuffle_partitions(docs)
    mark = (F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")) - F.lit(1 << 31)).cast("int")
    base = docs.select(F.col(id_col).cast("long").alias("id"), mark.alias("mark"), F.col(text_col).alias("text"))
    cells = cut(base.mapInArrow(_cell_batches(length), _CELL))
    rep = F.min(F.struct("id", "mark", "first", "last")).alias("rep")
    distinct = cells.where("anchor is not null").groupBy("anchor", "cell").agg(F.sum("times").alias("copies"), rep)
    anchors = distinct.groupBy("anchor").agg(F.count("*").alias("kinds"), F.sum("copies").alias("total")).where("total > 1")
    shared = cut(distinct.join(anchors, "anchor"))
    parts = F.ceil(F.col("kinds") / min(CELLS, 400_000 // length)).cast("int")
    ranges = F.when(parts > 1, F.ceil(parts / PARTS_A_RANGE)).otherwise(0).cast("int")
    several = shared.where("kinds > 1").select("rep.*", F.struct("anchor", F.pmod(F.col("cell"), parts).cast("int").alias("part"), "cell", "copies", ranges.alias("ranges"), F.col("rep.first").alias("first"), F.col("rep.last").alias("last")).alias("c"))
    wanted = several.groupBy("id", "mark").agg(F.collect_list("c").alias("cells"))
    bodies = base.join(wanted, ["id", "mark"], "left").mapInArrow(_body_batches(length), "anchor long, part int, cell long, copies long, ranges int, body binary")
    shards = bodies.repartition(n, "anchor", "part").sortWithinPartitions("anchor", "part", "cell")
    settled = shards.mapInArrow(_shard_batches(length), "key long, anchor long, cell long, runs binary, strings binary")
    merged = settled.repartition(n, "key").sortWithinPartitions("key", "anchor").mapInArrow(_merge_batches(length), "anchor long, cell long, runs binary")
    whole = shared.where("copies > 1").select("anchor", "cell", _whole(length).alias("runs"))
    answers = merged.unionByName(whole)
    answers = answers.groupBy("anchor", "cell").agg(F.collect_list("runs").alias("runs"))
    asked = cells.where("not known").drop("runs").join(answers, ["anchor", "cell"])
    spots = asked.select("id", "mark", F.explode("runs").alias("runs"), "first").unionByName(cells.where("anchor is null").select("id", "mark", "runs", "first"))
    per_doc = spots.groupBy("id", "mark").agg(F.collect_list(F.struct("runs", "first")).alias("spots"))
    judged = base.join(per_doc, ["id", "mark"], "left")
    return judged.mapInArrow(_rewrite, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def _whole(length: int):
    """The packed range of all of a cell's strings: [0, last - first + length) as two little-endian ints."""
    end = F.lpad(F.hex((F.col("rep.last") - F.col("rep.first") + length).cast("long")), 8, "0")
    little = F.concat(*(F.substring(end, at, 2) for at in (7, 5, 3, 1)))
    return F.unhex(F.concat(F.lit("00000000"), little))
