"""SimHash near-duplicates through Golay-code fuzzy keys.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits.  Two or fewer differing bits always leave one
segment equal and a second one, named by the segment that is equal, with at most one differing bit.  That second
segment is decoded with the perfect (23,12) Golay code: a word within distance 2 of its codeword has that
codeword as its key; a word at distance 3 has it and the five codewords at distance 4.  Words that differ in one
bit always share such a key.  So a fingerprint has up to 6 keys in each of three families, each of an equal
segment and a codeword, and every link is found by a hash join on keys and then verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.arrays import inside, min_labels, mix, prefix_hash, releasing, row_chunks, span_hash, text_column, window_hash, words
from ratewright.llm.components import connected_components
from ratewright.llm.lineage import cut

GOLAY_GENERATOR = 0xAE3  # x^11+x^9+x^7+x^6+x^5+x+1
SEGMENTS = ((0, 23), (23, 23), (46, 18))  # first bit, bits
FAMILIES = ((2, 1), (0, 2), (1, 0))  # (equal segment, decoded segment)
MAX_RUN = 256  # a key held by more fingerprints is refined by longer keys instead of compared pair by pair
BLOCKS, EQUAL_BLOCKS = 8, 6
_SHINGLE_SEED = 42


def _syndrome(v: int) -> int:
    for bit in range(22, 10, -1):
        if v >> bit & 1:
            v ^= GOLAY_GENERATOR << (bit - 11)
    return v


class Golay:
    """Tables of the (23,12) code, built from its generator."""

    def __init__(self):
        unit = [_syndrome(1 << b) for b in range(23)]
        self.low = np.array([_syndrome(v) for v in range(1 << 12)], np.int64)
        self.high = np.array([_syndrome(v << 12) for v in range(1 << 11)], np.int64)
        self.leaders = np.zeros((2048, 6), np.int64)  # error patterns: the nearest codeword's, then those of weight 4
        filled = np.zeros(2048, np.int64)
        for weight in range(5):
            for bits in combinations(range(23), weight):
                s = 0
                for b in bits:
                    s ^= unit[b]
                if weight == 4 and filled[s] and bin(int(self.leaders[s, 0])).count("1") < 3:
                    continue
                self.leaders[s, filled[s]] = sum(1 << b for b in bits)
                filled[s] += 1
        for s in range(2048):
            self.leaders[s, filled[s] :] = self.leaders[s, 0]

    def keys(self, v: np.ndarray) -> np.ndarray:
        """The codeword numbers (12 bits) of each word, 6 columns with repeats."""
        s = self.low[v & 0xFFF] ^ self.high[v >> 12]
        return (v[:, None] ^ self.leaders[s]) >> 11


_GOLAY: list[Golay] = []


def golay() -> Golay:
    if not _GOLAY:
        _GOLAY.append(Golay())
    return _GOLAY[0]


def fuzzy_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, number of its fingerprint) without repeats in a fingerprint."""
    seg = [(fp >> np.uint64(at)).astype(np.int64) & ((1 << n) - 1) for at, n in SEGMENTS]
    keys, owner = [], []
    for family, (equal, decoded) in enumerate(FAMILIES):
        k = np.sort(golay().keys(seg[decoded]), axis=1)
        fresh = np.c_[np.ones(len(fp), bool), k[:, 1:] != k[:, :-1]]
        k = (family << 36) | (seg[equal][:, None] << 12) | k
        keys.append(k[fresh])
        owner.append(np.broadcast_to(np.arange(len(fp))[:, None], fresh.shape)[fresh])
    return np.concatenate(keys), np.concatenate(owner)


def long_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """48-bit keys: any 6 of 8 bytes; two differing bits leave 6 bytes equal."""
    part = [(fp >> np.uint64(8 * b)).astype(np.int64) & 0xFF for b in range(BLOCKS)]
    keys = []
    for number, chosen in enumerate(combinations(range(BLOCKS), EQUAL_BLOCKS)):
        k = np.full(len(fp), number, np.int64)
        for b in chosen:
            k = (k << 8) | part[b]
        keys.append(k)
    return np.concatenate(keys), np.tile(np.arange(len(fp)), len(keys))


def simhash_texts(texts: list[bytes]) -> np.ndarray:
    """64-bit fingerprints of UTF-8 texts: 3-word shingles of the A-Z-lower-cased words, XXH64 with seed 42."""
    digest, joined, counts = xxhash.xxh64_digest, [], np.ones(len(texts), np.int64)
    for i, text in enumerate(texts):
        ws = text.lower().split()
        if len(ws) > 3:
            line = b" ".join(ws)
            ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1) - 1
            starts = np.r_[0, ends[:-1] + 1]
            counts[i] = len(ws) - 2
            joined += [digest(line[a:b], _SHINGLE_SEED) for a, b in zip(starts[:-2].tolist(), ends[2:].tolist(), strict=True)]
        else:
            joined.append(digest(b" ".join(ws), _SHINGLE_SEED) if ws else bytes(8))
    bits = np.unpackbits(np.frombuffer(b"".join(joined), np.uint8).reshape(-1, 8), axis=1)
    first = np.r_[0, np.cumsum(counts)[:-1]]
    ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    return np.packbits(2 * ones > counts[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


@releasing
def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offs = text_column(batch.column(batch.num_columns - 1))
        out = np.zeros(batch.num_rows, np.uint64)
        for a, b in row_chunks(offs):
            out[a:b] = simhash_texts([data[offs[i] : offs[i + 1]].tobytes() for i in range(a, b)])
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out.view(np.int64))], names=[*batch.schema.names[:-1], "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fp) for each row; fp holds the 64 bits as a signed long.  A null or wordless text has fp 0."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(_fingerprint_batches, f"`{id_col}` {kind}, fp long")


def _key_batches(make):
    @releasing
    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            key, owner = make(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[owner])], names=["key", "fp"])

    return run


def _runs_to_links(radius: int, most: int | None):
    """Over rows sorted by key: a star of links per group of near fingerprints, or, for a key of more than `most` rows, its rows as they are (link = null)."""

    def links_of(key, fp):
        left, right = [], []
        for step in range(1, len(key)):
            same = key[step:] == key[:-step]
            if not same.any():
                break
            at = np.flatnonzero(same)
            at = at[np.bitwise_count((fp[at] ^ fp[at + step]).view(np.uint64)) <= radius]
            left.append(fp[at])
            right.append(fp[at + step])
        if not left:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        nodes, ids = np.unique(np.concatenate(left + right), return_inverse=True)
        half = len(ids) // 2
        root = nodes[min_labels(ids[:half], ids[half:], len(nodes))]
        return nodes[root != nodes], root[root != nodes]

    def large_run(fp):
        """One key's fingerprints (at most 2**16 by the length of long keys), a block of rows at a time."""
        label = np.arange(len(fp))
        for at in range(0, len(fp), 64):
            near = np.bitwise_count((fp[at : at + 64, None] ^ fp[None, :]).view(np.uint64)) <= radius
            i, j = np.nonzero(near)
            label = min_labels(np.r_[i + at, np.arange(len(fp))], np.r_[j, label], len(fp))
        return fp[label != np.arange(len(fp))], fp[label[label != np.arange(len(fp))]]

    @releasing
    def run(batches):
        key, fp, hot = np.zeros(0, np.int64), np.zeros(0, np.int64), None

        def rows(a, b=None):
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()) if b is not None else pa.nulls(len(a), pa.int64())], names=["fp", "link"])

        def settle(key, fp):
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
            size = np.diff(np.r_[start, len(key)])
            limit = most or MAX_RUN
            for s, n in zip(start[size > limit], size[size > limit], strict=True):
                yield rows(fp[s : s + n]) if most else rows(*large_run(fp[s : s + n]))
            small = np.repeat(size <= limit, size) & np.repeat(size > 1, size)
            yield rows(*links_of(key[small], fp[small]))

        for batch in batches:
            k, f = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if hot is not None:  # the rest of a run that was already too large goes straight through
                n = int(np.searchsorted(k, hot, side="right"))
                if n:
                    yield rows(f[:n])
                k, f = k[n:], f[n:]
                if not len(k):
                    continue
                hot = None
            key, fp = np.r_[key, k], np.r_[fp, f]
            done = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last key may go on
            if done:
                yield from settle(key[:done], fp[:done])
                key, fp = key[done:], fp[done:]
            if most and len(key) > most:
                hot = key[-1]
                yield rows(fp)
                key, fp = key[:0], fp[:0]
        yield from settle(key, fp)

    return run


def near_links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """(fp, link): stars whose components are those of all pairs of distinct `fp` that differ in `radius` (at most 2) or fewer bits.

    `fps` has one row per distinct fingerprint.  No pair list is ever sent on: a task reduces its keys' verified pairs to
    one link per fingerprint.  Keys of more than MAX_RUN fingerprints are refined exactly, by 28 keys of 48 bits each.
    """
    if not 0 <= radius <= 2:
        raise ValueError("the fuzzy keys guarantee links of at most 2 differing bits")
    keyed = fps.select("fp").mapInArrow(_key_batches(fuzzy_keys), "key long, fp long")
    first = cut(keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_runs_to_links(radius, MAX_RUN), "fp long, link long"))
    again = first.where("link is null").select("fp").distinct().mapInArrow(_key_batches(long_keys), "key long, fp long")
    second = again.repartition("key").sortWithinPartitions("key").mapInArrow(_runs_to_links(radius, None), "fp long, link long")
    return first.where("link is not null").unionByName(second)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2) -> DataFrame:
    """(id_col, fp, component_id): component_id is the smallest id reachable over fingerprints of at most `radius` differing bits.

    Equal fingerprints are grouped first, so a group of copies, however large, is one node.  Every row is returned, repeated
    rows and null ids too; a null id never becomes a component's id unless all of its ids are null.
    """
    rows = cut(fingerprints(docs, id_col, text_col))
    nodes = rows.groupBy("fp").agg(F.min(id_col).alias("least"))
    roots = connected_components(near_links(nodes, radius), "fp", "link")
    named = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = cut(named)
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(ids, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2) -> DataFrame:
    """The rows of `docs` whose id is the smallest of its component, all columns (repeats of such a row stay)."""
    kept = near_duplicates(docs, id_col, text_col, radius).where(F.col(id_col).eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col(id_col).alias("_kept_id")).distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_kept_id"]), "left_semi")


# Near copies are pairs whose sets of five-word shingles have a Jaccard likeness of LIKENESS or more.  Each set has a fingerprint of WIDE
# bits (a bit is set where over half of its shingles' hashes have it), of which PARTS segments of 23 bits are decoded.  A key is a codeword near a
# segment together with a minimum of a hash over the set, one minimum to a segment: the minimum is equal in both sets with the chance of their
# likeness, however the texts were edited, and takes the part that the equal segment has above.  At 0.8 a bit differs with a chance of 0.15, and
# two segments share a codeword with one of 0.60 (always where at most two bits differ; by pigeonhole some segment is such up to 32 differing
# bits).  So all PARTS keys miss a pair at 0.8 with a chance of (1 - 0.8 * 0.60)**11 = 0.0007, and less above.  A pair that shares a key is judged
# by its sets; pairs that no star settles only if their fingerprints allow it.
SHINGLE, LIKENESS = 5, 0.8
LANES, PARTS = 16, 11  # 64-bit lanes of the fingerprint; segments of its first bits that make keys
WIDE = 64 * LANES
# of WIDE bits 155 +- 11.5 differ at LIKENESS, more in small sets; beyond this bound with a chance of 2e-6, while at 0.6 nearly all pairs are beyond it
MOST_APART, MORE_APART = 208, 512  # that many, and the second number over the smaller set's shingles
FIRST_LANES, FIRST_APART = 4, 66  # the same for the first lanes alone, which are looked at first: 39 +- 5.7 differ at LIKENESS
BLOCK = 4096  # rows of one key that a task compares with as many others; more are dealt out as pairs of blocks
_SALTS = np.random.Generator(np.random.PCG64(20240302)).integers(1 << 62, 1 << 63, LANES, dtype=np.uint64)
_ODD = np.random.Generator(np.random.PCG64(20240301)).integers(1 << 62, 1 << 63, (2, PARTS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()  # a byte's bits, a byte each
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the sorted 32-bit hashes of its distinct shingles of A-Z-lower-cased words, and the first of each row (n rows + 1 entries).

    One to four words are one shingle; wordless rows have none.
    """
    start, end, first = words(data, offsets)
    n = np.diff(first)
    h = span_hash(prefix_hash(_LOWER[data]), start, end) if len(start) else np.zeros(0, np.uint64)
    at, row = inside(first, SHINGLE)
    rows, hashes = [row], [window_hash(h, SHINGLE)[at] if len(at) else np.zeros(0, np.uint64)]
    for length in range(1, SHINGLE):
        short = np.flatnonzero(n == length)
        if len(short):
            rows.append(short)
            hashes.append(window_hash(h, length)[first[short]])
    keyed = np.unique((np.concatenate(rows).astype(np.uint64) << np.uint64(32)) | (np.concatenate(hashes) >> np.uint64(32)))
    return keyed.astype(np.uint32), np.searchsorted(keyed, np.arange(len(n) + 1, dtype=np.uint64) << np.uint64(32))


def set_bits(items: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The WIDE bits of each row's items, a byte each; every row has one item at least.

    Counts of eight bits are added as one number, in blocks of at most 255 items, so that none overflows its byte.
    """
    n = np.diff(first)
    blocks = -(-n // 255)
    row_block = np.cumsum(blocks) - blocks
    start = np.repeat(first[:-1], blocks) + 255 * (np.arange(blocks.sum()) - np.repeat(row_block, blocks))
    end, counts = np.r_[start[1:], first[-1]], []
    for k in range(0, len(start), 64):
        part = items[start[k] : end[min(k + 64, len(start)) - 1]].astype(np.uint64)
        lanes = np.stack([mix(part + salt) for salt in _SALTS], axis=1)
        counts.append(np.add.reduceat(_SPREAD[lanes.view(np.uint8)], start[k : k + 64] - start[k], axis=0).view(np.uint8))
    ones = np.add.reduceat(np.concatenate(counts), row_block, axis=0, dtype=np.int32)
    return (2 * ones > n[:, None]).astype(np.uint8)


def minima(items: np.ndarray, first: np.ndarray) -> np.ndarray:
    """PARTS minima of hashes of each row's items; every row has one at least."""
    h = mix(items.astype(np.uint64) + np.uint64(1))
    return np.stack([np.minimum.reduceat(h * m, first[:-1]) for m in _ODD[0]], axis=1)


def segment_codes(bits: np.ndarray) -> np.ndarray:
    """The sorted codewords near each of the PARTS segments, with repeats: (rows, PARTS, 6)."""
    value = bits[:, : 23 * PARTS].reshape(-1, 23).astype(np.int64) @ (1 << np.arange(23))
    return np.sort(golay().keys(value), axis=1).reshape(len(bits), PARTS, -1)


def _key(least: np.ndarray, codes: np.ndarray, part: np.ndarray) -> np.ndarray:
    return mix(least + codes.astype(np.uint64) * _ODD[1][part])


def set_keys(bits: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, number of its set): each codeword near a segment with that segment's minimum, without repeats in a set."""
    codes = segment_codes(bits)
    fresh = np.concatenate([np.ones((*codes.shape[:2], 1), bool), codes[:, :, 1:] != codes[:, :, :-1]], axis=2)
    owner, part, _ = np.nonzero(fresh)
    return _key(least[owner, part], codes[fresh], part), owner


def first_shared_key(least: np.ndarray, codes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The key that stands for a pair among all that it shares: the first segment's, with the least codeword."""
    equal = (codes[a][:, :, :, None] == codes[b][:, :, None, :]).any(axis=3) & (least[a] == least[b])[:, :, None]
    part, place = np.divmod(equal.reshape(len(a), -1).argmax(axis=1), codes.shape[2])
    return _key(least[a, part], codes[a, part, place], part)


@releasing
def _set_batches(batches):
    """(id, text) to (id, node, n, bits, least, items): node names the set of n shingles, items are its packed hashes, bits and least its keys' parts."""
    for batch in batches:
        data, offs = text_column(batch.column(1))
        for a, b in row_chunks(offs, 1 << 20):
            items, first = shingle_sets(data[offs[a] : offs[b]], offs[a : b + 1] - offs[a])
            n = np.diff(first)
            full = np.flatnonzero(n)
            node = np.zeros(b - a, np.int64)
            bits, least = np.zeros((b - a, WIDE // 8), np.uint8), np.zeros((b - a, PARTS), np.uint64)
            if len(full):
                own = np.r_[first[:-1][full], len(items)]
                total = np.add.reduceat(mix(items.astype(np.uint64) + np.uint64(7)), own[:-1])
                node[full] = mix(total + n[full].astype(np.uint64)).view(np.int64)
                bits[full], least[full] = np.packbits(set_bits(items, own), axis=1), minima(items, own)
            packed = [[x.tobytes() for x in y] for y in (bits, least)] + [[items[i:j].tobytes() for i, j in zip(first[:-1], first[1:], strict=True)]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(node), pa.array(n.astype(np.int32)), *(pa.array(x, pa.binary()) for x in packed)],
                names=["id", "node", "n", "bits", "least", "items"],
            )


def _packed(column, kind, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, width)


@releasing
def _set_key_batches(batches):
    """(node, bits, least) to (key, node)."""
    for batch in batches:
        if batch.num_rows:
            bits = np.unpackbits(_packed(batch.column(1), np.uint8, WIDE // 8), axis=1)
            key, owner = set_keys(bits, _packed(batch.column(2), np.uint64, PARTS))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(batch.column(0).to_numpy()[owner])], names=["key", "node"])


@releasing
def _shared_keys(batches):
    """Rows (key, node) sorted by key: those of keys of several nodes."""
    last = None  # the last row met, and whether it is told already
    for batch in batches:
        key, node = (batch.column(i).to_numpy() for i in range(2))
        if not len(key):
            continue
        told = False
        if last is not None:
            key, node, told = np.r_[last[0], key], np.r_[last[1], node], last[2]
        same = np.r_[False, key[1:] == key[:-1]]
        shared = same | np.r_[same[1:], False]
        last = key[-1], node[-1], bool(shared[-1])
        shared[0] &= not told
        yield pa.RecordBatch.from_arrays([pa.array(key[shared]), pa.array(node[shared])], names=["key", "node"])


def _are_alike(x, y, least: float) -> bool:
    """Whether two sets, as packed by _set_batches, have that Jaccard likeness."""
    x, y = (np.frombuffer(v.as_buffer(), np.uint32) for v in (x, y))
    both = np.sort(np.concatenate([x, y]), kind="stable")
    same = int((both[1:] == both[:-1]).sum())
    return same >= least * (len(both) - same)


def _alike(least: float):
    """Rows (a, b, items of a, items of b): the pairs whose sets are alike."""

    @releasing
    def run(batches):
        for batch in batches:
            keep = pa.array([_are_alike(x, y, least) for x, y in zip(batch.column(2), batch.column(3), strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["node", "link"])

    return run


def _near_pairs(task, side, root, n, fp, least: float, apart: int):
    """Row numbers (later, earlier) of the pairs of one task, of different roots and of different sides (or side 2), that sizes and fingerprints allow."""
    low, more = np.searchsorted(task, task, "left"), MORE_APART * fp.shape[1] // LANES
    for i in range(0, len(task), 64):
        block = slice(i, min(i + 64, len(task)))
        other = slice(int(low[i]), block.stop)
        at = np.arange(other.start, other.stop)
        ours = (at >= low[block, None]) & (at < np.arange(i, block.stop)[:, None])
        ours &= (side[block, None] == 2) | (side[block, None] != side[None, other])
        ours &= root[block, None] != root[None, other]
        x, y = np.nonzero(ours)
        for k in range(0, len(x), 1 << 13):
            a, b = x[k : k + (1 << 13)] + i, y[k : k + (1 << 13)] + other.start
            small, large = np.minimum(n[a], n[b]), np.maximum(n[a], n[b])
            fit = small >= least * large
            a, b, small = a[fit], b[fit], small[fit]
            near = np.bitwise_count(fp[a] ^ fp[b]).sum(axis=1, dtype=np.int32) <= apart + more // small
            yield a[near], b[near]


def _by_task(settle):
    """A mapInArrow function over rows sorted by their first column: `settle` gets tables of whole tasks."""

    @releasing
    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            task = held.column(0).to_numpy()
            done = int(np.searchsorted(task, task[-1])) if len(task) else 0  # the last task may go on
            if done:
                yield settle(held.slice(0, done).combine_chunks())
                held = held.slice(done)
        if held is not None and held.num_rows:
            yield settle(held.combine_chunks())

    return run


def _close_rows(least: float):
    """Rows (task, side, key, node, n, first lanes) by task and node: key and node of those that the first lanes bring near another one, and the
    smallest such node if that is smaller than their own."""

    def settle(table):
        task, side, key, node, n = (table.column(k).to_numpy() for k in range(5))
        fp = _packed(table.column(5), np.uint64, FIRST_LANES)
        close, partner = np.zeros(len(task), bool), np.arange(len(task))
        for a, b in _near_pairs(task, side, node, n, fp, least, FIRST_APART):
            close[a] = close[b] = True
            np.minimum.at(partner, a, b)
        at = np.flatnonzero(close)
        smaller = pa.array(node[partner[at]], mask=partner[at] == at)
        return pa.RecordBatch.from_arrays([pa.array(key[at]), pa.array(node[at]), smaller], names=["key", "node", "partner"])

    return _by_task(settle)


def _open_links(least: float):
    """Rows (task, side, key, node, root, n, bits, least, items) by task: links between alike nodes of one task (of different sides, or side 2)
    that have different roots and are not linked by earlier ones.  A pair is judged in one of the keys that it shares only."""

    def settle(table):
        task, side, key, node, root, n = (table.column(k).to_numpy() for k in range(6))
        fp = _packed(table.column(6), np.uint64, LANES)
        minimum, items = _packed(table.column(7), np.uint64, PARTS), table.column(8)
        codes = segment_codes(np.unpackbits(fp.view(np.uint8), axis=1))
        joined: dict[int, int] = {}

        def top(x):
            while x in joined:
                x = joined[x]
            return x

        left, right = [], []
        for a, b in _near_pairs(task, side, root, n, fp, least, MOST_APART):
            if not len(a):
                continue
            here = first_shared_key(minimum, codes, a, b).view(np.int64) == key[a]
            for i, j in zip(a[here].tolist(), b[here].tolist(), strict=True):
                x, y = top(int(root[i])), top(int(root[j]))
                if x != y and _are_alike(items[i], items[j], least):
                    joined[max(x, y)] = min(x, y)
                    left.append(node[i])
                    right.append(node[j])
        return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["node", "link"])

    return _by_task(settle)


def _dealt(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """`rows` (key, node, ...) with the task that compares them and their side in it.  `counts` has the keys (others are dropped) and their _rows.

    A key of up to BLOCK rows is one task (side 2: all pairs); of a larger one each block is a task, and each pair of blocks (sides 0 and 1).
    """
    blocks = F.ceil(F.col("_rows") / BLOCK).cast("int")
    rows = rows.join(counts, "key").withColumns({"_blocks": blocks, "_own": F.pmod(F.xxhash64("node"), blocks).cast("int")})
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    task = F.xxhash64("key", F.least("_own", "_other"), F.greatest("_own", "_other"))
    side = F.when(F.col("_own") == F.col("_other"), 2).otherwise((F.col("_own") > F.col("_other")).cast("int"))
    return rows.withColumns({"task": task, "side": side}).drop("_rows", "_blocks", "_own", "_other")


def _judged(pairs: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """(node, link): the pairs (a, b) of distinct nodes whose sets are alike; sets travel with pairs that their sizes allow."""
    slim = nodes.select("node", "n")
    sized = pairs.join(slim.select(F.col("node").alias("a"), F.col("n").alias("_n")), "a").join(slim.withColumnRenamed("node", "b"), "b")
    sized = sized.where(F.least("n", "_n") >= least * F.greatest("n", "_n")).select("a", "b")
    named = sized.join(nodes.select(F.col("node").alias("b"), F.col("items").alias("_b")), "b")
    named = named.join(nodes.select(F.col("node").alias("a"), F.col("items").alias("_a")), "a")
    return named.select("a", "b", "_a", "_b").mapInArrow(_alike(least), "node long, link long")


def _near_groups(docs: DataFrame, id_col: str, text_col: str, least: float) -> DataFrame:
    """(node, least_id, root): the distinct sets, the least id that has each, and their groups."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, node long, n int, bits binary, least binary, items binary"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_set_batches, schema)
    nodes = cut(rows.groupBy("node").agg(F.min("id").alias("least_id"), *(F.any_value(c).alias(c) for c in ("n", "bits", "least", "items"))))
    keyed = nodes.where("n > 0").select("node", "bits", "least").mapInArrow(_set_key_batches, "key long, node long")
    shared = cut(keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_shared_keys, "key long, node long"))
    slim = nodes.select("node", "n", F.substring("bits", 1, 8 * FIRST_LANES).alias("first"))
    dealt = _dealt(shared, shared.groupBy("key").agg(F.count("*").alias("_rows"))).join(slim, "node").select("task", "side", "key", "node", "n", "first")
    close = cut(dealt.repartition("task").sortWithinPartitions("task", "node").mapInArrow(_close_rows(least), "key long, node long, partner long"))
    sharing = cut(nodes.select("node", "n", "bits", "least", "items").join(close.select("node").distinct(), "node", "left_semi"))
    links = cut(_judged(close.where("partner is not null").select(F.col("partner").alias("a"), F.col("node").alias("b")).distinct(), sharing, least))
    roots = connected_components(links, "node", "link")
    rest = close.select("key", "node").distinct().join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    several = rest.groupBy("key").agg(F.min("root").alias("_low"), F.max("root").alias("_high"), F.count("*").alias("_rows"))
    several = several.where("_low <> _high and _rows > 2").select("key", "_rows")
    dealt = _dealt(rest, several).join(sharing, "node").select("task", "side", "key", "node", "root", "n", "bits", "least", "items")
    found = dealt.repartition("task").sortWithinPartitions("task", "node").mapInArrow(_open_links(least), "node long, link long")
    links = links.unionByName(found)  # the first ones are a table already
    roots = connected_components(links, "node", "link")
    return nodes.select("node", "least_id").join(roots, "node", "left").select("node", "least_id", F.coalesce("root", "node").alias("root"))


def keep_one_near_copy(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LIKENESS) -> DataFrame:
    """The rows of `docs`, all columns, without near copies of a row with a smaller id: of each group linked by pairs of a Jaccard likeness of
    `least` (LIKENESS or more) of the sets of five-word shingles the smallest id stays.

    Equal sets are one node, so copies of any number are grouped before the join.  Nodes that no fingerprint of their keys is near go
    first.  Of the others each is judged against the smallest near one of each key, which settles groups of near copies with rows in proportion;
    then nodes of one key that are still in different groups are judged by the task that holds the key, and only links leave it.  Of a key
    with more than BLOCK nodes each pair of blocks is a task; no result depends on that.  Wordless and null texts are alike; repeats of a row
    that stays stay; a null id stays only where all ids of its group are null.
    """
    if least < LIKENESS:
        raise ValueError(f"the keys find pairs of a likeness of {LIKENESS} and more")
    groups = _near_groups(docs, id_col, text_col, least)
    kept = groups.groupBy("root").agg(F.min("least_id").alias("_kept_id")).select("_kept_id").distinct()
    return docs.join(kept, docs[id_col].eqNullSafe(kept["_kept_id"]), "left_semi")
