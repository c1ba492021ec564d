"""Exact removal of repeated word passages, found through difference-cover anchors.

A *window* is `window` consecutive words of one document.  A word is removed if a window that covers it also
starts, word for word, in a document with a smaller id.

COVER is a difference cover modulo PERIOD: any two positions can be moved right together by fewer than PERIOD
words so that both fall, modulo PERIOD, in COVER.  Two equal windows, wherever they start, therefore hold equal
`window - PERIOD + 1`-word anchors at aligned cover positions.  So

1. only anchors at cover positions (3 of 7) are hashed and exchanged, to find those that two documents share;
2. each shared anchor is extended to the full windows around it, whose hashes are exchanged to find, for each
   window, the smallest id that holds it; the answer goes back to the documents as word positions.

Both exchanges send packed arrays, one per map chunk and hash bucket.  A chunk reduces each hash to the
occurrences of its smallest id before sending (the others are decided on the spot), so a hash that every document
holds costs a bucket one entry per chunk, not per document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.arrays import inside, prefix_hash, releasing, row_chunks, span_hash, text_column, window_hash, words
from ratewright.llm.lineage import shuffle_partitions

PERIOD, COVER = 7, (0, 1, 3)
CHUNK = 2_000_000  # occurrences that a task holds before it sends them
_SENT = "bucket int, chunk long, known boolean, body binary"
_ANSWERED = "chunk long, body binary"
_SPOTS = "id long, mark int, spots binary"


def _pack(hashes, doc, pos, ids, marks) -> bytes:
    used, doc = np.unique(doc, return_inverse=True)
    wide = np.uint32 if len(used) > 65535 else np.uint16
    far = np.int32 if len(pos) and pos.max() > 32767 else np.int16
    head = np.array([len(doc), hashes.dtype.itemsize if hashes is not None else 0, len(used), np.dtype(wide).itemsize, np.dtype(far).itemsize], np.int64)
    parts = (head, *([hashes] if hashes is not None else []), doc.astype(wide), pos.astype(far), ids[used], marks[used])
    return b"".join(x.tobytes() for x in parts)


def _unpack(body: bytes, slices: int = 1, number: int = 0):
    """hashes (none: None), and per occurrence the id, mark and position; of several slices of the hashes the one of that number."""
    n, h, m, wide, far = np.frombuffer(body, np.int64, 5)
    at, out = 40, []
    for count, kind in ((n * (h > 0), f"u{h or 1}"), (n, f"u{wide}"), (n, f"i{far}"), (m, "i8"), (m, "i4")):
        out.append(np.frombuffer(body, kind, count, at))
        at += count * np.dtype(kind).itemsize
    hashes, doc, pos, ids, marks = out
    if slices > 1:
        own = np.flatnonzero(hashes % hashes.dtype.type(slices) == number)
        hashes, doc, pos = hashes[own], doc[own], pos[own]
    return hashes.astype(np.uint64) if h else None, ids[doc], marks[doc], pos.astype(np.int64)


def _spot_rows(bodies: list[bytes]) -> pa.RecordBatch:
    """One row (id, mark, positions) per document."""
    _, ids, marks, pos = zip(*map(_unpack, bodies), strict=True)
    ids, marks, pos = np.concatenate(ids), np.concatenate(marks), np.concatenate(pos)
    order = np.lexsort((pos, marks, ids))
    ids, marks, pos = ids[order], marks[order], pos[order].astype(np.int32)
    start = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])]) if len(ids) else np.zeros(0, np.int64)
    offsets = np.r_[start, len(ids)].astype(np.int64) * 4
    spots = pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(pos.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(ids[start]), pa.array(marks[start]), spots.cast(pa.binary())], names=["id", "mark", "spots"])


class _Sender:
    """Gathers occurrences (hash, document, position) and packs them by bucket.

    `later`: an occurrence is to be answered if a smaller id has its hash; else if any other id has it.
    """

    def __init__(self, buckets: int, later: bool):
        self.buckets, self.later = buckets, later
        self.clear()

    def clear(self):
        self.parts, self.ids, self.marks, self.docs, self.n = [], [], [], 0, 0

    def add(self, ids, marks, hashes, doc, pos):
        self.parts.append((hashes, doc + self.docs, pos))
        self.ids.append(ids)
        self.marks.append(marks)
        self.docs += len(ids)
        self.n += len(hashes)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return self.clear()
        hashes, doc, pos = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        ids, marks = np.concatenate(self.ids), np.concatenate(self.marks)
        self.clear()
        if (np.diff(ids) < 0).any():  # occurrences in the order of ids
            by_id = np.argsort(ids, kind="stable")
            rank = np.empty(len(ids), np.int64)
            rank[by_id] = np.arange(len(ids))
            order = np.argsort(rank[doc], kind="stable")
            hashes, doc, pos, ids, marks = hashes[order], rank[doc[order]], pos[order], ids[by_id], marks[by_id]
        order = np.argsort(hashes, kind="stable")
        hashes, doc, pos = hashes[order], doc[order], pos[order]
        start = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
        size = np.diff(np.r_[start, len(hashes)])
        low, high = ids[doc[start]], ids[doc[start + size - 1]]
        several = np.repeat(low < high, size)
        known = (ids[doc] > np.repeat(low, size)) if self.later else several
        chunk = int(ids[0]) ^ (int(marks[0]) << 20)  # where the answers for these documents meet
        if known.any():  # these pass the exchange unchanged
            body = _pack(None, doc[known], pos[known], ids, marks)
            yield self.rows([(abs(chunk) % self.buckets, chunk, True, body)])
        if self.later:
            send = ~known
            hashes, doc, pos = hashes[send], doc[send], pos[send]
        else:  # of a hash that is known to be shared, two ids say so to the other chunks; they need no answer
            ends = np.zeros(len(hashes), bool)
            ends[start] = ends[start + size - 1] = True
            send = ~several | ends
            hashes, doc, pos = hashes[send], doc[send], np.where(several, -1, pos)[send]
        bucket = ((hashes >> np.uint64(32)) * np.uint64(self.buckets)) >> np.uint64(32)
        cuts = np.searchsorted(bucket, np.arange(self.buckets + 1))
        if not self.later:
            hashes = hashes.astype(np.uint32)  # with the bucket enough to find candidates
        sent = [(b, chunk, False, _pack(hashes[i:j], doc[i:j], pos[i:j], ids, marks)) for b, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if j > i]
        for at in range(0, len(sent), 64):
            yield self.rows(sent[at : at + 64])

    @staticmethod
    def rows(sent) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.int64(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*sent, strict=True), kinds, strict=True)], names=["bucket", "chunk", "known", "body"])


def _answers(later: bool, most: int):
    """Per bucket: of the occurrences sent, those that the rule answers, packed by the chunk that they came from."""

    def rows(chunks, bodies):
        return pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(bodies, pa.binary())], names=["chunk", "body"])

    def settle(sent):
        """A bucket's packed bodies, some `most` occurrences of them at a time."""
        slices = -(-sum(int(np.frombuffer(body, np.int64, 1)[0]) for _, body in sent) // most)
        for number in range(slices):
            yield from settle_slice(sent, slices, number)

    def settle_slice(sent, slices, number):
        parts = [_unpack(body, slices, number) for _, body in sent]
        source = np.repeat(np.arange(len(sent)), [len(x[0]) for x in parts])
        hashes, ids, marks, pos = (np.concatenate(x) for x in zip(*parts, strict=True))
        if not len(hashes):
            return
        order = np.argsort(hashes, kind="stable")
        hashes, sorted_ids = hashes[order], ids[order]
        start = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
        size = np.diff(np.r_[start, len(hashes)])
        low = np.minimum.reduceat(sorted_ids, start)
        hit = np.zeros(len(ids), bool)
        hit[order] = sorted_ids > np.repeat(low, size) if later else np.repeat(low < np.maximum.reduceat(sorted_ids, start), size)
        at = np.flatnonzero(hit & (pos >= 0))
        cuts = np.searchsorted(source[at], np.arange(len(sent) + 1))
        for (chunk, _), i, j in zip(sent, cuts[:-1], cuts[1:], strict=True):
            if j > i:
                part = at[i:j]
                owners = np.unique(np.rec.fromarrays([ids[part], marks[part]], names="id,mark"), return_inverse=True)
                yield rows([chunk], [_pack(None, owners[1], pos[part], owners[0].id, owners[0].mark)])

    @releasing
    def run(batches):
        bucket, sent = None, []
        for batch in batches:
            for b, chunk, known, body in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if known:
                    yield rows([chunk], [body])
                    continue
                if b != bucket:
                    yield from settle(sent)
                    bucket, sent = b, []
                sent.append((chunk, body))
        yield from settle(sent)

    return run


@releasing
def _by_document(batches):
    chunk, bodies = None, []
    for batch in batches:
        for c, body in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
            if c != chunk and bodies:
                yield _spot_rows(bodies)
                bodies = []
            chunk = c
            bodies.append(body)
    if bodies:
        yield _spot_rows(bodies)


def _exchange(df: DataFrame, send, later: bool) -> DataFrame:
    """(id, mark, list of packed positions) of the occurrences that `send` emits and the rule answers."""
    n = shuffle_partitions(df)
    sent = df.mapInArrow(send(n, later), _SENT).repartition(n, "bucket").sortWithinPartitions("bucket")
    answered = sent.mapInArrow(_answers(later, CHUNK), _ANSWERED).repartition(n, "chunk").sortWithinPartitions("chunk")
    return answered.mapInArrow(_by_document, _SPOTS).groupBy("id", "mark").agg(F.collect_list("spots").alias("spots"))


def _send_anchors(window: int):
    length = window - PERIOD + 1
    at_cover = np.isin(np.arange(PERIOD), COVER)

    def send(buckets: int, later: bool):
        @releasing
        def run(batches):
            out = _Sender(buckets, later)
            for batch in batches:
                batch = batch.filter(pa.compute.is_valid(batch.column(0)))
                ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                data, offs = text_column(batch.column(2))
                for a, b in row_chunks(offs):
                    part, o = data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
                    start, end, first = words(part, o)
                    at, row = inside(first, length)
                    pos = at - first[:-1][row]
                    keep = at_cover[pos % PERIOD]
                    hashes = window_hash(span_hash(prefix_hash(part), start, end), length)
                    out.add(ids[a:b], marks[a:b], hashes[at[keep]], row[keep], pos[keep])
                    if out.n >= CHUNK:
                        yield from out.flush()
            yield from out.flush()

        return run

    return send


def _positions(spots) -> np.ndarray:
    return np.frombuffer(b"".join(spots), np.int32).astype(np.int64) if spots is not None else np.zeros(0, np.int64)


def _covered(starts: np.ndarray, before: int, length: int, n: int) -> np.ndarray:
    """Of 0..n-1, those in some [s - before, s - before + length)."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, np.clip(starts - before, 0, n), 1)
    np.add.at(change, np.clip(starts - before + length, 0, n), -1)
    return np.cumsum(change[:-1]) > 0


def _send_windows(window: int):
    def send(buckets: int, later: bool):
        @releasing
        def run(batches):
            out = _Sender(buckets, later)
            for batch in batches:
                spots = batch.column(batch.num_columns - 1)
                batch = batch.filter(pa.compute.and_(pa.compute.is_valid(spots), pa.compute.is_valid(batch.column(0))))
                spots = batch.column(batch.num_columns - 1)
                ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                data, offs = text_column(batch.column(2))
                for a, b in row_chunks(offs):
                    part, o = data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
                    start, end, first = words(part, o)
                    at, row = inside(first, window)
                    wanted = np.zeros(len(start) + 1, bool)
                    for r in range(a, b):
                        i, j = first[r - a], first[r - a + 1]
                        wanted[i:j] = _covered(_positions(spots[r].as_py()), PERIOD - 1, PERIOD, j - i)
                    keep = wanted[at]
                    hashes = window_hash(span_hash(prefix_hash(part), start, end), window)
                    out.add(ids[a:b], marks[a:b], hashes[at[keep]], row[keep], (at - first[:-1][row])[keep])
                    if out.n >= CHUNK:
                        yield from out.flush()
            yield from out.flush()

        return run

    return send


def _rewrite(window: int):
    @releasing
    def run(batches):
        for batch in batches:
            spots, last = batch.column(batch.num_columns - 1), batch.num_columns - 1
            data, offs = text_column(batch.column(2))
            n_words, n_removed, kept = [], [], []
            for r in range(batch.num_rows):
                ws = data[offs[r] : offs[r + 1]].tobytes().split()
                n_words.append(len(ws))
                cut = 0
                if spots[r].is_valid:
                    gone = _covered(_positions(spots[r].as_py()), 0, window, len(ws))
                    cut = int(gone.sum())
                    ws = [ws[i] for i in np.flatnonzero(~gone)]
                n_removed.append(cut)
                kept.append(b" ".join(ws))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(last)), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=[*batch.schema.names[:last], "n_words", "n_removed", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """All columns of `docs` in a struct `row`, and n_words, n_removed and kept (the kept words joined by one space).

    Every row is returned.  A null text has no words; fewer than `window` words are never removed; a null id neither removes
    nor is removed; rows that share an id do not remove each other, and each is judged on its own text.  Windows are judged
    on the input, not on what is left.
    """
    if window < PERIOD:
        raise ValueError(f"the difference cover needs windows of at least {PERIOD} words")
    base = docs.select(
        F.col(id_col).cast("long").alias("id"),
        (F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")) - F.lit(1 << 31)).cast("int").alias("mark"),
        F.col(text_col).alias("text"),
        *([F.struct(*(c for c in docs.columns if c != text_col)).alias("rest")]),
    )
    anchors = _exchange(base.select("id", "mark", "text"), _send_anchors(window), later=False)
    found = base.join(anchors, ["id", "mark"], "left")
    windows = _exchange(found, _send_windows(window), later=True)
    judged = base.join(windows, ["id", "mark"], "left")
    rest = base.schema["rest"].dataType.simpleString()
    out = judged.mapInArrow(_rewrite(window), f"id long, mark int, text string, rest {rest}, n_words long, n_removed long, kept string")
    return out.select(F.struct(*(F.col("text").alias(c) if c == text_col else F.col("rest")[c].alias(c) for c in docs.columns)).alias("row"), "n_words", "n_removed", "kept")
