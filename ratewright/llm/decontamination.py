"""Benchmark decontamination through templates.

Words are reduced to a template: lower case without outer punctuation, and a typed placeholder for units and for each run of
numbers or of names.  Windows of `WINDOW` template words are hash-joined between documents and benchmark items; a window with
too few plain words is joined by its values instead, so it must be there verbatim.  Matches on diagonals (document position minus
item position) that differ by the item's length at most are one occurrence.  Its slots must be filled consistently: each item
value by one document value of the same type (two item values may get the same one); windows of other slots don't count.  So a
question with other numbers or names is found, and a chance agreement of placeholders is not.  A capital that opens a sentence may
or may not be a name: such windows are taken in both readings.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.llm.arrays import inside, mix, prefix_hash, releasing, row_chunks, span_hash, text_column, window_hash, words

WINDOW = 8
LEAST_WORDS = 4  # plain words that a window needs to be found by its template; others are found verbatim
COVERAGE, LONG_RUN = 0.5, 20  # an occurrence holds that share of the item's words, or that many
SMALL_BENCHMARK = 16_000_000  # bytes of benchmark windows, as they travel, up to which they are sent to every task
FILTER_BITS = (17, 28)  # least and most bits, as powers of two, of the filter of window hashes that every task gets
UNITS = "kg g mg km m cm mm mi ft lb oz l ml h hr hrs min mins s sec secs hour hours minute minutes second seconds day days week weeks month months year years meter meters metre metres kilometer kilometers mile miles foot feet inch inches gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres dollar dollars euro euros cent cents percent degree degrees"

_NUMBER, _NAME, _UNIT = (mix(np.array([x], np.uint64))[0] for x in (11, 12, 13))
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?:"]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def _hash_words(text: str) -> np.ndarray:
    data, offs = text_column(pa.array([text]))
    start, end, _ = words(data, offs)
    return span_hash(prefix_hash(data), start, end)


_UNIT_HASHES = np.sort(_hash_words(UNITS))


def template(data: np.ndarray, offsets: np.ndarray, openers: bool = False):
    """Of the template's words: hash, value hash, whether it is a slot, whether it holds a sentence's first word as a name, place of the first
    word that it stands for (one place more than words); and each row's first word.  Words without a letter or digit don't count; a run of
    numbers or of names in a sentence is one word.  `openers`: a capital that opens a sentence is a name, else it is not.
    """
    start, end, first = words(data, offsets)
    if not len(start):
        empty = np.zeros(0, np.uint64)
        return empty, empty, np.zeros(0, bool), np.zeros(0, bool), np.zeros(1, np.int64), first
    solid = np.flatnonzero(_ALNUM[data])
    low, high = np.searchsorted(solid, start), np.searchsorted(solid, end)
    keep = low < high
    row_first = np.r_[0, np.cumsum(keep)][first]
    new_sentence = np.r_[True, _STOP[data[end[:-1] - 1]]]
    new_sentence[first[:-1][first[:-1] < len(start)]] = True
    newline = np.r_[0, np.cumsum(data == 0x0A)]
    new_sentence[1:] |= newline[start[1:]] > newline[end[:-1]]
    sentence = np.cumsum(new_sentence)[keep]
    start, end = solid[low[keep]], solid[high[keep] - 1] + 1
    value = span_hash(prefix_hash(_LOWER[data]), start, end)
    digits = np.r_[0, np.cumsum(_DIGIT[data])]
    number = digits[end] > digits[start]
    capital = (data[start] >= 0x41) & (data[start] <= 0x5A)
    opener = capital & new_sentence[keep]
    capital = capital if openers else capital & ~opener
    unit = _UNIT_HASHES[np.minimum(np.searchsorted(_UNIT_HASHES, value), len(_UNIT_HASHES) - 1)] == value
    out = value.copy()
    out[capital] = _NAME
    out[unit] = _UNIT
    out[number] = _NUMBER
    run = np.r_[False, (out[1:] == out[:-1]) & (number | (capital & ~unit))[1:] & (sentence[1:] == sentence[:-1])]
    place = np.r_[np.flatnonzero(~run), len(out)]
    if run.any():
        at = np.maximum.accumulate(np.where(run, 0, np.arange(len(out))))
        sums = np.add.reduceat(mix(value + (np.arange(len(out)) - at).astype(np.uint64)), place[:-1])
        value = np.where(np.diff(place) > 1, mix(sums), value[place[:-1]])
    opens = (opener & capital & ~unit & ~number)[place[:-1]]  # in a run of names only its first word can open a sentence
    return out[place[:-1]], value, (capital | unit | number)[place[:-1]], opens, place, np.searchsorted(place, row_first)


def _windows(shape, value, slot, first, length):
    """Numbers, rows and hashes of the windows: of their templates, or of their values where there are too few plain words."""
    at, row = inside(first, length)
    if not len(at):
        return at, row, np.zeros(0, np.uint64)
    plain = np.r_[0, np.cumsum(~slot)]
    enough = plain[at + length] - plain[at] >= min(LEAST_WORDS, length)
    exact = value + slot.astype(np.uint64)  # windows that are equal hold slots at the same places too
    return at, row, np.where(enough, window_hash(shape, length)[at], window_hash(exact, length, 1)[at])


def _value_lists(value: np.ndarray, slot: np.ndarray, at: np.ndarray, length: int) -> pa.Array:
    """The slots' values of each window."""
    places = np.flatnonzero(slot)
    low, high = np.searchsorted(places, at), np.searchsorted(places, at + length)
    ends = np.cumsum(high - low)
    flat = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - (high - low), high - low) + np.repeat(low, high - low)
    return pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(value[places[flat]].view(np.int64)))


def _window_batches(lengths: list[int], wanted: np.ndarray | None):
    """Per window: id, mark, position, hash, values of its slots, its template words, the words that these stand for, the row's template words and
    words, and whether the row begins (1) or ends (2) with a slot of the window.  `wanted`: packed bits of the hashes that are looked for, else all."""

    @releasing
    def run(batches):
        for batch in batches:
            data, offs = text_column(batch.column(2))
            for a, b in row_chunks(offs):
                part, o = data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
                for openers in (False, True):
                    shape, value, slot, opens, place, first = template(part, o, openers)
                    opened = np.r_[0, np.cumsum(opens)]
                    for length in lengths:
                        at, row, hashes = _windows(shape, value, slot, first, length)
                        if openers and len(at):  # all other windows have been read already
                            hit = opened[at + length] > opened[at]
                            at, row, hashes = at[hit], row[hit], hashes[hit]
                        if wanted is not None and len(at):
                            bit = hashes & np.uint64(8 * len(wanted) - 1)
                            hit = wanted[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8) & 1 == 1
                            at, row, hashes = at[hit], row[hit], hashes[hit]
                        if not len(at):
                            continue
                        edge = (slot[at] & (at == first[row])) + 2 * (slot[at + length - 1] & (at + length == first[row + 1]))
                        begin, whole = place[first[:-1]], place[first[1:]] - place[first[:-1]]
                        numbers = (place[at] - begin[row], np.full(len(at), length), place[at + length] - place[at], np.diff(first)[row], whole[row], edge)
                        n_at, n_length, n_words, n_shape, n, n_edge = (pa.array(x.astype(np.int32)) for x in numbers)
                        slots = _value_lists(value, slot, at, length)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array(row + a)), batch.column(1).take(pa.array(row + a)), n_at, pa.array(hashes.view(np.int64)), slots, n_length, n_words, n_shape, n, n_edge],
                            names=["id", "mark", "at", "hash", "slots", "length", "words", "shape", "n", "edge"],
                        )

    return run


def _hash_filter(held: DataFrame, windows: int) -> np.ndarray:
    """Packed bits, one set by each hash's low bits.  Their number follows the count of windows up to 2**FILTER_BITS[1]; beyond that more other
    hashes pass, which the join drops.  Only the bits, at most 32 MB, reach the driver, put together in Spark by stretches of 2**16."""
    size = min(max((16 * max(windows, 1) - 1).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
    bits = np.zeros(1 << (size - 3), np.uint8)

    def pack(key, table):
        one = np.zeros(1 << 16, np.uint8)
        one[table.column("bit").to_numpy() & 0xFFFF] = 1
        return pa.table({"stretch": pa.array([key[0].as_py()], pa.int64()), "body": pa.array([np.packbits(one, bitorder="little").tobytes()], pa.binary())})

    bit = F.col("hash").bitwiseAND(F.lit((1 << size) - 1)).alias("bit")
    placed = held.select(bit).distinct().select(F.shiftright("bit", 16).alias("stretch"), "bit")
    for r in placed.groupBy("stretch").applyInArrow(pack, "stretch long, body binary").toLocalIterator():
        bits[r["stretch"] << 13 : (r["stretch"] + 1) << 13] = np.frombuffer(r["body"], np.uint8)
    return bits


def _occurrences(coverage: float, long_run: int):
    """The windows that a document shares with an item to one row, n_matched, first_word and n_slots of the best occurrence, or none."""

    def covered(which, spans):
        return len({w for k in which for w in range(*spans[k])})

    def judge(which, spans, pairs, n):
        """(n_matched, -first_word, n_slots) of windows taken as one occurrence."""
        own = {p for k in which for p in pairs[k]}
        item = Counter(i for i, _ in own)
        odd = {(i, d) for i, d in own if item[i] > 1}
        kept = [k for k in which if not odd.intersection(pairs[k])] if odd else which
        matched = covered(kept, spans)
        if not kept or matched < long_run and (odd or matched < coverage * n):
            return None
        return matched, kept, len(own - odd)

    def run(key, table):
        names = ["at", "_item_at", "_item_words", "slots", "_item_slots", "_item_edge"]
        found = {}  # of two readings of one place that with fewer slots says more
        for w in zip(*(table.column(c).to_pylist() for c in names), strict=True):
            if w[:2] not in found or len(w[3]) < len(found[w[:2]][3]):
                found[w[:2]] = w
        at, item_at, wide, slots, item_slots, edge = zip(*found.values(), strict=True)
        n = table.column("_item_n")[0].as_py()
        spans = [(i, i + w) for i, w in zip(item_at, wide, strict=True)]
        # a run of numbers or names at the item's edge may go on in the document, so it says nothing of the slot's value
        pairs = [{p for k, p in enumerate(zip(i, d, strict=True)) if not (k == 0 and e & 1 or k == len(i) - 1 and e & 2)} for i, d, e in zip(item_slots, slots, edge, strict=True)]
        line = [a - i for a, i in zip(at, item_at, strict=True)]
        order = sorted(range(len(at)), key=line.__getitem__)
        best, high, seen = None, 0, 0
        for low in range(len(order)):
            if low and line[order[low]] == line[order[low - 1]]:
                continue
            same = low
            while same < len(order) and line[order[same]] == line[order[low]]:
                same += 1
            high = max(high, same)
            while high < len(order) and line[order[high]] - line[order[low]] <= n:
                high += 1
            for which in [order[low:same]] + ([order[low:high]] if high > same and high > seen else []):
                got = judge(which, spans, pairs, n)
                if got:
                    got = (got[0], -min(at[k] for k in got[1]), got[2])
                    best = got if best is None or got[:2] > best[:2] else best
            seen = high
        rows = [] if best is None else [{"id": key[0].as_py(), "item": key[2].as_py(), "n": n, "n_matched": best[0], "first_word": -best[1], "n_slots": best[2]}]
        fields = [("id", table.schema.field("id").type), ("item", table.schema.field("_item").type), *((c, pa.int32()) for c in ("n", "n_matched", "first_word", "n_slots"))]
        return pa.Table.from_pylist(rows, schema=pa.schema(fields))

    return run


def _lengths(items: DataFrame) -> list[int]:
    """WINDOW, and the lengths of shorter items (at most WINDOW numbers)."""

    @releasing
    def run(batches):
        for batch in batches:
            text = text_column(batch.column(2))
            n = np.concatenate([np.diff(template(*text, openers)[-1]) for openers in (False, True)])
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(n[(n > 0) & (n < WINDOW)]).astype(np.int32))], names=["n"])

    return [WINDOW, *sorted(r[0] for r in items.mapInArrow(run, "n int").distinct().collect())]


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", coverage: float = COVERAGE, long_run: int = LONG_RUN) -> DataFrame:
    """(id_col, item_id, n_matched, coverage, first_word, n_slots): the documents that hold an item, one row for each of their items.

    n_matched words of the item lie in consistent windows of one occurrence (the best, if there are several), which starts at the document's
    word first_word.  That is `coverage` of the item or `long_run` words; with inconsistent slots only the latter counts, over the windows
    without them.  Null or wordless texts never match; a run of numbers or names in a window of few plain words matches the same run,
    not a part of a longer one; rows that share an id are matched by their own texts and reported together; repeated items are reported by each id.
    """

    def keyed(df, who, text):
        mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
        return df.where(F.col(text).isNotNull() & F.col(who).isNotNull()).select(F.col(who).alias("id"), mark.alias("mark"), F.col(text).alias("text"))

    kinds = {c: df.schema[c].dataType.simpleString() for df, c in ((docs, id_col), (benchmark, item_id))}
    schema = "id {}, mark long, at int, hash long, slots array<long>, length int, words int, shape int, n int, edge int"
    items = keyed(benchmark, item_id, item_text)
    lengths = _lengths(items)
    held = items.mapInArrow(_window_batches(lengths, None), schema.format(kinds[item_id]))
    held = held.where((F.col("length") == WINDOW) | (F.col("length") == F.col("shape")))
    windows, size = held.agg(F.count("*"), F.sum(80 + 8 * F.size("slots"))).first()
    small = (size or 0) <= SMALL_BENCHMARK
    wanted = _hash_filter(held, windows)
    names = {"id": "_item", "mark": "_item_mark", "at": "_item_at", "slots": "_item_slots", "words": "_item_words", "n": "_item_n", "edge": "_item_edge"}
    held = held.select("hash", "length", *(F.col(c).alias(to) for c, to in names.items()))
    found = keyed(docs, id_col, text_col).mapInArrow(_window_batches(lengths, wanted), schema.format(kinds[id_col])).drop("words", "shape", "n", "edge")
    pairs = found.join(F.broadcast(held) if small else held, ["hash", "length"])
    kept = f"id {kinds[id_col]}, item {kinds[item_id]}, n int, n_matched int, first_word int, n_slots int"
    got = pairs.groupBy("id", "mark", "_item", "_item_mark").applyInArrow(_occurrences(coverage, long_run), kept)
    best = F.max_by(F.struct("n_matched", (F.col("n_matched") / F.col("n")).alias("coverage"), "first_word", "n_slots"), F.struct("n_matched", -F.col("first_word"), -F.col("n")))
    return got.groupBy(F.col("id").alias(id_col), F.col("item").alias(item_id)).agg(best.alias("b")).select(id_col, item_id, "b.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **parameters) -> DataFrame:
    """The rows of `docs`, all columns, that hold no item (by id; rows with a null id stay)."""
    gone = leaks(docs, benchmark, id_col, text_col, **parameters).select(F.col(id_col).alias("_leaked")).distinct()
    return docs.join(gone, docs[id_col] == gone["_leaked"], "left_anti")
