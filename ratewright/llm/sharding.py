"""Shards of near-equal bytes by histogram sort.

Rows are ordered by (hash of the text, id), so equal texts are neighbours.  Splitters of that order are found by counting
exact bytes below candidate keys in every partition, keeping for each splitter the interval that holds its target and
probing inside it again until the bytes below meet the tolerance.  An interval that has shrunk to one text hash (a large
group of copies) is probed by id.  Then rows are exchanged once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewright.llm.arrays import releasing
from ratewright.llm.lineage import cut, shuffle_partitions

LOW, HIGH = -(1 << 63), (1 << 63) - 1


def _count_below(keys: DataFrame, probes: list[tuple[int, int]]) -> list[int]:
    """Bytes of the rows whose (key, id) is not above each probe (sorted)."""
    edges = _edges(probes)

    @releasing
    def run(batches):
        total = np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            key, who, size = (batch.column(i).to_numpy() for i in range(3))
            np.add.at(total, _part(key, who, *edges), size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["part", "bytes"])

    sums = keys.select("_key", "_who", "_size").mapInArrow(run, "part int, bytes long").groupBy("part").agg(F.sum("bytes")).collect()
    total = np.zeros(len(probes) + 1, np.int64)
    for part, n in sums:
        total[part] = n
    return np.cumsum(total)[:-1].tolist()


def _edges(probes):
    return np.array([p[0] for p in probes], np.int64), np.array([p[1] for p in probes], np.int64)


def _part(key: np.ndarray, who: np.ndarray, edge_key: np.ndarray, edge_who: np.ndarray) -> np.ndarray:
    """How many edges are below (key, who)."""
    part = np.searchsorted(edge_key, key, side="left")
    last = np.searchsorted(edge_key, key, side="right")
    split = np.flatnonzero(part < last)
    for a in np.unique(part[split]):  # once for each hash that edges have
        own = split[part[split] == a]
        part[own] += np.searchsorted(edge_who[a : last[own[0]]], who[own], side="left")
    return part


def splitters(keys: DataFrame, targets: list[int], slack: list[float], total: int, probes: int = 32, max_rounds: int = 64) -> list[tuple[int, int]]:
    """A (key, id) edge for each target of bytes below it, within its slack where rows allow it, else the nearest found.

    `keys`: _key, _who, _size.  Each round reads `keys` once and brings probes x targets sums to the driver.
    """
    state = [{"lo": LOW, "hi": HIGH, "lo_n": 0, "hi_n": total, "key": None, "best": (abs(total - t), (HIGH, HIGH)), "done": False} for t in targets]
    for s, t in zip(state, targets, strict=True):
        s["best"] = min(s["best"], (abs(t), (LOW, LOW)))
        s["done"] = total == 0
    for _ in range(max_rounds):
        asked = set()
        for s in state:
            if not s["done"]:
                width = s["hi"] - s["lo"]
                s["ask"] = sorted({s["lo"] + width * i // (probes + 1) for i in range(1, probes + 1)} - {s["lo"]}) or [s["hi"]]
                asked |= {(p, HIGH) if s["key"] is None else (s["key"], p) for p in s["ask"]}
        if not asked:
            break
        probe_list = sorted(asked)
        below = dict(zip(probe_list, _count_below(keys, probe_list), strict=True))
        for s, t, slop in zip(state, targets, slack, strict=True):
            if s["done"]:
                continue
            for p in s["ask"]:
                at = (p, HIGH) if s["key"] is None else (s["key"], p)
                n = below[at]
                s["best"] = min(s["best"], (abs(n - t), at))
                if n < t and n >= s["lo_n"]:
                    s["lo"], s["lo_n"] = max(s["lo"], p), n
                elif n >= t and p < s["hi"]:
                    s["hi"], s["hi_n"] = p, n
            if s["best"][0] <= slop or s["lo_n"] == s["hi_n"]:
                s["done"] = True
            elif s["hi"] - s["lo"] <= 1:
                if s["key"] is not None:
                    s["done"] = True
                else:
                    s |= {"key": s["hi"], "lo": LOW, "hi": HIGH}
    return [s["best"][1] for s in state]


def shard_by_bytes(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8, tolerance: float = 0.002, parts: int | None = None) -> DataFrame:
    """All columns of `docs`, and size (UTF-8 bytes of the text, null: none, plus `overhead`), shard and slot (gapless from 0 in a shard), in place of columns of those names.

    Shards differ from the mean size by about `tolerance` of it, or by a document where one is larger than that.  Copies of a text lie
    together; a group of copies is split only where it is larger than the slack allows.  A shard is numbered in `parts` tasks (default: so
    many that there is one per shuffle partition).  Null ids sort first; an empty table gives an empty result.
    """
    parts = parts or max(1, -(-shuffle_partitions(docs) // shards))
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + F.lit(overhead)
    key = F.xxhash64(F.coalesce(text_col, F.lit("")))
    keyed = docs.select(key.alias("_key"), F.coalesce(F.col(id_col).cast("long"), F.lit(LOW)).alias("_who"), size.alias("_size"), F.struct("*").alias("row"))
    keys = cut(keyed.select("_key", "_who", "_size"))
    total = keys.agg(F.sum("_size")).first()[0] or 0
    fine = shards * parts
    targets = [total * i // fine for i in range(1, fine)]
    slack = [tolerance * total / shards / 2 if i % parts == 0 else 0.1 * total / fine for i in range(1, fine)]
    edges = _edges(sorted(splitters(keys, targets, slack, total)))

    @releasing
    def place(batches):
        for batch in batches:
            part = _part(batch.column("_key").to_numpy(), batch.column("_who").to_numpy(), *edges) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int32))], names=[*batch.schema.names, "_part"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema) + ", _part int"
    placed = keyed.mapInArrow(place, schema)
    counts = cut(keys.mapInArrow(place, "_key long, _who long, _size long, _part int").groupBy("_part").agg(F.count("*").alias("_n")))
    before = Window.partitionBy(F.floor(F.col("_part") / parts)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_part").orderBy("_key", "_who")
    numbered = placed.withColumn("_row", F.row_number().over(within)).join(F.broadcast(base), "_part")  # a row per part
    return numbered.select(
        *(F.col("row")[c].alias(c) for c in docs.columns if c not in ("size", "shard", "slot")),
        F.col("_size").alias("size"),
        F.floor(F.col("_part") / parts).cast("int").alias("shard"),
        (F.col("_row") - 1 + F.col("_base")).cast("long").alias("slot"),
    )
