"""Leaf-wise gradient boosting from histograms of binned features.

Features are cut at exact quantiles of the training rows; nulls are filled with the median, and a feature with nulls gets an indicator.  A tree grows best
leaf first, to a bound of leaves, with an L2 penalty on leaf values, from sums of gradients and counts per (leaf, feature, bin).

Rows of equal bins always have equal predictions, so the training rows are first added up to cells of equal bins.  While there are at most CELLS of
them, a task holds all and trains a model; models of several folds and settings train beside each other, a task each.  Beyond that the
histograms of a tree's candidate leaves come from one Spark job a level over the binned rows, of any number.  Both ways grow the same trees.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewright.operators.quantiles import later, quantile_rows
from ratewright.sources.io import written

BINS = 64
CELLS = 200_000
REBASE = 10


@dataclass(frozen=True)
class Setting:
    leaves: int = 15
    l2: float = 100.0
    cap: float = 1e300
    iterations: int = 200
    rate: float = 0.04
    least: int = 30


class _Node:
    """A leaf, or what it is split into: its conditions, gradient sum, count and best split (gain, feature, bin)."""

    def __init__(self, path: tuple, histogram: np.ndarray, setting: Setting):
        self.path, self.kids = path, None
        gradient, count = histogram
        self.g, self.n = float(gradient[0].sum()), float(count[0].sum())
        left_g, left_n = np.cumsum(gradient, axis=1)[:, :-1], np.cumsum(count, axis=1)[:, :-1]
        right_g, right_n = self.g - left_g, self.n - left_n
        fine = (left_n >= setting.least) & (right_n >= setting.least)
        gain = np.where(fine, left_g**2 / np.maximum(left_n + setting.l2, 1e-300) + right_g**2 / np.maximum(right_n + setting.l2, 1e-300) - self.g**2 / max(self.n + setting.l2, 1e-300), -np.inf)
        k = int(np.argmax(gain)) if gain.size else 0
        self.split = (float(gain.flat[k]), *map(int, np.unravel_index(k, gain.shape))) if gain.size and gain.flat[k] > 1e-9 else None

    def paths(self) -> list[tuple]:
        _, feature, at = self.split
        return [(*self.path, (feature, at, True)), (*self.path, (feature, at, False))]


def grow(histograms: Callable[[list[tuple]], list[np.ndarray]], setting: Setting) -> list[tuple[tuple, float]]:
    """A tree as (conditions, value) of its leaves.

    Leaves are split in the order of their gain.  What the next splits need is asked for at once: the leaves that would be split as far as is known, level by
    level, until the order of splits needs nothing unknown.
    """
    root = _Node((), histograms([()])[0], setting)
    while True:
        queue, made, wanted, split = [(-root.split[0], 0, root)] if root.split else [], 0, [], set()
        while queue and len(split) + 1 < setting.leaves:
            node = heapq.heappop(queue)[2]
            split.add(node.path)
            if node.kids is None:
                wanted.append(node)
            else:
                for kid in node.kids:
                    if kid.split:
                        made += 1
                        heapq.heappush(queue, (-kid.split[0], made, kid))
        if not wanted:
            break
        found = iter(histograms([p for node in wanted for p in node.paths()]))
        for node in wanted:
            node.kids = [_Node(p, next(found), setting) for p in node.paths()]
    leaves, open_ = [], [root]
    while open_:
        node = open_.pop()
        if node.path in split:
            open_ += node.kids
        else:
            leaves.append((node.path, -setting.rate * node.g / (node.n + setting.l2) if node.n + setting.l2 > 0 else 0.0))
    return leaves


def _matches(bins: np.ndarray, path: tuple) -> np.ndarray:
    keep = np.ones(len(bins), dtype=bool)
    for feature, at, left in path:
        keep &= (bins[:, feature] <= at) == left
    return keep


def _added(bins: np.ndarray, trees: list, start: np.ndarray) -> np.ndarray:
    for tree in trees:
        for path, value in tree:
            start[_matches(bins, path)] += value
    return start


def _histogram(flat: np.ndarray, gradient: np.ndarray, count: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
    """Sums of gradients and counts per feature and bin; `flat`: bins as numbers over all features."""
    features, bins = shape
    each = lambda w: np.bincount(flat.ravel(), np.repeat(w, features), features * bins).reshape(shape)
    return np.stack([each(gradient), each(count)])


def train_cells(bins: np.ndarray, count: np.ndarray, total: np.ndarray, shape: tuple[int, int], setting: Setting) -> dict:
    """{"base", "trees"} from cells: their bins, numbers of rows and sums of the target."""
    base = float(total.sum() / max(count.sum(), 1))
    predicted, flat, trees = np.full(len(bins), base), bins.astype(np.int64) + np.arange(shape[0]) * shape[1], []
    for _ in range(setting.iterations):
        gradient = count * predicted - total
        rows = {(): np.arange(len(bins))}

        def histograms(paths, rows=rows, gradient=gradient):
            out = []
            for path in paths:
                if path not in rows:
                    own = rows[path[:-1]]
                    rows[path] = own[_matches(bins[own], path[-1:])]
                own = rows[path]
                out.append(_histogram(flat[own], gradient[own], count[own], shape))
            return out

        tree = grow(histograms, setting)
        for path, value in tree:
            predicted[rows[path]] += value
        trees.append(tree)
    return {"base": base, "trees": trees}


@dataclass(frozen=True)
class Binning:
    """Cut points per feature, medians, and which features have an indicator of nulls."""

    edges: tuple[tuple[float, ...], ...]
    medians: tuple[float, ...]
    missing: tuple[bool, ...]

    @property
    def shape(self) -> tuple[int, int]:
        return len(self.edges) + sum(self.missing), max([2, *(len(e) + 1 for e in self.edges)])

    def bins(self, columns: list[np.ndarray]) -> np.ndarray:
        """A row's bin per feature: the number of cut points below the value."""
        out = []
        for x, edges, middle in zip(columns, self.edges, self.medians, strict=True):
            out.append(np.searchsorted(edges, np.where(np.isnan(x), middle, x), side="left"))
        out += [np.isnan(x).astype(np.int64) for x, has in zip(columns, self.missing, strict=True) if has]
        return np.stack(out, axis=1).astype(np.uint8) if out else np.zeros((0, 0), np.uint8)


def _columns(batch: pa.RecordBatch, first: int, n: int) -> list[np.ndarray]:
    return [batch.column(first + i).to_numpy(zero_copy_only=False).astype(float) for i in range(n)]


def _binnings(rows: DataFrame, features: list[str], season: str, bins: int) -> dict[int, Binning]:
    """The binning of each fold, from the seasons before it: folds times features times bins numbers."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias("value")) for f in features)))
    long = rows.select(season, each.alias("x")).select(season, "x.*")
    cuts = {f"{k}": k / bins for k in range(1, bins)} | {"median": 0.5}
    found = quantile_rows(long, ["feature"], "value", cuts, part=season).collect()
    counts = long.groupBy(season, "feature").agg(F.count_if(F.col("value").isNull()).alias("nulls")).collect()
    edges, medians = {}, {}
    for r in found:
        if r["name"] == "median":
            medians[r["fold"], r["feature"]] = r["quantile"]
        else:
            edges.setdefault((r["fold"], r["feature"]), set()).add(r["quantile"])
    folds = sorted({r[season] for r in counts if r[season] is not None})
    nulls = {(fold, f): any(r["nulls"] for r in counts if r["feature"] == f and r[season] is not None and r[season] < fold) for fold in folds for f in features}
    return {fold: Binning(tuple(tuple(sorted(edges.get((fold, f), ()))) for f in features), tuple(medians.get((fold, f), 0.0) for f in features), tuple(nulls[fold, f] for f in features)) for fold in folds}


def _binned(rows: DataFrame, features: list[str], y: str, season: str, binnings: dict[int, Binning], folds: list[int]) -> DataFrame:
    """(fold, bins, y): each training row in every fold that it comes before."""
    given = rows.where(F.col(y).isNotNull()).withColumn("fold", later(folds, F.col(season)))
    given = given.select(F.col("fold").cast("long").alias("fold"), F.col(y).cast("double").alias("y"), *(F.col(f).cast("double") for f in features))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold, columns = batch.column(0).to_numpy(), _columns(batch, 2, len(features))
            for k in np.unique(fold):
                at = np.flatnonzero(fold == k)
                bins = binnings[int(k)].bins([c[at] for c in columns])
                yield pa.RecordBatch.from_arrays([pa.array(fold[at]), pa.array([b.tobytes() for b in bins], pa.binary()), batch.column(1).take(pa.array(at))], ["fold", "bins", "y"])

    return given.mapInArrow(run, "fold long, bins binary, y double")


def _train_by_jobs(binned: DataFrame, shape: tuple[int, int], setting: Setting) -> dict:
    """As `train_cells`, with a Spark job for each level of each tree over rows (bins, y).

    Predictions of all but the last few trees are written beside the rows, so a job adds up few trees and a lost executor costs the current job.
    """
    base = float(binned.agg(F.avg("y")).first()[0] or 0.0)
    trees, recent = [], []
    state = written(binned.select("bins", "y", F.lit(base).alias("p")))

    def decoded(batch: pa.RecordBatch, trees: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        bins = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(len(batch), shape[0])
        return bins, batch.column(1).to_numpy(), _added(bins, trees, batch.column(2).to_numpy().copy())

    def histograms(paths: list[tuple]) -> list[np.ndarray]:
        now = list(recent)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((len(paths), 2, *shape))
            for batch in batches:
                bins, y, p = decoded(batch, now)
                flat = bins.astype(np.int64) + np.arange(shape[0]) * shape[1]
                for k, path in enumerate(paths):
                    own = _matches(bins, path)
                    sums[k] += _histogram(flat[own], (p - y)[own], np.ones(own.sum()), shape)
            g, n = sums[:, 0].ravel(), sums[:, 1].ravel()
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(g[at]), pa.array(n[at])], ["at", "g", "n"])

        out = np.zeros((2, len(paths) * shape[0] * shape[1]))
        for r in state.mapInArrow(run, "at long, g double, n double").groupBy("at").agg(F.sum("g").alias("g"), F.sum("n").alias("n")).collect():
            out[:, r["at"]] = r["g"], r["n"]
        return list(out.reshape(2, len(paths), *shape).swapaxes(0, 1))

    for _ in range(setting.iterations):
        tree = grow(histograms, setting)
        trees.append(tree)
        recent.append(tree)
        if len(recent) == REBASE:
            now = list(recent)

            def moved(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(decoded(batch, now)[2])], ["bins", "y", "p"])

            state = written(state.mapInArrow(moved, "bins binary, y double, p double"))
            recent = []
    return {"base": base, "trees": trees}


def fit(rows: DataFrame, features: list[str], y: str, season: str, folds: list[int], settings: list[Setting], bins: int = BINS, most_cells: int = CELLS) -> tuple[dict[int, Binning], dict[tuple[int, Setting], dict]]:
    """(binning per fold, model per fold and setting), each fold trained on the seasons before it; folds without such rows have no model.

    Models are lists of at most iterations times leaves numbers.  Rows without `y` are left out.
    """
    binnings = {k: b for k, b in _binnings(rows, features, season, bins).items() if k in folds}
    folds = sorted(binnings)
    caps = sorted({s.cap for s in settings})
    clipped = lambda cap: F.greatest(F.least(F.col("y"), F.lit(cap)), F.lit(-cap))
    if not folds:
        return binnings, {}
    binned = _binned(rows, features, y, season, binnings, folds)
    cells = written(binned.groupBy("fold", "bins").agg(F.count("*").alias("n"), *(F.sum(clipped(c)).alias(f"y{i}") for i, c in enumerate(caps))))
    sizes = {r["fold"]: r["count"] for r in cells.groupBy("fold").count().collect()}
    models = {}
    for k in [k for k in sizes if sizes[k] > most_cells]:
        for s in settings:
            models[k, s] = _train_by_jobs(binned.where(F.col("fold") == k).select("bins", clipped(s.cap).alias("y")), binnings[k].shape, s)
    small = [k for k in sizes if sizes[k] <= most_cells]
    if small:
        numbered = F.explode(F.array(*(F.lit(i) for i in range(len(settings)))))

        def train(key, pdf: pd.DataFrame) -> pd.DataFrame:
            fold, number = int(key[0]), int(key[1])
            s, shape = settings[number], binnings[fold].shape
            pdf = pdf.sort_values("bins")
            at = np.frombuffer(b"".join(pdf["bins"]), np.uint8).reshape(len(pdf), shape[0])
            model = train_cells(at, pdf["n"].to_numpy(float), pdf[f"y{caps.index(s.cap)}"].to_numpy(float), shape, s)
            return pd.DataFrame({"fold": [fold], "number": [number], "model": [json.dumps(model)]})

        found = cells.where(F.col("fold").isin(small)).withColumn("number", numbered).repartition(len(small) * len(settings), "fold", "number").groupBy("fold", "number").applyInPandas(train, "fold long, number int, model string")
        for r in found.collect():  # a row per model
            model = json.loads(r["model"])
            model["trees"] = [[(tuple(tuple(c) for c in path), value) for path, value in tree] for tree in model["trees"]]
            models[r["fold"], settings[r["number"]]] = model
    return binnings, models


def predict(rows: DataFrame, features: list[str], binning: Binning, model: dict, out: str = "predicted") -> DataFrame:
    """The rows with the model's prediction as a column `out`."""
    names = [f.name for f in rows.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = binning.bins(_columns(batch, len(names), len(features)))
            predicted = _added(bins, model["trees"], np.full(len(batch), model["base"]))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(predicted)], names=[*names, out])

    given = rows.select(*(F.col(f"`{c}`") for c in names), *(F.col(f).cast("double").alias(f"_f{i}") for i, f in enumerate(features)))
    return given.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(out, T.DoubleType())]))


def grid_select(rows: DataFrame, features: list[str], y: str, settings: list[Setting], season: str = "season", bins: int = BINS, most_cells: int = CELLS) -> DataFrame:
    """(test_season, leaves, l2, target_cap, mae, n, chosen): mean absolute errors of every setting over the seasons before each test season.

    A season is predicted by the model of the seasons before it, trained on `y` clipped at the cap both ways; errors are those of `y` as it is.  The first
    season is trained on only.  Chosen (1) is the least error to nine digits; ties: the larger L2, then fewer leaves, then the smaller cap.
    """
    rows = written(rows.where(F.col(y).isNotNull()).select(F.col(season).cast("long").alias("season"), F.col(y).cast("double").alias("y"), *(F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features))))
    own = [f"x{i}" for i in range(len(features))]
    folds = [r["season"] for r in rows.select("season").distinct().collect()]
    binnings, models = fit(rows, own, "y", "season", folds, settings, bins, most_cells)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seasons, y_, columns = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _columns(batch, 2, len(own))
            for k in np.unique(seasons):
                at = np.flatnonzero(seasons == k)
                found = [(i, models[int(k), s]) for i, s in enumerate(settings) if (int(k), s) in models]
                bins_ = binnings[int(k)].bins([c[at] for c in columns]) if found else None
                for i, model in found:
                    miss = np.abs(_added(bins_, model["trees"], np.full(len(at), model["base"])) - y_[at])
                    yield pa.RecordBatch.from_arrays([pa.array([int(k)]), pa.array([i], pa.int32()), pa.array([float(miss.sum())]), pa.array([len(at)])], ["fold", "number", "miss", "n"])

    each = rows.mapInArrow(run, "fold long, number int, miss double, n long").groupBy("fold", "number").agg(F.sum("miss").alias("miss"), F.sum("n").alias("n"))
    found = each.withColumn("test_season", later(folds, F.col("fold"))).groupBy("test_season", "number").agg((F.sum("miss") / F.sum("n")).alias("mae"), F.sum("n").alias("n"))
    named = F.array(*(F.struct(F.lit(s.leaves).alias("leaves"), F.lit(s.l2).alias("l2"), F.lit(s.cap).alias("target_cap")) for s in settings))
    named_rows = found.withColumn("_s", named[F.col("number")]).select("test_season", "_s.*", "mae", "n")
    best = Window.partitionBy("test_season").orderBy(F.round("mae", 9), F.desc("l2"), "leaves", "target_cap")  # a row per setting
    return named_rows.withColumn("chosen", (F.row_number().over(best) == 1).cast("int"))

