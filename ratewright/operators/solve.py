"""Ridge estimates from distributed Gram sums.

Events are reduced to Gram entries (group, i, j, sum of w x_i x_j) by Spark, partial sums first; the y column is the term
Y.  Only a group's Gram, terms squared at most, reaches a task for the dense solve, all groups in one job.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewright.operators.quantiles import exact_quantiles, later
from ratewright.sources.io import written

Y = "~y"  # sorts after the terms


def term(name: Column | str, value: Column | float = 1.0) -> Column:
    name = F.lit(name) if isinstance(name, str) else name
    return F.struct(name.alias("t"), (value if isinstance(value, Column) else F.lit(value)).cast("double").alias("v"))


def _pair_sums(df: DataFrame, group: list[str], x: Column, weight: Column | None = None) -> DataFrame:
    """(group, i, j, v, n): sums over rows of weight x_i x_j for the terms i <= j of the array `x`."""
    w = weight if weight is not None else F.lit(1.0)
    pairs = F.flatten(F.transform(F.col("_x"), lambda a: F.transform(F.filter(F.col("_x"), lambda b: b["t"] >= a["t"]), lambda b: F.struct(a["t"].alias("i"), b["t"].alias("j"), (F.col("_w") * a["v"] * b["v"]).alias("v")))))
    rows = df.select(*group, x.alias("_x"), w.cast("double").alias("_w")).select(*group, F.explode(pairs).alias("p"))
    return rows.groupBy(*group, "p.i", "p.j").agg(F.sum("p.v").alias("v"), F.count("*").alias("n"))


def gram(df: DataFrame, group: list[str], terms: list[Column], y: Column, weight: Column | None = None) -> DataFrame:
    """(group, i, j, v): sums of weight x_i x_j for i <= j over the non-zero terms of each row, y among them, and rows in `n`."""
    return _pair_sums(df, group, F.array(*terms, term(Y, y)), weight)


def _matrices(pdf: pd.DataFrame):
    names = sorted(set(pdf["i"]) | set(pdf["j"]))
    at = {t: k for k, t in enumerate(names)}
    full = np.zeros((len(names), len(names)))
    i, j = pdf["i"].map(at).to_numpy(), pdf["j"].map(at).to_numpy()
    full[i, j] = pdf["v"].to_numpy()
    full[j, i] = pdf["v"].to_numpy()
    terms = [t for t in names if t != Y]
    k = [at[t] for t in terms]
    return terms, full[np.ix_(k, k)], full[k, at[Y]] if Y in at else np.zeros(len(k)), float(pdf["n"].max())


def _scaled(terms: list[str], g: np.ndarray, xy: np.ndarray):
    """The terms but "(1)", their Gram and X'y over their deviations, and those; a constant term has the deviation 1."""
    one = terms.index("(1)")
    mean, square = g[:, one] / g[one, one], np.diag(g) / g[one, one]
    sd = np.sqrt(np.where(square - mean**2 > 1e-12 * square, square - mean**2, 1.0))
    keep = [k for k in range(len(terms)) if k != one]
    return [terms[k] for k in keep], g[np.ix_(keep, keep)] / np.outer(sd[keep], sd[keep]), xy[keep] / sd[keep], sd[keep]


def _standardizing(terms: list[str], g: np.ndarray, features: set[str]) -> np.ndarray:
    """The matrix that takes the mean off `features` and divides them by their population deviation, both known from the sums of "(1)"; a constant one becomes 0."""
    one = terms.index("(1)")
    mean, square = g[:, one] / g[one, one], np.diag(g) / g[one, one]
    out = np.eye(len(terms))
    for k, name in enumerate(terms):
        if name in features:
            variance = square[k] - mean[k] ** 2
            out[k, k] = 1 / np.sqrt(variance) if variance > 1e-12 * square[k] else 0.0
            out[k, one] -= mean[k] * out[k, k]
    return out


def _ridge(g: np.ndarray, xy: np.ndarray) -> np.ndarray:
    """By Cholesky where the matrix is positive definite, as it is with a penalty, else the least solution."""
    try:
        root = np.linalg.cholesky(g)
    except np.linalg.LinAlgError:
        return np.linalg.lstsq(g, xy, rcond=None)[0]
    return np.linalg.solve(root.T, np.linalg.solve(root, xy))


def _nonnegative(g: np.ndarray, xy: np.ndarray) -> np.ndarray:
    b = np.zeros(len(xy))
    for _ in range(500):
        last = b.copy()
        for k in range(len(b)):
            if g[k, k] > 0:
                b[k] = max(0.0, (xy[k] - g[k] @ b + g[k, k] * b[k]) / g[k, k])
        if np.abs(b - last).max(initial=0.0) < 1e-10:
            break
    return b


def solve(grams: DataFrame, group: list[str], alpha: float | str, unpenalized: tuple[str, ...] = (), least_rows: int = 1, nonnegative: bool = False, center: tuple[str, ...] = (),
          scaled: bool = False, standardize: tuple[str, ...] = (), intercept: bool = True) -> DataFrame:
    """(group, term, coefficient): (G + alpha I) b = X'y per group; `alpha` is a number or a column of the group.

    Terms in `unpenalized` carry no penalty; groups of fewer rows get zeros; prefixes in `center` have their mean taken off afterwards;
    `nonnegative` solves by coordinate descent with b >= 0.  `scaled` penalises terms divided by their population deviation, known from the
    sums of the term "(1)", which then is no term of the model; coefficients are those of the terms as they were given.  `standardize` names terms that
    are penalised as if their mean were off and their deviation 1; without `intercept` the model then has none, though "(1)" takes what the means leave.
    """
    to_standardize = set(standardize)

    def one(key, pdf: pd.DataFrame) -> pd.DataFrame:
        terms, g, xy, rows = _matrices(pdf)
        sd, back = np.ones(len(terms)), None
        if scaled:
            terms, g, xy, sd = _scaled(terms, g, xy)
        own = terms
        if to_standardize:
            back = _standardizing(terms, g, to_standardize)
            keep = [k for k, t in enumerate(terms) if intercept or t != "(1)"]
            back, own = back[keep], [terms[k] for k in keep]
            g, xy = back @ g @ back.T, back @ xy
        a = float(pdf[alpha].iloc[0]) if isinstance(alpha, str) else alpha
        g = g + np.diag([0.0 if t in unpenalized else a for t in own])
        b = np.zeros(len(own)) if rows < least_rows else _nonnegative(g, xy) if nonnegative else _ridge(g, xy)
        if back is not None:
            b = back.T @ b
        for prefix in center:
            at = [k for k, t in enumerate(terms) if t.startswith(prefix)]
            b[at] -= b[at].mean() if at else 0.0
        out = pd.DataFrame({"term": terms, "coefficient": b / sd})
        for name, value in zip(group, key, strict=True):
            out[name] = value
        return out[[*group, "term", "coefficient"]]

    schema = T.StructType([*(grams.schema[c] for c in group), T.StructField("term", T.StringType()), T.StructField("coefficient", T.DoubleType())])
    return grams.groupBy(*group).applyInPandas(one, schema)


def prior_grams(grams: DataFrame, grid: DataFrame, season: str = "season", period: str = "period") -> DataFrame:
    """Grams of all rows before each (season, period) of `grid`: this season's earlier periods and the whole season before."""
    g = grid.select(F.col(season).alias("grid_season"), F.col(period).alias("grid_period")).distinct()
    now = g.join(grams, (F.col(season) == F.col("grid_season")) & (F.col(period) < F.col("grid_period")))
    last = grams.groupBy(season, "i", "j").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    before = g.join(last, F.col(season) + 1 == F.col("grid_season")).select("grid_season", "grid_period", "i", "j", "v", "n")
    both = now.select("grid_season", "grid_period", "i", "j", "v", "n").unionByName(before)
    return both.groupBy("grid_season", "grid_period", "i", "j").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))


def two_way_gram(df: DataFrame, group: list[str], offense: str, defense: str, measure: str) -> DataFrame:
    """measure ~ mean + offence effect + defence effect."""
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    return gram(df, group, [term("mean"), term(name("o:", offense)), term(name("d:", defense))], F.col(measure))


def two_way_ratings(df: DataFrame, offense: str, defense: str, measure: str, alpha: float = 10.0, least_rows: int = 20, season: str = "season", period: str = "period") -> DataFrame:
    """Opponent-adjusted ratings before every (season, period): columns grid_season, grid_period, term (mean, o:x, d:x), coefficient.

    They use this season's earlier periods and the whole season before.  Each event goes into one cell (season, period, offence, defence) of a count and
    a sum, added up before the exchange.  A season's cells, sides squared times periods at most, meet in one task, which adds them up period by period: the
    Gram before a period is that before the last one and the cells between.  Rows without a side or a measure add nothing; a period nothing precedes has no rows.
    """
    sides = [F.col(offense).cast("string").alias("o"), F.col(defense).cast("string").alias("d")]
    whole = F.col(measure).isNotNull() & F.col(offense).isNotNull() & F.col(defense).isNotNull()
    cells = df.where(F.col(season).isNotNull() & F.col(period).isNotNull()).groupBy(F.col(season).alias("grid_season"), F.col(period).alias("grid_period"), *sides)
    cells = cells.agg(F.count_if(whole).alias("n"), F.coalesce(F.sum(F.when(whole, F.col(measure).cast("double"))), F.lit(0.0)).alias("y"))
    before = cells.groupBy((F.col("grid_season") + 1).cast(cells.schema["grid_season"].dataType).alias("grid_season"), "o", "d").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    rows = cells.unionByName(before.withColumn("grid_period", F.lit(None).cast(cells.schema["grid_period"].dataType)))

    def one(key, pdf: pd.DataFrame) -> pd.DataFrame:
        periods, terms, coefficients = [], [], []
        past = pdf[pdf["n"] > 0]
        o_code, o_names = pd.factorize(past["o"], sort=True)
        d_code, d_names = pd.factorize(past["d"], sort=True)
        n, y = np.zeros((len(o_names), len(d_names))), np.zeros((len(o_names), len(d_names)))
        now = past["grid_period"].to_numpy()
        add = lambda at: (np.add.at(n, (o_code[at], d_code[at]), past["n"].to_numpy()[at]), np.add.at(y, (o_code[at], d_code[at]), past["y"].to_numpy()[at]))
        add(pd.isna(now))
        for p in sorted(pdf["grid_period"].dropna().unique()):
            if n.any():
                o, d = np.flatnonzero(n.any(axis=1)), np.flatnonzero(n.any(axis=0))
                own, sums = n[np.ix_(o, d)], y[np.ix_(o, d)]
                g = np.block([[own.sum().reshape(1, 1), own.sum(axis=1)[None], own.sum(axis=0)[None]], [own.sum(axis=1)[:, None], np.diag(own.sum(axis=1)), own], [own.sum(axis=0)[:, None], own.T, np.diag(own.sum(axis=0))]])
                g += np.diag([0.0, *[alpha] * (len(o) + len(d))])
                b = _ridge(g, np.r_[sums.sum(), sums.sum(axis=1), sums.sum(axis=0)]) if own.sum() >= least_rows else np.zeros(len(g))
                b[1 : len(o) + 1] -= b[1 : len(o) + 1].mean()
                b[len(o) + 1 :] -= b[len(o) + 1 :].mean()
                terms += ["mean", *(f"o:{x}" for x in o_names[o]), *(f"d:{x}" for x in d_names[d])]
                periods += [p] * len(b)
                coefficients += b.tolist()
            add(now == p)
        return pd.DataFrame({"grid_season": [key[0]] * len(terms), "grid_period": np.array(periods, dtype=int if len(periods) else float), "term": np.array(terms, dtype=object), "coefficient": coefficients})

    schema = T.StructType([cells.schema["grid_season"], cells.schema["grid_period"], T.StructField("term", T.StringType()), T.StructField("coefficient", T.DoubleType())])
    return rows.groupBy("grid_season").applyInPandas(one, schema)


def paired_gram(games: DataFrame, group: list[str], home: str, away: str, margin: str, neutral: str | None = None, weight: Column | None = None) -> DataFrame:
    """margin ~ rating of home - rating of away + home field (not on neutral ground)."""
    name = lambda c: F.concat(F.lit("t:"), F.col(c).cast("string"))
    field = F.lit(1.0) if neutral is None else 1.0 - F.coalesce(F.col(neutral), F.lit(0)).cast("double")
    return gram(games, group, [term(name(home)), term(name(away), -1.0), term("home", field)], F.col(margin), weight)


def paired_ratings(games: DataFrame, group: list[str], home: str, away: str, margin: str, alpha: float = 1.0, **options) -> DataFrame:
    return solve(paired_gram(games, group, home, away, margin, **options), group, alpha, ("home",), center=("t:",))


def _long(df: DataFrame, features: list[str], kept: list[str]) -> DataFrame:
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features)))
    return df.select(*kept, each.alias("_x")).select(*kept, "_x.*")


def _filled(f: str, s: Column) -> Column:
    """A feature with its nulls filled by the median and both ends clipped, as the statistics `s` say."""
    return F.greatest(F.least(F.coalesce(F.col(f).cast("double"), s["median"]), s["high"]), s["low"])


def _by_feature(stats: DataFrame, by: list[str], names: tuple[str, ...]) -> DataFrame:
    """A row per group with a map from feature to statistics: `_s`."""
    return stats.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("feature", F.struct(*names)))).alias("_s"))


def _with(df: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
    """Joined with a row per group, as Spark sees fit; without groups that is one row."""
    return df.join(side, on) if on else df.crossJoin(F.broadcast(side))


QUANTILES = {"median": 0.5, "low": 0.01, "high": 0.99}


def feature_stats(df: DataFrame, features: list[str], group: list[str] | None = None) -> DataFrame:
    """(group, feature, median, low, high, mean, sd): exact quantiles; mean and population deviation after filling and clipping.

    Quantiles are found by counting (see `exact_quantiles`), moments in one pass over the rows as they are.  A feature without values has nulls.
    """
    group = group or []
    found = written(exact_quantiles(_long(df, features, group), [*group, "feature"], "value", QUANTILES))
    rows = df.select(*group, *features)
    joined = rows.join(_by_feature(found, group, tuple(QUANTILES)), group, "left") if group else rows.join(F.broadcast(_by_feature(found, [], tuple(QUANTILES))), how="left")  # one row
    sums = joined.groupBy(*group).agg(*(F.struct(F.avg(x).alias("mean"), F.stddev_pop(x).alias("sd")).alias(f"_m{i}") for i, x in enumerate(_filled(f, F.col("_s")[f]) for f in features)))
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f"_m{i}.mean").alias("mean"), F.col(f"_m{i}.sd").alias("sd")) for i, f in enumerate(features))))
    moments = sums.select(*group, each.alias("_x")).select(*group, "_x.*")
    return moments.join(found, [*group, "feature"], "left").select(*group, "feature", *QUANTILES, "mean", "sd")


def standardized(df: DataFrame, stats: DataFrame, features: list[str], by: list[str] | None = None, missing: bool = False) -> DataFrame:
    """Rows with `_terms`, an array of (feature, z), and for `missing` an indicator of each null; `by`: the groups that have statistics of their own."""
    by = by or []
    out = _with(df, _by_feature(stats, by, (*QUANTILES, "mean", "sd")), by)

    def z(f):
        s = F.col("_s")[f]
        return term(f, F.when(s["sd"] > 0, (_filled(f, s) - s["mean"]) / s["sd"]).otherwise(0.0))

    cols = [z(f) for f in features] + ([term(f"{f}_missing", F.col(f).isNull().cast("double")) for f in features] if missing else [])
    return out.withColumn("_terms", F.array(*cols)).drop("_s")


def linear_gram(rows: DataFrame, group: list[str], y: Column, weight: Column | None = None, intercept: bool = True) -> DataFrame:
    """Gram of `_terms` rows (see `standardized`), with an intercept term "(1)"."""
    x = F.concat(F.col("_terms"), F.array(term("(1)")) if intercept else F.array().cast("array<struct<t:string,v:double>>"), F.array(term(Y, y)))
    return _pair_sums(rows, group, x, weight)


def _models(coefficients: DataFrame, on: list[str]) -> DataFrame:
    """A row per model with its coefficients as a map, `_m`."""
    return coefficients.groupBy(*on).agg(F.map_from_entries(F.collect_list(F.struct("term", "coefficient"))).alias("_m"))


def _score() -> Column:
    """`_terms` times `_m`, and the intercept."""
    of = lambda t: F.coalesce(F.try_element_at(F.col("_m"), t), F.lit(0.0))
    return F.aggregate("_terms", of(F.lit("(1)")), lambda acc, x: acc + x["v"] * of(x["t"]))


def apply_linear(rows: DataFrame, coefficients: DataFrame, on: list[str], out: str, cap: float | None = None) -> DataFrame:
    """Score `_terms` rows with the coefficient table of their group (`on`), intercept included, capped both ways."""
    joined = _with(rows, _models(coefficients, on), on)
    total = _score()
    value = F.greatest(F.least(total, F.lit(cap)), F.lit(-cap)) if cap is not None else total
    return joined.withColumn(out, value).drop("_m")


def season_forward(
    rows: DataFrame, features: list[str], y: str, alphas: list[float], season: str = "season", least_rows: int = 50, nonnegative: bool = False, missing: bool = False
) -> DataFrame:
    """Out-of-fold predictions: each season scored by models of the seasons before it, one per alpha, all solved in one job.

    Medians, clips, means and deviations are those of the fold's own past too, so nothing of a season or a later one reaches its scores.  Seasons before which
    no feature has a value, or fewer than `least_rows` rows are, have no scores.

    Quantiles of all folds come from one count by season.  A row that no later fold's clips or fillings change goes into the Gram of its season, and a
    fold's Gram is the sum of those before it; only rows that some fold changes are taken to the later folds.  Means and deviations are read from the
    Grams, in which a feature is measured from its first fold's median, so that squares stay small.
    """
    rows = written(rows)
    names = tuple(QUANTILES)
    bounds = written(exact_quantiles(_long(rows, features, [season]), ["feature"], "value", QUANTILES, part=season))
    origin = {r["feature"]: r["x"] for r in bounds.groupBy("feature").agg(F.min_by("median", "fold").alias("x")).collect()}  # a row per feature
    folds = [r[season] for r in rows.select(season).where(F.col(season).isNotNull()).distinct().collect()]  # a row per season
    own = written(_by_feature(bounds, ["fold"], names))
    earlier = F.explode(F.filter(F.array(*map(F.lit, folds)), lambda s: s < F.col("fold")))
    ends = bounds.withColumn("_season", earlier).groupBy("_season", "feature").agg(F.max("low").alias("low"), F.min("high").alias("high"))
    narrow = written(_by_feature(ends, ["_season"], ("low", "high")).withColumnRenamed("_s", "_n"))

    def terms(value, indicators: bool) -> list[Column]:
        made = [term(f, F.coalesce(value(f) - F.lit(float(origin.get(f, 0.0))), F.lit(0.0))) for f in features]
        return made + [term(f"{f}_missing", F.col(f).isNull().cast("double")) for f in features if indicators] + [term("(1)")]

    inside = lambda f: F.coalesce(F.col(f).cast("double").between(F.col("_n")[f]["low"], F.col("_n")[f]["high"]), F.lit(False))
    plain = F.lit(True)
    for f in features:
        plain &= inside(f)
    marked = rows.withColumn("_season", F.col(season)).join(narrow, "_season").withColumn("_plain", plain)
    target = term(Y, F.col(y))
    by_season = _pair_sums(marked.where("_plain"), ["_season"], F.array(*terms(lambda f: F.col(f).cast("double"), False), target))
    shared = by_season.withColumn("fold", later(folds, F.col("_season"))).select("fold", "i", "j", "v", "n")
    clipped = marked.where("not _plain").drop("_n").withColumn("fold", later(folds, F.col("_season"))).join(own, "fold")
    changed = _pair_sums(clipped, ["fold"], F.array(*terms(lambda f: _filled(f, F.col("_s")[f]), missing), target))
    before = shared.unionByName(changed).groupBy("fold", "i", "j").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))

    grid = before.withColumn("alpha", F.explode(F.array(*map(F.lit, alphas))))
    enough = grid.withColumn("_most", F.max("n").over(Window.partitionBy("fold", "alpha"))).where(F.col("_most") >= least_rows).drop("_most")
    models = solve(enough, ["fold", "alpha"], "alpha", ("(1)",), nonnegative=nonnegative, standardize=tuple(features), intercept=not nonnegative)
    tested = rows.withColumn("fold", F.col(season)).join(own, "fold").withColumn("_terms", F.array(*terms(lambda f: _filled(f, F.col("_s")[f]), missing)[:-1])).drop("_s")
    scored = _with(tested, _models(models, ["fold", "alpha"]), ["fold"]).withColumn("predicted", _score()).drop("_m", "_terms")
    return scored.drop("alpha") if len(alphas) == 1 else scored


def nested_grid_select(
    rows: DataFrame, features: Callable[[Column, Column], dict[str, Column]], y: str, ks: list[float], caps: list[float], alphas: list[float], target_caps: list[float], season: str = "season"
) -> DataFrame:
    """(test_season, k, cap, alpha, target_cap, mae, n, chosen): the mean absolute error of every setting over the seasons before each test season.

    `features(k, cap)` gives a row's features under a transition setting.  A season is predicted by a non-negative ridge without intercept, fitted on
    the seasons before it, of features over their deviations there, to `y` clipped at the target cap both ways; errors are those of `y` as it is.
    The first season is fitted only.  Chosen (1) is the least error to nine digits; ties: the smaller alpha, then k, cap and target cap.  Rows without `y`
    are left out, null features are 0.

    Each (k, cap) is reduced once to Grams of a season, which hold every target cap; the Grams before a season are sums of those, so
    rows are never read again for a fold, a penalty or a target cap.  Errors are added where they arise.
    """
    number = lambda x: F.lit(float(x))
    settings = F.explode(F.array(*(F.struct(number(k).alias("k"), number(c).alias("cap")) for k in ks for c in caps)))
    made = [term(name, F.coalesce(value.cast("double"), F.lit(0.0))) for name, value in features(F.col("_g.k"), F.col("_g.cap")).items()]
    target = F.col(y).cast("double")
    long = rows.where(target.isNotNull()).withColumn("_g", settings).select(F.col(season).alias("season"), "_g.k", "_g.cap", target.alias("_y"), F.array(*made).alias("_terms"))

    clipped = [term(f"{Y}:{i}", F.greatest(F.least(F.col("_y"), number(c)), number(-c))) for i, c in enumerate(target_caps)]
    grams = _pair_sums(long, ["season", "k", "cap"], F.concat("_terms", F.array(term("(1)"), *clipped)))
    folds = grams.select(F.col("season").alias("fold")).distinct()
    before = grams.join(F.broadcast(folds), F.col("season") < F.col("fold")).groupBy("fold", "k", "cap", "i", "j").agg(F.sum("v").alias("v"), F.sum("n").alias("n"))
    targets = F.explode(F.array(*(F.struct(F.lit(f"{Y}:{i}").alias("name"), number(c).alias("cap")) for i, c in enumerate(target_caps))))
    own = lambda c: F.when(F.col(c) == F.col("_t.name"), Y).when(~F.startswith(F.col(c), F.lit(Y)), F.col(c))
    grid = before.withColumn("_t", targets).select("fold", "k", "cap", F.col("_t.cap").alias("target_cap"), own("i").alias("i"), own("j").alias("j"), "v", "n").where("i is not null and j is not null")
    models = solve(grid.withColumn("alpha", F.explode(F.array(*map(number, alphas)))), ["fold", "k", "cap", "alpha", "target_cap"], "alpha", nonnegative=True, scaled=True)

    scored = long.withColumnRenamed("season", "fold").join(_models(models, ["fold", "k", "cap", "alpha", "target_cap"]), ["fold", "k", "cap"])
    miss = F.abs(_score() - F.col("_y"))
    errors = scored.groupBy("fold", "k", "cap", "alpha", "target_cap").agg(F.sum(miss).alias("miss"), F.count("*").alias("n"))
    tests = folds.withColumnRenamed("fold", "test_season")
    found = errors.join(F.broadcast(tests), F.col("fold") < F.col("test_season")).groupBy("test_season", "k", "cap", "alpha", "target_cap").agg((F.sum("miss") / F.sum("n")).alias("mae"), F.sum("n").alias("n"))
    best = Window.partitionBy("test_season").orderBy(F.round("mae", 9), "alpha", "k", "cap", "target_cap")  # a row per setting
    return found.withColumn("chosen", (F.row_number().over(best) == 1).cast("int"))


def zero_intercept_slope(df: DataFrame, x: str, y: str, weight: Column, alpha: float, low: float, high: float, least_rows: int) -> DataFrame:
    """Clipped sum(wxy) / (sum(wxx) + alpha); 1 where the sample is too small."""
    slope = F.sum(weight * F.col(x) * F.col(y)) / (F.sum(weight * F.col(x) * F.col(x)) + alpha)
    clipped = F.greatest(F.least(slope, F.lit(high)), F.lit(low))
    return df.agg(F.when(F.count("*") >= least_rows, clipped).otherwise(1.0).alias("slope"), F.count("*").alias("n"))


def form_blend(parts: DataFrame, season_weight: float, process_weight: float, half: float, most: float) -> DataFrame:
    """Season and recent, process and result ratings mixed; the mix counts games/(games+half), at most `most`, against the preseason rating."""
    mix = lambda p: season_weight * F.col(f"season_{p}") + (1 - season_weight) * F.col(f"recent_{p}")
    form = process_weight * mix("process") + (1 - process_weight) * mix("result")
    share = F.least(F.col("games") / (F.col("games") + half), F.lit(most))
    return parts.withColumns({"form": form, "form_weight": share}).withColumn("rating", F.col("preseason") * (1 - F.col("form_weight")) + F.col("form") * F.col("form_weight"))


def consensus(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, median, range, population deviation and sign agreement of several predictions of a row."""
    x = F.array_compact(F.array(*(F.col(c).cast("double") for c in columns)))
    d = df.withColumn("_x", F.array_sort(x))
    n = F.size("_x")
    mean = F.aggregate("_x", F.lit(0.0), lambda a, v: a + v) / n
    mid = (F.element_at("_x", F.floor((n + 1) / 2).cast("int")) + F.element_at("_x", F.floor(n / 2).cast("int") + 1)) / 2
    sd = F.sqrt(F.aggregate(F.transform("_x", lambda v: F.pow(v - F.col("mean"), 2)), F.lit(0.0), lambda a, v: a + v) / n)
    up = F.size(F.filter("_x", lambda v: v > 0))
    down = F.size(F.filter("_x", lambda v: v < 0))
    d = d.where(F.size("_x") > 0).withColumn("mean", mean)
    return d.withColumns({"median": mid, "range": F.array_max("_x") - F.array_min("_x"), "sd": sd, "agreement": F.greatest(up, down)}).drop("_x")
