"""Grading predictions and summarising them by scope, threshold and bin."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewright.functions.clean import implied_probability, net_profit
from ratewright.operators.windows import drawdown


def grade(df: DataFrame, edge: str, actual: str, line: str, price: Column, closing: str | None = None) -> DataFrame:
    """Side by the sign of the edge, cover margin, result (W, L, P push, N no side), profit of one unit, contest points and closing-line value."""
    side = F.signum(edge).cast("int")
    margin = (F.col(actual) - F.col(line)) * side
    result = F.when(F.col(edge).isNull() | F.col(line).isNull() | (side == 0), "N").when(margin > 0, "W").when(margin < 0, "L").otherwise("P")
    out = df.withColumns({"side": side, "cover_margin": margin, "result": result})
    out = out.withColumns({"profit": F.when(F.col("result") == "W", net_profit(price)).when(F.col("result") == "L", -1.0).otherwise(0.0), "points": F.when(F.col("result") == "W", 1.0).when(F.col("result") == "P", 0.5).otherwise(0.0)})
    return out.withColumn("closing_value", (F.col(closing) - F.col(line)) * side) if closing else out


def wilson(wins: Column, losses: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Wilson score interval of wins over decided bets (none: null)."""
    n = (wins + losses).cast("double")
    p = wins / n
    centre, half = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return F.when(n > 0, (centre - half) / (1 + z * z / n)), F.when(n > 0, (centre + half) / (1 + z * z / n))


def record(extra: dict[str, Column] | None = None) -> list[Column]:
    """Aggregates of graded rows."""
    count = lambda r: F.count_if(F.col("result") == r)
    bets = F.count_if(F.col("result") != "N")
    return [bets.alias("bets"), count("W").alias("wins"), count("L").alias("losses"), count("P").alias("pushes"), F.sum("profit").alias("profit"), *(v.alias(k) for k, v in (extra or {}).items())]


def with_rates(summary: DataFrame, z: float = 1.96) -> DataFrame:
    low, high = wilson(F.col("wins"), F.col("losses"), z)
    decided = F.col("wins") + F.col("losses")
    return summary.withColumns({"win_rate": F.when(decided > 0, F.col("wins") / decided), "roi": F.when(F.col("bets") > 0, F.col("profit") / F.col("bets")), "wilson_low": low, "wilson_high": high})


def scoped(df: DataFrame, scope: str, aggs: list[Column]) -> DataFrame:
    """The aggregates for every value of `scope` and for ALL, in one pass."""
    out = df.withColumn("scope", F.col(scope).cast("string")).rollup("scope").agg(*aggs, F.grouping("scope").alias("_all"))
    return out.withColumn("scope", F.when(F.col("_all") == 1, "ALL").otherwise(F.col("scope"))).drop("_all")


def threshold_grid(df: DataFrame, edge: str, thresholds: list[float], keys: list[str]) -> DataFrame:
    """The record of the same rows at each threshold.  Rows are exploded into the thresholds they reach: a short constant list, no join."""
    reached = F.filter(F.array(*map(F.lit, thresholds)), lambda t: F.abs(F.col(edge)) >= t)
    return df.withColumn("threshold", F.explode(reached)).groupBy(*keys, "threshold").agg(*record())


def performance(df: DataFrame, keys: list[str], order: list, edge: str, realised: str) -> DataFrame:
    """Record, rates, correlation of edge and outcome and the largest drawdown of profit."""
    d = drawdown(df.where("result <> 'N'"), keys, order, "profit")
    return with_rates(d.groupBy(*keys).agg(*record({"correlation": F.corr(edge, realised), "max_drawdown": F.max("drawdown")})))


def bins(c: Column, edges: list[float]) -> Column:
    """Number of the right-closed bin: 0 up to the first edge, then each up to the next."""
    return reduce(lambda acc, ie: F.when(c <= ie[1], ie[0]).otherwise(acc), reversed(list(enumerate(edges))), F.lit(len(edges)))


def calibration(df: DataFrame, predicted: str, hit: Column, edges: list[float]) -> DataFrame:
    """Per bin of predicted probability: rows, mean predicted, realised and the gap."""
    out = df.groupBy(bins(F.col(predicted), edges).alias("bin")).agg(F.count("*").alias("n"), F.avg(predicted).alias("predicted"), F.avg(hit.cast("int")).alias("realised"))
    return out.withColumn("gap", F.col("realised") - F.col("predicted"))


def brier_logloss(predicted: str, hit: Column, eps: float = 1e-6) -> tuple[Column, Column]:
    y = hit.cast("double")
    p = F.greatest(F.least(F.col(predicted), F.lit(1 - eps)), F.lit(eps))
    return F.avg(F.pow(F.col(predicted) - y, 2)), -F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))


def errors(actual: str, predicted: str) -> list[Column]:
    e = F.col(actual) - F.col(predicted)
    return [F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"), F.corr(actual, predicted).alias("correlation"), F.count("*").alias("n")]


def stake_ledger(df: DataFrame, keys: list[str], order: list, flat: float, fraction: str, bankroll: float, price: Column) -> DataFrame:
    """Recorded stakes settled: flat and fractional net by row, and the running bankroll of the recorded stakes."""
    won, lost = F.col("result") == "W", F.col("result") == "L"
    stake = F.col(fraction) * bankroll
    settle = lambda s: F.when(won, s * net_profit(price)).when(lost, -s).otherwise(0.0)
    d = df.withColumns({"flat_net": settle(F.lit(flat)), "stake": stake, "fraction_net": settle(stake)})
    d = drawdown(d, keys, order, "fraction_net")
    return d.withColumn("bankroll", F.col("running") + bankroll).withColumn("drawdown_share", F.col("drawdown") / (F.col("peak") + bankroll))


def compare(new: DataFrame, old: DataFrame, on: list[str], metrics: list[str]) -> DataFrame:
    """(on, metric, new, old, change) for each metric."""
    long = lambda df, name: df.unpivot(on, metrics, "metric", name)
    cast = lambda df: df.select(*on, *(F.col(m).cast("double").alias(m) for m in metrics))
    return long(cast(new), "new").join(long(cast(old), "old"), [*on, "metric"], "left").withColumn("change", F.col("new") - F.col("old"))


def smoothed_pmf(history: DataFrame, value: str, low: int, high: int, smoothing: float) -> DataFrame:
    """Probability of every integer from low to high: (count + smoothing) over the total; values outside are clipped in."""
    spark = history.sparkSession
    clipped = F.greatest(F.least(F.rint(F.col(value).cast("double")).cast("int"), F.lit(high)), F.lit(low))
    counts = history.where(F.col(value).isNotNull()).groupBy(clipped.alias("margin")).agg(F.count("*").alias("n"))
    support = spark.range(low, high + 1).select(F.col("id").cast("int").alias("margin"))
    d = support.join(counts, "margin", "left").fillna(0, ["n"])
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("_total"))
    return d.crossJoin(F.broadcast(total)).select("margin", "n", ((F.col("n") + smoothing) / (F.col("_total") + smoothing * (high - low + 1))).alias("p"))  # one row


def stability(coefficients: DataFrame, term: str, coefficient: str) -> DataFrame:
    """Over folds: share of the majority sign, mean absolute coefficient and its share of the largest."""
    positive = F.count_if(F.col(coefficient) > 0)
    n = F.count("*")
    out = coefficients.groupBy(term).agg(n.alias("folds"), (F.greatest(positive, F.count_if(F.col(coefficient) < 0)) / n).alias("sign_stability"), F.avg(F.abs(coefficient)).alias("mean_abs"))
    return out.withColumn("material", F.col("mean_abs") / F.max("mean_abs").over(Window.partitionBy(F.lit(1))))  # a row per term


def integrity(df: DataFrame, scopes: dict[str, Column], feature: str, least_coverage: float, least_sd: float) -> DataFrame:
    """Coverage, spread and non-zero count of a feature in each scope that a row falls in, and whether it passes."""
    in_scopes = F.filter(F.array(*(F.when(c, F.lit(s)) for s, c in scopes.items())), lambda s: s.isNotNull())
    d = df.withColumn("scope", F.explode(in_scopes)).groupBy("scope").agg(F.count("*").alias("rows"), (F.count(feature) / F.count("*")).alias("coverage"), F.coalesce(F.stddev_pop(feature), F.lit(0.0)).alias("sd"), F.count_if(F.col(feature) != 0).alias("nonzero"))
    return d.withColumn("passed", (F.col("coverage") >= least_coverage) & (F.col("sd") >= least_sd) & (F.col("nonzero") > 0))


def pooled_noise(seasons: DataFrame, rmse: str, games: str, low: float, high: float) -> DataFrame:
    """Games-weighted root mean square of season errors, clipped."""
    pooled = F.sqrt(F.sum(F.col(games) * F.col(rmse) * F.col(rmse)) / F.sum(games))
    return seasons.agg(F.greatest(F.least(pooled, F.lit(high)), F.lit(low)).alias("sigma"), F.sum(games).alias("games"))
