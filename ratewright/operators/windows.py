"""Window operators: percentiles, ranks, schedule factors, cumulative sums and re-ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percentile_score(df: DataFrame, group: list[str], value: str, out: str, eligible: Column | None = None, higher_is_better: bool = True, fallback: float | None = 50.0, least: int = 1) -> DataFrame:
    """Percentile (0 to 100, ties take the mean rank) among eligible rows of the group; others get `fallback`.

    Neither percent_rank nor cume_dist is this: the rank of equal values is their mean rank over the number of eligible rows.
    """
    ok = F.col(value).isNotNull() & (eligible if eligible is not None else F.lit(True))
    d = df.withColumn("_ok", ok.cast("int"))
    by = Window.partitionBy(*group, "_ok")
    first = F.rank().over(by.orderBy(F.col(value) if higher_is_better else F.desc(value)))
    same = F.count("*").over(Window.partitionBy(*group, "_ok", value))
    n = F.count("*").over(by)
    score = 100.0 * (first + (same - 1) / 2) / n
    return d.withColumn(out, F.when((F.col("_ok") == 1) & (n >= least), score).otherwise(F.lit(fallback).cast("double"))).drop("_ok")


def rank_min(df: DataFrame, group: list[str], value: str, out: str = "rank") -> DataFrame:
    """Competition rank, the largest value first."""
    return df.withColumn(out, F.rank().over(Window.partitionBy(*group).orderBy(F.desc(value))))


def first_k(df: DataFrame, group: list[str], order: list, k: int, out: str = "rank") -> DataFrame:
    """The first k rows of each group in a total order, with their place."""
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(out) <= k)


def dedupe_by_priority(df: DataFrame, keys: list[str], order: list) -> tuple[DataFrame, DataFrame]:
    """The best row of each key, and the rows that lost with their place."""
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rn = 1").drop("_rn"), ranked.where("_rn > 1").withColumnRenamed("_rn", "place")


def fill_slots(candidates: DataFrame, keys: list[str], slots: list[str], slot: str, player: str, order: list) -> DataFrame:
    """Slots in the given order each take their best candidate that no earlier slot took; all keys at once."""
    out, left = None, candidates
    for s in slots:
        best = first_k(left.where(F.col(slot) == s), keys, [*order, F.col(player)], 1, "_place").drop("_place")
        out = best if out is None else out.unionByName(best)
        left = left.join(best.select(*keys, player), [*keys, player], "left_anti")
    return out


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 3958.8 * 2 * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def schedule_factors(team_games: DataFrame, team: str, date: str, is_away: str, season: str) -> DataFrame:
    """Per team-game: rest days, whether it follows a bye, the road streak up to and with it, road games in the last four, back to back."""
    w = Window.partitionBy(team, season).orderBy(date)
    d = team_games.withColumn("rest_days", F.date_diff(date, F.lag(date).over(w)))
    d = d.withColumn("_home_runs", F.sum(1 - F.col(is_away)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    streak = F.sum(is_away).over(Window.partitionBy(team, season, "_home_runs").orderBy(date).rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumns({"road_streak": streak, "road_last4": F.sum(is_away).over(w.rowsBetween(-3, 0)), "after_bye": (F.col("rest_days") >= 12).cast("int"), "back_to_back": ((F.col(is_away) == 1) & (F.lag(is_away).over(w) == 1)).cast("int")})
    return d.drop("_home_runs")


def change_flags(df: DataFrame, group: list[str], order: str, value: str) -> DataFrame:
    """Whether a value differs from the group's first and from the one before."""
    w = Window.partitionBy(*group).orderBy(order)
    differs = lambda other: (~F.col(value).eqNullSafe(other)).cast("int")
    return df.withColumns({"differs_first": differs(F.first(value).over(w)), "differs_last": F.when(F.row_number().over(w) == 1, 0).otherwise(differs(F.lag(value).over(w)))})


def rolling_prior(df: DataFrame, group: list[str], order: str, value: str, n: int = 3, out: str = "prior_mean") -> DataFrame:
    """Mean of up to n rows before each row, not with it."""
    return df.withColumn(out, F.avg(value).over(Window.partitionBy(*group).orderBy(order).rowsBetween(-n, -1)))


def recency_weight(df: DataFrame, group: list[str], period: str, decay: float, out: str = "weight") -> DataFrame:
    """decay to the power of the periods since the group's last."""
    return df.withColumn(out, F.pow(F.lit(decay), F.max(period).over(Window.partitionBy(*group)) - F.col(period)))


def drawdown(df: DataFrame, group: list[str], order: list, profit: str) -> DataFrame:
    """Running total, its peak so far (from the first total, not from 0) and the gap."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    d = df.withColumn("running", F.sum(profit).over(w)).withColumn("peak", F.max("running").over(w))
    return d.withColumn("drawdown", F.col("peak") - F.col("running"))


def zscore(df: DataFrame, group: list[str], value: str, out: str = "z", population: bool = False) -> DataFrame:
    """(value - mean) / deviation in the group; 0 where nothing varies."""
    w = Window.partitionBy(*group)
    sd = (F.stddev_pop if population else F.stddev_samp)(value).over(w)
    return df.withColumn(out, F.when(sd > 0, (F.col(value) - F.avg(value).over(w)) / sd).otherwise(F.when(F.col(value).isNotNull(), 0.0)))


def clip_recenter(df: DataFrame, group: list[str], value: str, low: float, high: float, rounds: int = 20, out: str | None = None) -> DataFrame:
    """`rounds` times: take the group's mean off, clip.  All rounds are windows over one partitioning, so rows move once; nulls stay null and don't count."""
    out = out or value
    w = Window.partitionBy(*group)
    d = df.withColumn(out, F.col(value).cast("double"))
    for _ in range(rounds):
        d = d.withColumn(out, F.when(F.col(out).isNotNull(), F.greatest(F.least(F.col(out) - F.avg(out).over(w), F.lit(float(high))), F.lit(float(low)))))
    return d


def lock_and_tiebreak(card: DataFrame, group: list[str], rank: str, strength: str, tiebreak: str, locked: int = 4, last: int = 8, within: float = 0.5) -> DataFrame:
    """Ranks 1..locked stay; the next place goes to the row of places locked+1..last within `within` of the strongest of them that has the greatest tie-break."""
    w = Window.partitionBy(*group)
    pool = F.col(rank).between(locked + 1, last)
    top = F.max(F.when(pool, F.col(strength))).over(w)
    near = pool & (top - F.col(strength) <= within)
    order = F.when(F.col(rank) <= locked, 0).when(near, 1).otherwise(2)
    d = card.withColumns({"_o": order, "_t": F.when(near, -F.col(tiebreak)).otherwise(0)})
    first = F.row_number().over(Window.partitionBy(*group, "_o").orderBy("_t", rank))
    d = d.withColumn("_o", F.when(F.col("_o") == 1, F.when(first == 1, 1).otherwise(2)).otherwise(F.col("_o")))
    return d.withColumn("final_rank", F.row_number().over(Window.partitionBy(*group).orderBy("_o", rank))).drop("_o", "_t")


def veto_rerank(card: DataFrame, group: list[str], veto: Column, rank: str) -> DataFrame:
    """Vetoed rows go to the end, in their order."""
    d = card.withColumn("vetoed", veto.cast("int"))
    return d.withColumn("final_rank", F.row_number().over(Window.partitionBy(*group).orderBy("vetoed", rank)))


def contest_rank(df: DataFrame, group: list[str], residual: str, tie: list[str], top: int = 5, alternates: int = 3) -> DataFrame:
    """Rank by absolute residual and a status: top, alternate or pass."""
    r = F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(F.abs(residual)), *tie))
    d = df.withColumn("contest_rank", r)
    return d.withColumn("status", F.when(F.col("contest_rank") <= top, "TOP").when(F.col("contest_rank") <= top + alternates, "ALTERNATE").otherwise("PASS"))


def confidence_board(card: DataFrame, group: list[str], strength: str, other_signal: str, weights: tuple[float, float, float] = (0.5, 0.3, 0.2), top: int = 5) -> DataFrame:
    """For the chosen rows of a card: gap to the first alternate, agreement of a second signal and own strength as a weighted score, its tier and rank."""
    w = Window.partitionBy(*group)
    alternate = F.max(F.when(F.col("contest_rank") == top + 1, F.abs(F.col(strength)))).over(w)
    gap = F.abs(F.col(strength)) - F.coalesce(alternate, F.lit(0.0))
    boundary = 1 - F.exp(-F.greatest(gap, F.lit(0.0)) / 10)
    agree = F.when(F.signum(strength) == F.signum(other_signal), 1.0).when(F.col(other_signal) == 0, 0.5).otherwise(0.0)
    size = F.least(F.abs(F.col(strength)) / 50, F.lit(1.0))
    d = card.withColumn("score", F.round(100 * (weights[0] * boundary + weights[1] * agree + weights[2] * size), 6)).where(F.col("contest_rank") <= top)
    tier = F.when(F.col("score") >= 75, "HIGH").when(F.col("score") >= 50, "MEDIUM").otherwise("LOW")
    return d.withColumn("tier", tier).withColumn("board_rank", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("score"), "contest_rank")))
