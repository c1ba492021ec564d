"""Selecting rules on past seasons: gate grids, walk-forward gates, candidates, promotion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def gate_stats(graded: DataFrame, gates: list[tuple], season: str, ensembles: dict[str, str]) -> DataFrame:
    """Wins, losses and pushes per gate and season.  A gate is (ensemble, least edge, most range, least agreement).

    Rows are exploded into the gates that they pass: the gates are a constant list in the plan, so nothing is joined.
    """
    passed = F.array_compact(F.array(*(F.when((F.abs(F.col(ensembles[e])) >= t) & (F.col("range") <= r) & (F.col("agreement") >= a), F.struct(F.lit(i).alias("gate"), F.signum(ensembles[e]).cast("int").alias("side"))) for i, (e, t, r, a) in enumerate(gates))))
    d = graded.withColumn("_g", F.explode(passed)).select("_g.*", season, "gain")
    result = F.col("gain") * F.col("side")
    return d.groupBy("gate", season).agg(F.count_if(result > 0).alias("wins"), F.count_if(result < 0).alias("losses"), F.count_if(result == 0).alias("pushes"))


def beta_score(wins: Column, losses: Column, prior: float = 25.0) -> Column:
    """Mean less half a deviation of Beta(prior + wins, prior + losses)."""
    a, b = wins + prior, losses + prior
    return a / (a + b) - 0.5 * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))


def walk_forward(stats: DataFrame, season: str, first: int, floor: int) -> DataFrame:
    """For each season from `first`: the gate with the best score over the seasons before (at least `floor` bets), and its record in the season."""
    earlier = stats.select("gate", F.col(season).alias("_s"), "wins", "losses")
    seasons = stats.select(season).distinct().where(F.col(season) >= first)
    past = seasons.join(earlier, F.col("_s") < F.col(season)).groupBy(season, "gate").agg(F.sum("wins").alias("w"), F.sum("losses").alias("l"))
    scored = past.where(F.col("w") + F.col("l") >= floor).withColumn("score", beta_score(F.col("w"), F.col("l")))
    best = scored.groupBy(season).agg(F.max_by("gate", F.struct("score", -F.col("gate"))).alias("gate"), F.max("score").alias("score"))
    return best.join(stats, ["gate", season], "left").fillna(0, ["wins", "losses", "pushes"])


def candidate_choice(summary: DataFrame, control: str, name: str, least_stability: float) -> DataFrame:
    """Candidates beside the control: gains, eligibility, and the place among the eligible by correlation, then error, then name."""
    base = summary.where(F.col(name) == control).select(F.col("correlation").alias("_c"), F.col("rmse").alias("_r"))
    d = summary.crossJoin(F.broadcast(base))  # one row
    d = d.withColumns({"correlation_gain": F.col("correlation") - F.col("_c"), "rmse_gain": F.col("_r") - F.col("rmse")}).drop("_c", "_r")
    ok = (F.col(name) != control) & (F.col("correlation_gain") > 0) & (F.col("rmse_gain") >= 0) & (F.col("stability") >= least_stability)
    d = d.withColumn("eligible", ok)
    w = Window.partitionBy("eligible").orderBy(F.desc("correlation"), "rmse", name)
    return d.withColumn("place", F.when(F.col("eligible"), F.row_number().over(w)))


def promotion(summary: DataFrame, floors: dict[str, float]) -> DataFrame:
    """A pass flag per metric floor and whether all pass."""
    flags = {f"{m}_passed": F.coalesce(F.col(m) >= v, F.lit(False)) for m, v in floors.items()}
    out = summary.withColumns(flags)
    every = F.lit(True)
    for f in flags:
        every &= F.col(f)
    return out.withColumn("promoted", every)
