"""Joins with stated cardinality, as-of and prior-window joins.  None of them is a cross join of event rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def checked_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left", unique: str = "right") -> DataFrame:
    """Equi join; a repeated key on a side that `unique` names ("right", "left" or "both") raises when the plan runs.

    The check is a window count over the join key, so it shuffles the side by the key that the join needs anyway.
    """

    def checked(df: DataFrame, side: str) -> DataFrame:
        n = F.count("*").over(Window.partitionBy(*on))
        message = F.concat(F.lit(f"repeated key on the {side} side: "), F.to_json(F.struct(*on)))
        return df.withColumn("_n", n).where(F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(True)).drop("_n")

    if unique in ("right", "both"):
        right = checked(right, "right")
    if unique in ("left", "both"):
        left = checked(left, "left")
    return left.join(right, on, how)


def attach_two_sided(games: DataFrame, ratings: DataFrame, keys: list[str], entity: str, home: str = "home", away: str = "away") -> DataFrame:
    """The same table joined for the home and the away side, its columns prefixed."""
    values = [c for c in ratings.columns if c not in (*keys, entity)]
    for side, column in (("home", home), ("away", away)):
        part = ratings.select(*keys, F.col(entity).alias(column), *(F.col(c).alias(f"{side}_{c}") for c in values))
        games = games.join(part, [*keys, column], "left")
    return games


def mirror(df: DataFrame, keys: list[str], entity: str, opponent: str, values: list[str], prefix: str = "opp_") -> DataFrame:
    """Each row beside the row of its opponent."""
    other = df.select(*keys, F.col(entity).alias(opponent), F.col(opponent).alias(entity), *(F.col(v).alias(prefix + v) for v in values))
    return df.join(other, [*keys, entity, opponent])


def overlay(base: DataFrame, local: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    """Full outer: a local value wins; `source` says which side a row has."""
    b, x = base.withColumn("_b", F.lit(1)), local.withColumn("_l", F.lit(1))
    joined = b.select(*on, "_b", *(F.col(v).alias(f"b_{v}") for v in values)).join(x.select(*on, "_l", *(F.col(v).alias(f"l_{v}") for v in values)), on, "full_outer")
    source = F.when(F.col("_l").isNull(), "base").when(F.col("_b").isNull(), "local").otherwise("both")
    return joined.select(*on, *(F.coalesce(f"l_{v}", f"b_{v}").alias(v) for v in values), source.alias("source"))


def outer_union(parts: dict[str, DataFrame], on: list[str]) -> DataFrame:
    """Full outer join of any number of tables with distinct value columns in one shuffle: a union of rows, then one group per key."""
    values = [c for df in parts.values() for c in df.columns if c not in on]
    rows = [df.select(*on, *((F.col(c) if c in df.columns else F.lit(None)).alias(c) for c in values)) for df in parts.values()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.groupBy(*on).agg(*(F.max(c).alias(c) for c in values))


def override(base: DataFrame, patch: DataFrame, on: list[str], values: list[str], authoritative: Column | None = None, any_of: tuple[str, ...] = ()) -> DataFrame:
    """Left join; a value of the patch replaces the base's; where `authoritative` holds the base's goes first; `any_of` flags are or-ed."""
    right = patch.select(*on, *(F.col(v).alias(f"_p_{v}") for v in (*values, *any_of)))
    out = base.join(right, on, "left")
    kept = {v: F.when(~authoritative, F.col(v)) if authoritative is not None else F.col(v) for v in values}
    out = out.withColumns({v: F.coalesce(f"_p_{v}", k) for v, k in kept.items()} | {v: ((F.coalesce(v, F.lit(0)) == 1) | (F.coalesce(f"_p_{v}", F.lit(0)) == 1)).cast("int") for v in any_of})
    return out.drop(*(f"_p_{v}" for v in (*values, *any_of)))


def asof_prior(grid: DataFrame, snapshots: DataFrame, keys: list[str], period: str, values: list[str], depth: int = 4) -> DataFrame:
    """For each (keys, period) of `grid` the last `depth` strictly earlier snapshots, newest first, as an array `prior` of structs.

    Both sides are put on one time line per key, snapshots of a period behind the questions of that period.  A snapshot takes its `depth` - 1
    predecessors with it, and a question the last such array that it has passed: both are frames of bounded size over rows sorted once.  Snapshots
    of one period are ordered by their values; those without a period are earlier than nothing.
    """
    snap = F.struct(F.col(period).alias("period"), *values)
    stamped = snapshots.where(F.col(period).isNotNull()).select(*keys, F.col(period).alias("_at"), F.lit(1).alias("_kind"), snap.alias("_s"))
    asked = grid.select(*keys, F.col(period).alias("_at"), F.lit(0).alias("_kind"), F.lit(None).cast(stamped.schema["_s"].dataType).alias("_s"))
    line = stamped.unionByName(asked).repartition(*keys)  # for both windows
    own = Window.partitionBy(*keys, "_kind").orderBy("_at", "_s").rowsBetween(-(depth - 1), Window.currentRow)
    passed = Window.partitionBy(*keys).orderBy("_at", "_kind", "_s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = line.withColumn("_last", F.when(F.col("_kind") == 1, F.reverse(F.collect_list("_s").over(own)))).withColumn("_prior", F.last("_last", ignorenulls=True).over(passed))
    none = F.array().cast(line.schema["_prior"].dataType)
    return line.where("_kind = 0").select(*keys, F.col("_at").alias(period), F.coalesce("_prior", none).alias("prior"))


def prior_window(grid: DataFrame, history: DataFrame, keys: list[str], season: str = "season", period: str = "period") -> DataFrame:
    """History of each (keys, season, period) of `grid`: this season before the period, and all of the season before.

    Two equi joins on the season (one shifted by a year) instead of an inequality join over both.
    """
    g = grid.select(*(F.col(k).alias(f"_g_{k}") for k in keys), F.col(season).alias("grid_season"), F.col(period).alias("grid_period"))
    same = [F.col(k) == F.col(f"_g_{k}") for k in keys]
    now = g.join(history, [*same, F.col(season) == F.col("grid_season"), F.col(period) < F.col("grid_period")])
    last = g.join(history, [*same, F.col(season) + 1 == F.col("grid_season")])
    out = now.withColumn("age", F.col("grid_period") - F.col(period)).unionByName(last.withColumn("age", F.lit(None).cast("int")))
    return out.drop(*(f"_g_{k}" for k in keys))


#: exp(-x * x / 2) is 0 in double precision beyond so many bandwidths.
KERNEL_REACH = 39.0
_STEPS = 4


def kernel_weighted(candidates: DataFrame, history: DataFrame, line: str, outcome: str, bandwidth: float) -> DataFrame:
    """Per candidate line and outcome: the Gaussian-weighted count of all history lines and the number of history rows with the outcome.

    History is first counted by (line, outcome) and candidates by line.  Lines meet by an equi join on buckets, history in every bucket whose
    candidates it can reach with a weight that isn't 0 in double precision; what lies beyond adds nothing to a sum.  Null lines and outcomes are left out.
    """
    width = KERNEL_REACH * bandwidth / _STEPS
    bucket = lambda c: F.floor(F.col(c).cast("double") / width)
    counts = history.where(F.col(line).isNotNull() & F.col(outcome).isNotNull()).groupBy(F.col(line).alias("_h"), F.col(outcome).alias("_o")).agg(F.count("*").alias("_n"))
    lines = candidates.where(F.col(line).isNotNull()).select(F.col(line).alias("_c")).distinct()
    reach = F.explode(F.array(*(F.lit(k) for k in range(-_STEPS - 1, _STEPS + 2))))
    near = lines.withColumn("_b", bucket("_c")).join(counts.withColumn("_k", reach).withColumn("_b", bucket("_h") + F.col("_k")).drop("_k"), "_b")
    weight = F.exp(-F.pow((F.col("_c") - F.col("_h")) / bandwidth, 2) / 2)
    sums = near.groupBy("_c", "_o").agg(F.sum(F.col("_n") * weight).alias("_w"))
    totals = counts.groupBy("_o").agg(F.sum("_n").alias("_n")).agg(F.collect_list(F.struct("_o", "_n")).alias("_all"))  # one row, an entry per outcome
    every = lines.crossJoin(F.broadcast(totals)).select("_c", F.explode("_all").alias("_x")).select("_c", "_x.*")
    joined = every.join(sums, ["_c", "_o"], "left")
    return joined.select(F.col("_c").alias(line), F.col("_o").alias(outcome), F.coalesce("_w", F.lit(0.0)).alias("weight"), F.col("_n").alias("n"))


def disagreement(left: DataFrame, right: DataFrame, on: list[str], value: str, tolerance: float) -> DataFrame:
    """Keys that one side lacks or where the values differ by more than the tolerance."""
    joined = left.select(*on, F.col(value).alias("left_value"), F.lit(1).alias("_l")).join(right.select(*on, F.col(value).alias("right_value"), F.lit(1).alias("_r")), on, "full_outer")
    kind = F.when(F.col("_l").isNull(), "missing_left").when(F.col("_r").isNull(), "missing_right").when(F.abs(F.col("left_value") - F.col("right_value")) > tolerance, "differs")
    return joined.select(*on, "left_value", "right_value", kind.alias("kind")).where("kind is not null")
