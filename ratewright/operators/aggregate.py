"""Aggregations: efficiency tables, player seasons, shrinkage, scores, units, continuity and shares."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewright.operators.quantiles import exact_quantiles, medians
from ratewright.operators.windows import percentile_score


def conditional_means(df: DataFrame, keys: list[str], measures: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One pass over the events: for each name the mean of a value over the rows where its condition holds (none: null)."""
    return df.groupBy(*keys).agg(*(F.avg(F.when(cond, value)).alias(n) for n, (cond, value) in measures.items()), F.count("*").alias("plays"))


def primary_by_volume(df: DataFrame, keys: list[str], player: str, volume: str, measure: str) -> DataFrame:
    """The player with the most volume of each key (ties: the least player), the share of the key's volume and the mean measure."""
    each = df.groupBy(*keys, player).agg(F.sum(volume).alias("_v"), F.sum(measure).alias("_m"), F.count("*").alias("_n"))
    best = F.max_by(F.struct(player, "_v", "_m", "_n"), F.struct("_v", -F.col(player)))
    out = each.groupBy(*keys).agg(best.alias("b"), F.sum("_v").alias("_all"))
    return out.select(*keys, F.col(f"b.{player}").alias(player), (F.col("b._v") / F.col("_all")).alias("share"), (F.col("b._m") / F.col("b._n")).alias("mean_measure"))


def games_played(games: DataFrame, keys: list[str], home: str, away: str, date: str) -> DataFrame:
    """Per team over both sides: games and the latest date."""
    both = games.select(*keys, F.explode(F.array(home, away)).alias("team"), date)
    return both.groupBy(*keys, "team").agg(F.count("*").alias("games"), F.max(date).alias("latest"))


def player_season(df: DataFrame, keys: list[str], sums: list[str], means: list[str], played: str | None = None, first: dict[str, str] | None = None) -> DataFrame:
    """Sums and means of weekly rows; weeks with a positive `played`; identity fields at the least order value where not null."""
    aggs = [F.sum(c).alias(c) for c in sums] + [F.avg(c).alias(f"mean_{c}") for c in means]
    if played:
        aggs.append(F.sum(F.when(F.col(played) > 0, 1).otherwise(0)).alias("games"))
    aggs += [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(o))).alias(c) for c, o in (first or {}).items()]
    return df.groupBy(*keys).agg(*aggs)


def unpivot_roles(df: DataFrame, keys: list[str], roles: dict[str, str], out: str = "player") -> DataFrame:
    """Count per player and metric over id columns: `roles` maps an id column to its metric; one column per metric."""
    rows = F.explode(F.array(*(F.struct(F.col(c).alias(out), F.lit(m).alias("metric")) for c, m in roles.items())))
    long = df.select(*keys, rows.alias("x")).select(*keys, "x.*").where(F.col(out).isNotNull())
    return long.groupBy(*keys, out).agg(*(F.count_if(F.col("metric") == m).alias(m) for m in dict.fromkeys(roles.values())))


def recency_rollup(df: DataFrame, keys: list[str], age: str, values: list[str], weights: dict[int, float]) -> DataFrame:
    """Weighted mean over seasons by age (0: latest), weights made to sum to 1 over the seasons that have the value."""
    w = reduce(lambda acc, kv: F.when(F.col(age) == kv[0], kv[1]).otherwise(acc), weights.items(), F.lit(0.0))
    d = df.withColumn("_w", w)
    return d.groupBy(*keys).agg(*((F.sum(F.col(v) * F.col("_w")) / F.nullif(F.sum(F.when(F.col(v).isNotNull(), F.col("_w"))), F.lit(0.0))).alias(v) for v in values), F.count("*").alias("seasons"))


def empirical_bayes(df: DataFrame, group: list[str], events: str, opportunities: str, prior: float, out: str = "rate") -> DataFrame:
    """(events + group rate x prior) / (opportunities + prior)."""
    w = Window.partitionBy(*group)
    rate = F.sum(events).over(w) / F.sum(opportunities).over(w)
    return df.withColumn(out, (F.col(events) + rate * prior) / (F.col(opportunities) + prior))


def shrink_to_median(df: DataFrame, group: list[str], value: str, sample: str, half: float = 150.0, least: float = 0.0, out: str = "shrunk") -> DataFrame:
    """value x n/(n+half) + median x half/(n+half); the median is that of the group's rows with at least `least` of the sample."""
    middle = exact_quantiles(df.where(F.col(sample) >= least), group, value, {"_median": 0.5})
    share = F.col(sample) / (F.col(sample) + half)
    joined = df.join(middle, group, "left")
    return joined.withColumn(out, F.coalesce(F.col(value), F.col("_median")) * share + F.col("_median") * (1 - share)).drop("_median")


def weighted_components(weights: dict[str, float]) -> tuple[Column, Column]:
    """Weighted mean of the components that are there, and how many are."""
    top = reduce(lambda a, b: a + b, [F.when(F.col(c).isNotNull(), F.col(c) * w).otherwise(0.0) for c, w in weights.items()])
    bottom = reduce(lambda a, b: a + b, [F.when(F.col(c).isNotNull(), w).otherwise(0.0) for c, w in weights.items()])
    n = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in weights])
    return F.when(bottom > 0, top / bottom), n


def scorecards(df: DataFrame, group: list[str], metrics: dict[str, float], confidence: Column, prefix: str = "score_") -> DataFrame:
    """Percentile scores of metrics in their group (negative weight: lower is better), their weighted mean, shrunk towards 50 by confidence."""
    for m, w in metrics.items():
        df = percentile_score(df, group, m, prefix + m, higher_is_better=w >= 0, fallback=None)
    mean, n = weighted_components({prefix + m: abs(w) for m, w in metrics.items()})
    return df.withColumns({"composite": mean, "components": n}).withColumn("score", 50 + (F.col("composite") - 50) * confidence)


def saturation(volume: Column | str, half: float) -> Column:
    """v / (v + half)."""
    v = F.col(volume) if isinstance(volume, str) else volume
    return v / (v + half)


def final_grade(df: DataFrame, sources: list[str], reliability: Column, baseline: str, context: Column) -> DataFrame:
    """The first source that is there, plus context, shrunk once to the baseline; `grade_source` names it."""
    grade = F.coalesce(*(F.col(s) for s in sources))
    source = F.coalesce(*(F.when(F.col(s).isNotNull(), F.lit(s)) for s in sources), F.lit("baseline"))
    value = F.when(grade.isNull(), F.col(baseline)).otherwise(F.col(baseline) + (grade + context - F.col(baseline)) * reliability)
    return df.withColumns({"final_grade": value, "grade_source": source})


def grade_history(df: DataFrame, keys: list[str], season: str, grade: str, reliability: str, decay: float) -> DataFrame:
    """Reliability- and recency-weighted grade, the latest grade, mean reliability and effective sample (sum of weights, squared, over sum of squares)."""
    w = F.col(reliability) * F.pow(F.lit(decay), F.col("_last") - F.col(season))
    d = df.withColumn("_last", F.max(season).over(Window.partitionBy(*keys))).withColumn("_w", w)
    return d.groupBy(*keys).agg((F.sum(F.col("_w") * F.col(grade)) / F.sum("_w")).alias("grade"), F.max_by(grade, season).alias("latest"), F.avg(reliability).alias("confidence"), (F.pow(F.sum("_w"), 2) / F.sum(F.col("_w") * F.col("_w"))).alias("effective"))


def replacement(df: DataFrame, group: list[str], grade: str, qualified: Column, quantile: float = 0.2) -> DataFrame:
    """The exact quantile (linear interpolation) of qualified rows."""
    good = df.where(qualified)
    return good.groupBy(*group).agg(F.count("*").alias("qualified")).join(exact_quantiles(good, group, grade, {"replacement": quantile}), group, "left").select(*group, "replacement", "qualified")


def weighted_units(chosen: DataFrame, keys: list[str], unit: str, weight: str, value: str, baseline: str, slots: dict[str, int]) -> DataFrame:
    """Per unit: weighted value, value over replacement and the share of its slots that are filled."""
    expected = reduce(lambda acc, kv: F.when(F.col(unit) == kv[0], kv[1]).otherwise(acc), slots.items(), F.lit(None).cast("int"))
    out = chosen.groupBy(*keys, unit).agg((F.sum(F.col(weight) * F.col(value)) / F.sum(weight)).alias("rating"), (F.sum(F.col(weight) * (F.col(value) - F.col(baseline))) / F.sum(weight)).alias("over_replacement"), F.count("*").alias("filled"))
    return out.withColumn("completeness", F.col("filled") / expected)


def pivot_units(units: DataFrame, keys: list[str], unit: str, rating: str, names: list[str], blends: dict[str, dict[str, float]]) -> DataFrame:
    """One row per key with a column per unit (a stated list: no job to find it) and weighted blends of them."""
    wide = units.groupBy(*keys).pivot(unit, names).agg(F.first(rating))
    return wide.withColumns({n: weighted_components(w)[0] for n, w in blends.items()})


def center_and_impute(df: DataFrame, group: list[str], values: list[str]) -> DataFrame:
    """Missing values by the group's median (none: 0), then the group's mean off."""
    w = Window.partitionBy(*group)
    d = df.join(medians(df, group, values, "_m_"), group, "left").withColumns({v: F.coalesce(F.col(v), F.col(f"_m_{v}"), F.lit(0.0)) for v in values})
    return d.withColumns({v: F.col(v) - F.avg(v).over(w) for v in values}).drop(*(f"_m_{v}" for v in values))


def strength_blend(df: DataFrame, parts: dict[str, float], continuity: str, confidence: str, most: float, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Weighted parts plus one continuity adjustment scaled by confidence and bounded; and an audit row for each component."""
    base, _ = weighted_components(parts)
    adjust = F.greatest(F.least((F.col(continuity) - 50) / 50 * most * F.col(confidence), F.lit(most)), F.lit(-most))
    out = df.withColumns({"base": base, "adjustment": adjust}).withColumn("strength", F.col("base") + F.col("adjustment"))
    rows = F.explode(F.array(*(F.struct(F.lit(p).alias("component"), F.col(p).cast("double").alias("value"), F.lit(w).alias("weight")) for p, w in parts.items()), F.struct(F.lit("continuity").alias("component"), F.col("adjustment").alias("value"), F.lit(1.0).alias("weight"))))
    return out, out.select(*keys, rows.alias("x")).select(*keys, "x.*")


def continuity(usage: DataFrame, season: str, team: str, player: str, snaps: str, starters: int = 5) -> DataFrame:
    """Against the season before: share of last season's snaps that came back, players in common, and retained pairs of the top five."""
    total = usage.withColumn("_t", F.sum(snaps).over(Window.partitionBy(season, team)))
    place = F.row_number().over(Window.partitionBy(season, team).orderBy(F.desc(snaps), player))
    d = total.withColumn("_top", (place <= starters).cast("int"))
    last = d.select((F.col(season) + 1).alias(season), team, player, (F.col(snaps) / F.col("_t")).alias("_share"), F.col("_top").alias("_last_top"))
    both = d.select(season, team, player, "_top").join(last, [season, team, player])
    kept = F.sum(F.col("_top") * F.col("_last_top"))
    return both.groupBy(season, team).agg(F.sum("_share").alias("returning_share"), F.count("*").alias("returning"), kept.alias("top_kept"), (kept * (kept - 1) / 2).cast("long").alias("pairs_kept"))


def share_overlap(a: DataFrame, b: DataFrame, keys: list[str], player: str, share: str) -> DataFrame:
    """Sum of the lesser over sum of the greater shares of two long share tables, and players at least half used before and hardly now."""
    j = a.select(*keys, player, F.col(share).alias("_a")).join(b.select(*keys, player, F.col(share).alias("_b")), [*keys, player], "full_outer").fillna(0.0, ["_a", "_b"])
    return j.groupBy(*keys).agg((F.sum(F.least("_a", "_b")) / F.sum(F.greatest("_a", "_b"))).alias("overlap"), F.count_if((F.col("_b") >= 0.5) & (F.col("_a") < 0.05)).alias("missing_core"))


def decayed_mean(window: DataFrame, keys: list[str], value: str, decay: float, prior_weight: float) -> DataFrame:
    """Mean over a prior window (see `prior_window`): decay to the age this season, prior_weight last season; rows without age are last season's."""
    w = F.when(F.col("age").isNotNull(), F.pow(F.lit(decay), F.col("age"))).otherwise(prior_weight)
    return window.groupBy(*keys).agg((F.sum(F.col(value) * w) / F.sum(w)).alias("mean"), F.sum(w).alias("weight"))


def game_matrix(games: DataFrame, metrics: list[str]) -> DataFrame:
    """Expected metric of each side: mean + own offence + other's defence, and the home advantage; rating columns carry home_/away_ and _off/_def."""
    out = games
    for m in metrics:
        home = F.col(f"{m}_mean") + F.col(f"home_{m}_off") + F.col(f"away_{m}_def")
        away = F.col(f"{m}_mean") + F.col(f"away_{m}_off") + F.col(f"home_{m}_def")
        out = out.withColumns({f"home_expected_{m}": home, f"away_expected_{m}": away, f"{m}_advantage": home - away})
    return out


def duplicate_audit(df: DataFrame, identity: str, canonical: str) -> DataFrame:
    return df.groupBy(identity).agg(F.count("*").alias("rows"), F.count_distinct(canonical).alias("canonicals")).where("rows > 1")


def canonical_rows(df: DataFrame, identity: str, preferred: dict[str, str], sets: list[str], season: str) -> DataFrame:
    """One row per identity: preferred values (least priority among non-null), sorted distinct sets joined by a pipe, the span of seasons."""
    return df.groupBy(identity).agg(
        *(F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(p, c))).alias(c) for c, p in preferred.items()),
        *(F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), "|").alias(f"all_{c}") for c in sets),
        F.min(season).alias("first_season"), F.max(season).alias("last_season"), F.count("*").alias("rows"),
    )
