"""Queries of the estimators.  Where a result needs a dense solve, the SQL states the Gram sums that it is solved from."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ratewright.operators import evaluate as E
from ratewright.operators import gates as G
from ratewright.operators import solve as S
from ratewright.plans.base import EV, PAIRS, PRED, events, games, predictions, query
from ratewright.sources.io import written


@query("two_way_ridge_ratings")
def _(spark, sf):
    ev = events(spark, sf).withColumn("epa", F.col("measure") / 10000)
    return S.two_way_ratings(ev, "offense", "defense", "epa").withColumn("coefficient", F.round("coefficient", 6))


@query("two_way_ridge_gram", "WITH " + EV + """, x AS (SELECT season, period, 'd:' || defense AS d, 'o:' || offense AS o, measure AS y FROM ev),
p AS (SELECT season, period, d AS i, d AS j, 1 AS v FROM x UNION ALL SELECT season, period, d, 'mean', 1 FROM x UNION ALL SELECT season, period, d, o, 1 FROM x UNION ALL SELECT season, period, d, '~y', y FROM x UNION ALL SELECT season, period, 'mean', 'mean', 1 FROM x UNION ALL SELECT season, period, 'mean', o, 1 FROM x UNION ALL SELECT season, period, 'mean', '~y', y FROM x UNION ALL SELECT season, period, o, o, 1 FROM x UNION ALL SELECT season, period, o, '~y', y FROM x)
SELECT season, period, i, j, sum(v)::DOUBLE AS v, count(*) AS n FROM p GROUP BY ALL""")
def _(spark, sf):
    g = S.two_way_gram(events(spark, sf), ["season", "period"], "offense", "defense", "measure")
    return g.where("not (i = '~y' and j = '~y')")


@query("paired_comparison_ratings")
def _(spark, sf):
    g = games(spark, sf).withColumn("m", F.col("margin") / 10000)
    return S.paired_ratings(g, ["season"], "home", "away", "m", 5.0).withColumn("coefficient", F.round("coefficient", 6))


@query("paired_comparison_gram", "WITH " + PAIRS + """, x AS (SELECT season, 't:' || home AS h, 't:' || away AS a, margin AS y FROM games), p AS (SELECT season, h AS i, h AS j, 1 AS v FROM x UNION ALL SELECT season, a, a, 1 FROM x UNION ALL SELECT season, least(h, a), greatest(h, a), -1 FROM x UNION ALL SELECT season, 'home', h, 1 FROM x UNION ALL SELECT season, 'home', a, -1 FROM x UNION ALL SELECT season, 'home', 'home', 1 FROM x UNION ALL SELECT season, 'home', '~y', y FROM x UNION ALL SELECT season, h, '~y', y FROM x UNION ALL SELECT season, a, '~y', -y FROM x)
SELECT season, i, j, sum(v)::DOUBLE AS v, count(*) AS n FROM p GROUP BY ALL""")
def _(spark, sf):
    return S.paired_gram(games(spark, sf), ["season"], "home", "away", "margin").where("i <> '~y'")


FEATURES = ["edge", "line", "model"]


def _gains(spark, sf):
    return predictions(spark, sf).withColumn("gain", (F.col("actual") - F.col("line")).cast("double"))


def _frame(spark, sf, missing=False):
    p = _gains(spark, sf)
    p = p.withColumn("model", F.when(F.col("team") % 6 != 0, F.col("model"))) if missing else p
    stats = S.feature_stats(p, FEATURES)
    return S.standardized(p, stats, FEATURES, missing=missing), stats, p


@query("process_margin_model")
def _(spark, sf):
    rows, stats, _ = _frame(spark, sf)
    decay = F.pow(F.lit(0.85), F.lit(2001) - F.col("season"))
    model = S.solve(S.linear_gram(rows, [], F.col("gain"), decay).withColumn("one", F.lit(1)), ["one"], 25.0, ("(1)",))
    scored = S.apply_linear(rows, model.drop("one"), [], "process_margin", 28.0)
    return scored.select("season", "period", "team", F.round("process_margin", 6).alias("process_margin"))


@query("process_feature_stats", "WITH " + PRED + """, l AS (UNPIVOT (SELECT edge, line, model FROM pred) ON edge, line, model INTO NAME feature VALUE value), q AS (SELECT feature, quantile_cont(value::DOUBLE, 0.5) AS median, quantile_cont(value::DOUBLE, 0.01) AS low, quantile_cont(value::DOUBLE, 0.99) AS high FROM l GROUP BY feature)
SELECT feature, round(any_value(median), 6) AS median, round(any_value(low), 6) AS low, round(any_value(high), 6) AS high, round(avg(greatest(least(value, high), low)), 6) AS mean, round(stddev_pop(greatest(least(value, high), low)), 6) AS sd FROM l JOIN q USING (feature) GROUP BY feature""")
def _(spark, sf):
    stats = S.feature_stats(predictions(spark, sf), FEATURES)
    return stats.select("feature", *(F.round(c, 6).alias(c) for c in ("median", "low", "high", "mean", "sd")))


@query("residual_ridge")
def _(spark, sf):
    rows, _, _ = _frame(spark, sf, missing=True)
    model = S.solve(S.linear_gram(rows, ["season"], F.col("gain")), ["season"], 50.0, ("(1)",))
    return model.withColumn("coefficient", F.round("coefficient", 6))


@query("season_forward_oof")
def _(spark, sf):
    oof = S.season_forward(_gains(spark, sf), FEATURES, "gain", [50.0], least_rows=50)
    return oof.select("season", "period", "team", "gain", F.round("predicted", 6).alias("predicted"))


@query("nested_grid_select")
def _(spark, sf):
    played = F.col("period") - 1

    def mixed(k, cap):
        current = F.least(played / (played + k), cap)
        return {"prior": F.col("model") * (1 - current), "current": F.col("line") * current}

    found = S.nested_grid_select(predictions(spark, sf), mixed, "actual", [3.0, 5.0, 8.0, 12.0], [0.65, 0.75, 0.85], [30.0, 100.0, 300.0, 1000.0], [140.0, 160.0, 180.0])
    return found.withColumn("mae", F.round("mae", 6))


@query("positive_ridge")
def _(spark, sf):
    rows, _, _ = _frame(spark, sf)
    return S.solve(S.linear_gram(rows, ["season"], F.col("gain"), intercept=False), ["season"], 10.0, nonnegative=True).withColumn("coefficient", F.round("coefficient", 6))


@query("zero_intercept_slope", "WITH " + PRED + """ SELECT round(CASE WHEN count(*) >= 30 THEN greatest(least(sum((1 + team % 2) * edge * (actual - line))::DOUBLE / (sum((1 + team % 2) * edge * edge) + 10.0::DOUBLE), 2.0), -2.0) ELSE 1.0 END, 9) AS slope, count(*) AS n FROM pred""")
def _(spark, sf):
    p = predictions(spark, sf).withColumn("gain", F.col("actual") - F.col("line"))
    return S.zero_intercept_slope(p, "edge", "gain", 1 + F.col("team") % 2, 10.0, -2.0, 2.0, 30).withColumn("slope", F.round("slope", 9))


@query("power_points", "WITH " + EV + """, s AS (SELECT season, offense AS team, sum(measure)::BIGINT AS v FROM ev GROUP BY ALL), p AS (SELECT season, team, greatest(least((v - avg(v) OVER (PARTITION BY season)) * 0.000002::DOUBLE, 14.0), -14.0) AS points FROM s) SELECT season, team, round(points, 6) AS points, (rank() OVER (PARTITION BY season ORDER BY points DESC))::INTEGER AS rank FROM p""")
def _(spark, sf):
    s = events(spark, sf).groupBy("season", F.col("offense").alias("team")).agg(F.sum("measure").alias("v"))
    centred = (F.col("v") - F.avg("v").over(Window.partitionBy("season"))) * 0.000002
    p = s.withColumn("points", F.greatest(F.least(centred, F.lit(14.0)), F.lit(-14.0)))
    return p.select("season", "team", F.round("points", 6).alias("points"), F.rank().over(Window.partitionBy("season").orderBy(F.desc("points"))).alias("rank"))


_BLEND = PRED + """, b AS (SELECT season, team, count(*) AS games, avg(edge) AS sp, avg(actual - line) AS sr, avg(CASE WHEN period > 6 THEN edge END) AS rp, avg(CASE WHEN period > 6 THEN actual - line END) AS rr, (team % 9)::DOUBLE AS pre FROM pred GROUP BY ALL), f AS (SELECT season, team, pre, least(games / (games + 5.0::DOUBLE), 0.6) AS fw, 0.7::DOUBLE * (0.7::DOUBLE * sp + (1 - 0.7::DOUBLE) * rp) + (1 - 0.7::DOUBLE) * (0.7::DOUBLE * sr + (1 - 0.7::DOUBLE) * rr) AS form FROM b WHERE rp IS NOT NULL)"""


def _blend(spark, sf):
    p = predictions(spark, sf).withColumn("gain", F.col("actual") - F.col("line"))
    late = F.col("period") > 6
    b = p.groupBy("season", "team").agg(F.count("*").alias("games"), F.avg("edge").alias("season_process"), F.avg("gain").alias("season_result"), F.avg(F.when(late, F.col("edge"))).alias("recent_process"), F.avg(F.when(late, F.col("gain"))).alias("recent_result"))
    return S.form_blend(b.where("recent_process is not null").withColumn("preseason", (F.col("team") % 9).cast("double")), 0.7, 0.7, 5.0, 0.6)


@query("live_form_blend", "WITH " + _BLEND + """ SELECT season, team, round(form, 6) AS form, round(fw, 9) AS form_weight, round(pre * (1 - fw) + form * fw, 6) AS rating FROM f""")
def _(spark, sf):
    return _blend(spark, sf).select("season", "team", F.round("form", 6).alias("form"), F.round("form_weight", 9).alias("form_weight"), F.round("rating", 6).alias("rating"))


_TRANSITION = PRED + """, """ + PAIRS + """,
c AS (SELECT *, count(*) OVER (PARTITION BY season, team ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS g FROM pred),
tg AS (SELECT home AS team, season, period, make_date(season, period, 1 + (home + away) % 28) AS d, 0 AS is_away FROM games UNION ALL SELECT away, season, period, make_date(season, period, 1 + (home + away) % 28), 1 FROM games),
one AS (SELECT team, season, d, max(is_away) AS is_away FROM tg GROUP BY ALL),
f AS (SELECT team, season, d, date_diff('day', lag(d) OVER w, d) AS rest, (is_away = 1 AND lag(is_away) OVER w = 1)::INTEGER AS b2b,
    (sum(is_away) OVER (PARTITION BY team, season ORDER BY d ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) >= 3)::INTEGER AS three FROM one WINDOW w AS (PARTITION BY team, season ORDER BY d)),
x AS (SELECT season, period, home, away, h.line AS hl, a.line AS al, h.edge AS he, a.edge AS ae, least(h.g / (h.g + 3.0::DOUBLE), 0.65) AS hw, least(a.g / (a.g + 3.0::DOUBLE), 0.65) AS aw,
    coalesce(hf.rest, 7) - coalesce(af.rest, 7) AS rest, coalesce(af.b2b, 0) + coalesce(af.three, 0) AS burden
  FROM (SELECT *, make_date(season, period, 1 + (home + away) % 28) AS d FROM games) m JOIN c h USING (season, period) JOIN c a USING (season, period)
  LEFT JOIN f hf ON hf.team = m.home AND hf.season = m.season AND hf.d = m.d LEFT JOIN f af ON af.team = m.away AND af.season = m.season AND af.d = m.d WHERE h.team = home AND a.team = away)
"""


@query("transition_features", "WITH " + _TRANSITION + """ SELECT season, period, home, away, round((1 - hw) * hl - (1 - aw) * al, 6) + 0.0::DOUBLE AS prior_line, round(hw * hl - aw * al, 6) + 0.0::DOUBLE AS current_line, round(hw * he - aw * ae, 6) + 0.0::DOUBLE AS form_edge,
  1.0::DOUBLE AS home_field, greatest(least(rest, 7), -7)::DOUBLE AS rest_advantage, burden::DOUBLE AS schedule_burden FROM x""")
def _(spark, sf):
    from ratewright.operators import features as FT
    from ratewright.operators import windows as W
    from ratewright.operators.joins import attach_two_sided

    n = F.count("*").over(Window.partitionBy("season", "team").orderBy("period").rowsBetween(Window.unboundedPreceding, -1))
    sides = predictions(spark, sf).withColumn("games", n).select("season", "period", "team", "games", "line", "edge")
    g = games(spark, sf).select("season", "period", "home", "away", F.make_date("season", "period", 1 + (F.col("home") + F.col("away")) % 28).alias("d"))
    both = g.select(F.col("home").alias("team"), "season", "d", F.lit(0).alias("is_away")).unionByName(g.select(F.col("away").alias("team"), "season", "d", F.lit(1).alias("is_away")))
    schedule = W.schedule_factors(both.groupBy("team", "season", "d").agg(F.max("is_away").alias("is_away")), "team", "d", "is_away", "season")
    schedule = schedule.select("team", "season", "d", F.col("rest_days").alias("rest"), "back_to_back", (F.col("road_last4") >= 3).cast("int").alias("three_of_four"))
    x = attach_two_sided(attach_two_sided(g, sides, ["season", "period"], "team"), schedule, ["season", "d"], "team").where("home_games is not null and away_games is not null")
    x = x.withColumns({"back_to_back": F.col("away_back_to_back"), "three_of_four": F.col("away_three_of_four")} | {c: F.lit(None).cast("double") for c in ("neutral", "travel_miles", "far", "west_east")})
    out = FT.transition_features(x, ["line"], 3.0, 0.65, ("edge",))
    return out.select("season", "period", "home", "away", *((F.round(c, 6) + 0.0).alias(c) for c in ("prior_line", "current_line", "form_edge")), "home_field", "rest_advantage", "schedule_burden")


_CONS = PRED + """, c AS (SELECT season, period, team, actual - line AS gain, edge::DOUBLE AS a, (line - 150)::DOUBLE AS b, CASE WHEN team % 4 <> 0 THEN (model % 9 - 4)::DOUBLE END AS d FROM pred), x AS (SELECT *, list_sort(list_filter([a, b, d], lambda v: v IS NOT NULL)) AS l FROM c),
e AS (SELECT season, period, team, gain, list_avg(l) AS mean, list_median(l) AS median, list_max(l) - list_min(l) AS "range", greatest(len(list_filter(l, lambda v: v > 0)), len(list_filter(l, lambda v: v < 0)))::INTEGER AS agreement, list_stddev_pop(l) AS sd FROM x)"""


def _consensus(spark, sf):
    p = predictions(spark, sf)
    c = p.select("season", "period", "team", (F.col("actual") - F.col("line")).alias("gain"), F.col("edge").cast("double").alias("a"), (F.col("line") - 150).cast("double").alias("b"), F.when(F.col("team") % 4 != 0, (F.col("model") % 9 - 4).cast("double")).alias("d"))
    return S.consensus(c, ["a", "b", "d"])


@query("consensus_ensemble", "WITH " + _CONS + """ SELECT season, period, team, round(mean, 6) AS mean, round(median, 6) AS median, round("range", 6) AS "range", round(sd, 6) AS sd, agreement FROM e""")
def _(spark, sf):
    return _consensus(spark, sf).select("season", "period", "team", *(F.round(c, 6).alias(c) for c in ("mean", "median", "range", "sd")), "agreement")


GATES = [("mean", 2.0, 60.0, 2), ("mean", 5.0, 90.0, 2), ("median", 2.0, 60.0, 3), ("median", 8.0, 120.0, 2)]
_GATE = _CONS + """, gates(gate, en, t, r, ag) AS (VALUES (0, 'mean', 2.0, 60.0, 2), (1, 'mean', 5.0, 90.0, 2), (2, 'median', 2.0, 60.0, 3), (3, 'median', 8.0, 120.0, 2)), gp AS (SELECT gate::INTEGER AS gate, season, gain * sign(CASE WHEN en = 'mean' THEN mean ELSE median END) AS res FROM e, gates WHERE abs(CASE WHEN en = 'mean' THEN mean ELSE median END) >= t AND "range" <= r AND agreement >= ag),
gs AS (SELECT gate, season, count(CASE WHEN res > 0 THEN 1 END) AS wins, count(CASE WHEN res < 0 THEN 1 END) AS losses, count(CASE WHEN res = 0 THEN 1 END) AS pushes FROM gp GROUP BY ALL)"""


def _gate_stats(spark, sf):
    return G.gate_stats(_consensus(spark, sf), GATES, "season", {"mean": "mean", "median": "median"})


@query("gate_grid", "WITH " + _GATE + " SELECT * FROM gs")
def _(spark, sf):
    return _gate_stats(spark, sf)


@query("walk_forward_gate", "WITH " + _GATE + """, past AS (SELECT s.season, gate, sum(wins)::DOUBLE + 25 AS a, sum(losses)::DOUBLE + 25 AS b FROM (SELECT DISTINCT season FROM gs WHERE season >= 1997) s JOIN gs ON gs.season < s.season GROUP BY ALL HAVING sum(wins) + sum(losses) >= 20),
sc AS (SELECT season, gate, a / (a + b) - 0.5::DOUBLE * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS score FROM past), b AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY season ORDER BY score DESC, gate) = 1)
SELECT b.season, b.gate, round(score, 9) AS score, coalesce(wins, 0)::BIGINT AS wins, coalesce(losses, 0)::BIGINT AS losses, coalesce(pushes, 0)::BIGINT AS pushes FROM b LEFT JOIN gs USING (season, gate)""")
def _(spark, sf):
    return G.walk_forward(_gate_stats(spark, sf), "season", 1997, 20).withColumn("score", F.round("score", 9))


_SUM = PRED + """, c AS (SELECT 'model' AS name, actual - line AS y, model - line AS x, season FROM pred UNION ALL SELECT 'flat', actual - line, 150 - line, season FROM pred UNION ALL SELECT 'half', actual - line, (150 - line) * 0.5, season FROM pred), s AS (SELECT name, corr(y, x) AS correlation, sqrt(avg(((y - x) * (y - x))::DOUBLE)) AS rmse, 0.9::DOUBLE AS stability FROM c GROUP BY name)"""


def _summary(spark, sf):
    p = predictions(spark, sf)
    y = (F.col("actual") - F.col("line")).alias("y")
    c = p.select(F.lit("model").alias("name"), y, (F.col("model") - F.col("line")).cast("double").alias("x"))
    c = c.unionByName(p.select(F.lit("flat").alias("name"), y, (150 - F.col("line")).cast("double").alias("x"))).unionByName(p.select(F.lit("half").alias("name"), y, ((150 - F.col("line")) * 0.5).alias("x")))
    return c.groupBy("name").agg(F.corr("y", "x").alias("correlation"), F.sqrt(F.avg((F.col("y") - F.col("x")) * (F.col("y") - F.col("x")))).alias("rmse"), F.lit(0.9).alias("stability"))


@query("candidate_selection", "WITH " + _SUM + """, d AS (SELECT s.*, s.correlation - k.correlation AS cg, k.rmse - s.rmse AS rg FROM s, (SELECT * FROM s WHERE name = 'model') k), e AS (SELECT *, name <> 'model' AND round(cg, 9) > 0 AND rg >= 0 AND stability >= 0.75 AS eligible FROM d)
SELECT name, round(correlation, 6) AS correlation, round(rmse, 6) AS rmse, eligible, CASE WHEN eligible THEN (row_number() OVER (PARTITION BY eligible ORDER BY round(correlation, 6) DESC, round(rmse, 6), name))::INTEGER END AS place FROM e""")
def _(spark, sf):
    s = _summary(spark, sf).withColumns({"correlation": F.round("correlation", 6), "rmse": F.round("rmse", 6)})
    return G.candidate_choice(s, "model", "name", 0.75).select("name", "correlation", "rmse", "eligible", "place")


@query("promotion_gates", "WITH " + _SUM + """ SELECT name, coalesce(correlation >= 0.1, false) AS correlation_passed, coalesce(stability >= 0.8, false) AS stability_passed, coalesce(correlation >= 0.1, false) AND coalesce(stability >= 0.8, false) AS promoted FROM s""")
def _(spark, sf):
    return G.promotion(_summary(spark, sf), {"correlation": 0.1, "stability": 0.8}).select("name", "correlation_passed", "stability_passed", "promoted")


@query("residual_calibration", "WITH " + PRED + """ SELECT season, round(avg(actual - model), 6) AS residual_mean, round(stddev_pop(actual - model), 6) AS sigma, count(*) AS n FROM pred GROUP BY season""")
def _(spark, sf):
    r = F.col("actual") - F.col("model")
    return predictions(spark, sf).groupBy("season").agg(F.round(F.avg(r), 6).alias("residual_mean"), F.round(F.stddev_pop(r), 6).alias("sigma"), F.count("*").alias("n"))


@query("phase_switch_predict", "WITH " + PRED + """ SELECT season, period, team, round(CASE WHEN period <= 9 THEN 0.5::DOUBLE * edge + 1.0 ELSE (1 - 0.25::DOUBLE) * (0.5::DOUBLE * edge + 1.0) + 0.25::DOUBLE * (0.125::DOUBLE * edge - 2.0) END, 9) AS predicted FROM pred""")
def _(spark, sf):
    from ratewright.operators.phases import phase_switch

    coefs = spark.createDataFrame([("A", "edge", 0.5), ("A", "(1)", 1.0), ("B", "edge", 0.125), ("B", "(1)", -2.0)], "model string, term string, coefficient double")
    rows = predictions(spark, sf).withColumn("_terms", F.array(S.term("edge", F.col("edge"))))
    return phase_switch(rows, coefs, "period", 9, 0.25).select("season", "period", "team", F.round("predicted", 9).alias("predicted"))


@query("boosted_margin")
def _(spark, sf):
    from ratewright.operators.phases import boosted

    p = predictions(spark, sf).withColumn("gain", (F.col("actual") - F.col("line")).cast("double"))
    return boosted(p, FEATURES, "gain", "season", 2000).select("season", "period", "team", "predicted")


@query("boosted_grid_select")
def _(spark, sf):
    from ratewright.operators import boosting

    p = predictions(spark, sf).withColumn("gain", (F.col("actual") - F.col("line")).cast("double"))
    settings = [boosting.Setting(leaves, l2, cap) for leaves in (7, 15) for l2 in (10.0, 100.0) for cap in (21.0, 35.0)]
    return boosting.grid_select(p, FEATURES, "gain", settings).withColumn("mae", F.round("mae", 6))


@query("live_matchup_features")
def _(spark, sf):
    ev = written(events(spark, sf).select("season", "period", "offense", "defense", "player", "volume", "measure"))  # its joins are made once for all that reads it
    ev = ev.withColumn("epa", F.col("measure") / 10000)
    ratings = S.two_way_ratings(ev, "offense", "defense", "epa")
    wide = ratings.where("term <> 'mean'").select("grid_season", "grid_period", F.substring("term", 1, 1).alias("side"), F.expr("cast(substring(term, 3) as int)").alias("team"), "coefficient")
    wide = wide.groupBy("grid_season", "grid_period", "team").pivot("side", ["o", "d"]).agg(F.first("coefficient"))
    g = games(spark, sf, ev).select(F.col("season").alias("grid_season"), F.col("period").alias("grid_period"), "home", "away")
    from ratewright.operators import features as FT
    from ratewright.operators.joins import attach_two_sided

    rated = attach_two_sided(g, wide, ["grid_season", "grid_period"], "team")
    facts = FT.personnel(ev.select(F.col("season").alias("grid_season"), F.col("period").alias("grid_period"), F.col("offense").alias("team"), "player", "volume", "epa"), ["grid_season", "team"], "grid_period", "player", "volume", "epa", core=0.01)
    sides = g.select("grid_season", "grid_period", F.explode(F.array("home", "away")).alias("team"))
    out = FT.personnel_advantages(rated, FT.personnel_before(sides, facts, ["grid_season", "team"], "grid_period"), "grid_season", "grid_period", "team")
    return out.withColumn("process_advantage", F.col("home_o") + F.col("away_d") - F.col("away_o") - F.col("home_d"))


@query("scenario_rescore", "WITH " + PRED + """ SELECT season, period, team, round(0.5::DOUBLE * edge + 0.25::DOUBLE * line, 6) AS baseline, round(0.5::DOUBLE * edge + 0.25::DOUBLE * CASE WHEN team % 5 = 0 THEN line + 4 ELSE line END, 6) AS scenario, CASE WHEN team % 5 = 0 THEN 1.0::DOUBLE ELSE 0.0 END AS delta, CASE WHEN team % 5 = 0 THEN 'line' ELSE '' END AS reasons FROM pred""")
def _(spark, sf):
    from ratewright.operators.phases import rescore

    p = predictions(spark, sf)
    patch = p.where("team % 5 = 0").select("season", "period", "team", (F.col("line") + 4).alias("line"))
    out = rescore(p, patch, ["season", "period", "team"], {"edge": 0.5, "line": 0.25}, ["line"])
    return out.select("season", "period", "team", *(F.round(c, 6).alias(c) for c in ("baseline", "scenario", "delta")), "reasons")


@query("walkforward_replay")
def _(spark, sf):
    """Ratings before every week predict its games, which are then graded: one plan over the grid."""
    g = games(spark, sf).withColumn("m", F.col("margin") / 10000)
    cells = S.paired_gram(g, ["season", "period"], "home", "away", "m")
    r = S.solve(S.prior_grams(cells, g), ["grid_season", "grid_period"], 5.0, ("home",), 20, center=("t:",))
    field = r.where("term = 'home'").select(F.col("grid_season").alias("season"), F.col("grid_period").alias("period"), F.col("coefficient").alias("field"))
    team = r.where("term like 't:%'").select(F.col("grid_season").alias("season"), F.col("grid_period").alias("period"), F.expr("cast(substring(term, 3) as int)").alias("team"), F.col("coefficient").alias("rating"))
    from ratewright.operators.joins import attach_two_sided

    x = attach_two_sided(g.select("season", "period", "home", "away", "m"), team, ["season", "period"], "team").join(field, ["season", "period"], "left")
    x = x.withColumns({"predicted": F.col("home_rating") - F.col("away_rating") + F.col("field"), "line": F.lit(0.0)})
    return E.grade(x.withColumn("edge", F.col("predicted")), "edge", "m", "line", F.lit(-110)).select("season", "period", "home", "away", "m", "predicted", "result", "profit")


