"""Queries of the voting and evaluation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratewright.functions import clean as C
from ratewright.operators import evaluate as E
from ratewright.operators import votes as V
from ratewright.plans.base import PRED, predictions, query, table
from ratewright.plans.q_scalar import phi_sql

_READ = """r AS (SELECT user_id % 40 AS game, CAST(ts AS DATE) AS day, event_type AS mode, round(value / 50) * 0.5 AS v FROM events), cnt AS (SELECT game, day, v, count(*) AS votes FROM r GROUP BY ALL),
k AS (SELECT *, row_number() OVER w AS rn, coalesce(lead(votes) OVER w, 0) AS second, count(*) OVER (PARTITION BY game, day) AS "values" FROM cnt WINDOW w AS (PARTITION BY game, day ORDER BY votes DESC, v)),
voted AS (SELECT game, day, CASE WHEN "values" = 1 THEN 'unanimous' WHEN votes >= 2 AND votes > second THEN 'majority' ELSE 'conflict' END AS status, CASE WHEN "values" = 1 OR (votes >= 2 AND votes > second) THEN v END AS v, votes, second, "values" FROM k WHERE rn = 1)"""


def _readings(spark, sf):
    return table(spark, sf, "events").select((F.col("user_id") % 40).alias("game"), F.to_date("ts").alias("day"), F.col("event_type").alias("mode"), (F.round(F.col("value") / 50) * 0.5).alias("v"))


@query("majority_vote", "WITH " + _READ + " SELECT * FROM voted")
def _(spark, sf):
    return V.majority_vote(_readings(spark, sf), ["game", "day"], "v")


@query("line_finalize", "WITH " + _READ + """, s AS (SELECT DISTINCT game, day, CASE WHEN game % 7 <> 0 THEN 3.0 END::DOUBLE AS reference FROM r), f AS (SELECT s.*, CASE WHEN s.game % 11 = 0 THEN 9.5::DOUBLE END AS m, voted.v AS vv FROM s LEFT JOIN voted USING (game, day)), l AS (SELECT game, day, reference, coalesce(m, vv, reference) AS v, CASE WHEN m IS NOT NULL THEN 'manual' WHEN vv IS NOT NULL THEN 'voted' WHEN reference IS NOT NULL THEN 'fallback' ELSE 'missing' END AS src FROM f)
SELECT day, count(*) AS games, sum((src IN ('manual', 'voted'))::INTEGER)::BIGINT AS strict, count(CASE WHEN src = 'missing' THEN 1 END) AS missing, count(CASE WHEN src = 'missing' THEN 1 END) = 0 AS complete FROM l GROUP BY day""")
def _(spark, sf):
    r = _readings(spark, sf)
    schedule = r.select("game", "day").distinct().withColumn("reference", F.when(F.col("game") % 7 != 0, 3.0))
    manual = schedule.where("game % 11 = 0").select("game", "day", F.lit(9.5).alias("v"))
    return V.coverage(V.finalize_lines(schedule, V.majority_vote(r, ["game", "day"], "v"), manual, ["game", "day"], "v", "reference"), ["day"])


@query("half_point_tie_recovery", """WITH r AS (SELECT user_id AS game, event_type AS mode, floor(event_id / 7) % 9 AS slot, (user_id % 10) + CASE WHEN event_type IN ('click', 'view') THEN 0.5 ELSE 0.0 END::DOUBLE AS v FROM events),
t AS (SELECT game, slot, count(DISTINCT v) AS n, max(v) - min(v) AS gap, count(DISTINCT CASE WHEN v <> floor(v) THEN mode END) AS hm, count(CASE WHEN v = floor(v) THEN 1 END) AS nw, count(CASE WHEN v <> floor(v) THEN 1 END) AS nh FROM r GROUP BY ALL)
SELECT r.game, r.slot::BIGINT AS slot, r.v, count(*) AS readings, sum((n = 2 AND gap = 0.5 AND nw = nh AND hm >= 2 AND v = floor(v))::INTEGER)::BIGINT AS rejected FROM r JOIN t USING (game, slot) GROUP BY ALL""")
def _(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("game"), F.col("event_type").alias("mode"), (F.floor(F.col("event_id") / 7) % 9).alias("slot"), ((F.col("user_id") % 10) + F.when(F.col("event_type").isin("click", "view"), 0.5).otherwise(0.0)).alias("v"))
    return V.half_point_recovery(e, ["game", "slot"], "v", "mode").groupBy("game", "slot", "v").agg(F.count("*").alias("readings"), F.sum("rejected").alias("rejected"))


@query("manual_adjustments", """SELECT user_id AS team, greatest(least(sum(CASE WHEN event_type = 'error' THEN -0.5 ELSE 0.25 END), 3.0), -3.0)::DOUBLE AS adjustment, array_to_string(list_sort(list(DISTINCT event_type)), '; ') AS reasons, count(*) AS entries FROM events WHERE event_id % 3 = 0 GROUP BY user_id""")
def _(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("team"), F.when(F.col("event_type") == "error", -0.5).otherwise(0.25).alias("points"), "event_type", (F.col("event_id") % 3 == 0).cast("int").alias("active"))
    return V.manual_adjustments(e, ["team"], "points", "event_type", "active", 3.0)


@query("correlation_audit", "WITH " + PRED + """ SELECT coalesce(season::VARCHAR, 'ALL') AS scope, round(corr(edge, actual - line), 6) AS correlation, count(CASE WHEN sign(edge) = sign(actual - line) THEN 1 END) AS same_sign, count(*) AS n FROM pred GROUP BY ROLLUP (season)""")
def _(spark, sf):
    p = predictions(spark, sf).withColumn("gain", F.col("actual") - F.col("line"))
    out = E.scoped(p, "season", [F.corr("edge", "gain").alias("correlation"), F.count_if(F.signum("edge") == F.signum("gain")).alias("same_sign"), F.count("*").alias("n")])
    return out.withColumn("correlation", F.round("correlation", 6))


_GRADED = PRED + """, g AS (SELECT *, sign(edge)::INTEGER AS side, (actual - line) * sign(edge)::INTEGER AS cover_margin, CASE WHEN edge = 0 THEN 'N' WHEN (actual - line) * sign(edge) > 0 THEN 'W' WHEN (actual - line) * sign(edge) < 0 THEN 'L' ELSE 'P' END AS result FROM pred),
gr AS (SELECT *, CASE result WHEN 'W' THEN 100.0::DOUBLE / 110 WHEN 'L' THEN -1.0 ELSE 0.0 END AS profit FROM g)"""


def graded(spark, sf):
    return E.grade(predictions(spark, sf), "edge", "actual", "line", F.lit(-110), "model")


@query("grade_outcomes", "WITH " + _GRADED + """ SELECT season, period, team, side, cover_margin, result, round(profit, 9) AS profit, CASE result WHEN 'W' THEN 1.0 WHEN 'P' THEN 0.5 ELSE 0.0 END::DOUBLE AS points, ((model - line) * side) AS closing_value FROM gr""")
def _(spark, sf):
    return graded(spark, sf).select("season", "period", "team", "side", "cover_margin", "result", F.round("profit", 9).alias("profit"), "points", "closing_value")


_RECORD = """count(CASE WHEN result <> 'N' THEN 1 END) AS bets, count(CASE WHEN result = 'W' THEN 1 END) AS wins, count(CASE WHEN result = 'L' THEN 1 END) AS losses, count(CASE WHEN result = 'P' THEN 1 END) AS pushes, round(sum(profit), 6) AS profit"""


@query("scoped_summary", "WITH " + _GRADED + f""" SELECT coalesce(season::VARCHAR, 'ALL') AS scope, {_RECORD} FROM gr GROUP BY ROLLUP (season)""")
def _(spark, sf):
    return E.scoped(graded(spark, sf), "season", E.record()).withColumn("profit", F.round("profit", 6))


@query("threshold_grid", "WITH " + _GRADED + f""" SELECT season, threshold::DOUBLE AS threshold, {_RECORD} FROM gr, (VALUES (2.0), (5.0), (10.0), (25.0)) AS t(threshold) WHERE abs(edge) >= threshold GROUP BY ALL""")
def _(spark, sf):
    return E.threshold_grid(graded(spark, sf), "edge", [2.0, 5.0, 10.0, 25.0], ["season"]).withColumn("profit", F.round("profit", 6))


_PERF = _GRADED + f""", run AS (SELECT *, sum(profit) OVER (PARTITION BY season ORDER BY period, team ROWS UNBOUNDED PRECEDING) AS running FROM gr WHERE result <> 'N'), pk AS (SELECT *, max(running) OVER (PARTITION BY season ORDER BY period, team ROWS UNBOUNDED PRECEDING) AS peak FROM run),
s AS (SELECT season, {_RECORD}, round(corr(edge, actual - line), 6) AS correlation, round(max(peak - running), 6) AS max_drawdown, sum(profit) AS raw FROM pk GROUP BY season), z AS (SELECT *, (wins + losses)::DOUBLE AS n, wins / (wins + losses)::DOUBLE AS p FROM s WHERE wins + losses > 0)"""


@query("performance_summary", "WITH " + _PERF + """ SELECT season, bets, wins, losses, pushes, profit, correlation, max_drawdown, round(p, 6) AS win_rate, round(raw / bets, 6) AS roi, round((p + 1.96::DOUBLE * 1.96 / (2 * n) - 1.96::DOUBLE * sqrt(p * (1 - p) / n + 1.96::DOUBLE * 1.96 / (4 * n * n))) / (1 + 1.96::DOUBLE * 1.96 / n), 6) AS wilson_low FROM z""")
def _(spark, sf):
    g = graded(spark, sf).withColumn("gain", F.col("actual") - F.col("line"))
    out = E.performance(g, ["season"], [F.col("period"), F.col("team")], "edge", "gain").where("wins + losses > 0")
    return out.select("season", "bets", "wins", "losses", "pushes", *(F.round(c, 6).alias(c) for c in ("profit", "correlation", "max_drawdown", "win_rate", "roi", "wilson_low")))


_PROB = _GRADED + f""", pr AS (SELECT *, {phi_sql("(abs(edge) / 40)")} AS p FROM gr WHERE result IN ('W', 'L'))"""


def _probabilities(spark, sf):
    return graded(spark, sf).where("result in ('W', 'L')").withColumn("p", C.normal_cdf(F.abs("edge") / 40))


@query("calibration_bins", "WITH " + _PROB + """ SELECT CASE WHEN p <= 0.55 THEN 0 WHEN p <= 0.65 THEN 1 WHEN p <= 0.8 THEN 2 ELSE 3 END AS bin, count(*) AS n, round(avg(p), 6) AS predicted, round(avg((result = 'W')::INTEGER), 6) AS realised, round(avg((result = 'W')::INTEGER) - avg(p), 6) AS gap FROM pr GROUP BY 1""")
def _(spark, sf):
    out = E.calibration(_probabilities(spark, sf), "p", F.col("result") == "W", [0.55, 0.65, 0.8])
    return out.select("bin", "n", *(F.round(c, 6).alias(c) for c in ("predicted", "realised", "gap")))


@query("brier_logloss", "WITH " + _PROB + """ SELECT season, round(avg(pow(p - (result = 'W')::INTEGER, 2)), 6) AS brier, round(-avg((result = 'W')::INTEGER * ln(least(greatest(p, 1e-6), 1 - 1e-6)) + (1 - (result = 'W')::INTEGER) * ln(1 - least(greatest(p, 1e-6), 1 - 1e-6))), 6) AS log_loss FROM pr GROUP BY season""")
def _(spark, sf):
    b, l = E.brier_logloss("p", F.col("result") == "W")
    return _probabilities(spark, sf).groupBy("season").agg(F.round(b, 6).alias("brier"), F.round(l, 6).alias("log_loss"))


@query("error_metrics", "WITH " + PRED + """ SELECT season, round(sqrt(avg(((actual - model) * (actual - model))::DOUBLE)), 6) AS rmse, round(avg(abs(actual - model)), 6) AS mae, round(corr(actual, model), 6) AS correlation, count(*) AS n FROM pred GROUP BY season""")
def _(spark, sf):
    out = predictions(spark, sf).groupBy("season").agg(*E.errors("actual", "model"))
    return out.select("season", *(F.round(c, 6).alias(c) for c in ("rmse", "mae", "correlation")), "n")


@query("stake_ledger", "WITH " + _GRADED + """, st AS (SELECT *, least(abs(edge) * 0.0005, 0.05)::DOUBLE * 10000 AS stake FROM gr), n AS (SELECT *, CASE result WHEN 'W' THEN stake * (100.0::DOUBLE / 110) WHEN 'L' THEN -stake ELSE 0 END AS net FROM st), r AS (SELECT *, sum(net) OVER (PARTITION BY season ORDER BY period, team ROWS UNBOUNDED PRECEDING) AS running FROM n), p AS (SELECT *, max(running) OVER (PARTITION BY season ORDER BY period, team ROWS UNBOUNDED PRECEDING) AS peak FROM r)
SELECT season, round(sum(net), 4) AS net, round(sum(CASE result WHEN 'W' THEN 50 * (100.0::DOUBLE / 110) WHEN 'L' THEN -50 ELSE 0 END), 4) AS flat_net, round(max((peak - running) / (peak + 10000)), 6) AS worst FROM p GROUP BY season""")
def _(spark, sf):
    g = graded(spark, sf).withColumn("kelly", F.least(F.abs("edge") * 0.0005, F.lit(0.05)))
    d = E.stake_ledger(g, ["season"], [F.col("period"), F.col("team")], 50.0, "kelly", 10000.0, F.lit(-110))
    return d.groupBy("season").agg(F.round(F.sum("fraction_net"), 4).alias("net"), F.round(F.sum("flat_net"), 4).alias("flat_net"), F.round(F.max("drawdown_share"), 6).alias("worst"))


@query("compare_baseline", "WITH " + _GRADED + """, s AS (SELECT season, count(CASE WHEN result = 'W' THEN 1 END)::DOUBLE AS wins, count(CASE WHEN result = 'L' THEN 1 END)::DOUBLE AS losses FROM gr GROUP BY season), u AS (SELECT season, 'wins' AS metric, wins AS v FROM s UNION ALL SELECT season, 'losses', losses FROM s)
SELECT a.season, a.metric, a.v AS "new", b.v AS "old", a.v - b.v AS change FROM u a LEFT JOIN u b ON b.season + 1 = a.season AND b.metric = a.metric""")
def _(spark, sf):
    s = graded(spark, sf).groupBy("season").agg(F.count_if(F.col("result") == "W").alias("wins"), F.count_if(F.col("result") == "L").alias("losses"))
    return E.compare(s, s.withColumn("season", F.col("season") + 1), ["season"], ["wins", "losses"])


@query("histogram_pmf", "WITH " + PRED + """, c AS (SELECT greatest(least(actual - line, 40), -40)::INTEGER AS margin, count(*) AS n FROM pred GROUP BY 1), s AS (SELECT unnest(range(-40, 41))::INTEGER AS margin) SELECT margin, coalesce(n, 0)::BIGINT AS n, round((coalesce(n, 0) + 0.5::DOUBLE) / ((SELECT count(*) FROM pred) + 0.5 * 81), 9) AS p FROM s LEFT JOIN c USING (margin)""")
def _(spark, sf):
    p = predictions(spark, sf).select((F.col("actual") - F.col("line")).alias("m"))
    return E.smoothed_pmf(p, "m", -40, 40, 0.5).withColumn("p", F.round("p", 9))


@query("coefficient_stability", "WITH " + PRED + """, f AS (SELECT team AS term, season, sum(edge * (actual - line))::DOUBLE / nullif(sum(edge * edge), 0)::DOUBLE AS c FROM pred GROUP BY ALL), s AS (SELECT term, count(*) AS folds, greatest(count(CASE WHEN c > 0 THEN 1 END), count(CASE WHEN c < 0 THEN 1 END)) / count(*)::DOUBLE AS sign_stability, avg(abs(c)) AS mean_abs FROM f GROUP BY term) SELECT term, folds, round(sign_stability, 9) AS sign_stability, round(mean_abs, 6) AS mean_abs, round(mean_abs / max(mean_abs) OVER (), 6) AS material FROM s""")
def _(spark, sf):
    p = predictions(spark, sf)
    f = p.groupBy(F.col("team").alias("term"), "season").agg((F.sum(F.col("edge") * (F.col("actual") - F.col("line"))) / F.nullif(F.sum(F.col("edge") * F.col("edge")), F.lit(0))).alias("c"))
    return E.stability(f, "term", "c").select("term", "folds", *(F.round(x, k).alias(x) for x, k in (("sign_stability", 9), ("mean_abs", 6), ("material", 6))))


@query("feature_integrity", "WITH " + PRED + """, x AS (SELECT CASE WHEN team % 6 <> 0 THEN edge END AS f, season, period FROM pred), s AS (SELECT 'ALL' AS scope, f FROM x UNION ALL SELECT 'late', f FROM x WHERE period > 9 UNION ALL SELECT 'first', f FROM x WHERE season = 1995), a AS (SELECT scope, count(*) AS rows, count(f) / count(*)::DOUBLE AS coverage, coalesce(stddev_pop(f), 0) AS sd, count(CASE WHEN f <> 0 THEN 1 END) AS nonzero FROM s GROUP BY scope)
SELECT scope, rows, round(coverage, 9) AS coverage, round(sd, 6) AS sd, nonzero, (coverage >= 0.8 AND sd >= 1.0 AND nonzero > 0) AS passed FROM a""")
def _(spark, sf):
    x = predictions(spark, sf).withColumn("f", F.when(F.col("team") % 6 != 0, F.col("edge")))
    out = E.integrity(x, {"ALL": F.lit(True), "late": F.col("period") > 9, "first": F.col("season") == 1995}, "f", 0.8, 1.0)
    return out.withColumns({"coverage": F.round("coverage", 9), "sd": F.round("sd", 6)})


@query("noise_pooling", "WITH " + PRED + """, s AS (SELECT season, count(*) AS games, sqrt(avg(((actual - line) * (actual - line))::DOUBLE)) AS rmse FROM pred GROUP BY season) SELECT round(greatest(least(sqrt(sum(games * rmse * rmse) / sum(games)), 200.0), 5.0), 6)::DOUBLE AS sigma, sum(games)::BIGINT AS games FROM s""")
def _(spark, sf):
    s = predictions(spark, sf).groupBy("season").agg(F.count("*").alias("games"), F.sqrt(F.avg(((F.col("actual") - F.col("line")) * (F.col("actual") - F.col("line"))).cast("double"))).alias("rmse"))
    return E.pooled_noise(s, "rmse", "games", 5.0, 200.0).withColumn("sigma", F.round("sigma", 6))


@query("rank_analogs", "WITH " + _GRADED + """, c AS (SELECT *, row_number() OVER (PARTITION BY season, period ORDER BY abs(edge) DESC, team) AS r FROM gr) SELECT r::INTEGER AS contest_rank, round(avg(CASE result WHEN 'W' THEN 1.0 WHEN 'P' THEN 0.5 ELSE 0.0 END::DOUBLE), 9) AS mean_points, count(*) AS n, count(DISTINCT season) AS seasons FROM c WHERE r <= 5 GROUP BY r""")
def _(spark, sf):
    from ratewright.operators.windows import contest_rank

    c = contest_rank(graded(spark, sf), ["season", "period"], "edge", ["team"]).where("contest_rank <= 5")
    return c.groupBy("contest_rank").agg(F.round(F.avg("points"), 9).alias("mean_points"), F.count("*").alias("n"), F.count_distinct("season").alias("seasons"))


