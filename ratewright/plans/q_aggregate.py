"""Queries of the aggregation operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ratewright.operators import aggregate as A
from ratewright.operators import joins as J
from ratewright.plans.base import EV, PAIRS, events, games, query, table
from ratewright.plans.q_windows import _SP, _season_player


def _is(kind):
    return F.col("kind") == kind


@query("team_game_efficiency", "WITH " + EV + """ SELECT season, period, offense, defense, avg(CASE WHEN kind = 'R' THEN measure END) AS pass_epa, avg(CASE WHEN kind = 'A' THEN measure END) AS rush_epa, avg((l_discount < 0.05)::INTEGER) AS success, avg(CASE WHEN kind = 'R' THEN (volume >= 40)::INTEGER WHEN kind = 'A' THEN (volume >= 30)::INTEGER END) AS explosive, avg(CASE WHEN kind = 'R' THEN (status = 'F')::INTEGER END) AS sack_rate, count(*) AS plays FROM ev GROUP BY ALL""")
def _(spark, sf):
    explosive = F.when(_is("R"), (F.col("volume") >= 40).cast("int")).when(_is("A"), (F.col("volume") >= 30).cast("int"))
    m = {"pass_epa": (_is("R"), F.col("measure")), "rush_epa": (_is("A"), F.col("measure")), "success": (F.lit(True), (F.col("l_discount") < 0.05).cast("int")), "explosive": (F.lit(True), explosive), "sack_rate": (_is("R"), (F.col("status") == "F").cast("int"))}
    return A.conditional_means(events(spark, sf), ["season", "period", "offense", "defense"], m)


@query("offense_summary_clipped", "WITH " + EV + """ SELECT season, period, offense, avg(least(greatest(measure, 5000), 60000)) AS epa, avg((measure > 30000)::INTEGER) AS success, avg((volume >= 45)::INTEGER) AS explosive, count(*) AS plays FROM ev GROUP BY ALL""")
def _(spark, sf):
    from ratewright.functions.clean import clip

    on = F.lit(True)
    m = {"epa": (on, clip("measure", 5000, 60000)), "success": (on, (F.col("measure") > 30000).cast("int")), "explosive": (on, (F.col("volume") >= 45).cast("int"))}
    return A.conditional_means(events(spark, sf), ["season", "period", "offense"], m)


@query("special_teams_sum", "WITH " + EV + """, k AS (SELECT DISTINCT season, offense FROM ev) SELECT season, offense, coalesce(n, 0)::BIGINT AS n, coalesce(total, 0)::BIGINT AS total FROM k LEFT JOIN (SELECT season, offense, count(*) AS n, sum(least(measure, 60000))::BIGINT AS total FROM ev WHERE kind = 'N' AND volume > 48 GROUP BY ALL) USING (season, offense)""")
def _(spark, sf):
    ev = events(spark, sf)
    st = ev.where("kind = 'N' and volume > 48").groupBy("season", "offense").agg(F.count("*").alias("n"), F.sum(F.least("measure", F.lit(60000))).alias("total"))
    return ev.select("season", "offense").distinct().join(st, ["season", "offense"], "left").fillna(0, ["n", "total"])


@query("primary_by_volume", "WITH " + EV + """, v AS (SELECT season, offense, period, player, sum(volume) AS v, sum(measure) AS m, count(*) AS n FROM ev GROUP BY ALL), t AS (SELECT season, offense, period, sum(v) AS total FROM v GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY season, offense, period ORDER BY v DESC, player) AS rn FROM v)
SELECT b.season, b.offense, b.period, b.player, v::DOUBLE / total::DOUBLE AS share, m::DOUBLE / n AS mean_measure FROM b JOIN t USING (season, offense, period) WHERE rn = 1""")
def _(spark, sf):
    return A.primary_by_volume(events(spark, sf), ["season", "offense", "period"], "player", "volume", "measure")


@query("home_away_union_counts", "WITH " + PAIRS + """ SELECT season, team, count(*) AS games, max(period) AS latest FROM (SELECT season, home AS team, period FROM games UNION ALL SELECT season, away, period FROM games) GROUP BY ALL""")
def _(spark, sf):
    return A.games_played(games(spark, sf), ["season"], "home", "away", "period")


@query("player_season_offense", "WITH " + EV + """, w AS (SELECT season, period, player, sum(measure)::BIGINT AS points, sum(volume)::BIGINT AS volume FROM ev GROUP BY ALL) SELECT season, player, sum(points)::BIGINT AS points, sum(volume)::BIGINT AS volume, avg(points) AS mean_points, count(CASE WHEN volume > 100 THEN 1 END) AS games FROM (SELECT season, period, player, points, volume FROM w) GROUP BY ALL""")
def _(spark, sf):
    w = events(spark, sf).groupBy("season", "period", "player").agg(F.sum("measure").alias("points"), F.sum("volume").alias("volume"))
    out = A.player_season(w.withColumn("big", F.col("volume") - 100), ["season", "player"], ["points", "volume"], ["points"], "big")
    return out


@query("player_season_snaps", "WITH " + EV + """, w AS (SELECT season, period, player, sum(volume)::BIGINT AS snaps, sum(CASE WHEN kind = 'A' THEN volume ELSE 0 END)::BIGINT AS defense_snaps, min(offense) AS team FROM ev GROUP BY ALL) SELECT season, player, sum(snaps)::BIGINT AS snaps, sum(defense_snaps)::BIGINT AS defense_snaps, count(CASE WHEN defense_snaps > 0 THEN 1 END) AS games, min_by(team, period) AS team FROM w GROUP BY ALL""")
def _(spark, sf):
    w = events(spark, sf).groupBy("season", "period", "player").agg(F.sum("volume").alias("snaps"), F.sum(F.when(_is("A"), F.col("volume")).otherwise(0)).alias("defense_snaps"), F.min("offense").alias("team"))
    return A.player_season(w, ["season", "player"], ["snaps", "defense_snaps"], [], "defense_snaps", {"team": "period"})


@query("player_season_tracking", """SELECT user_id, event_type, count(*) AS n, avg(floor(value)) AS mean_speed, sum(floor(value))::BIGINT AS distance FROM events GROUP BY ALL""")
def _(spark, sf):
    e = table(spark, sf, "events").withColumns({"speed": F.floor("value"), "distance": F.floor("value"), "n": F.lit(1)})
    return A.player_season(e, ["user_id", "event_type"], ["n", "distance"], ["speed"])


@query("role_event_unpivot", """WITH long AS (SELECT l_suppkey AS player, 'tackle' AS m FROM lineitem UNION ALL SELECT l_partkey % 100, 'sack' FROM lineitem WHERE l_linestatus = 'F' UNION ALL SELECT l_orderkey % 100, 'tackle' FROM lineitem WHERE l_quantity > 25)
SELECT player, count(CASE WHEN m = 'tackle' THEN 1 END) AS tackle, count(CASE WHEN m = 'sack' THEN 1 END) AS sack FROM long GROUP BY player""")
def _(spark, sf):
    l = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("solo"), F.when(F.col("l_linestatus") == "F", F.col("l_partkey") % 100).alias("sacker"), F.when(F.col("l_quantity") > 25, F.col("l_orderkey") % 100).alias("assist"))
    return A.unpivot_roles(l, [], {"solo": "tackle", "sacker": "sack", "assist": "tackle"})


@query("player_season_assemble", "WITH " + EV + """, a AS (SELECT season, player, sum(measure)::BIGINT AS pass FROM ev WHERE kind = 'R' GROUP BY ALL), b AS (SELECT season, player, sum(measure)::BIGINT AS rush, count(*) AS n FROM ev WHERE kind = 'A' AND volume > 46 GROUP BY ALL)
SELECT season, player, pass, rush, CASE WHEN coalesce(n, 0) > 1 THEN rush ELSE pass END AS preferred, coalesce(pass, 0) + coalesce(rush, 0) AS composite FROM a FULL JOIN b USING (season, player)""")
def _(spark, sf):
    ev = events(spark, sf)
    a = ev.where(_is("R")).groupBy("season", "player").agg(F.sum("measure").alias("pass"))
    b = ev.where(_is("A") & (F.col("volume") > 46)).groupBy("season", "player").agg(F.sum("measure").alias("rush"), F.count("*").alias("n"))
    out = J.outer_union({"a": a, "b": b}, ["season", "player"])
    preferred = F.when(F.coalesce("n", F.lit(0)) > 1, F.col("rush")).otherwise(F.col("pass"))
    return out.select("season", "player", "pass", "rush", preferred.alias("preferred"), (F.coalesce("pass", F.lit(0)) + F.coalesce("rush", F.lit(0))).alias("composite"))


@query("recency_weighted_rollup", "WITH " + _SP + """, a AS (SELECT *, max(season) OVER (PARTITION BY player) - season AS age FROM sp), w AS (SELECT *, CASE age WHEN 0 THEN 0.5 WHEN 1 THEN 0.25 WHEN 2 THEN 0.125 ELSE 0.0 END::DOUBLE AS w FROM a)
SELECT player, round(sum(points * w) / sum(w), 4) AS points, count(*) AS seasons FROM w GROUP BY player""")
def _(spark, sf):
    d = _season_player(spark, sf).withColumn("age", F.max("season").over(Window.partitionBy("player")) - F.col("season"))
    out = A.recency_rollup(d, ["player"], "age", ["points"], {0: 0.5, 1: 0.25, 2: 0.125})
    return out.withColumn("points", F.round("points", 4))


_EB = _SP + """, e AS (SELECT season, player, count(CASE WHEN kind = 'R' THEN 1 END) AS hits, count(*) AS n FROM ev GROUP BY ALL)"""


def _hits(spark, sf):
    return events(spark, sf).groupBy("season", "player").agg(F.count_if(_is("R")).alias("hits"), F.count("*").alias("n"))


@query("empirical_bayes_rate", "WITH " + _EB + """ SELECT season, player, round((hits + (sum(hits) OVER w)::DOUBLE / sum(n) OVER w * 40) / (n + 40), 9) AS rate FROM e WINDOW w AS (PARTITION BY season)""")
def _(spark, sf):
    return A.empirical_bayes(_hits(spark, sf), ["season"], "hits", "n", 40.0).select("season", "player", F.round("rate", 9).alias("rate"))


@query("shrink_to_median", "WITH " + _EB + """, r AS (SELECT season, player, hits::DOUBLE / n AS v, n FROM e), m AS (SELECT season, quantile_cont(v, 0.5) AS med FROM r WHERE n >= 80 GROUP BY season) SELECT season, player, round(v * (n / (n + 150.0::DOUBLE)) + med * (1 - n / (n + 150.0::DOUBLE)), 9) AS shrunk FROM r LEFT JOIN m USING (season)""")
def _(spark, sf):
    r = _hits(spark, sf).withColumn("v", F.col("hits") / F.col("n"))
    return A.shrink_to_median(r, ["season"], "v", "n", 150.0, 80.0).select("season", "player", F.round("shrunk", 9).alias("shrunk"))


def _pct(value, group="season", desc=False):
    return f"100.0::DOUBLE * (rank() OVER (PARTITION BY {group} ORDER BY {value}{' DESC' if desc else ''}) + (count(*) OVER (PARTITION BY {group}, {value}) - 1) / 2) / count(*) OVER (PARTITION BY {group})"


_CARDS = _EB + f""", j AS (SELECT * FROM sp JOIN e USING (season, player)), c AS (SELECT season, player, n, {_pct('volume')} AS s1, {_pct('hits', desc=True)} AS s2 FROM j), x AS (SELECT *, (s1 * 0.75 + s2 * 0.25) / 1.0::DOUBLE AS composite FROM c)"""


def _cards(spark, sf):
    j = _season_player(spark, sf).join(_hits(spark, sf), ["season", "player"])
    return A.scorecards(j, ["season"], {"volume": 0.75, "hits": -0.25}, A.saturation("n", 100.0))


@query("position_scorecards", "WITH " + _CARDS + """ SELECT season, player, round(composite, 6) AS composite, 2 AS components, round(50 + (composite - 50) * (n / (n + 100.0::DOUBLE)), 6) AS score FROM x""")
def _(spark, sf):
    return _cards(spark, sf).select("season", "player", F.round("composite", 6).alias("composite"), "components", F.round("score", 6).alias("score"))


@query("weighted_components", """WITH p AS (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size END AS a, CASE WHEN p_size % 3 = 0 THEN p_partkey % 7 END AS b FROM part) SELECT p_partkey, round(CASE WHEN a IS NOT NULL OR b IS NOT NULL THEN (coalesce(a * 0.5, 0) + coalesce(b * 0.25, 0)) / (CASE WHEN a IS NULL THEN 0 ELSE 0.5 END + CASE WHEN b IS NULL THEN 0 ELSE 0.25 END) END::DOUBLE, 9) AS score, ((a IS NOT NULL)::INTEGER + (b IS NOT NULL)::INTEGER) AS components FROM p""")
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("a"), F.when(F.col("p_size") % 3 == 0, F.col("p_partkey") % 7).alias("b"))
    mean, n = A.weighted_components({"a": 0.5, "b": 0.25})
    return p.select("p_partkey", F.round(mean, 9).alias("score"), n.alias("components"))


@query("position_score_frame", f"""WITH p AS (SELECT p_type AS grp, p_partkey AS player, p_size AS a, p_partkey % 17 AS b FROM part), s AS (SELECT grp, player, {_pct('a', 'grp')} AS sa, {_pct('b', 'grp', True)} AS sb FROM p) SELECT grp, player, round((sa * 0.5 + sb * 0.5) / 1.0::DOUBLE, 6) AS composite FROM s""")
def _(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_type").alias("grp"), F.col("p_partkey").alias("player"), F.col("p_size").alias("a"), (F.col("p_partkey") % 17).alias("b"))
    return A.scorecards(p, ["grp"], {"a": 0.5, "b": -0.5}, F.lit(1.0)).select("grp", "player", F.round("composite", 6).alias("composite"))


@query("reliability_confidence", "WITH " + _EB + """ SELECT player, count(CASE WHEN n >= 80 THEN 1 END) AS qualified, round(0.5 * (sum(n) / (sum(n) + 500.0::DOUBLE)) + 0.5 * least(count(CASE WHEN n >= 80 THEN 1 END) / 4.0::DOUBLE, 1.0), 9) AS confidence FROM e GROUP BY player""")
def _(spark, sf):
    q = F.count_if(F.col("n") >= 80)
    out = _hits(spark, sf).groupBy("player").agg(q.alias("qualified"), F.sum("n").alias("v"))
    return out.select("player", "qualified", F.round(0.5 * A.saturation("v", 500.0) + 0.5 * F.least(F.col("qualified") / 4, F.lit(1.0)), 9).alias("confidence"))


@query("final_grade_shrink", """WITH p AS (SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_size::DOUBLE END AS own, CASE WHEN p_size % 3 = 0 THEN (p_partkey % 60)::DOUBLE END AS other, 40.0::DOUBLE AS base, p_size FROM part) SELECT p_partkey, round(CASE WHEN coalesce(own, other) IS NULL THEN base ELSE base + (coalesce(own, other) + CASE WHEN p_size > 30 THEN -1.5 ELSE 0 END - base) * (p_size / (p_size + 20.0::DOUBLE)) END, 9) AS final_grade, CASE WHEN own IS NOT NULL THEN 'own' WHEN other IS NOT NULL THEN 'other' ELSE 'baseline' END AS grade_source FROM p""")
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_size", F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("double")).alias("own"), F.when(F.col("p_size") % 3 == 0, (F.col("p_partkey") % 60).cast("double")).alias("other"), F.lit(40.0).alias("base"))
    out = A.final_grade(p, ["own", "other"], A.saturation("p_size", 20.0), "base", F.when(F.col("p_size") > 30, -1.5).otherwise(0.0))
    return out.select("p_partkey", F.round("final_grade", 9).alias("final_grade"), "grade_source")


@query("grade_history_summary", "WITH " + _EB + """, g AS (SELECT *, n / (n + 100.0::DOUBLE) AS rel, pow(0.5::DOUBLE, max(season) OVER (PARTITION BY player) - season) AS d FROM e) SELECT player, round(sum(rel * d * hits) / sum(rel * d), 6) AS grade, max_by(hits, season) AS latest, round(avg(rel), 6) AS confidence, round(pow(sum(rel * d), 2) / sum(rel * d * rel * d), 6) AS effective FROM g GROUP BY player""")
def _(spark, sf):
    g = _hits(spark, sf).withColumn("rel", A.saturation("n", 100.0))
    out = A.grade_history(g, ["player"], "season", "hits", "rel", 0.5)
    return out.select("player", F.round("grade", 6).alias("grade"), "latest", F.round("confidence", 6).alias("confidence"), F.round("effective", 6).alias("effective"))


@query("replacement_quantile", """SELECT p_type, round(quantile_cont(p_size, 0.2), 9) AS replacement, count(*) AS qualified FROM part WHERE p_partkey % 3 <> 0 GROUP BY p_type""")
def _(spark, sf):
    return A.replacement(table(spark, sf, "part"), ["p_type"], "p_size", F.col("p_partkey") % 3 != 0).withColumn("replacement", F.round("replacement", 9))


_UNITS = """u AS (SELECT p_brand AS team, p_type AS unit, p_size AS v, 1 + p_partkey % 3 AS w FROM part QUALIFY row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_size DESC, p_partkey) <= 3), r AS (SELECT team, unit, sum(w * v)::DOUBLE / sum(w)::DOUBLE AS rating, sum(w * (v - 20))::DOUBLE / sum(w)::DOUBLE AS over_replacement, count(*) AS filled, count(*) / 3.0::DOUBLE AS completeness FROM u GROUP BY ALL)"""
_TYPES = ["ECONOMY", "STANDARD", "PROMO", "LARGE", "MEDIUM", "SMALL"]


def _units(spark, sf):
    from ratewright.operators.windows import first_k

    p = first_k(table(spark, sf, "part"), ["p_brand", "p_type"], [F.desc("p_size"), F.col("p_partkey")], 3)
    chosen = p.select(F.col("p_brand").alias("team"), F.col("p_type").alias("unit"), F.col("p_size").alias("v"), (1 + F.col("p_partkey") % 3).alias("w"), F.lit(20).alias("base"))
    return A.weighted_units(chosen, ["team"], "unit", "w", "v", "base", dict.fromkeys(_TYPES, 3))


@query("slot_weighted_units", "WITH " + _UNITS + """ SELECT team, unit, round(rating, 9) AS rating, round(over_replacement, 9) AS over_replacement, filled, CASE WHEN unit IN ('ECONOMY', 'STANDARD', 'PROMO', 'LARGE', 'MEDIUM', 'SMALL') THEN completeness END AS completeness FROM r""")
def _(spark, sf):
    return _units(spark, sf).withColumns({c: F.round(c, 9) for c in ("rating", "over_replacement")})


@query("wide_unit_pivot", "WITH " + _UNITS + """, p AS (SELECT team, max(CASE WHEN unit = 'ECONOMY' THEN rating END) AS ECONOMY, max(CASE WHEN unit = 'STANDARD' THEN rating END) AS STANDARD, max(CASE WHEN unit = 'PROMO' THEN rating END) AS PROMO FROM r GROUP BY team)
SELECT team, round(ECONOMY, 6) AS ECONOMY, round(STANDARD, 6) AS STANDARD, round(PROMO, 6) AS PROMO, round((coalesce(ECONOMY * 0.5, 0) + coalesce(PROMO * 0.25, 0)) / nullif(CASE WHEN ECONOMY IS NULL THEN 0 ELSE 0.5 END + CASE WHEN PROMO IS NULL THEN 0 ELSE 0.25 END, 0)::DOUBLE, 6) AS overall FROM p""")
def _(spark, sf):
    out = A.pivot_units(_units(spark, sf), ["team"], "unit", "rating", ["ECONOMY", "STANDARD", "PROMO"], {"overall": {"ECONOMY": 0.5, "PROMO": 0.25}})
    return out.select("team", *(F.round(c, 6).alias(c) for c in ("ECONOMY", "STANDARD", "PROMO", "overall")))


@query("center_and_impute", "WITH " + _EB + """, x AS (SELECT season, player, CASE WHEN player % 4 <> 0 THEN hits END AS v FROM e), m AS (SELECT season, quantile_cont(v, 0.5) AS med FROM x GROUP BY season), f AS (SELECT season, player, coalesce(v, med, 0)::DOUBLE AS v FROM x JOIN m USING (season)) SELECT season, player, round(v - avg(v) OVER (PARTITION BY season), 6) AS v FROM f""")
def _(spark, sf):
    x = _hits(spark, sf).select("season", "player", F.when(F.col("player") % 4 != 0, F.col("hits").cast("double")).alias("v"))
    return A.center_and_impute(x, ["season"], ["v"]).select("season", "player", F.round("v", 6).alias("v"))


@query("team_strength_blend", """WITH s AS (SELECT s_suppkey AS team, (s_nationkey * 2)::DOUBLE AS offense, (s_suppkey % 40)::DOUBLE AS defense, (s_suppkey % 101)::DOUBLE AS cont FROM supplier), x AS (SELECT *, (offense * 0.5 + defense * 0.5) / 1.0 AS base, greatest(least((cont - 50) / 50 * 3.0 * 0.8, 3.0), -3.0)::DOUBLE AS adj FROM s)
SELECT team, component, value, weight FROM (SELECT team, 'offense' AS component, offense AS value, 0.5::DOUBLE AS weight FROM x UNION ALL SELECT team, 'defense', defense, 0.5 FROM x UNION ALL SELECT team, 'continuity', round(adj, 9), 1.0 FROM x UNION ALL SELECT team, 'strength', round(base + adj, 9), 1.0 FROM x)""")
def _(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("team"), (F.col("s_nationkey") * 2).cast("double").alias("offense"), (F.col("s_suppkey") % 40).cast("double").alias("defense"), (F.col("s_suppkey") % 101).cast("double").alias("cont"), F.lit(0.8).alias("conf"))
    out, audit = A.strength_blend(s, {"offense": 0.5, "defense": 0.5}, "cont", "conf", 3.0, ["team"])
    audit = audit.unionByName(out.select("team", F.lit("strength").alias("component"), F.col("strength").alias("value"), F.lit(1.0).alias("weight")))
    return audit.withColumn("value", F.round("value", 9))


_USE = EV + """, u AS (SELECT season, offense, player, sum(volume)::BIGINT AS snaps FROM ev GROUP BY ALL)"""


def _usage(spark, sf):
    return events(spark, sf).groupBy("season", "offense", "player").agg(F.sum("volume").alias("snaps"))


@query("roster_continuity", "WITH " + _USE + """, d AS (SELECT *, snaps::DOUBLE / (sum(snaps) OVER (PARTITION BY season, offense))::DOUBLE AS share, (row_number() OVER (PARTITION BY season, offense ORDER BY snaps DESC, player) <= 5)::INTEGER AS top FROM u)
SELECT a.season, a.offense, round(sum(b.share), 9) AS returning_share, count(*) AS returning, sum(a.top * b.top)::BIGINT AS top_kept, (sum(a.top * b.top) * (sum(a.top * b.top) - 1) / 2)::BIGINT AS pairs_kept FROM d a JOIN d b ON b.season + 1 = a.season AND b.offense = a.offense AND b.player = a.player GROUP BY ALL""")
def _(spark, sf):
    return A.continuity(_usage(spark, sf), "season", "offense", "player", "snaps").withColumn("returning_share", F.round("returning_share", 9))


@query("share_overlap", "WITH " + _USE + """, s AS (SELECT season, offense, player, snaps::DOUBLE / max(snaps) OVER (PARTITION BY season, offense) AS share FROM u), j AS (SELECT season, offense, player, coalesce(a.share, 0) AS a, coalesce(b.share, 0) AS b FROM s a FULL JOIN (SELECT season + 1 AS season, offense, player, share FROM s) b USING (season, offense, player))
SELECT season, offense, round(sum(least(a, b)) / sum(greatest(a, b)), 9) AS overlap, count(CASE WHEN b >= 0.5 AND a < 0.05 THEN 1 END) AS missing_core FROM j GROUP BY ALL""")
def _(spark, sf):
    w = Window.partitionBy("season", "offense")
    s = _usage(spark, sf).withColumn("share", F.col("snaps") / F.max("snaps").over(w)).drop("snaps")
    return A.share_overlap(s, s.withColumn("season", F.col("season") + 1), ["season", "offense"], "player", "share").withColumn("overlap", F.round("overlap", 9))


_WINDOW = EV + """, tg AS (SELECT season, period, offense, sum(measure)::BIGINT AS points FROM ev GROUP BY ALL), grid AS (SELECT DISTINCT season, period, offense FROM ev),
pw AS (SELECT g.offense, g.season AS grid_season, g.period AS grid_period, points, CASE WHEN t.season = g.season THEN pow(0.5::DOUBLE, g.period - t.period) ELSE 0.25 END AS w FROM grid g JOIN tg t ON t.offense = g.offense AND ((t.season = g.season AND t.period < g.period) OR t.season = g.season - 1))"""


@query("decayed_weighted_mean", "WITH " + _WINDOW + """ SELECT offense, grid_season, grid_period, round(sum(points * w) / sum(w), 3) AS mean, sum(w) AS weight FROM pw GROUP BY ALL""")
def _(spark, sf):
    ev = events(spark, sf)
    tg = ev.groupBy("season", "period", "offense").agg(F.sum("measure").alias("points"))
    pw = J.prior_window(ev.select("season", "period", "offense").distinct(), tg, ["offense"])
    out = A.decayed_mean(pw, ["offense", "grid_season", "grid_period"], "points", 0.5, 0.25)
    return out.withColumn("mean", F.round("mean", 3))


@query("game_matrix", "WITH " + PAIRS + """, o AS (SELECT season, offense AS team, avg(points) AS off FROM side GROUP BY ALL), d AS (SELECT season, defense AS team, avg(points) AS def FROM side GROUP BY ALL), m AS (SELECT season, avg(points) AS mean FROM side GROUP BY ALL), r AS (SELECT o.season, o.team, off - mean AS off, def - mean AS def FROM o JOIN d USING (season, team) JOIN m USING (season))
SELECT g.season, g.period, g.home, g.away, round(mean + h.off + a.def, 6) AS home_expected, round(mean + a.off + h.def, 6) AS away_expected, round(h.off + a.def - a.off - h.def, 6) AS advantage FROM games g JOIN m USING (season) JOIN r h ON h.season = g.season AND h.team = home JOIN r a ON a.season = g.season AND a.team = away""")
def _(spark, sf):
    from ratewright.plans.base import side

    s = side(spark, sf)
    mean = s.groupBy("season").agg(F.avg("points").alias("epa_mean"))
    r = s.groupBy("season", F.col("offense").alias("team")).agg(F.avg("points").alias("o")).join(s.groupBy("season", F.col("defense").alias("team")).agg(F.avg("points").alias("d")), ["season", "team"]).join(mean, "season")
    r = r.select("season", "team", (F.col("o") - F.col("epa_mean")).alias("epa_off"), (F.col("d") - F.col("epa_mean")).alias("epa_def"))
    g = J.attach_two_sided(games(spark, sf).select("season", "period", "home", "away"), r, ["season"], "team").join(mean, "season")
    g = A.game_matrix(g.dropna(), ["epa"])
    return g.select("season", "period", "home", "away", F.round("home_expected_epa", 6).alias("home_expected"), F.round("away_expected_epa", 6).alias("away_expected"), F.round("epa_advantage", 6).alias("advantage"))


@query("duplicate_audit", """SELECT p_name, count(*) AS rows, count(DISTINCT p_brand) AS canonicals FROM part GROUP BY p_name HAVING count(*) > 1""")
def _(spark, sf):
    return A.duplicate_audit(table(spark, sf, "part"), "p_name", "p_brand")


@query("canonical_aggregate", "WITH " + EV + """, e AS (SELECT player, season, offense, CASE WHEN volume % 2 = 0 THEN offense END AS team, period * 100 + volume AS prio FROM ev) SELECT player, min_by(team, prio * 1000 + team) AS team, array_to_string(list_sort(list(DISTINCT season::VARCHAR)), '|') AS all_season, min(season) AS first_season, max(season) AS last_season, count(*) AS rows FROM e GROUP BY player""")
def _(spark, sf):
    e = events(spark, sf).select("player", "season", F.when(F.col("volume") % 2 == 0, F.col("offense")).alias("team"), (F.col("period") * 100 + F.col("volume")).alias("prio"))
    return A.canonical_rows(e, "player", {"team": "prio"}, ["season"], "season")


@query("group_summaries", """SELECT p_type, p_brand, count(*) AS n, avg(p_size) AS mean_size, max(p_size) AS most, grouping(p_brand)::INTEGER AS level FROM part GROUP BY ROLLUP (p_type, p_brand)""")
def _(spark, sf):
    out = table(spark, sf, "part").rollup("p_type", "p_brand").agg(F.count("*").alias("n"), F.avg("p_size").alias("mean_size"), F.max("p_size").alias("most"), F.grouping("p_brand").cast("int").alias("level"))
    return out
