"""Queries of the window, selection and set operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ratewright.operators import select as X
from ratewright.operators import windows as W
from ratewright.plans.base import EV, PAIRS, PRED, events, games, predictions, query, side, table

_SP = EV + """, sp AS (SELECT season, player, sum(measure)::BIGINT AS points, sum(volume)::BIGINT AS volume FROM ev GROUP BY ALL)"""


def _season_player(spark, sf):
    return events(spark, sf).groupBy("season", "player").agg(F.sum("measure").alias("points"), F.sum("volume").alias("volume"))


@query("percentile_score", "WITH " + _SP + """, b AS (SELECT *, points // 500000 AS bucket FROM sp), e AS (SELECT season, bucket, rank() OVER (PARTITION BY season ORDER BY bucket) AS r, count(*) OVER (PARTITION BY season, bucket) AS same, count(*) OVER (PARTITION BY season) AS n, player FROM b WHERE volume > 1500)
SELECT b.season, b.player, round(CASE WHEN e.player IS NULL OR e.n < 5 THEN 50.0 ELSE 100.0 * (r + (same - 1) / 2) / n END::DOUBLE, 6) AS score FROM b LEFT JOIN e ON e.season = b.season AND e.player = b.player""")
def _(spark, sf):
    b = _season_player(spark, sf).withColumn("bucket", F.floor(F.col("points") / 500000))
    return W.percentile_score(b, ["season"], "bucket", "score", F.col("volume") > 1500, least=5).select("season", "player", F.round("score", 6).alias("score"))


@query("rank_min", "WITH " + EV + " SELECT season, offense, count(DISTINCT player) AS n, rank() OVER (PARTITION BY season ORDER BY count(DISTINCT player) DESC)::INTEGER AS rank FROM ev GROUP BY season, offense")
def _(spark, sf):
    return W.rank_min(events(spark, sf).groupBy("season", "offense").agg(F.count_distinct("player").alias("n")), ["season"], "n")


@query("first_rank_top5", "WITH " + EV + """, v AS (SELECT season, offense, player, sum(volume)::BIGINT AS v FROM ev GROUP BY ALL) SELECT *, (row_number() OVER (PARTITION BY season, offense ORDER BY v DESC, player))::INTEGER AS place, (row_number() OVER (PARTITION BY season, offense ORDER BY v DESC, player) <= 5)::INTEGER AS top5 FROM v""")
def _(spark, sf):
    v = events(spark, sf).groupBy("season", "offense", "player").agg(F.sum("volume").alias("v"))
    place = F.row_number().over(Window.partitionBy("season", "offense").orderBy(F.desc("v"), "player"))
    return v.withColumn("place", place).withColumn("top5", (F.col("place") <= 5).cast("int"))


@query("dedupe_by_priority", """SELECT p_name, p_brand, p_partkey AS kept FROM part QUALIFY row_number() OVER (PARTITION BY p_name, p_brand ORDER BY p_size DESC, p_partkey) = 1""")
def _(spark, sf):
    best, _ = W.dedupe_by_priority(table(spark, sf, "part"), ["p_name", "p_brand"], [F.desc("p_size"), F.col("p_partkey")])
    return best.select("p_name", "p_brand", F.col("p_partkey").alias("kept"))


@query("top_k_per_group", "WITH " + PRED + """ SELECT season, period, team, edge, (row_number() OVER (PARTITION BY season, period ORDER BY abs(edge) DESC, team))::INTEGER AS rank FROM pred QUALIFY rank <= 5""")
def _(spark, sf):
    return W.first_k(predictions(spark, sf).select("season", "period", "team", "edge"), ["season", "period"], [F.desc(F.abs("edge")), F.col("team")], 5)


@query("depth_rank", """SELECT p_brand AS team, p_type AS role, p_partkey AS player, (row_number() OVER (PARTITION BY p_brand, p_type ORDER BY (p_size % 4 = 0), p_retailprice DESC, p_partkey))::INTEGER AS depth FROM part""")
def _(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_brand").alias("team"), F.col("p_type").alias("role"), F.col("p_partkey").alias("player"), (F.col("p_size") % 4 == 0).alias("out"), "p_retailprice")
    return W.first_k(p, ["team", "role"], [F.col("out"), F.desc("p_retailprice"), F.col("player")], 1 << 30, "depth").drop("out", "p_retailprice")


_FILL = EV + """, v AS (SELECT offense, p_type AS slot, l_partkey % 60 AS player, sum(volume)::BIGINT AS vol FROM ev JOIN part ON p_partkey = l_partkey GROUP BY ALL), c AS (SELECT *, (row_number() OVER (PARTITION BY offense, slot ORDER BY vol DESC, player))::INTEGER AS rank FROM v QUALIFY rank <= 6)"""
for _n, _s in enumerate(["ECONOMY", "STANDARD", "PROMO", "LARGE"]):
    _FILL += f""", s{_n} AS (SELECT * FROM c WHERE slot = '{_s}'""" + "".join(f""" AND (offense, player) NOT IN (SELECT offense, player FROM s{k})""" for k in range(_n)) + """ QUALIFY row_number() OVER (PARTITION BY offense ORDER BY rank, player) = 1)"""


@query("greedy_slot_fill", "WITH " + _FILL + " SELECT * FROM s0 UNION ALL SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3")
def _(spark, sf):
    from ratewright.plans.q_joins import _candidates

    return W.fill_slots(_candidates(spark, sf, 6), ["offense"], ["ECONOMY", "STANDARD", "PROMO", "LARGE"], "slot", "player", [F.col("rank")])


_TG = PAIRS + """, tg AS (SELECT home AS team, season, make_date(season, period, 1 + (home + away) % 28) AS d, 0 AS is_away FROM games UNION ALL SELECT away, season, make_date(season, period, 1 + (home + away) % 28), 1 FROM games), one AS (SELECT team, season, d, max(is_away) AS is_away FROM tg GROUP BY ALL)"""


def _team_games(spark, sf):
    g = games(spark, sf).withColumn("d", F.make_date("season", "period", 1 + (F.col("home") + F.col("away")) % 28))
    both = g.select(F.col("home").alias("team"), "season", "d", F.lit(0).alias("is_away")).unionByName(g.select(F.col("away").alias("team"), "season", "d", F.lit(1).alias("is_away")))
    return both.groupBy("team", "season", "d").agg(F.max("is_away").alias("is_away"))


@query("schedule_factors", "WITH " + _TG + """, a AS (SELECT *, date_diff('day', lag(d) OVER w, d)::INTEGER AS rest_days, sum(1 - is_away) OVER (PARTITION BY team, season ORDER BY d ROWS UNBOUNDED PRECEDING) AS hr, sum(is_away) OVER (PARTITION BY team, season ORDER BY d ROWS 3 PRECEDING)::BIGINT AS road_last4, lag(is_away) OVER w AS la FROM one WINDOW w AS (PARTITION BY team, season ORDER BY d))
SELECT team, season, d, is_away, rest_days, sum(is_away) OVER (PARTITION BY team, season, hr ORDER BY d ROWS UNBOUNDED PRECEDING)::BIGINT AS road_streak, road_last4, (rest_days >= 12)::INTEGER AS after_bye, CASE WHEN is_away = 1 AND la = 1 THEN 1 WHEN is_away = 0 OR la = 0 THEN 0 END AS back_to_back FROM a""")
def _(spark, sf):
    return W.schedule_factors(_team_games(spark, sf), "team", "d", "is_away", "season")


_PRIMARY = EV + """, v AS (SELECT season, offense, period, player, sum(volume) AS v FROM ev GROUP BY ALL), p AS (SELECT season, offense, period, player FROM v QUALIFY row_number() OVER (PARTITION BY season, offense, period ORDER BY v DESC, player) = 1)"""


def _primary(spark, sf):
    v = events(spark, sf).groupBy("season", "offense", "period", "player").agg(F.sum("volume").alias("v"))
    return W.first_k(v, ["season", "offense", "period"], [F.desc("v"), F.col("player")], 1).select("season", "offense", "period", "player")


@query("change_flags", "WITH " + _PRIMARY + """ SELECT *, (player <> first_value(player) OVER w)::INTEGER AS differs_first, coalesce((player <> lag(player) OVER w)::INTEGER, 0) AS differs_last FROM p WINDOW w AS (PARTITION BY season, offense ORDER BY period)""")
def _(spark, sf):
    return W.change_flags(_primary(spark, sf), ["season", "offense"], "period", "player")


@query("rolling_prior_vector", "WITH " + EV + """, tg AS (SELECT season, offense, period, sum(volume)::BIGINT AS v FROM ev GROUP BY ALL) SELECT *, avg(v) OVER (PARTITION BY season, offense ORDER BY period ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS prior_mean FROM tg""")
def _(spark, sf):
    tg = events(spark, sf).groupBy("season", "offense", "period").agg(F.sum("volume").alias("v"))
    return W.rolling_prior(tg, ["season", "offense"], "period", "v")


@query("recency_weight", "WITH " + EV + """, tg AS (SELECT DISTINCT season, offense, period FROM ev) SELECT *, pow(0.5::DOUBLE, max(period) OVER (PARTITION BY season, offense) - period) AS weight FROM tg""")
def _(spark, sf):
    return W.recency_weight(events(spark, sf).select("season", "offense", "period").distinct(), ["season", "offense"], "period", 0.5)


@query("drawdown", "WITH " + PRED + """, p AS (SELECT season, period, team, CASE WHEN sign(edge) = sign(actual - line) THEN 10 WHEN actual = line OR edge = 0 THEN 0 ELSE -11 END AS profit FROM pred), r AS (SELECT *, sum(profit) OVER (PARTITION BY season ORDER BY period, team ROWS UNBOUNDED PRECEDING)::BIGINT AS running FROM p)
SELECT season, max(peak - running)::BIGINT AS max_drawdown, max(running)::BIGINT AS best FROM (SELECT *, max(running) OVER (PARTITION BY season ORDER BY period, team ROWS UNBOUNDED PRECEDING) AS peak FROM r) GROUP BY season""")
def _(spark, sf):
    hit = F.signum("edge") == F.signum(F.col("actual") - F.col("line"))
    p = predictions(spark, sf).withColumn("profit", F.when(hit, 10).when((F.col("actual") == F.col("line")) | (F.col("edge") == 0), 0).otherwise(-11))
    d = W.drawdown(p, ["season"], ["period", "team"], "profit")
    return d.groupBy("season").agg(F.max("drawdown").alias("max_drawdown"), F.max("running").alias("best"))


@query("zscore_center", "WITH " + _SP + """ SELECT season, player, round(coalesce((points - avg(points) OVER w) / nullif(stddev_samp(points) OVER w, 0), 0), 6) AS z FROM sp WINDOW w AS (PARTITION BY season)""")
def _(spark, sf):
    return W.zscore(_season_player(spark, sf), ["season"], "points").select("season", "player", F.round("z", 6).alias("z"))


@query("clip_recenter", "WITH RECURSIVE " + _SP + """, z AS (SELECT season, player, coalesce((points - avg(points) OVER w) / nullif(stddev_samp(points) OVER w, 0), 0) AS z FROM sp WINDOW w AS (PARTITION BY season)),
r AS (SELECT 0 AS k, season, player, z FROM z UNION ALL SELECT k + 1, season, player, greatest(least(z - avg(z) OVER (PARTITION BY season), 1.5), -1.5) FROM r WHERE k < 20)
SELECT season, player, round(z, 6) AS z FROM r WHERE k = 20""")
def _(spark, sf):
    z = W.zscore(_season_player(spark, sf), ["season"], "points").select("season", "player", "z")
    return W.clip_recenter(z, ["season"], "z", -1.5, 1.5).withColumn("z", F.round("z", 6))


_CARD = PRED + """, card AS (SELECT season, period, team, edge, line, row_number() OVER (PARTITION BY season, period ORDER BY abs(edge) DESC, team) AS contest_rank FROM pred)"""


def _card(spark, sf):
    return W.contest_rank(predictions(spark, sf), ["season", "period"], "edge", ["team"])


@query("locked_rank_tiebreak", "WITH " + _CARD + """, t AS (SELECT *, max(CASE WHEN contest_rank BETWEEN 5 AND 8 THEN abs(edge) END) OVER (PARTITION BY season, period) AS top FROM card), o AS (SELECT *, contest_rank BETWEEN 5 AND 8 AND top - abs(edge) <= 2.5 AS near FROM t),
f AS (SELECT *, CASE WHEN contest_rank <= 4 THEN 0 WHEN near AND row_number() OVER (PARTITION BY season, period, near ORDER BY line % 10 DESC, contest_rank) = 1 THEN 1 ELSE 2 END AS o FROM o)
SELECT season, period, team, (row_number() OVER (PARTITION BY season, period ORDER BY o, contest_rank))::INTEGER AS final_rank FROM f""")
def _(spark, sf):
    c = _card(spark, sf).withColumns({"size": F.abs("edge"), "key": F.col("line") % 10})
    return W.lock_and_tiebreak(c, ["season", "period"], "contest_rank", "size", "key", within=2.5).select("season", "period", "team", "final_rank")


@query("veto_rerank", "WITH " + _CARD + """ SELECT season, period, team, (line > 150 AND edge > 0)::INTEGER AS vetoed, (row_number() OVER (PARTITION BY season, period ORDER BY line > 150 AND edge > 0, contest_rank))::INTEGER AS final_rank FROM card""")
def _(spark, sf):
    return W.veto_rerank(_card(spark, sf), ["season", "period"], (F.col("line") > 150) & (F.col("edge") > 0), "contest_rank").select("season", "period", "team", "vetoed", "final_rank")


@query("contest_rank", "WITH " + _CARD + """ SELECT season, period, team, edge, contest_rank::INTEGER AS contest_rank, CASE WHEN contest_rank <= 5 THEN 'TOP' WHEN contest_rank <= 8 THEN 'ALTERNATE' ELSE 'PASS' END AS status FROM card""")
def _(spark, sf):
    return _card(spark, sf).select("season", "period", "team", "edge", "contest_rank", "status")


@query("confidence_board", "WITH " + _CARD + """, a AS (SELECT *, max(CASE WHEN contest_rank = 6 THEN abs(edge) END) OVER (PARTITION BY season, period) AS alt, line - 150 AS other FROM card),
s AS (SELECT season, period, team, contest_rank, round(100 * (0.5::DOUBLE * (1 - exp(-greatest(abs(edge) - coalesce(alt, 0), 0) / 10.0::DOUBLE)) + 0.3::DOUBLE * CASE WHEN sign(edge) = sign(other) THEN 1.0 WHEN other = 0 THEN 0.5 ELSE 0.0 END + 0.2::DOUBLE * least(abs(edge) / 50.0::DOUBLE, 1.0)), 6) AS score FROM a WHERE contest_rank <= 5)
SELECT season, period, team, score, CASE WHEN score >= 75 THEN 'HIGH' WHEN score >= 50 THEN 'MEDIUM' ELSE 'LOW' END AS tier, (row_number() OVER (PARTITION BY season, period ORDER BY score DESC, contest_rank))::INTEGER AS board_rank FROM s""")
def _(spark, sf):
    c = _card(spark, sf).withColumn("other", F.col("line") - 150)
    return W.confidence_board(c, ["season", "period"], "edge", "other").select("season", "period", "team", "score", "tier", "board_rank")


@query("latest_run", """SELECT event_type, max_by(event_id, ts) AS run_id, max(ts) AS at FROM events WHERE ts >= TIMESTAMP '2024-01-05' GROUP BY event_type""")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_type", F.col("event_id").alias("run_id"), F.col("ts").alias("at"))
    return X.latest_run([e.where("run_id % 2 = 0"), e.where("run_id % 2 = 1")], ["event_type"], "at", "2024-01-05").select("event_type", "run_id", "at")


@query("latest_revision", """SELECT o_custkey AS series, 'board-' || o_orderkey || '-' || (o_orderkey % 5) || '.pdf' AS url, (o_orderkey % 5)::INTEGER AS revision FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey % 5 DESC, o_orderkey DESC) = 1""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    url = F.concat(F.lit("board-"), "o_orderkey", F.lit("-"), (F.col("o_orderkey") % 5).cast("string"), F.lit(".pdf"))
    return X.latest_revision(o.select(F.col("o_custkey").alias("series"), url.alias("url"), F.to_date("o_orderdate").alias("day"), "o_orderkey"), ["series"], "url", "day", "o_orderkey").select("series", "url", "revision")


@query("detect_period", "WITH " + EV + """, w AS (SELECT year(o_orderdate) * 12 + month(o_orderdate) AS period, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY 1) SELECT min(period)::BIGINT AS period FROM w WHERE b >= TIMESTAMP '1998-05-17'""")
def _(spark, sf):
    o = table(spark, sf, "orders").select((F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("long").alias("period"), "o_orderdate")
    return X.detect_period(o, "period", "o_orderdate", "1998-05-17")


_OFFERS = """o AS (SELECT user_id AS game, event_type AS book, event_id, value AS line, ts, CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 ELSE 9 END AS priority FROM events), fresh AS (SELECT * FROM o WHERE (epoch_us((SELECT max(ts) FROM events)) - epoch_us(ts)) / 60000000.0 <= 20000)"""


@query("priority_pick", "WITH " + _OFFERS + """, all_games AS (SELECT DISTINCT game FROM o), best AS (SELECT game, book, line FROM fresh QUALIFY row_number() OVER (PARTITION BY game ORDER BY priority, ts DESC, event_id DESC) = 1) SELECT game, book, line, CASE WHEN b.game IS NULL THEN 'no fresh offer' END AS reason FROM all_games LEFT JOIN best b USING (game)""")
def _(spark, sf):
    e = table(spark, sf, "events").select(F.col("user_id").alias("game"), F.col("event_type").alias("book"), "event_id", F.col("value").alias("line"), F.col("ts"))
    now = e.agg(F.max("ts").alias("now"))
    return X.priority_pick(e.crossJoin(F.broadcast(now)), "game", "book", ["purchase", "click", "view"], "ts", "now", 20000, ["event_id"]).select("game", "book", "line", "reason")


@query("orientation_union", "WITH " + PAIRS + """ SELECT season, period, home AS team, away AS opponent, margin, 0 AS is_away FROM games UNION ALL SELECT season, period, away, home, -margin, 1 FROM games""")
def _(spark, sf):
    return X.both_sides(games(spark, sf), ["season", "period"], "home", "away", "margin")


@query("keyset_difference", """WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'P') SELECT k, 'missing' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT k, 'unexpected' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("k"), "o_orderstatus")
    return X.keyset_difference(o.where("o_orderstatus = 'F'").select("k"), o.where("o_orderstatus = 'P'").select("k"))


@query("set_intersections", "WITH " + EV + """, p AS (SELECT DISTINCT season, offense, player FROM ev) SELECT a.season, a.offense, count(*) AS returning_players FROM p a JOIN p b ON b.offense = a.offense AND b.player = a.player AND b.season = a.season - 1 GROUP BY ALL""")
def _(spark, sf):
    p = events(spark, sf).select("season", "offense", "player")
    now = p.distinct()
    last = p.withColumn("season", F.col("season") + 1)
    return now.intersect(last).groupBy("season", "offense").agg(F.count("*").alias("returning_players"))


@query("portfolio_union", "WITH " + _CARD + """, c2 AS (SELECT season, period, team, row_number() OVER (PARTITION BY season, period ORDER BY line DESC, team) AS r FROM pred), e AS (SELECT season, period, team, contest_rank AS r1 FROM card WHERE contest_rank <= 5), f AS (SELECT season, period, team, r AS r2 FROM c2 WHERE r <= 5)
SELECT season, period, team, r1::INTEGER AS rank_1, r2::INTEGER AS rank_2, CASE WHEN r2 IS NULL THEN 'only_1' WHEN r1 IS NULL THEN 'only_2' ELSE 'both' END AS membership FROM e FULL JOIN f USING (season, period, team)""")
def _(spark, sf):
    p = predictions(spark, sf)
    a = W.first_k(p, ["season", "period"], [F.desc(F.abs("edge")), F.col("team")], 5).select("season", "period", "team", "rank")
    b = W.first_k(p, ["season", "period"], [F.desc("line"), F.col("team")], 5).select("season", "period", "team", "rank")
    return X.compare_entries(a, b, ["season", "period", "team"], "rank")
