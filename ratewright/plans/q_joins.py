"""Queries of the join and identity operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ratewright.functions import clean as C
from ratewright.operators import identity as I
from ratewright.operators import joins as J
from ratewright.sources.io import written
from ratewright.plans.base import EV, PAIRS, PRED, events, games, predictions, query, side, table
from ratewright.plans.q_scalar import _NAME_SQL


@query("checked_join", "SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def _(spark, sf):
    n = table(spark, sf, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    return J.checked_join(n, table(spark, sf, "region"), ["r_regionkey"]).select("n_nationkey", "n_name", "r_name")


@query("two_sided_attach", "WITH " + PAIRS + """, r AS (SELECT season, period, offense, sum(points)::BIGINT AS rating FROM side GROUP BY ALL)
SELECT g.season, g.period, home, away, margin, h.rating AS home_rating, a.rating AS away_rating FROM games g LEFT JOIN r h ON h.season = g.season AND h.period = g.period AND h.offense = home LEFT JOIN r a ON a.season = g.season AND a.period = g.period AND a.offense = away""")
def _(spark, sf):
    r = side(spark, sf).groupBy("season", "period", "offense").agg(F.sum("points").alias("rating"))
    return J.attach_two_sided(games(spark, sf).select("season", "period", "home", "away", "margin"), r, ["season", "period"], "offense")


@query("opponent_mirror_join", "WITH " + PAIRS + """ SELECT a.season, a.period, a.offense, a.defense, a.points, b.points AS opp_points, a.points - b.points AS net FROM side a JOIN side b ON a.season = b.season AND a.period = b.period AND a.offense = b.defense AND a.defense = b.offense""")
def _(spark, sf):
    return J.mirror(side(spark, sf), ["season", "period"], "offense", "defense", ["points"]).withColumn("net", F.col("points") - F.col("opp_points"))


_WEIGHTS = {"ECONOMY": 3, "STANDARD": 2, "PROMO": 1}


@query("lookup_map_join", """SELECT p_partkey, p_type, coalesce(w, 0) AS weight FROM part LEFT JOIN (VALUES ('ECONOMY', 3), ('STANDARD', 2), ('PROMO', 1)) AS t(k, w) ON k = p_type""")
def _(spark, sf):
    w = spark.createDataFrame(list(_WEIGHTS.items()), "p_type string, w int")  # a constant table
    return table(spark, sf, "part").join(F.broadcast(w), "p_type", "left").select("p_partkey", "p_type", F.coalesce("w", F.lit(0)).alias("weight"))


@query("outer_overlay", """WITH b AS (SELECT p_partkey AS id, p_size AS v FROM part WHERE p_partkey % 3 <> 0), l AS (SELECT p_partkey AS id, p_size + 100 AS v FROM part WHERE p_partkey % 2 = 0)
SELECT id, coalesce(l.v, b.v) AS v, CASE WHEN l.id IS NULL THEN 'base' WHEN b.id IS NULL THEN 'local' ELSE 'both' END AS source FROM b FULL JOIN l USING (id)""")
def _(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("v"))
    return J.overlay(p.where("id % 3 <> 0"), p.where("id % 2 = 0").withColumn("v", F.col("v") + 100), ["id"], ["v"])


@query("outer_three_way", "WITH " + EV + """ SELECT season, player, sum(CASE WHEN kind = 'R' THEN measure END)::BIGINT AS passing, sum(CASE WHEN kind = 'A' THEN measure END)::BIGINT AS rushing, sum(CASE WHEN kind = 'N' AND volume > 45 THEN measure END)::BIGINT AS receiving FROM ev WHERE kind <> 'N' OR volume > 45 GROUP BY ALL""")
def _(spark, sf):
    ev = events(spark, sf)
    part = lambda c, n: ev.where(c).groupBy("season", "player").agg(F.sum("measure").alias(n))
    return J.outer_union({"a": part("kind = 'R'", "passing"), "b": part("kind = 'A'", "rushing"), "c": part("kind = 'N' and volume > 45", "receiving")}, ["season", "player"])


@query("missing_left_anti", "SELECT c_custkey FROM customer ANTI JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'P'")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey").join(table(spark, sf, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")


@query("key_semi_filter", "SELECT count(*) AS n, sum(l_quantity)::BIGINT AS q FROM lineitem SEMI JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') ON l_orderkey = o_orderkey")
def _(spark, sf):
    done = table(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf, "lineitem").join(done, "l_orderkey", "left_semi").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("long").alias("q"))


@query("override_join", """WITH m AS (SELECT event_id % 15000 AS o_orderkey, max(value) AS price, max((event_type = 'error')::INTEGER) AS flag FROM events WHERE event_id % 2 = 0 GROUP BY 1)
SELECT o_orderkey, coalesce(price, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END) AS price, (o_orderstatus = 'F' OR coalesce(flag, 0) = 1)::INTEGER AS flag FROM orders LEFT JOIN m USING (o_orderkey)""")
def _(spark, sf):
    m = table(spark, sf, "events").where("event_id % 2 = 0").groupBy((F.col("event_id") % 15000).alias("o_orderkey")).agg(F.max("value").alias("price"), F.max((F.col("event_type") == "error").cast("int")).alias("flag"))
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), (F.col("o_orderstatus") == "F").cast("int").alias("flag"), "o_orderstatus")
    return J.override(o, m, ["o_orderkey"], ["price"], F.col("o_orderstatus") == "P", ("flag",)).drop("o_orderstatus")


_SNAP = EV + """, snap AS (SELECT season, offense, period, sum(volume)::BIGINT AS volume FROM ev WHERE (offense + period) % 3 <> 0 GROUP BY ALL), grid AS (SELECT DISTINCT season, offense, period FROM ev)"""


@query("asof_prior_snapshot", "WITH " + _SNAP + """, r AS (SELECT g.season, g.offense, g.period, s.period AS snap_period, s.volume, row_number() OVER (PARTITION BY g.season, g.offense, g.period ORDER BY s.period DESC) AS rn FROM grid g JOIN snap s ON s.season = g.season AND s.offense = g.offense AND s.period < g.period)
SELECT g.season, g.offense, g.period, max(CASE WHEN rn = 1 THEN snap_period END) AS last_period, max(CASE WHEN rn = 1 THEN volume END) AS last_volume, max(CASE WHEN rn = 2 THEN volume END) AS before_volume, count(CASE WHEN rn BETWEEN 2 AND 4 THEN 1 END)::INTEGER AS earlier FROM grid g LEFT JOIN r USING (season, offense, period) GROUP BY ALL""")
def _(spark, sf):
    ev = events(spark, sf)
    snap = ev.where((F.col("offense") + F.col("period")) % 3 != 0).groupBy("season", "offense", "period").agg(F.sum("volume").alias("volume"))
    out = J.asof_prior(ev.select("season", "offense", "period").distinct(), snap, ["season", "offense"], "period", ["volume"])
    at = lambda i, c: F.try_element_at("prior", F.lit(i)).getField(c)
    return out.select("season", "offense", "period", at(1, "period").alias("last_period"), at(1, "volume").alias("last_volume"), at(2, "volume").alias("before_volume"), F.greatest(F.size("prior") - 1, F.lit(0)).alias("earlier"))


@query("prior_window_range_join", "WITH " + EV + """, tg AS (SELECT season, period, offense, sum(measure)::BIGINT AS points FROM ev GROUP BY ALL), grid AS (SELECT DISTINCT season, period, offense FROM ev)
SELECT g.offense, g.season AS grid_season, g.period AS grid_period, count(*) AS n, sum(points)::BIGINT AS points, count(CASE WHEN t.season = g.season THEN 1 END) AS current FROM grid g JOIN tg t ON t.offense = g.offense AND ((t.season = g.season AND t.period < g.period) OR t.season = g.season - 1) GROUP BY ALL""")
def _(spark, sf):
    ev = events(spark, sf)
    tg = ev.groupBy("season", "period", "offense").agg(F.sum("measure").alias("points"))
    out = J.prior_window(ev.select("season", "period", "offense").distinct(), tg, ["offense"])
    return out.groupBy("offense", "grid_season", "grid_period").agg(F.count("*").alias("n"), F.sum("points").alias("points"), F.count("age").alias("current"))


@query("asof_identity", "WITH " + EV + """, seen AS (SELECT DISTINCT season, offense, player % 60 AS name, period, player FROM ev WHERE offense % 2 = 0), asked AS (SELECT DISTINCT season, offense, player % 60 AS name, 6 AS period FROM ev WHERE offense % 2 = 0),
j AS (SELECT a.*, list(DISTINCT CASE WHEN s.period = 6 THEN player END) FILTER (WHERE s.period = 6) AS e, list(DISTINCT player) FILTER (WHERE s.period < 6) AS p FROM asked a LEFT JOIN seen s ON s.season = a.season AND s.offense = a.offense AND s.name = a.name AND s.period <= 6 GROUP BY ALL)
SELECT season, offense, name, period, CASE WHEN len(e) = 1 THEN e[1] WHEN e IS NULL AND len(p) = 1 THEN p[1] END AS player, CASE WHEN len(e) = 1 THEN 'exact' WHEN len(e) > 1 THEN 'conflict' WHEN len(p) = 1 THEN 'prior' WHEN len(p) > 1 THEN 'ambiguous' ELSE 'missing' END AS status FROM j""")
def _(spark, sf):
    seen = events(spark, sf).where("offense % 2 = 0").select("season", "offense", (F.col("player") % 60).alias("name"), "period", "player").distinct()
    asked = seen.select("season", "offense", "name").distinct().withColumn("period", F.lit(6))
    return I.asof_identity(asked, seen, ["season", "offense", "name"], "period", "player")


_PARTS = """l AS (SELECT p_partkey AS row_id, CASE WHEN p_partkey % 3 = 0 THEN p_partkey END AS pid, p_name AS name, p_brand AS brand, p_size AS size FROM part), r AS (SELECT p_partkey AS id, p_partkey AS pid, p_name AS name, p_brand AS brand, p_size AS size FROM part WHERE p_partkey % 2 = 0)"""


@query("exact_then_unique_match", "WITH " + _PARTS + """, u3 AS (SELECT name, brand, size, min(id) AS id FROM r GROUP BY ALL HAVING min(id) = max(id)), u2 AS (SELECT name, brand, min(id) AS id FROM r GROUP BY ALL HAVING min(id) = max(id))
SELECT row_id, coalesce(a.id, u3.id, u2.id) AS matched, CASE WHEN a.id IS NOT NULL THEN 'id' WHEN u3.id IS NOT NULL THEN 'full' WHEN u2.id IS NOT NULL THEN 'name' ELSE 'unmatched' END AS method FROM l LEFT JOIN r a ON a.pid = l.pid LEFT JOIN u3 ON u3.name = l.name AND u3.brand = l.brand AND u3.size = l.size LEFT JOIN u2 ON u2.name = l.name AND u2.brand = l.brand""")
def _(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_partkey").alias("pid"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    rows = p.withColumnRenamed("id", "row_id").withColumn("pid", F.when(F.col("pid") % 3 == 0, F.col("pid")))
    return I.match_cascade(rows, p.where("id % 2 = 0"), "id", {"id": ["pid"], "full": ["name", "brand", "size"], "name": ["name", "brand"]}, "row_id").select("row_id", "matched", "method")


@query("provider_conflict_quarantine", """WITH long AS (SELECT DISTINCT (l_orderkey % 300)::VARCHAR AS canonical, provider, value FROM (SELECT l_orderkey, 'a' AS provider, (l_suppkey)::VARCHAR AS value FROM lineitem UNION ALL SELECT l_orderkey, 'b', (l_orderkey % 450)::VARCHAR FROM lineitem))
SELECT provider, 'provider' AS direction, value, count(*) AS others FROM long GROUP BY ALL HAVING count(*) > 1 UNION ALL SELECT provider, 'canonical', canonical, count(*) FROM long GROUP BY ALL HAVING count(*) > 1""")
def _(spark, sf):
    seen = table(spark, sf, "lineitem").select((F.col("l_orderkey") % 300).alias("c"), F.col("l_suppkey").alias("a"), (F.col("l_orderkey") % 450).alias("b"))
    return I.provider_conflicts(seen, "c", ["a", "b"])


_SCORED = f"""n AS (SELECT doc_id, lang, source, {_NAME_SQL.replace("{0}", "text")} AS name FROM documents), k AS (SELECT doc_id, lang, source, md5(replace(name, ' ', '')) AS compact, CASE WHEN len(string_split(name, ' ')) > 1 THEN left(string_split(name, ' ')[1], 1) || '.' || string_split(name, ' ')[-1] END AS short FROM n),
pairs AS (SELECT a.doc_id AS row_id, b.doc_id AS id, (CASE WHEN a.compact = b.compact THEN 50 ELSE 0 END + CASE WHEN a.short = b.short THEN 15 ELSE 0 END + CASE WHEN a.lang = b.lang THEN 20 ELSE 0 END + CASE WHEN a.source = b.source THEN 15 ELSE 0 END)::INTEGER AS score FROM k a JOIN k b ON (a.compact = b.compact OR a.short = b.short) WHERE a.doc_id % 2 = 1 AND b.doc_id % 2 = 0),
top AS (SELECT row_id, score, min(id) AS id, count(*) AS n FROM pairs GROUP BY row_id, score QUALIFY score = max(score) OVER (PARTITION BY row_id))"""


@query("scored_name_match", "WITH " + _SCORED + """ SELECT row_id, CASE WHEN score >= 65 AND n = 1 THEN id END AS id, score, CASE WHEN score < 65 THEN 'weak' WHEN n > 1 THEN 'tied' ELSE 'accepted' END AS status FROM top""")
def _(spark, sf):
    """Whole texts as names: copies are found by a digest of all letters, others by first letter and last word."""
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", F.md5(C.compact_name("text").cast("binary")).alias("compact"), C.initial_last("text").alias("short"))
    d = written(d)  # texts are folded once, though four sides of joins read the keys
    evidence = {"compact": 50, "short": 15, "lang": 20, "source": 15}
    return I.scored_match(d.where("doc_id % 2 = 1").withColumnRenamed("doc_id", "row_id"), d.where("doc_id % 2 = 0").withColumnRenamed("doc_id", "id"), "row_id", "id", ["compact", "short"], evidence)


@query("historical_bridge_match", """WITH h AS (SELECT p_name AS name, p_brand AS brand, p_size AS size, p_partkey AS target FROM part WHERE p_partkey % 2 = 0), r AS (SELECT p_partkey AS source, p_name AS name, p_brand AS brand, p_size AS size FROM part WHERE p_partkey % 2 = 1),
e AS (SELECT name, brand, size, min(target) AS t FROM h GROUP BY ALL HAVING count(DISTINCT target) = 1), w AS (SELECT name, brand, min(target) AS t FROM h GROUP BY ALL HAVING count(DISTINCT target) = 1),
j AS (SELECT r.*, e.t AS et, coalesce(e.t, w.t) AS t FROM r LEFT JOIN e USING (name, brand, size) LEFT JOIN w USING (name, brand)), c AS (SELECT t, count(DISTINCT source) AS n FROM j WHERE t IS NOT NULL GROUP BY t)
SELECT source, CASE WHEN n = 1 THEN j.t END AS target, CASE WHEN j.t IS NULL THEN 'none' WHEN n > 1 THEN 'contested' WHEN et IS NOT NULL THEN 'exact' ELSE 'wide' END AS bridge FROM j LEFT JOIN c USING (t)""")
def _(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("source"), F.col("p_name").alias("name"), F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    history = p.where("source % 2 = 0").withColumnRenamed("source", "target")
    return I.bridge(p.where("source % 2 = 1"), history, ["name", "brand", "size"], ["name", "brand"], "source", "target").select("source", "target", "bridge")


@query("permanent_crosswalk_map", """WITH x AS (SELECT p_partkey AS canonical, unnest([p_partkey % 1500, p_size + 5000, p_partkey + 10000])::VARCHAR AS provider_id FROM part) SELECT min(canonical) AS canonical, provider_id FROM (SELECT DISTINCT * FROM x) GROUP BY provider_id HAVING count(*) = 1""")
def _(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("canonical"), F.concat_ws("|", F.col("p_partkey") % 1500, F.col("p_size") + 5000, F.col("p_partkey") + 10000).alias("ids"))
    return I.crosswalk_map(p, "canonical", "ids")


@query("unordered_pair_key_match", "WITH " + PAIRS + """, o AS (SELECT season, period, least(home::VARCHAR, away::VARCHAR) || '|' || greatest(home::VARCHAR, away::VARCHAR) AS pair, margin FROM games) SELECT s.season, s.period, s.offense, s.defense, points, margin FROM side s JOIN o ON o.season = s.season AND o.period = s.period AND pair = least(offense::VARCHAR, defense::VARCHAR) || '|' || greatest(offense::VARCHAR, defense::VARCHAR)""")
def _(spark, sf):
    g = games(spark, sf).select("season", "period", I.pair_key("home", "away").alias("pair"), "margin")
    return side(spark, sf).withColumn("pair", I.pair_key("offense", "defense")).join(g, ["season", "period", "pair"]).drop("pair")


@query("cross_source_disagreement", """WITH a AS (SELECT o_orderkey AS id, o_totalprice AS v FROM orders WHERE o_orderkey % 10 <> 3), b AS (SELECT o_orderkey AS id, o_totalprice + CASE WHEN o_orderkey % 7 = 0 THEN 1.0 ELSE 0.0 END AS v FROM orders WHERE o_orderkey % 11 <> 4)
SELECT id, a.v AS left_value, b.v AS right_value, CASE WHEN a.id IS NULL THEN 'missing_left' WHEN b.id IS NULL THEN 'missing_right' ELSE 'differs' END AS kind FROM a FULL JOIN b USING (id) WHERE a.id IS NULL OR b.id IS NULL OR abs(a.v - b.v) > 0.5""")
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("v"))
    return J.disagreement(o.where("id % 10 <> 3"), o.where("id % 11 <> 4").withColumn("v", F.col("v") + F.when(F.col("id") % 7 == 0, 1.0).otherwise(0.0)), ["id"], "v", 0.5)


@query("lineage_match", "WITH " + PRED + """, audit AS (SELECT season, count(*) AS expected, min(team)::VARCHAR AS h FROM pred WHERE team % 5 <> 0 OR season % 2 = 0 GROUP BY ALL) SELECT p.season, count(*) AS rows, any_value(expected) AS expected, sum((p.team::VARCHAR < h)::INTEGER)::BIGINT AS violations, count(*) = any_value(expected) AS covered FROM pred p JOIN audit USING (season) GROUP BY p.season""")
def _(spark, sf):
    p = predictions(spark, sf)
    audit = p.where("team % 5 <> 0 or season % 2 = 0").groupBy("season").agg(F.count("*").alias("expected"), F.min("team").cast("string").alias("h"))
    out = J.checked_join(p, audit, ["season"], "inner").groupBy("season").agg(F.count("*").alias("rows"), F.max("expected").alias("expected"), F.sum((F.col("team").cast("string") < F.col("h")).cast("int")).alias("violations"))
    return out.withColumn("covered", F.col("rows") == F.col("expected"))


@query("cross_team_ownership", """WITH s AS (SELECT l_suppkey % 200 AS id, l_linenumber AS team, (l_quantity > 45 AND l_partkey % 40 = 0)::INTEGER AS own FROM lineitem WHERE l_suppkey % 3 <> 0 OR l_linenumber = 1),
g AS (SELECT id, list_sort(list(DISTINCT team)) AS teams, count(DISTINCT CASE WHEN own = 1 THEN team END) AS owners, min(CASE WHEN own = 1 THEN team END) AS o FROM s GROUP BY id)
SELECT id, array_to_string(teams, '|') AS teams, owners, CASE WHEN len(teams) = 1 THEN 'single' WHEN owners = 1 THEN 'owned' ELSE 'quarantined' END AS status, CASE WHEN len(teams) = 1 OR owners = 1 THEN coalesce(o, teams[1]) END AS owner FROM g""")
def _(spark, sf):
    s = table(spark, sf, "lineitem").where("l_suppkey % 3 <> 0 or l_linenumber = 1").select((F.col("l_suppkey") % 200).alias("id"), F.col("l_linenumber").alias("team"), ((F.col("l_quantity") > 45) & (F.col("l_partkey") % 40 == 0)).cast("int").alias("own"))
    return I.ownership(s, "id", "team", "own")


@query("fallback_provider_link", """WITH f AS (SELECT p_name AS name, min(p_partkey) AS b FROM part WHERE p_partkey % 9 = 0 GROUP BY p_name HAVING count(DISTINCT p_partkey) = 1), r AS (SELECT p_partkey AS id, p_name AS name, CASE WHEN p_partkey % 4 = 0 THEN p_partkey END AS pid FROM part)
SELECT id, r.name, coalesce(pid::VARCHAR, b::VARCHAR, 'new_' || replace(lower(r.name), ' ', '_')) AS pid, CASE WHEN pid IS NOT NULL THEN 'own' WHEN b IS NOT NULL THEN 'borrowed' ELSE 'synthetic' END AS method FROM r LEFT JOIN f USING (name)""")
def _(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_partkey").alias("pid"))
    return I.link_or_borrow(p.withColumn("pid", F.when(F.col("id") % 4 == 0, F.col("pid"))), p.where("id % 9 = 0").drop("id"), "name", "pid", "new_")


@query("kernel_cross_join", "WITH " + PRED + """, h AS (SELECT line, sign(actual - line)::INTEGER AS outcome, count(*) AS n FROM pred GROUP BY ALL), c AS (SELECT DISTINCT model AS line FROM pred)
SELECT c.line, outcome, round(sum(n * exp(-pow((c.line - h.line) / 5.0::DOUBLE, 2) / 2)), 6) AS weight, sum(n)::BIGINT AS n FROM c CROSS JOIN h GROUP BY ALL""")
def _(spark, sf):
    p = predictions(spark, sf)
    out = J.kernel_weighted(p.select(F.col("model").alias("line")), p.withColumn("outcome", F.signum(F.col("actual") - F.col("line")).cast("int")), "line", "outcome", 5.0)
    return out.withColumn("weight", F.round("weight", 6))


_CAND = EV + """, v AS (SELECT offense, p_type AS slot, l_partkey % 60 AS player, sum(volume)::BIGINT AS vol FROM ev JOIN part ON p_partkey = l_partkey GROUP BY ALL), c AS (SELECT offense, slot, player, (row_number() OVER (PARTITION BY offense, slot ORDER BY vol DESC, player))::INTEGER AS rank FROM v QUALIFY rank <= 3)"""


def _candidates(spark, sf, most=3):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("slot"))
    v = events(spark, sf).join(p, "l_partkey").groupBy("offense", "slot", (F.col("l_partkey") % 60).alias("player")).agg(F.sum("volume").alias("vol"))
    w = Window.partitionBy("offense", "slot").orderBy(F.desc("vol"), "player")
    return v.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)


@query("distinct_slot_assignment", "WITH " + _CAND + """, x AS (SELECT a.offense, a.player AS ECONOMY, b.player AS STANDARD, d.player AS PROMO, ((a.rank = 1)::INTEGER + (b.rank = 1)::INTEGER + (d.rank = 1)::INTEGER) AS first_choices, (a.rank + b.rank + d.rank)::BIGINT AS rank_sum FROM c a JOIN c b ON b.offense = a.offense AND b.slot = 'STANDARD' AND b.player <> a.player JOIN c d ON d.offense = a.offense AND d.slot = 'PROMO' AND d.player <> a.player AND d.player <> b.player WHERE a.slot = 'ECONOMY'),
k AS (SELECT *, rank() OVER (PARTITION BY offense ORDER BY first_choices DESC, rank_sum) AS k FROM x), t AS (SELECT *, count(*) OVER (PARTITION BY offense) AS ties, row_number() OVER (PARTITION BY offense ORDER BY ECONOMY, STANDARD, PROMO) AS rn FROM k WHERE k = 1) SELECT offense, ECONOMY, STANDARD, PROMO, first_choices, rank_sum, ties FROM t WHERE rn = 1""")
def _(spark, sf):
    return I.distinct_slots(_candidates(spark, sf), ["offense"], ["ECONOMY", "STANDARD", "PROMO"], "slot", "player", "rank")


@query("evidence_slot_assignment", "WITH " + EV + """, top AS (SELECT offense, player, sum(volume) AS vol FROM ev GROUP BY offense, player QUALIFY row_number() OVER (PARTITION BY offense ORDER BY vol DESC, player) <= 3),
p AS (SELECT offense, player, row_number() OVER (PARTITION BY offense ORDER BY vol DESC, player) AS rn FROM top), e AS (SELECT offense, player, kind, sum(measure)::BIGINT AS w FROM ev GROUP BY ALL),
perm(perm, a, b, c) AS (VALUES (0, 'R', 'A', 'N'), (1, 'R', 'N', 'A'), (2, 'A', 'R', 'N'), (3, 'A', 'N', 'R'), (4, 'N', 'R', 'A'), (5, 'N', 'A', 'R')), perms AS (SELECT perm, 1 AS rn, a AS kind FROM perm UNION ALL SELECT perm, 2, b FROM perm UNION ALL SELECT perm, 3, c FROM perm),
s AS (SELECT offense, perm, sum(coalesce(w, 0))::BIGINT AS evidence FROM p JOIN perms USING (rn) LEFT JOIN e USING (offense, player, kind) GROUP BY ALL), best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY offense ORDER BY evidence DESC, perm) = 1)
SELECT offense, player, kind, evidence FROM p JOIN best USING (offense) JOIN perms USING (perm, rn)""")
def _(spark, sf):
    ev = events(spark, sf)
    w = Window.partitionBy("offense").orderBy(F.desc("vol"), "player")
    top = ev.groupBy("offense", "player").agg(F.sum("volume").alias("vol")).withColumn("rn", F.row_number().over(w)).where("rn <= 3").drop("vol")
    return I.evidence_slots(top, ev.groupBy("offense", "player", "kind").agg(F.sum("measure").alias("w")), ["offense"], ["R", "A", "N"], "player", "kind", "w")


@query("entity_token_match")
def _(spark, sf):
    """The long words of all conversations to those of the benchmark, which several of them are like."""
    words = lambda name: table(spark, sf, name).select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}{9,}"), 0)).alias("word")).distinct()
    tokens = words("conversations").select(F.concat(F.lit("t:"), "word").alias("token_id"), F.col("word").alias("token"))
    return I.token_match(tokens, words("benchmark").select(F.col("word").alias("entity"), F.col("word").alias("alias")), "token_id", "token", "entity", "alias")


@query("training_frame_assemble", "WITH " + PRED + """, form AS (SELECT season, team, count(*) AS n FROM pred GROUP BY ALL) SELECT p.season, p.period, p.team, p.actual, p.line, f.n AS form, n_name AS unit FROM pred p JOIN form f USING (season, team) JOIN nation ON n_nationkey = p.team WHERE p.line IS NOT NULL""")
def _(spark, sf):
    p = predictions(spark, sf)
    form = p.groupBy("season", "team").agg(F.count("*").alias("form"))
    units = table(spark, sf, "nation").select(F.col("n_nationkey").alias("team"), F.col("n_name").alias("unit"))
    out = J.checked_join(J.checked_join(p, form, ["season", "team"], "inner"), units, ["team"], "inner")
    return out.where("line is not null").select("season", "period", "team", "actual", "line", "form", "unit")
