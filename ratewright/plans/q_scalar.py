"""Queries of the cleaning, standardising and formula operators."""

from __future__ import annotations


from pyspark.sql import functions as F

from ratewright.functions import clean as C
from ratewright.operators import standardize as S
from ratewright.plans.base import EV, PRED, events, predictions, query, table

_LETTERS, _PLAIN = (x.replace("'", "''") for x in C.ascii_letters())
_NAME_SQL = (
    r"regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(lower(translate({0}, '" + _LETTERS + "', '" + _PLAIN + r"')), '[^\x00-\x7F]', '', 'g'), '[''.]', '', 'g'), '[^a-z0-9]+', ' ', 'g')), ' (jr|sr|ii|iii|iv|v)$', '')"
)
_PHI_SQL = """CASE WHEN {x} >= 0 THEN 1 - {u} ELSE {u} END"""


def phi_sql(x: str) -> str:
    t = f"(1 / (1 + 0.2316419::DOUBLE * abs({x})))"
    poly = "0.0::DOUBLE"
    for b in reversed(C._CDF):
        poly = f"{t} * ({b!r}::DOUBLE + {poly})"
    upper = f"(exp(-({x}) * ({x}) / 2) * ({poly}) * 0.3989422804014327::DOUBLE)"
    return _PHI_SQL.format(x=x, u=upper)


@query("standardize_aliases", """SELECT CAST(o_orderkey AS VARCHAR) AS game_id, o_totalprice AS score, CAST(o_orderdate AS DATE) AS game_date, 0 AS neutral, o_orderstatus AS status FROM orders""")
def _(spark, sf):
    spec = {
        "game_id": S.Field(("game_id", "O_ORDERKEY"), "string", required=True),
        "score": S.Field(("points", "o_totalprice"), "double"),
        "game_date": S.Field(("gameday", "o_orderdate"), "date"),
        "neutral": S.Field(("neutral_site",), "int", 0),
        "status": S.Field(("o_orderstatus",), "string"),
    }
    return S.standardize(table(spark, sf, "orders"), spec)


@query("standardize_events", "WITH " + EV + """ SELECT season, period, offense, defense, measure::DOUBLE AS epa, (l_discount < 0.05)::INTEGER AS success, (kind = 'R')::INTEGER AS pass, (kind = 'A')::INTEGER AS rush, (status = 'F')::INTEGER AS sack, player::VARCHAR AS player FROM ev""")
def _(spark, sf):
    raw = events(spark, sf).withColumns({"is_ok": (F.col("l_discount") < 0.05).cast("int"), "r": (F.col("kind") == "R").cast("string"), "a": (F.col("kind") == "A").cast("int"), "f": (F.col("status") == "F").cast("int")})
    spec = {k: S.Field((k,), "int", required=True) for k in ("season", "period", "offense", "defense")}
    spec |= {"epa": S.Field(("measure",), "double"), "success": S.Field(("success", "is_ok"), "int", 0), "rush": S.Field(("a",), "int", 0), "sack": S.Field(("f",), "int", 0), "player": S.Field(("player",), "string")}
    out = S.standardize(raw.withColumn("r", S.truthy("r")), spec | {"pass": S.Field(("r",), "int", 0)})
    return out


@query("standardize_participation", "WITH " + EV + """ SELECT season, period, offense AS team, player, sum(volume)::BIGINT AS snaps, sum(CASE WHEN kind = 'N' THEN volume ELSE 0 END)::BIGINT AS st_snaps FROM ev GROUP BY ALL""")
def _(spark, sf):
    raw = events(spark, sf).select("season", "period", F.col("offense").alias("team"), "player", F.col("volume").alias("snaps"), F.when(F.col("kind") == "N", F.col("volume")).otherwise(0).alias("st_snaps"))
    return S.sum_duplicates(raw, ["season", "period", "team", "player"], ["snaps", "st_snaps"])


@query("standardize_rosters", """WITH r AS (SELECT DISTINCT s_suppkey::VARCHAR AS player_id, s_name AS name, s_nationkey AS team, s_acctbal FROM supplier UNION SELECT DISTINCT c_custkey::VARCHAR, c_name, c_nationkey, c_acctbal FROM customer)
SELECT player_id, name, team, array_to_string(list_filter([CASE WHEN s_acctbal < 0 THEN 'negative' END, CASE WHEN team % 5 = 0 THEN 'team' END, CASE WHEN length(player_id) < 2 THEN 'short_id' END], lambda x: x IS NOT NULL), '|') AS issues FROM r""")
def _(spark, sf):
    a = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("player_id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("team"), "s_acctbal")
    b = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("player_id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("team"), F.col("c_acctbal").alias("s_acctbal"))
    checks = {"negative": F.col("s_acctbal") < 0, "team": F.col("team") % 5 == 0, "short_id": F.length("player_id") < 2}
    return S.flag_issues(a.unionByName(b).dropDuplicates(), checks).drop("s_acctbal")


@query("standardize_weekly_stats", "WITH " + EV + """ SELECT season, period, player, max(volume) AS volume, avg(measure) AS measure, min(offense) AS team FROM (SELECT *, row_number() OVER (PARTITION BY season, period, player ORDER BY l_orderkey, offense) AS rn FROM ev) GROUP BY season, period, player""")
def _(spark, sf):
    out = S.collapse_repeats(events(spark, sf), ["season", "period", "player"], ["volume"], ["measure"], ["offense"], "offense")
    return out.withColumnRenamed("offense", "team")


@query("standardize_factors", """WITH f AS (SELECT o_custkey AS home, month(o_orderdate)::INTEGER AS period, (upper(trim(CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'no' END)) IN ('1', 'YES'))::INTEGER AS short_rest, o_totalprice AS miles, row_number() OVER (PARTITION BY o_custkey, month(o_orderdate) ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
SELECT home, period, short_rest, miles FROM f WHERE rn = 1""")
def _(spark, sf):
    o = table(spark, sf, "orders").withColumns({"flag": F.when(F.col("o_orderstatus") == "F", " yes ").otherwise("no"), "period": F.month("o_orderdate")})
    one = S.unique_by(o, ["o_custkey", "period"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return one.select(F.col("o_custkey").alias("home"), "period", S.truthy("flag").alias("short_rest"), F.col("o_totalprice").alias("miles"))


@query("standardize_local_metrics", """SELECT event_id::VARCHAR AS id, user_id AS season_key, value AS rating, CAST(ts AS DATE) AS day, NULL::DOUBLE AS cpoe FROM events""")
def _(spark, sf):
    spec = {"id": S.Field(("event_id",), "string", required=True), "season_key": S.Field(("user_id",), "long"), "rating": S.Field(("grade", "value"), "double"), "day": S.Field(("ts",), "date"), "cpoe": S.Field(("cpoe",), "double")}
    return S.standardize(table(spark, sf, "events"), spec)


@query("coalesce_columns", """SELECT p_partkey, coalesce(nullif(trim(CASE WHEN p_size % 3 = 0 THEN '  ' ELSE p_brand END), ''), nullif(trim(p_type), ''), p_name) AS label FROM part""")
def _(spark, sf):
    p = table(spark, sf, "part").withColumn("b", F.when(F.col("p_size") % 3 == 0, "  ").otherwise(F.col("p_brand")))
    return p.select("p_partkey", C.coalesce_columns("b", "p_type", "p_name").alias("label"))


@query("alias_without_collision", """SELECT p_partkey, coalesce(CASE WHEN p_size > 25 THEN p_brand END, p_type) AS brand FROM part""")
def _(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.when(F.col("p_size") > 25, F.col("p_brand")).alias("brand"), F.col("p_type").alias("brand_name"))
    return S.merge_aliases(p, {"brand": ["brand_name"]})


@query("point_in_time_filter", """SELECT o_orderkey, month(o_orderdate)::INTEGER AS period, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate END AS played FROM orders WHERE month(o_orderdate) <= 6 AND (o_orderkey % 7 = 0 OR o_orderdate <= TIMESTAMP '1998-06-30') AND o_orderstatus = 'F'""")
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.month("o_orderdate").alias("period"), F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate")).alias("played"), (F.col("o_orderstatus") == "F").cast("int").alias("done"))
    return S.point_in_time(o, "period", 6, "played", F.to_timestamp(F.lit("1998-06-30")), "done").drop("done")


@query("scrimmage_filter", "WITH " + EV + """ SELECT season, period, offense, count(*) AS plays, sum(measure)::BIGINT AS total FROM ev WHERE kind <> 'N' AND status <> 'O' GROUP BY ALL""")
def _(spark, sf):
    ev = events(spark, sf).withColumns({"special": (F.col("kind") == "N").cast("int"), "no_play": (F.col("status") == "O").cast("int")})
    return S.exclude_flags(ev, ["special", "no_play"], ["measure", "offense"]).groupBy("season", "period", "offense").agg(F.count("*").alias("plays"), F.sum("measure").alias("total"))


@query("clip_outliers", "WITH " + EV + """ SELECT season, offense, sum(greatest(least(measure, 50000), 5000))::BIGINT AS clipped, sum(measure)::BIGINT AS raw FROM ev GROUP BY ALL""")
def _(spark, sf):
    ev = events(spark, sf).withColumn("raw", F.col("measure"))
    return S.clip_columns(ev, {"measure": (5000, 50000)}).groupBy("season", "offense").agg(F.sum("measure").cast("long").alias("clipped"), F.sum("raw").alias("raw"))


@query("price_sign_normalize", """SELECT event_id, -coalesce(CASE WHEN event_id % 4 <> 0 THEN round(value / 50) END, round(value / 100)) AS home_margin, CASE WHEN event_id % 4 <> 0 THEN 'current' ELSE 'opening' END AS line_kind FROM events""")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 4 != 0, F.round(F.col("value") / 50)).alias("current"), F.round(F.col("value") / 100).alias("opening"))
    return e.select("event_id", (-F.coalesce("current", "opening")).alias("home_margin"), F.when(F.col("current").isNotNull(), "current").otherwise("opening").alias("line_kind"))


@query("game_key_derive", """SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey::VARCHAR END, year(o_orderdate)::VARCHAR || '_' || month(o_orderdate)::VARCHAR || '_' || o_custkey::VARCHAR) AS game_id FROM orders""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    key = F.coalesce(F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey").cast("string")), F.concat_ws("_", F.year("o_orderdate"), F.month("o_orderdate"), "o_custkey"))
    return o.select("o_orderkey", key.alias("game_id"))


@query("labels_view", "WITH " + PRED + """ SELECT season, period, team, CASE WHEN edge = 0 THEN 'pick''em' WHEN edge > 0 THEN printf('T%d -%.1f', team, abs(edge)::DOUBLE) ELSE printf('line -%.1f', abs(edge)::DOUBLE) END AS label, CASE WHEN abs(edge) >= 20 THEN 'PLAY' ELSE 'PASS' END AS decision FROM pred""")
def _(spark, sf):
    p = predictions(spark, sf)
    return p.select("season", "period", "team", C.spread_label(F.concat(F.lit("T"), "team"), F.lit("line"), "edge").alias("label"), F.when(F.abs("edge") >= 20, "PLAY").otherwise("PASS").alias("decision"))


@query("forbidden_feature_guard", "SELECT DISTINCT c_nationkey AS offense FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey")
def _(spark, sf):
    return events(spark, sf).select(*S.guard_features(["offense"])).distinct()


@query("clean_scalar", """SELECT l_orderkey, CASE WHEN lower(trim(x)) IN ('', 'nan', 'none', 'null', 'na', 'n/a', '<na>', 'nat') THEN NULL ELSE regexp_replace(trim(x), '^(-?[0-9]+)\\.0+$', '\\1') END AS cleaned FROM (SELECT l_orderkey, CASE WHEN l_linenumber = 1 THEN ' NaN ' WHEN l_linenumber = 2 THEN ' x ' ELSE l_orderkey::VARCHAR || '.0' END AS x FROM lineitem)""".replace("\\\\", "\\"))
def _(spark, sf):
    x = F.when(F.col("l_linenumber") == 1, " NaN ").when(F.col("l_linenumber") == 2, " x ").otherwise(F.concat(F.col("l_orderkey").cast("string"), F.lit(".0")))
    return table(spark, sf, "lineitem").select("l_orderkey", C.clean_scalar(x).alias("cleaned"))


@query("normalize_code", """SELECT c_custkey, CASE upper(trim(c_mktsegment)) WHEN 'AUTOMOBILE' THEN 'AUTO' WHEN 'HOUSEHOLD' THEN 'HOME' ELSE upper(trim(c_mktsegment)) END AS code FROM customer""")
def _(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", C.normalize_code(F.lower("c_mktsegment"), {"AUTOMOBILE": "AUTO", "HOUSEHOLD": "HOME"}).alias("code"))


@query("name_keys", f"""WITH n AS (SELECT doc_id, {_NAME_SQL.replace("{0}", "text || ' Jr.'")} AS name FROM documents)
SELECT doc_id, name, replace(name, ' ', '') AS compact, CASE WHEN len(string_split(name, ' ')) > 1 THEN left(string_split(name, ' ')[1], 1) || '.' || string_split(name, ' ')[-1] END AS initial_last FROM n""")
def _(spark, sf):
    text = F.concat("text", F.lit(" Jr."))
    return table(spark, sf, "documents").select("doc_id", C.normalize_name(text).alias("name"), C.compact_name(text).alias("compact"), C.initial_last(text).alias("initial_last"))


@query("alias_list", """SELECT p_partkey, array_to_string(list_filter(CASE WHEN a = b THEN [a, c] WHEN a = c OR b = c THEN [a, b] ELSE [a, b, c] END, lambda x: x IS NOT NULL), '|') AS aliases FROM (SELECT p_partkey, p_brand AS a, p_type AS b, CASE WHEN p_size % 2 = 0 THEN p_brand ELSE p_name END AS c FROM part)""")
def _(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", C.alias_list("p_brand", "p_type", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise(F.col("p_name"))).alias("aliases"))


@query("normalize_date", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN 'week ' || o_orderkey ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""")
def _(spark, sf):
    k = F.col("o_orderkey") % 3
    raw = F.when(k == 0, F.date_format("o_orderdate", "MM/dd/yyyy")).when(k == 1, F.date_format("o_orderdate", "yyyyMMdd")).otherwise(F.concat(F.lit("week "), "o_orderkey"))
    return table(spark, sf, "orders").select("o_orderkey", C.normalize_date(raw).alias("day"))


@query("safe_divide", "WITH " + EV + """ SELECT season, offense, coalesce(sum(CASE WHEN kind = 'R' AND player % 3 = 0 THEN measure END)::DOUBLE / nullif(sum(CASE WHEN kind = 'R' AND player % 3 = 0 THEN volume END), 0), 0) AS rate FROM ev GROUP BY ALL""")
def _(spark, sf):
    on = (F.col("kind") == "R") & (F.col("player") % 3 == 0)
    agg = events(spark, sf).groupBy("season", "offense").agg(F.sum(F.when(on, F.col("measure"))).alias("a"), F.sum(F.when(on, F.col("volume"))).alias("b"))
    return agg.select("season", "offense", C.safe_divide("a", "b", 0.0).alias("rate"))


@query("american_odds", """WITH p AS (SELECT event_id, (event_id % 500) - 250 AS raw FROM events), s AS (SELECT event_id, CASE WHEN abs(raw) >= 100 THEN raw ELSE -110 END::DOUBLE AS price FROM p)
SELECT event_id, price, round(CASE WHEN price < 0 THEN -price / (-price + 100) ELSE 100 / (price + 100) END, 9) AS implied, round(CASE WHEN price < 0 THEN 100 / -price ELSE price / 100 END, 9) AS profit FROM s""")
def _(spark, sf):
    e = table(spark, sf, "events").select("event_id", C.sane_price(F.col("event_id") % 500 - 250).alias("price"))
    return e.select("event_id", "price", F.round(C.implied_probability("price"), 9).alias("implied"), F.round(C.net_profit("price"), 9).alias("profit"))


@query("normal_cdf", f"""SELECT event_id, round({phi_sql("((value - 50) / 25)")}, 7) AS p FROM events""")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", F.round(C.normal_cdf((F.col("value") - 50) / 25), 7).alias("p"))


_KELLY = f"""WITH {PRED}, c AS (SELECT season, period, team, edge, {phi_sql("((abs(edge) + 0.5) / 13.5)")} AS p FROM pred)
SELECT season, period, team, round(p, 7) AS cover_probability, round(110.0::DOUBLE / 210, 7) AS break_even, round(least(greatest((p * (100.0::DOUBLE / 110) - (1 - p)) / (100.0::DOUBLE / 110) * 0.25, 0), 0.05), 7) AS kelly_stake,
CASE WHEN p <= 110.0::DOUBLE / 210 THEN 'pass' WHEN abs(edge) < 2 THEN 'lean' ELSE 'play' END AS decision FROM c"""


@query("cover_probability_kelly", _KELLY)
def _(spark, sf):
    got = C.cover_and_kelly("edge", 0.5, 13.5, F.lit(-110))
    return predictions(spark, sf).select("season", "period", "team", *((F.round(v, 7) if k != "decision" else v).alias(k) for k, v in got.items()))


@query("rest_travel_adjust", """SELECT o_orderkey, greatest(least((o_custkey % 11 - o_orderkey % 9) * 0.5, 2.0), -2.0)::DOUBLE AS rest, greatest(least((CASE WHEN o_totalprice > 200000 THEN 0.75 ELSE 0 END) + (CASE WHEN o_orderstatus = 'F' THEN 0.5 ELSE 0 END) + (CASE WHEN o_custkey % 4 = 0 THEN 0.5 ELSE 0 END), 1.5), -1.5)::DOUBLE AS travel,
array_to_string(list_filter([CASE WHEN o_totalprice > 200000 THEN 'long_trip' END, CASE WHEN o_orderstatus = 'F' THEN 'road' END, CASE WHEN o_custkey % 4 = 0 THEN 'zone' END], lambda x: x IS NOT NULL), '|') AS reasons FROM orders""")
def _(spark, sf):
    points, reasons = C.factor_points({"long_trip": (F.col("o_totalprice") > 200000, 0.75), "road": (F.col("o_orderstatus") == "F", 0.5), "zone": (F.col("o_custkey") % 4 == 0, 0.5)}, 1.5)
    return table(spark, sf, "orders").select("o_orderkey", C.rest_points(F.col("o_custkey") % 11, F.col("o_orderkey") % 9).alias("rest"), points.alias("travel"), reasons.alias("reasons"))


@query("availability_class", """WITH s AS (SELECT user_id, arg_max(CASE event_type WHEN 'error' THEN 'Out' WHEN 'click' THEN 'Questionable' ELSE event_type END, ts) AS status FROM events GROUP BY user_id)
SELECT user_id, CASE WHEN lower(status) = 'out' THEN 'unavailable' WHEN lower(status) = 'questionable' THEN 'uncertain' ELSE 'available' END AS availability FROM s""")
def _(spark, sf):
    status = F.when(F.col("event_type") == "error", "Out").when(F.col("event_type") == "click", "Questionable").otherwise(F.col("event_type"))
    newest = table(spark, sf, "events").groupBy("user_id").agg(F.max(F.struct(F.col("ts").alias("date"), status.alias("status"))).alias("newest"))
    return newest.select("user_id", C.availability(C.latest_injury(F.array("newest"))).alias("availability"))


@query("iso_time", """SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS stamp, (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(ts)) / 60000000.0::DOUBLE AS age FROM events""")
def _(spark, sf):
    e = table(spark, sf, "events").withColumn("stamp", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return e.select("event_id", "stamp", C.age_minutes(F.col("ts").cast("timestamp"), F.to_timestamp(F.lit("2024-02-01"))).alias("age"))


@query("price_text_parse", """SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 0.0 ELSE (CASE WHEN event_id % 2 = 0 THEN -1.0 ELSE 1.0 END) * (event_id % 17 + CASE WHEN event_id % 3 = 0 THEN 0.5 ELSE 0.0 END) END::DOUBLE AS spread FROM events""")
def _(spark, sf):
    k = F.col("event_id")
    token = F.when(k % 11 == 0, "pk").otherwise(F.concat(F.when(k % 2 == 0, "-").otherwise("+ "), (k % 17).cast("string"), F.when(k % 3 == 0, F.when(k % 5 == 0, "%").otherwise("½")).otherwise("")))
    return table(spark, sf, "events").select("event_id", C.parse_price_text(token).alias("spread"))


