"""Queries of the quality checks, the readers and fingerprints, and the offer stream."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ratewright.operators import quality as Q
from ratewright.plans.base import EV, PRED, events, predictions, query, table
from ratewright.sources import io
from ratewright.streaming import offers


@query("expect_table", """SELECT 'orders' AS category, 'rows' AS "check", true AS required, count(*) >= 1000 AS passed, '1000' AS expected, count(*)::VARCHAR AS observed FROM orders UNION ALL SELECT 'orders', 'distinct', true, count(DISTINCT o_custkey) >= 10, '10', count(DISTINCT o_custkey)::VARCHAR FROM orders UNION ALL SELECT 'orders', 'period', true, count(CASE WHEN o_orderstatus = 'Z' THEN 1 END) > 0, '> 0', count(CASE WHEN o_orderstatus = 'Z' THEN 1 END)::VARCHAR FROM orders""")
def _(spark, sf):
    return Q.expect_table(table(spark, sf, "orders"), "orders", 1000, "o_custkey", 10, "o_orderstatus", "Z")


@query("input_contract", """SELECT 'p_size in bounds' AS rule, count(CASE WHEN NOT p_size BETWEEN 2 AND 45 THEN 1 END) AS violations, count(*) AS rows FROM part UNION ALL SELECT 'p_name not null', count(CASE WHEN p_name IS NULL THEN 1 END), count(*) FROM part UNION ALL SELECT 'unique p_name', (count(*) - count(DISTINCT p_name))::BIGINT, count(*) FROM part""")
def _(spark, sf):
    return Q.input_contract(table(spark, sf, "part"), ["p_name", "p_size"], ["p_name"], {"p_size": (2, 45)})


@query("lineage_unchanged", """WITH a AS (SELECT p_partkey AS k, p_name AS h FROM part WHERE p_partkey % 5 <> 0), b AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 7 = 0 THEN p_brand ELSE p_name END AS h FROM part WHERE p_partkey % 3 <> 0)
SELECT k, CASE WHEN a.k IS NULL THEN 'new' WHEN b.k IS NULL THEN 'gone' WHEN a.h = b.h THEN 'same' ELSE 'changed' END AS status FROM a FULL JOIN b USING (k)""")
def _(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("h"), "p_brand")
    return Q.lineage_unchanged(p.where("k % 5 <> 0"), p.where("k % 3 <> 0").withColumn("h", F.when(F.col("k") % 7 == 0, F.col("p_brand")).otherwise(F.col("h"))), "k", "h")


@query("run_state_check", """WITH r AS (SELECT event_type, ts, event_id % 3 AS rows, event_id % 2 AS excluded, 2 AS expected FROM events), n AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC) = 1) SELECT event_type, ts, rows, CASE WHEN rows = 0 THEN excluded = expected ELSE rows + excluded = expected END AS passed FROM n""")
def _(spark, sf):
    r = table(spark, sf, "events").select("event_type", "ts", (F.col("event_id") % 3).alias("rows"), (F.col("event_id") % 2).alias("excluded"), F.lit(2).cast("long").alias("expected"))
    return Q.run_state(r, ["event_type"], "ts", "rows", "excluded", "expected")


@query("expect_ranges", """SELECT 'positive' AS rule, count(CASE WHEN NOT l_extendedprice > 0 THEN 1 END) AS violations, count(*) AS rows FROM lineitem UNION ALL SELECT 'discount', count(CASE WHEN NOT l_discount BETWEEN 0 AND 0.05 THEN 1 END), count(*) FROM lineitem UNION ALL SELECT 'dated', count(CASE WHEN l_shipdate IS NULL OR l_shipdate < TIMESTAMP '1996-01-01' THEN 1 END), count(*) FROM lineitem""")
def _(spark, sf):
    return Q.violations(table(spark, sf, "lineitem"), {"positive": F.col("l_extendedprice") > 0, "discount": F.col("l_discount").between(0, 0.05), "dated": F.col("l_shipdate") >= F.to_timestamp(F.lit("1996-01-01"))})


@query("no_lookahead_audit", "WITH " + PRED + """, x AS (SELECT *, period - 1 - CASE WHEN team % 9 = 0 THEN -1 ELSE 0 END AS through, CASE WHEN team % 8 <> 0 THEN team::VARCHAR END AS h FROM pred) SELECT 'through before period' AS rule, count(CASE WHEN NOT through <= period - 1 THEN 1 END) AS violations, count(*) AS rows FROM x UNION ALL SELECT 'hash present', count(CASE WHEN h IS NULL THEN 1 END), count(*) FROM x UNION ALL SELECT 'unique keys', (count(*) - count(DISTINCT (season, period)))::BIGINT, count(*) FROM x""")
def _(spark, sf):
    x = predictions(spark, sf).withColumns({"through": F.col("period") - 1 + F.when(F.col("team") % 9 == 0, 1).otherwise(0), "h": F.when(F.col("team") % 8 != 0, F.col("team").cast("string"))})
    return Q.no_lookahead(x, "through", "period", ["season", "period"], "h")


@query("integrity_certificate", """WITH c AS (SELECT 'orders' AS k, 'rows' AS n, count(*) >= 1000 AS p FROM orders UNION ALL SELECT 'orders', 'distinct', count(DISTINCT o_custkey) >= 10 FROM orders UNION ALL SELECT 'part', 'rows', count(*) >= 1000000 FROM part)
SELECT count(*) AS checks, count(CASE WHEN p THEN 1 END) AS passed, CASE WHEN bool_and(p) THEN 'PASS' ELSE 'FAIL' END AS status, '[' || coalesce(string_agg(CASE WHEN NOT p THEN '"' || k || '.' || n || '"' END, ',' ORDER BY k || '.' || n), '') || ']' AS failures FROM c""")
def _(spark, sf):
    a = Q.expect_table(table(spark, sf, "orders"), "orders", 1000, "o_custkey", 10)
    return Q.certificate([a, Q.expect_table(table(spark, sf, "part"), "part", 1000000)])[1]


@query("prior_result_reconcile", """WITH s AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 <> 0 THEN o_custkey END AS score FROM orders), o AS (SELECT o_orderkey AS k, o_custkey AS score FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_custkey + 1 FROM orders WHERE o_orderkey % 8 = 0 UNION ALL SELECT o_orderkey, o_custkey + 2 FROM orders WHERE o_orderkey % 25 = 1), u AS (SELECT k, min(score) AS v, count(DISTINCT score) AS n FROM o GROUP BY k)
SELECT k, CASE WHEN score IS NULL AND n = 1 THEN v ELSE score END AS score, CASE WHEN n IS NULL THEN CASE WHEN score IS NULL THEN 'missing' ELSE 'kept' END WHEN score IS NULL THEN CASE WHEN n = 1 THEN 'filled' ELSE 'ambiguous' END WHEN n = 1 AND v = score THEN 'confirmed' ELSE 'conflict' END AS status FROM s LEFT JOIN u USING (k)""")
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("score"))
    other = o.where("k % 2 = 0").unionByName(o.where("k % 8 = 0").withColumn("score", F.col("score") + 1)).unionByName(o.where("k % 25 = 1").withColumn("score", F.col("score") + 2))
    return Q.reconcile_results(o.withColumn("score", F.when(F.col("k") % 3 != 0, F.col("score"))), other, ["k"], "score")


@query("signal_variation_check", """WITH x AS (SELECT p_brand AS team, CASE WHEN p_size % 3 <> 0 THEN CASE WHEN p_brand < 'Brand#2' THEN 1 ELSE p_size END END AS s, CASE WHEN p_brand = 'Brand#1' THEN 1 ELSE p_size END AS h FROM part), d AS (SELECT team, count(s) / count(*)::DOUBLE AS coverage, count(DISTINCT s) AS "values", max(h) AS h FROM x GROUP BY team)
SELECT team, round(coverage, 9) AS coverage, "values", CASE WHEN coverage < 0.6 THEN 'low coverage' WHEN "values" > 1 THEN 'ok' WHEN h <= 1 THEN 'first game' ELSE 'constant' END AS status FROM d""")
def _(spark, sf):
    x = table(spark, sf, "part").select(F.col("p_brand").alias("team"), F.when(F.col("p_size") % 3 != 0, F.when(F.col("p_brand") < "Brand#2", 1).otherwise(F.col("p_size"))).alias("s"), F.when(F.col("p_brand") == "Brand#1", 1).otherwise(F.col("p_size")).alias("h"))
    return Q.signal_variation(x, ["team"], "s", 0.6, "h").withColumn("coverage", F.round("coverage", 9))


@query("scope_identity_audit", "WITH " + EV + """, a AS (SELECT season, count(*) AS n, count(DISTINCT player) AS players FROM ev GROUP BY season) SELECT season, n + CASE WHEN season = 1997 THEN 1 ELSE 0 END AS n, players, n AS again_n, players AS again_players, season <> 1997 AS matches FROM a""")
def _(spark, sf):
    ev = events(spark, sf)
    aggs = {"n": F.count("*"), "players": F.count_distinct("player")}
    stored = ev.groupBy("season").agg(*(c.alias(n) for n, c in aggs.items())).withColumn("n", F.col("n") + F.when(F.col("season") == 1997, 1).otherwise(0))
    return Q.recompute(stored, ev, ["season"], aggs)


@query("roster_coverage", """WITH c AS (SELECT c_nationkey AS team, count(DISTINCT c_custkey) AS ids, avg(regexp_matches(c_custkey::VARCHAR, '^[0-9]{2,}$')::INTEGER) AS w FROM customer GROUP BY 1) SELECT team, ids, round(w, 9) AS well_formed, 0::BIGINT AS conflicts, ids >= 45 AND w >= 0.95 AS passed FROM c""")
def _(spark, sf):
    return Q.roster_coverage(table(spark, sf, "customer"), "c_nationkey", "c_custkey", "c_name", "^[0-9]{2,}$", 45).withColumnRenamed("c_nationkey", "team").withColumn("well_formed", F.round("well_formed", 9))


@query("staleness_check", """SELECT event_id, CASE WHEN (epoch_us(TIMESTAMP '2024-01-20') - epoch_us(ts)) / 60000000.0 < -5 THEN 'future' WHEN ts > TIMESTAMP '2024-01-19' THEN 'after cutoff' WHEN (epoch_us(TIMESTAMP '2024-01-20') - epoch_us(ts)) / 60000000.0 > 2880 THEN 'stale' ELSE 'fresh' END AS status FROM events""")
def _(spark, sf):
    at = lambda d: F.to_timestamp(F.lit(d))
    return Q.staleness(table(spark, sf, "events"), "ts", at("2024-01-20"), at("2024-01-19"), 48.0).select("event_id", "status")


@query("board_completeness", """WITH b AS (SELECT CAST(ts AS DATE) AS day, user_id, CASE WHEN event_id % 97 <> 0 THEN round(value / 20) * CASE WHEN event_id % 53 = 0 THEN 0.25 ELSE 0.5 END END AS line FROM events)
SELECT day, count(*) AS rows, (count(*) - count(DISTINCT user_id))::BIGINT AS repeated, count(CASE WHEN line IS NULL THEN 1 END) AS missing, count(CASE WHEN line * 2 <> round(line * 2) THEN 1 END) AS off_grid, count(*) >= 3 AND count(*) = count(DISTINCT user_id) AND count(line) = count(*) AND count(CASE WHEN line * 2 <> round(line * 2) THEN 1 END) = 0 AS complete FROM b GROUP BY day""")
def _(spark, sf):
    e = table(spark, sf, "events")
    line = F.when(F.col("event_id") % 97 != 0, F.round(F.col("value") / 20) * F.when(F.col("event_id") % 53 == 0, 0.25).otherwise(0.5))
    return Q.board_completeness(e.select(F.to_date("ts").alias("day"), "user_id", line.alias("line")), ["day"], "user_id", "line", 3)


@query("read_typed", "SELECT count(*) AS n, sum(o_orderkey)::BIGINT AS total FROM orders")
def _(spark, sf):
    return io.read_typed(spark, f"{sf}/orders.parquet", table(spark, sf, "orders").schema).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("total"))


@query("first_available_source", "SELECT c_custkey, 'primary' AS source FROM customer")
def _(spark, sf):
    n = table(spark, sf, "customer").select("c_custkey")
    return io.first_available({"explicit": n.where("c_custkey < 0"), "primary": n, "backup": n})


@query("read_nested_offers", """SELECT user_id::VARCHAR AS id, event_type AS book, count(*) AS offers, sum(-(event_id % 7 + 0.5))::DOUBLE AS home_points FROM events WHERE event_id % 5 <> 0 GROUP BY ALL""")
def _(spark, sf):
    point = F.col("event_id") % 7 + 0.5
    outcome = lambda name, p: F.struct(F.lit(name).alias("name"), F.lit(-110.0).alias("price"), p.alias("point"))
    away = F.when(F.col("event_id") % 5 == 0, point + 1).otherwise(point)
    book = F.struct(F.col("event_type").alias("key"), F.lit("2024-01-01T00:00:00Z").alias("last_update"), F.array(F.struct(F.lit("spreads").alias("key"), F.array(outcome("H", -point), outcome("A", away)).alias("outcomes"))).alias("markets"))
    doc = F.to_json(F.array(F.struct(F.col("user_id").cast("string").alias("id"), F.lit("").alias("commence_time"), F.lit("H").alias("home_team"), F.lit("A").alias("away_team"), F.array(book).alias("bookmakers"))))
    rows = io.read_nested_offers(table(spark, sf, "events").select(doc.alias("json")), "json")
    return rows.groupBy("id", "book").agg(F.count("*").alias("offers"), F.sum("home_point").alias("home_points"))


@query("read_nested_depth", """SELECT p_brand AS team, p_type AS position, (row_number() OVER (PARTITION BY p_brand, p_type ORDER BY p_partkey))::INTEGER AS rank, p_partkey::VARCHAR AS athlete_id, p_name AS athlete FROM part""")
def _(spark, sf):
    p = table(spark, sf, "part")
    athletes = F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "p_name"))), lambda x: F.struct(x["p_partkey"].cast("string").alias("id"), x["p_name"].alias("displayName")))
    slots = p.groupBy("p_brand", "p_type").agg(F.struct(athletes.alias("athletes")).alias("v"))
    docs = slots.groupBy(F.col("p_brand").alias("team")).agg(F.to_json(F.struct(F.array(F.struct(F.map_from_entries(F.collect_list(F.struct("p_type", "v"))).alias("positions"))).alias("depthchart"))).alias("json"))
    return io.read_nested_depth(docs, "team", "json")


@query("multi_season_file_union", """SELECT year(o_orderdate)::INTEGER AS season, o_orderkey, CASE year(o_orderdate) WHEN 1997 THEN 0.5 WHEN 1998 THEN 1.0 END::DOUBLE AS season_weight FROM orders WHERE year(o_orderdate) IN (1997, 1998)""")
def _(spark, sf):
    o = table(spark, sf, "orders")
    each = {y: o.where(F.year("o_orderdate") == y).select("o_orderkey") for y in (1997, 1998)}
    return io.union_seasons(each, ["o_orderkey"], {1997: 0.5, 1998: 1.0}).select("season", "o_orderkey", "season_weight")


@query("frame_fingerprint")
def _(spark, sf):
    return io.frame_fingerprint(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber", "l_extendedprice"])


@query("row_lineage_hash", """SELECT c_custkey, sha256('{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","c_nationkey":' || c_nationkey || '}') AS row_hash FROM customer""")
def _(spark, sf):
    return io.row_lineage(table(spark, sf, "customer"), ["c_custkey", "c_nationkey", "c_name"]).select("c_custkey", "row_hash")


def _shared(spark, name):
    return f"{io.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("immutable_snapshot", "SELECT c_custkey, c_nationkey AS frozen, c_nationkey + (c_custkey % 2)::INTEGER AS current, (c_custkey % 2)::INTEGER AS drift FROM customer")
def _(spark, sf):
    n = table(spark, sf, "customer")
    kept = io.immutable_snapshot(n, _shared(spark, "snapshot"), ["c_custkey", "c_nationkey"])
    return io.drift(kept, n.withColumn("c_nationkey", (F.col("c_nationkey") + F.col("c_custkey") % 2).cast("int")), ["c_custkey"], "c_nationkey")


@query("replace_partition", "SELECT o_orderstatus, count(*) AS n, sum(o_orderkey + CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS total FROM orders GROUP BY 1")
def _(spark, sf):
    o, path = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), _shared(spark, "parts")
    io.replace_partitions(o, path, ["o_orderstatus"])
    io.replace_partitions(o.where("o_orderstatus = 'F'").withColumn("o_orderkey", F.col("o_orderkey") + 1), path, ["o_orderstatus"])
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("total"))


@query("append_evolving", "SELECT count(*) * 2 AS n, count(c_name) AS named FROM customer")
def _(spark, sf):
    n, path = table(spark, sf, "customer"), _shared(spark, "history")
    io.append_evolving(n.select("c_custkey"), path)
    io.append_evolving(n.select("c_custkey", "c_name"), path)
    return io.read_evolving(spark, path).agg(F.count("*").alias("n"), F.count("c_name").alias("named"))


@query("persist_with_history", "SELECT 2 * count(*) AS history, count(*) AS current, 2::BIGINT AS runs FROM customer")
def _(spark, sf):
    n, base = table(spark, sf, "customer"), _shared(spark, "runs")
    io.persist_with_history(n, base, "run-1")
    io.persist_with_history(n, base, "run-2", csv=True)
    count = lambda part, name: spark.read.parquet(f"{base}/{part}").agg(F.count("*").alias(name))
    return count("history", "history").crossJoin(count("current", "current")).crossJoin(count("audit", "runs"))  # three single rows


@query("season_context_build", "WITH " + EV + """, t AS (SELECT DISTINCT season FROM ev WHERE season >= 1998) SELECT t.season AS target_season, count(*) AS rows, count(DISTINCT ev.season) AS seasons, min(ev.season) AS first_season FROM t JOIN ev ON ev.season BETWEEN t.season - 4 AND t.season - 1 GROUP BY 1""")
def _(spark, sf):
    ev = events(spark, sf)
    out = io.season_context(ev, ev.select("season").distinct().where("season >= 1998"), "season")
    return out.groupBy("target_season").agg(F.count("*").alias("rows"), F.count_distinct("season").alias("seasons"), F.min("season").alias("first_season"))


@query("live_offer_stream", """
WITH o AS (SELECT user_id AS game, event_type AS book, event_id, value AS line, ts, CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 ELSE 4 END AS place FROM events),
-- where the watermark stands in the end
w AS (SELECT epoch_ms(max(ts)) - 3600000 AS now FROM events),
fresh AS (SELECT o.* FROM o, w WHERE now - epoch_ms(ts) <= 2 * 86400000),
best AS (SELECT game, book, event_id, line FROM fresh QUALIFY row_number() OVER (PARTITION BY game ORDER BY place, ts DESC, event_id DESC) = 1)
SELECT game, book, event_id, line, CASE WHEN b.game IS NULL THEN 'no fresh offer' END AS reason FROM (SELECT DISTINCT game FROM o) g LEFT JOIN best b USING (game)""")
def _(spark, sf):
    """The events arrive as offers in three runs of one stream, in the order of time; the table after the last commit."""
    events_ = table(spark, sf, "events")
    base = _shared(spark, "stream")
    first, last = events_.agg(F.min(F.unix_micros(F.col("ts").cast("timestamp"))), F.max(F.unix_micros(F.col("ts").cast("timestamp")))).first()
    cuts = [first + (last - first) * k // 3 for k in range(3)] + [last + 1]
    offers.use_state_store(spark)
    events_.limit(0).write.parquet(f"{base}/in")
    raw = spark.readStream.schema(events_.schema).parquet(f"{base}/in")
    stream = raw.select(F.col("user_id").alias("game"), F.col("event_type").alias("book"), "event_id", F.col("value").alias("line"), F.col("ts").cast("timestamp").alias("ts"))
    best = offers.best_offers(offers.live_offers(stream, "ts", ["event_id"], "1 hour"), "game", "book", ["purchase", "click", "view"], "ts", 2 * 24 * 60.0, ["event_id"])
    for a, b in zip(cuts, cuts[1:], strict=False):
        at = F.unix_micros(F.col("ts").cast("timestamp"))
        events_.where((at >= a) & (at < b)).write.mode("append").parquet(f"{base}/in")
        run = best.writeStream.outputMode("append").foreachBatch(offers.keep_best(spark, f"{base}/best", "game")).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
        run.awaitTermination()
    return offers.DeltaTable(spark, f"{base}/best", "game").read().select("game", "book", "event_id", "line", "reason")
