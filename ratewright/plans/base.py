"""The test tables in the library's roles, and the registry of queries with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: season, period, offense (customer nation), defense (supplier nation), an integer measure and a volume."""
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = items.join(orders, items.l_orderkey == orders.o_orderkey).join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    joined = joined.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("player"),
        F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("period"),
        F.col("c_nationkey").alias("offense"), F.col("s_nationkey").alias("defense"),
        F.floor(F.col("l_extendedprice") * (1 - F.col("l_discount")) + 0.5).cast("long").alias("measure"),
        F.col("l_quantity").cast("long").alias("volume"), "l_discount", F.col("l_returnflag").alias("kind"), F.col("l_linestatus").alias("status"),
    )


EV = """ev AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS player, CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS period,
    c_nationkey AS offense, s_nationkey AS defense, CAST(floor(l_extendedprice * (1 - l_discount) + 0.5) AS BIGINT) AS measure,
    CAST(l_quantity AS BIGINT) AS volume, l_discount, l_returnflag AS kind, l_linestatus AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""

# one row per season, period and pair of nations: the margin is what a bought from b less what b bought from a
PAIRS = EV + """, side AS (SELECT season, period, offense, defense, sum(measure)::BIGINT AS points FROM ev WHERE offense <> defense GROUP BY ALL),
games AS (SELECT a.season, a.period, a.offense AS home, a.defense AS away, a.points AS home_points, b.points AS away_points, a.points - b.points AS margin
  FROM side a JOIN side b ON a.season = b.season AND a.period = b.period AND a.offense = b.defense AND a.defense = b.offense WHERE a.offense < a.defense)"""


def side(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> DataFrame:
    ev = (events(spark, sf_dir) if ev is None else ev).where("offense <> defense")
    return ev.groupBy("season", "period", "offense", "defense").agg(F.sum("measure").alias("points"))


def games(spark: SparkSession, sf_dir: str, ev: DataFrame | None = None) -> DataFrame:
    from ratewright.operators.joins import mirror

    both = mirror(side(spark, sf_dir, ev), ["season", "period"], "offense", "defense", ["points"]).where("offense < defense")
    return both.select("season", "period", F.col("offense").alias("home"), F.col("defense").alias("away"), F.col("points").alias("home_points"), F.col("opp_points").alias("away_points"), (F.col("points") - F.col("opp_points")).alias("margin"))


# monthly price line per order: the model is the order's value, the line the mean of its customer nation in the month before
def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Graded-prediction stand-in: per customer nation and month, actual and last month's mean as the line, in whole units."""
    orders = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    monthly = orders.groupBy(F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("period"), F.col("c_nationkey").alias("team")).agg(
        F.floor(F.sum(F.floor("o_totalprice")) / F.count("*") / 1000).cast("long").alias("actual"), F.count("*").alias("n"))
    key = F.col("season") * 12 + F.col("period")
    monthly = monthly.withColumn("t", key)
    line = monthly.select((F.col("t") + 1).alias("t"), "team", F.col("actual").alias("line"))
    model = monthly.select((F.col("t") + 2).alias("t"), "team", F.col("actual").alias("model"))
    out = monthly.join(line, ["t", "team"]).join(model, ["t", "team"])
    return out.select("season", "period", "team", "actual", "line", "model", (F.col("model") - F.col("line")).alias("edge"))


PRED = """monthly AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS season, CAST(month(o_orderdate) AS INTEGER) AS period, c_nationkey AS team,
    CAST(floor(sum(floor(o_totalprice)) / count(*) / 1000) AS BIGINT) AS actual, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
stamped AS (SELECT *, season * 12 + period AS t FROM monthly),
pred AS (SELECT a.season, a.period, a.team, a.actual, l.actual AS line, m.actual AS model, m.actual - l.actual AS edge
  FROM stamped a JOIN stamped l ON l.t + 1 = a.t AND l.team = a.team JOIN stamped m ON m.t + 2 = a.t AND m.team = a.team)"""
