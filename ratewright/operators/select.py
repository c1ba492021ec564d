"""Selections and set operators: newest runs and revisions, priority picks, orientations, key differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_run(tables: list[DataFrame], group: list[str], at: str, since: str) -> DataFrame:
    """The newest row of each group over several tables (current and history), none older than `since`."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables).where(F.col(at) >= F.lit(since).cast("timestamp"))
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc(at)))).where("_rn = 1").drop("_rn")


def latest_revision(documents: DataFrame, group: list[str], url: str, day: str, tie: str) -> DataFrame:
    """The newest published document: dated ones first, then the day, the revision number in the url, the tie-break."""
    d = documents.withColumn("revision", F.coalesce(F.try_element_at(F.split(F.regexp_extract(url, r"-(\d+)\.pdf$", 1), " "), F.lit(1)).try_cast("int"), F.lit(0)))
    w = Window.partitionBy(*group).orderBy(F.col(day).isNull(), F.desc(day), F.desc("revision"), F.desc(tie))
    return d.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def detect_period(schedule: DataFrame, period: str, date: str, today: str) -> DataFrame:
    """The first period whose last date is not before today: the one going on, else the next."""
    spans = schedule.groupBy(period).agg(F.max(date).alias("_to"))
    return spans.where(F.col("_to") >= F.lit(today).cast("timestamp")).agg(F.min(period).alias(period))


def priority_pick(offers: DataFrame, game: str, book: str, priority: list[str], ts: str, now: str, most_minutes: float, tie: list[str]) -> DataFrame:
    """Per game the newest fresh offer of the best-placed book; games without one keep a row that says why."""
    place = F.coalesce(F.array_position(F.array(*map(F.lit, priority)), F.col(book)), F.lit(0))
    place = F.when(place == 0, len(priority) + 1).otherwise(place)
    fresh = (F.unix_micros(F.col(now).cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))) / 60_000_000 <= most_minutes
    w = Window.partitionBy(game).orderBy(F.desc("_fresh"), "_place", F.desc(ts), *(F.desc(t) for t in tie))
    best = offers.withColumns({"_fresh": fresh, "_place": place}).withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    others = [c for c in offers.columns if c not in (game, now)]
    return best.select(game, *(F.when(F.col("_fresh"), F.col(c)).alias(c) for c in others), F.when(~F.col("_fresh"), "no fresh offer").alias("reason"))


def both_sides(games: DataFrame, keys: list[str], home: str, away: str, margin: str) -> DataFrame:
    """A row for each side of a game."""
    a = games.select(*keys, F.col(home).alias("team"), F.col(away).alias("opponent"), F.col(margin).alias("margin"), F.lit(0).alias("is_away"))
    return a.unionByName(games.select(*keys, F.col(away).alias("team"), F.col(home).alias("opponent"), (-F.col(margin)).alias("margin"), F.lit(1).alias("is_away")))


def keyset_difference(expected: DataFrame, got: DataFrame) -> DataFrame:
    """Keys that are missing and keys that are unexpected."""
    a, b = expected.distinct(), got.distinct()
    return a.join(b, a.columns, "left_anti").withColumn("side", F.lit("missing")).unionByName(b.join(a, a.columns, "left_anti").withColumn("side", F.lit("unexpected")))


def compare_entries(first: DataFrame, second: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """Two entries side by side with the class of each row's membership."""
    joined = first.select(*keys, F.col(rank).alias("rank_1")).join(second.select(*keys, F.col(rank).alias("rank_2")), keys, "full_outer")
    return joined.withColumn("membership", F.when(F.col("rank_2").isNull(), "only_1").when(F.col("rank_1").isNull(), "only_2").otherwise("both"))
