"""Reconciling several readings of one number: majority votes, recovery of half-point ties, overrides."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def majority_vote(readings: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Per key: the value with the most votes, accepted if unanimous or at least 2 and more than the second; else a conflict.

    Votes are counted per value first, so a key's rows never meet unreduced.
    """
    counts = readings.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("votes"))
    w = Window.partitionBy(*keys).orderBy(F.desc("votes"), value)
    ranked = counts.withColumns({"_rn": F.row_number().over(w), "second": F.coalesce(F.lead("votes").over(w), F.lit(0)), "values": F.count("*").over(Window.partitionBy(*keys))})
    status = F.when(F.col("values") == 1, "unanimous").when((F.col("votes") >= 2) & (F.col("votes") > F.col("second")), "majority").otherwise("conflict")
    best = ranked.where("_rn = 1").withColumn("status", status)
    return best.select(*keys, F.when(status != "conflict", F.col(value)).alias(value), "votes", "second", "values", "status")


def best_source(voted: DataFrame, period: list[str], source: str) -> DataFrame:
    """The source with the most accepted keys of each period (ties: the least source)."""
    score = voted.groupBy(*period, source).agg(F.count_if(F.col("status") != "conflict").alias("accepted"))
    return score.withColumn("_rn", F.row_number().over(Window.partitionBy(*period).orderBy(F.desc("accepted"), source))).where("_rn = 1").drop("_rn")


def finalize_lines(schedule: DataFrame, voted: DataFrame, manual: DataFrame, keys: list[str], value: str, fallback: str) -> DataFrame:
    """Every scheduled game with its line: manual over voted over fallback, and which it is (only the first two are strict)."""
    v = voted.select(*keys, F.col(value).alias("_voted"))
    m = manual.select(*keys, F.col(value).alias("_manual"))
    out = schedule.join(v, keys, "left").join(m, keys, "left")
    source = F.when(F.col("_manual").isNotNull(), "manual").when(F.col("_voted").isNotNull(), "voted").when(F.col(fallback).isNotNull(), "fallback").otherwise("missing")
    return out.select(*schedule.columns, F.coalesce("_manual", "_voted", fallback).alias(value), source.alias("line_source"), source.isin("manual", "voted").cast("int").alias("strict"))


def coverage(lines: DataFrame, period: list[str]) -> DataFrame:
    return lines.groupBy(*period).agg(F.count("*").alias("games"), F.sum("strict").alias("strict"), F.count_if(F.col("line_source") == "missing").alias("missing")).withColumn("complete", F.col("missing") == 0)


def half_point_recovery(readings: DataFrame, keys: list[str], value: str, mode: str) -> DataFrame:
    """Readings marked `rejected` = 1: in a tie of a half and the whole number half a point below it, the whole readings, if two modes saw the half.

    A lost half sign is the usual misreading; a key with any other pair of values is left as it is.
    """
    whole = F.col(value) == F.floor(value)
    seen = readings.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count_distinct(value).alias("_values"), F.max(F.abs(value)).alias("_hi"), F.min(F.abs(value)).alias("_lo"),
        F.count_distinct(F.when(~whole, F.col(mode))).alias("_half_modes"), F.count_if(whole).alias("_n_whole"), F.count_if(~whole).alias("_n_half"),
    )
    tie = (F.col("_values") == 2) & (F.col("_hi") - F.col("_lo") == 0.5) & (F.col("_hi") != F.floor("_hi")) & (F.col("_n_whole") == F.col("_n_half")) & (F.col("_half_modes") >= 2)
    out = readings.join(seen, keys, "left")
    return out.withColumn("rejected", F.coalesce((tie & whole).cast("int"), F.lit(0))).drop("_values", "_hi", "_lo", "_half_modes", "_n_whole", "_n_half")


def manual_adjustments(rows: DataFrame, keys: list[str], points: str, reason: str, active: str, cap: float) -> DataFrame:
    """Sum of the active points per key, capped both ways, and the distinct reasons."""
    out = rows.where(F.col(active) == 1).groupBy(*keys).agg(F.sum(points).alias("_p"), F.array_join(F.array_sort(F.collect_set(reason)), "; ").alias("reasons"), F.count("*").alias("entries"))
    return out.select(*keys, F.greatest(F.least(F.col("_p"), F.lit(cap)), F.lit(-cap)).alias("adjustment"), "reasons", "entries")
