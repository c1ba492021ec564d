"""Expectations, staleness, lineage and no-lookahead checks.  A check is a row; nothing is raised unless asked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check(category: str, name: str, passed: Column, expected: Column | str | float, observed: Column, required: bool = True) -> Column:
    """A struct for `checks`: category, name, required, passed, expected, observed (both as text)."""
    as_text = lambda v: (v if isinstance(v, Column) else F.lit(v)).cast("string")
    return F.struct(F.lit(category).alias("category"), F.lit(name).alias("check"), F.lit(required).alias("required"), F.coalesce(passed, F.lit(False)).alias("passed"), as_text(expected).alias("expected"), as_text(observed).alias("observed"))


def checks(summary: DataFrame, structs: list[Column]) -> DataFrame:
    """One row per check and row of `summary` (its other columns are kept apart by the caller)."""
    return summary.select(F.explode(F.array(*structs)).alias("c")).select("c.*")


def expect_table(df: DataFrame, name: str, least_rows: int, distinct: str | None = None, least_distinct: int = 0, period: str | None = None, required_period=None) -> DataFrame:
    """Rows, distinct keys and the rows of a required period in one pass."""
    aggs = [F.count("*").alias("rows")]
    if distinct:
        aggs.append(F.count_distinct(distinct).alias("distinct"))
    if period:
        aggs.append(F.count_if(F.col(period) == F.lit(required_period)).alias("in_period"))
    out = [check(name, "rows", F.col("rows") >= least_rows, least_rows, F.col("rows"))]
    if distinct:
        out.append(check(name, "distinct", F.col("distinct") >= least_distinct, least_distinct, F.col("distinct")))
    if period:
        out.append(check(name, "period", F.col("in_period") > 0, "> 0", F.col("in_period")))
    return checks(df.agg(*aggs), out)


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations, rows): how many rows break each rule (null counts as broken), in one pass."""
    n = df.agg(*(F.count_if(~F.coalesce(ok, F.lit(False))).alias(f"v{i}") for i, ok in enumerate(rules.values())), F.count("*").alias("n"))
    return n.select(F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(f"v{i}").alias("violations"), F.col("n").alias("rows")) for i, r in enumerate(rules)))).alias("x")).select("x.*")


def input_contract(df: DataFrame, required: list[str], unique: list[str], bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Column names are asserted at once; repeated keys, null keys and out-of-bound values are counted."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}")
    rules = {f"{c} in bounds": F.col(c).isNull() | F.col(c).between(*b) for c, b in bounds.items()} | {f"{c} not null": F.col(c).isNotNull() for c in unique}
    repeated = df.groupBy(*unique).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations"), F.coalesce(F.sum("count"), F.lit(0)).alias("rows"))
    return violations(df, rules).unionByName(repeated.select(F.lit("unique " + ",".join(unique)).alias("rule"), "violations", "rows"))


def lineage_unchanged(stored: DataFrame, current: DataFrame, key: str, digest: str) -> DataFrame:
    """Per artefact: same, changed, new or gone."""
    j = stored.select(key, F.col(digest).alias("_s")).join(current.select(key, F.col(digest).alias("_c")), key, "full_outer")
    return j.select(key, F.when(F.col("_s").isNull(), "new").when(F.col("_c").isNull(), "gone").when(F.col("_s") == F.col("_c"), "same").otherwise("changed").alias("status"))


def run_state(runs: DataFrame, group: list[str], at: str, rows: str, excluded: str, expected: str) -> DataFrame:
    """The newest run of each group: zero rows pass only if every expected game is excluded."""
    newest = runs.groupBy(*group).agg(F.max_by(F.struct(rows, excluded, expected), at).alias("x"), F.max(at).alias(at))
    ok = F.when(F.col(f"x.{rows}") == 0, F.col(f"x.{excluded}") == F.col(f"x.{expected}")).otherwise(F.col(f"x.{rows}") + F.col(f"x.{excluded}") == F.col(f"x.{expected}"))
    return newest.select(*group, at, F.col(f"x.{rows}").alias(rows), ok.alias("passed"))


def no_lookahead(predictions: DataFrame, through: str, period: str, keys: list[str], digest: str) -> DataFrame:
    """Violations: knowledge not before the period, missing hashes, repeated keys."""
    rules = {"through before period": F.col(through) <= F.col(period) - 1, "hash present": F.col(digest).isNotNull() & (F.length(digest) > 0)}
    repeated = predictions.groupBy(*keys).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations"), F.coalesce(F.sum("count"), F.lit(0)).alias("rows"))
    return violations(predictions, rules).unionByName(repeated.select(F.lit("unique keys").alias("rule"), "violations", "rows"))


def certificate(details: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """All checks, and one row: PASS if every required check passed, with the failures as JSON."""
    rows = reduce(lambda a, b: a.unionByName(b), details)
    failed = F.array_sort(F.collect_list(F.when(F.col("required") & ~F.col("passed"), F.concat_ws(".", "category", "check"))))
    total = rows.agg(F.count("*").alias("checks"), F.count_if("passed").alias("passed"), F.bool_and(~F.col("required") | F.col("passed")).alias("_ok"), failed.alias("_f"))
    return rows, total.select("checks", "passed", F.when(F.col("_ok"), "PASS").otherwise("FAIL").alias("status"), F.to_json("_f").alias("failures"))


def reconcile_results(schedule: DataFrame, other: DataFrame, keys: list[str], score: str) -> DataFrame:
    """Missing scores from another table where it has exactly one value; a different value is a conflict and changes nothing."""
    one = other.where(F.col(score).isNotNull()).groupBy(*keys).agg(F.min(score).alias("_o"), F.count_distinct(score).alias("_n"))
    j = schedule.join(one, keys, "left")
    status = (
        F.when(F.col("_n").isNull(), F.when(F.col(score).isNull(), "missing").otherwise("kept"))
        .when(F.col(score).isNull(), F.when(F.col("_n") == 1, "filled").otherwise("ambiguous"))
        .when((F.col("_n") == 1) & (F.col("_o") == F.col(score)), "confirmed").otherwise("conflict")
    )
    return j.select(*keys, F.when(status == "filled", F.col("_o")).otherwise(F.col(score)).alias(score), status.alias("status"))


def signal_variation(df: DataFrame, group: list[str], signal: str, least_coverage: float, history: str) -> DataFrame:
    """Coverage and number of values of a signal; a constant one is excused where each row has a single game of history."""
    d = df.groupBy(*group).agg((F.count(signal) / F.count("*")).alias("coverage"), F.count_distinct(signal).alias("values"), F.max(history).alias("_h"))
    status = F.when(F.col("coverage") < least_coverage, "low coverage").when(F.col("values") > 1, "ok").when(F.col("_h") <= 1, "first game").otherwise("constant")
    return d.select(*group, "coverage", "values", status.alias("status"))


def recompute(stored: DataFrame, source: DataFrame, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    """Stored audit counts beside the same counts taken again."""
    again = source.groupBy(*keys).agg(*(c.alias(f"again_{n}") for n, c in aggs.items()))
    j = stored.join(again, keys, "full_outer")
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"again_{n}")) for n in aggs])
    return j.withColumn("matches", same)


def roster_coverage(roster: DataFrame, team: str, identity: str, name: str, pattern: str, least: int) -> DataFrame:
    """Per team: ids, share of rows with a well-formed id, ids with several names, and whether the team passes."""
    well = F.col(identity).cast("string").rlike(pattern)
    several = roster.groupBy(team, identity).agg(F.count_distinct(name).alias("_n")).groupBy(team).agg(F.count_if(F.col("_n") > 1).alias("conflicts"))
    d = roster.groupBy(team).agg(F.count_distinct(identity).alias("ids"), F.avg(well.cast("int")).alias("well_formed")).join(several, team)
    return d.withColumn("passed", (F.col("ids") >= least) & (F.col("well_formed") >= 0.95) & (F.col("conflicts") == 0))


def staleness(df: DataFrame, ts: str, now: Column, cutoff: Column, most_hours: float = 24.0, ahead_minutes: float = 5.0) -> DataFrame:
    """`status` of each row's time: fresh, stale, future or after the cut-off."""
    age = (F.unix_micros(now) - F.unix_micros(F.col(ts).cast("timestamp"))) / 60_000_000
    status = F.when(F.col(ts).isNull(), "missing").when(age < -ahead_minutes, "future").when(F.col(ts).cast("timestamp") > cutoff, "after cutoff").when(age > most_hours * 60, "stale").otherwise("fresh")
    return df.withColumn("status", status)


def board_completeness(board: DataFrame, period: list[str], key: str, value: str, expected: int) -> DataFrame:
    """Per period: rows, repeated keys, missing values, values off the half-point grid and whether the board is whole."""
    d = board.groupBy(*period).agg(F.count("*").alias("rows"), (F.count("*") - F.count_distinct(key)).alias("repeated"), F.count_if(F.col(value).isNull() | F.isnan(F.col(value).cast("double"))).alias("missing"), F.count_if(F.col(value) * 2 != F.rint(F.col(value).cast("double") * 2)).alias("off_grid"))
    return d.withColumn("complete", (F.col("rows") >= expected) & (F.col("repeated") == 0) & (F.col("missing") == 0) & (F.col("off_grid") == 0))
