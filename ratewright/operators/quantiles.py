"""Exact quantiles by counting: no task ever holds the values of a group, nor its distinct values.

Every round counts, for all keys at once, how many values fall into each of a fixed number of buckets of the bracket that holds the wanted rank, with the
least and the greatest value that each bucket really has.  Those two are the next bracket, so each round parts the bracket's ends; it stops where
the bracket holds few rows or one value.  Only rows inside such a small bracket are ever sorted, a bounded array a bracket.

Counts are kept by part (a season), and brackets are shared by all folds that look for a rank in the same bucket.  So "the median of all seasons before
this one" is read for every season from the same counts: no row is copied for a fold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewright.sources.io import written

SMALL = 4096
BUCKETS = 512
_WIDE = 1e6
_INFINITE = float("inf")


def _bucket(v: Column, lo: Column, hi: Column, buckets: int) -> Column:
    """A number that never falls as v rises and differs for lo and hi: by sign, else by logarithm where the ends are far apart, else by distance.

    -1, `buckets` and `buckets` + 1 are for -infinity, infinity and NaN; lo and hi are finite.
    """

    def share(x: Column, a: Column, b: Column, n: int) -> Column:
        gap = b / 2 - a / 2  # halves, as the difference of two doubles may be infinite
        return F.when(gap > 0, F.least(F.floor((x / 2 - a / 2) / gap * n).cast("int"), F.lit(n - 1))).otherwise((x > a).cast("int"))

    half = buckets // 2
    signs = F.when(v < 0, share(v, lo, F.lit(0.0), half)).when(v == 0, half).otherwise(half + 1 + share(v, F.lit(0.0), hi, half - 1))
    rising = share(F.ln(v), F.ln(lo), F.ln(hi), buckets)
    falling = share(-F.ln(-v), -F.ln(-lo), -F.ln(-hi), buckets)
    finite = (
        F.when((lo <= 0) & (hi >= 0) & (lo < hi), signs)
        .when((lo > 0) & (hi / _WIDE > lo) & (F.ln(hi) > F.ln(lo)), rising)
        .when((hi < 0) & (lo / _WIDE < hi) & (F.ln(-lo) > F.ln(-hi)), falling)
        .otherwise(share(v, lo, hi, buckets))
    )
    return F.when(F.isnan(v), buckets + 1).when(v == _INFINITE, buckets).when(v == -_INFINITE, -1).otherwise(finite)


def _narrowed(long: DataFrame, targets: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """The targets of large brackets, each in the bucket of its bracket that holds its rank."""
    brackets = targets.select(*keys, "lo", "hi", "from", "to").distinct()
    inside = long.join(brackets, keys).where(F.col("value").between(F.col("lo"), F.col("hi")))
    each = [*keys, "lo", "bucket"]
    counted = inside.withColumn("bucket", _bucket(F.col("value"), F.col("from"), F.col("to"), buckets)).groupBy(*each, "part")
    counted = written(counted.agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most")))
    ends = counted.groupBy(*each).agg(F.min("least").alias("new_lo"), F.max("most").alias("new_hi"), F.sum("n").alias("new_total"))
    one = [*keys, "fold", "rank", "lo"]
    own = targets.select(*one, "within").join(counted, [*keys, "lo"]).where("part < fold").groupBy(*one, "within", "bucket").agg(F.sum("n").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*one).orderBy("bucket")) - F.col("n")  # a row per bucket
    found = own.withColumn("before", before).where("before <= within and within < before + n")
    out = found.join(ends, each).select(*keys, "fold", "rank", F.col("new_lo").alias("lo"), F.col("new_hi").alias("hi"), (F.col("within") - F.col("before")).alias("within"), F.col("new_total").alias("total"))
    return out.select("*", F.col("lo").alias("from"), F.col("hi").alias("to"))


def later(parts: list, part: Column) -> Column:
    """One row for each of the listed parts that comes after the row's own."""
    return F.explode(F.filter(F.array(*map(F.lit, parts)), lambda p: p > part))


def _mix(at: Column, low: Column, high: Column) -> Column:
    """Between two neighbouring values; nothing is multiplied where one of them is the answer, as it may be infinite."""
    return F.when((F.floor(at) == F.ceil(at)) | (low == high), low).otherwise((F.ceil(at) - at) * low + (at - F.floor(at)) * high)


def _listed(probabilities: dict[str, float]) -> Column:
    return F.explode(F.array(*(F.struct(F.lit(name).alias("name"), F.lit(float(p)).alias("p")) for name, p in probabilities.items())))


def _sorted_rows(rows: DataFrame, by: list[str]) -> DataFrame:
    """An array of (value, part) per key or bracket: for those that hold few rows."""
    return rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("value", "part"))).alias("_rows"))


def _of_small(rows: DataFrame, keys: list[str], probabilities: dict[str, float], parts: list) -> DataFrame:
    """Quantiles of keys with few rows, straight from their sorted rows."""
    past = _sorted_rows(rows, keys).withColumn("fold", F.explode(F.array(*map(F.lit, parts)))).withColumn("_rows", F.filter("_rows", lambda x: x["part"] < F.col("fold"))).where(F.size("_rows") > 0)
    nth = lambda place: F.col("_rows")[place.cast("int")]["value"]
    each = past.withColumn("_p", _listed(probabilities)).withColumn("_at", F.col("_p.p") * (F.size("_rows") - 1))
    return each.select(*keys, "fold", F.col("_p.name").alias("name"), _mix(F.col("_at"), nth(F.floor("_at")), nth(F.ceil("_at"))).alias("quantile"))


def _of_large(rows: DataFrame, keys: list[str], probabilities: dict[str, float], parts: list, small: int, buckets: int) -> DataFrame:
    v = F.col("value")
    finite = F.when(~F.isnan(v) & (F.abs(v) != _INFINITE), v)
    sizes = written(rows.groupBy(*keys, "part").agg(F.count("*").alias("n"), F.min(finite).alias("least"), F.max(finite).alias("most")))
    counts = sizes.withColumn("fold", later(parts, F.col("part"))).groupBy(*keys, "fold").agg(F.sum("n").alias("n"))
    whole = sizes.groupBy(*keys).agg(F.min("least").alias("from"), F.max("most").alias("to"), F.sum("n").alias("total"))
    wanted = counts.withColumn("x", _listed(probabilities)).select(*keys, "fold", F.col("x.name").alias("name"), (F.col("x.p") * (F.col("n") - 1)).alias("at"))
    wanted = wanted.withColumn("rank", F.explode(F.array(F.floor("at"), F.ceil("at"))))
    targets = wanted.select(*keys, "fold", "rank").distinct().join(whole, keys)
    targets = targets.select(*keys, "fold", "rank", F.lit(-_INFINITE).alias("lo"), F.lit(float("nan")).alias("hi"), F.col("rank").alias("within"), "total", "from", "to")
    large, done = (F.col("total") > small) & (F.col("lo") < F.col("hi")), []
    while not targets.where(large).isEmpty():
        done.append(targets.where(~large))
        targets = written(_narrowed(rows, targets.where(large), keys, buckets))
    for found in done:
        targets = targets.unionByName(found)

    solved = targets.where("lo = hi").select(*keys, "fold", "rank", F.col("lo").alias("value"))
    left = targets.where("lo < hi")
    inside = rows.join(left.select(*keys, "lo", "hi").distinct(), keys).where(v.between(F.col("lo"), F.col("hi")))
    nth = F.element_at(F.filter("_rows", lambda x: x["part"] < F.col("fold")), (F.col("within") + 1).cast("int"))["value"]
    sought = left.join(_sorted_rows(inside, [*keys, "lo", "hi"]), [*keys, "lo", "hi"]).select(*keys, "fold", "rank", nth.alias("value"))
    both = wanted.join(solved.unionByName(sought), [*keys, "fold", "rank"]).groupBy(*keys, "fold", "name", "at")
    end = lambda place: F.max(F.when(F.col("rank") == place, F.col("value")))
    ends = both.agg(end(F.floor("at")).alias("_low"), end(F.ceil("at")).alias("_high"))
    return ends.select(*keys, "fold", "name", _mix(F.col("at"), F.col("_low"), F.col("_high")).alias("quantile"))


def quantile_rows(long: DataFrame, keys: list[str], value: str, probabilities: dict[str, float], part: str | None = None, small: int = SMALL, buckets: int = BUCKETS) -> DataFrame:
    """(keys, fold, name, quantile): exact quantiles of the non-null values, linear between neighbours, NaN above all, a row per name of `probabilities`.

    With `part` for every part of the table as `fold` those of all rows of smaller parts (none: no row); without, `fold` is 1.  Values are
    doubles.  They are written to the shared folder once and read again each round; brackets and counts are written too, so that Spark knows
    their size when it joins them.  Keys of at most `small` rows are sorted at once.
    """
    names, keys = keys, [f"_k{i}" for i in range(len(keys))]  # the caller's may be named like a column here
    rows = long.where(F.col(value).isNotNull()).select(*(F.col(c).alias(k) for c, k in zip(names, keys, strict=True)), (F.col(part) if part else F.lit(0)).alias("part"), F.col(value).cast("double").alias("value"))
    rows = written(rows.where(F.col("part").isNotNull()))
    parts = [r["part"] for r in rows.select("part").distinct().collect()] if part else [1]  # a row per season
    totals = rows.groupBy(*keys).agg(F.count("*").alias("_total"))
    if (totals.agg(F.max("_total")).first()[0] or 0) <= small:
        out = _of_small(rows, keys, probabilities, parts)
    else:
        totals = written(totals)
        of = lambda which: rows.join(totals.where(which).drop("_total"), keys, "left_semi") if keys else rows
        out = _of_large(of(f"_total > {small}"), keys, probabilities, parts, small, buckets)
        if keys:
            out = out.unionByName(_of_small(of(f"_total <= {small}"), keys, probabilities, parts))
    return out.withColumnsRenamed(dict(zip(keys, names, strict=True)))


def exact_quantiles(long: DataFrame, keys: list[str], value: str, probabilities: dict[str, float], part: str | None = None, small: int = SMALL, buckets: int = BUCKETS) -> DataFrame:
    """`quantile_rows` with a column per name: (keys, fold with `part`, names)."""
    by = [*keys, "fold"] if part else keys
    rows = quantile_rows(long, keys, value, probabilities, part, small, buckets)
    return rows.groupBy(*by).agg(*(F.max(F.when(F.col("name") == name, F.col("quantile"))).alias(name) for name in probabilities))


def medians(df: DataFrame, group: list[str], values: list[str], prefix: str) -> DataFrame:
    """(group, a column `prefix` + name per value): exact medians of several columns from one count."""
    each = F.explode(F.array(*(F.struct(F.lit(v).alias("_name"), F.col(v).cast("double").alias("_value")) for v in values)))
    found = exact_quantiles(df.select(*group, each.alias("_x")).select(*group, "_x.*"), [*group, "_name"], "_value", {"_median": 0.5})
    return found.groupBy(*group).agg(*(F.max(F.when(F.col("_name") == v, F.col("_median"))).alias(prefix + v) for v in values))
