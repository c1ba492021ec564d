"""Exact quantiles by counting against a sort, on values of every kind, and without a buffer of a group's values."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratewright.operators import quantiles as Q

PROBABILITIES = {"low": 0.01, "median": 0.5, "high": 0.99, "least": 0.0, "most": 1.0, "third": 1 / 3}


def expected(values):
    s = sorted((v for v in values if v is not None), key=lambda v: (math.isnan(v), v))

    def at(p):
        x = p * (len(s) - 1)
        a, b = math.floor(x), math.ceil(x)
        return s[a] if a == b or s[a] == s[b] else (b - x) * s[a] + (x - a) * s[b]

    return {k: at(p) for k, p in PROBABILITIES.items()}


def same(a, b):
    return a == b or (math.isnan(a) and math.isnan(b)) or math.isclose(a, b, rel_tol=1e-15)


def kinds(rng):
    yield "normal", [rng.gauss(0, 1) for _ in range(700)]
    yield "ties", [float(rng.randint(0, 3)) for _ in range(500)] + [7.0] * 400
    yield "one value", [2.5] * 300
    yield "all scales", [rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300) * rng.random() for _ in range(600)]
    yield "small positive", [10.0 ** -rng.uniform(0, 320) for _ in range(400)] + [0.0, -0.0, 5e-324, 1e-323]
    yield "largest", [1.7e308, -1.7e308, 1.6e308, 0.0] * 60
    yield "special", [float("nan"), float("inf"), float("-inf"), 1.0, 2.0, None] * 50
    yield "only special", [float("nan")] * 30 + [float("inf")] * 40
    yield "near", [1.0 + k * 2.0**-52 for k in range(200)]
    yield "single", [3.0]
    yield "none", [None, None]


@pytest.mark.parametrize("small,buckets", [(4, 8), (50, 16), (4096, 512)])
def test_equals_a_sort(spark, small, buckets):
    data = dict(kinds(random.Random(2)))
    rows = [(k, v) for k, vs in data.items() for v in vs]
    df = spark.createDataFrame(rows, "kind string, x double").repartition(4)
    got = {r["kind"]: r for r in Q.exact_quantiles(df, ["kind"], "x", PROBABILITIES, small=small, buckets=buckets).collect()}
    assert set(got) == set(data) - {"none"}
    for kind in got:
        for name, value in expected(data[kind]).items():
            assert same(got[kind][name], value), (kind, name, got[kind][name], value)


def test_equals_sparks_percentile(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.rand(3) * 1000 - 200).alias("x"))
    df = spark.createDataFrame(df.collect(), df.schema)
    want = {r.g: (r.a, r.b) for r in df.groupBy("g").agg(F.percentile("x", F.lit(0.2)).alias("a"), F.percentile("x", F.lit(0.99)).alias("b")).collect()}
    got = {r.g: (r.a, r.b) for r in Q.exact_quantiles(df, ["g"], "x", {"a": 0.2, "b": 0.99}, small=20).collect()}
    assert got == want


@pytest.mark.parametrize("small", [10, 4096])
def test_folds_see_the_past_only(spark, small):
    rng = np.random.default_rng(5)
    rows = [(f, s, float(v)) for f in ("a", "b") for s in range(2000, 2006) for v in rng.normal(s - 2000, 1 + (f == "b"), 40)]
    df = spark.createDataFrame(rows, "feature string, season int, x double").repartition(3)
    got = {(r.feature, r.fold): r for r in Q.exact_quantiles(df, ["feature"], "x", PROBABILITIES, part="season", small=small, buckets=8).collect()}
    assert set(got) == {(f, s) for f in ("a", "b") for s in range(2001, 2006)}
    for (f, fold), r in got.items():
        for name, value in expected([v for g, s, v in rows if g == f and s < fold]).items():
            assert same(r[name], value)


def test_no_rows(spark):
    assert Q.exact_quantiles(spark.createDataFrame([], "g int, x double"), ["g"], "x", {"m": 0.5}).count() == 0


def test_only_small_brackets_are_gathered(spark):
    """One group of 20,000 different values: no task gathers more of them than a bracket may hold."""
    df = spark.range(20_000).select(F.lit(1).alias("g"), (F.hash("id") / 7.0).alias("x"))
    out = Q.exact_quantiles(df, ["g"], "x", {"m": 0.5}, small=64)
    want = np.quantile([r.x for r in df.collect()], 0.5)
    assert math.isclose(out.first().m, want, rel_tol=1e-12)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan
