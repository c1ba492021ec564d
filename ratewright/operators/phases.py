"""Models that switch by phase, boosted trees, and what-if scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewright.operators import boosting
from ratewright.operators.boosting import Setting
from ratewright.operators.solve import apply_linear
from ratewright.sources.io import written


def phase_switch(rows: DataFrame, coefficients: DataFrame, period: str, last_early: int, share: float, first: str = "A", second: str = "B") -> DataFrame:
    """Model A up to `last_early`; later (1 - share) A + share B.  `coefficients`: model, term, coefficient; `rows` carry `_terms`."""
    out = rows
    for name in (first, second):
        out = apply_linear(out, coefficients.where(F.col("model") == name).drop("model"), [], f"_{name}")
    late = (1 - share) * F.col(f"_{first}") + share * F.col(f"_{second}")
    return out.withColumn("predicted", F.when(F.col(period) <= last_early, F.col(f"_{first}")).otherwise(late)).drop(f"_{first}", f"_{second}")


def boosted(rows: DataFrame, features: list[str], y: str, season: str, first_test: int, setting: Setting | None = None) -> DataFrame:
    """Leaf-wise boosted trees (see `boosting`) fitted on seasons before `first_test`, applied to the later ones; null where there are no earlier ones."""
    rows = written(rows)
    setting = setting or Setting()
    marked = rows.withColumn("_late", (F.col(season) >= first_test).cast("int"))
    binnings, models = boosting.fit(marked, features, y, "_late", [1], [setting])
    late = rows.where(F.col(season) >= first_test)
    if (1, setting) not in models:
        return late.withColumn("predicted", F.lit(None).cast("double"))
    return boosting.predict(late, features, binnings[1], models[1, setting])


def rescore(rows: DataFrame, patch: DataFrame, on: list[str], weights: dict[str, float], replaced: list[str]) -> DataFrame:
    """Baseline and scenario scores with the same weights, where `patch` replaces inputs; the change and which inputs changed.  Baseline inputs stay as they are."""
    p = patch.select(*on, *(F.col(c).alias(f"_n_{c}") for c in replaced))
    joined = rows.join(p, on, "left")
    new = lambda c: F.coalesce(f"_n_{c}", c) if c in replaced else F.col(c)
    total = lambda get: reduce(lambda a, b: a + b, [get(c) * w for c, w in weights.items()])
    out = joined.withColumns({"baseline": total(F.col), "scenario": total(new)})
    changed = F.array_compact(F.array(*(F.when(F.col(f"_n_{c}").isNotNull() & (F.col(f"_n_{c}") != F.col(c)), F.lit(c)) for c in replaced)))
    return out.withColumns({"delta": F.col("scenario") - F.col("baseline"), "reasons": F.array_join(changed, "|")}).drop(*(f"_n_{c}" for c in replaced))
