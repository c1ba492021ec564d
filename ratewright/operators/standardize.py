"""Raw tables to canonical columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewright.functions.clean import blank_to_null, clip


@dataclass(frozen=True)
class Field:
    """A canonical column: where it may come from, its type, and what stands in when no alias is there."""

    aliases: tuple[str, ...]
    type: str = "string"
    default: object = None
    required: bool = False
    merge: bool = False  # coalesce all aliases that exist instead of taking the first


def standardize(df: DataFrame, spec: dict[str, Field]) -> DataFrame:
    """One output column per field.  Text that doesn't parse becomes null; a required field without any alias raises."""
    have = {c.lower(): c for c in df.columns}
    out = []
    for name, f in spec.items():
        found = [have[a.lower()] for a in f.aliases if a.lower() in have]
        if f.required and not found:
            raise ValueError(f"none of {f.aliases} is there for the required column {name}")
        cols = [F.col(f"`{c}`").try_cast(f.type) for c in (found if f.merge else found[:1])]
        cols = [blank_to_null(c) if f.type == "string" else F.nanvl(c, F.lit(None)) if f.type == "double" else c for c in cols]
        default = [F.lit(f.default).cast(f.type)] if f.default is not None else []
        out.append(F.coalesce(*cols, *default).alias(name) if cols or default else F.lit(None).cast(f.type).alias(name))
    return df.select(*out)


def sum_duplicates(df: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """One row per key; counts of repeated rows add up."""
    return df.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))


def collapse_repeats(df: DataFrame, keys: list[str], maxima: list[str], means: list[str], identity: list[str], order: str) -> DataFrame:
    """One row per key: the largest counts, the mean rates and the identity fields of the row that comes first by `order`."""
    return df.groupBy(*keys).agg(*(F.max(c).alias(c) for c in maxima), *(F.avg(c).alias(c) for c in means), *(F.min_by(c, order).alias(c) for c in identity))


def flag_issues(df: DataFrame, checks: dict[str, F.Column], column: str = "issues") -> DataFrame:
    """The names of the checks that fail, joined by a pipe (empty: none)."""
    return df.withColumn(column, F.array_join(F.array_compact(F.array(*(F.when(bad, F.lit(n)) for n, bad in checks.items()))), "|"))


def unique_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in a total order."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")


def truthy(column: str) -> F.Column:
    return F.upper(F.trim(F.col(column).cast("string"))).isin("1", "1.0", "TRUE", "T", "YES", "Y").cast("int")


def merge_aliases(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Renames without collisions: a canonical column is the coalesce of itself and its aliases, which go."""
    drop = {a for v in aliases.values() for a in v}
    out = []
    for c in [*(c for c in df.columns if c not in drop or c in aliases), *(c for c in aliases if c not in df.columns)]:
        found = [x for x in (c, *aliases.get(c, [])) if x in df.columns]
        if found:
            out.append(F.coalesce(*(F.col(x) for x in found)).alias(c))
    return df.select(*out)


def point_in_time(df: DataFrame, period: str, through: int, date: str | None = None, as_of=None, completed: str | None = None) -> DataFrame:
    """What was known: completed rows up to a period and date; undated rows pass."""
    keep = F.col(period) <= through
    if date is not None and as_of is not None:
        keep &= F.col(date).isNull() | (F.col(date) <= F.lit(as_of))
    if completed is not None:
        keep &= F.col(completed) == 1
    return df.where(keep)


def exclude_flags(df: DataFrame, flags: list[str], required: list[str]) -> DataFrame:
    """Rows without any of the flags (null: not set) and with all required columns."""
    keep = F.lit(True)
    for f in flags:
        keep &= F.coalesce(F.col(f), F.lit(0)) == 0
    for r in required:
        keep &= F.col(r).isNotNull()
    return df.where(keep)


def clip_columns(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: clip(c, *b) for c, b in bounds.items()})


def guard_features(columns: list[str], forbidden: tuple[str, ...] = ("market", "spread", "price", "line_", "odds"), expected: list[str] | None = None) -> list[str]:
    """The feature names, or an error: none may hold a forbidden token, and an expected list must match in order."""
    bad = [c for c in columns if any(t in c.lower() for t in forbidden)]
    if bad:
        raise ValueError(f"forbidden features: {bad}")
    if expected is not None and list(columns) != list(expected):
        raise ValueError("the features differ from the contract")
    return list(columns)
