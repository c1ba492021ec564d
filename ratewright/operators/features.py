"""Features of games from what was known before them: transition from prior to current ratings, schedule burden, and personnel."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewright.operators.joins import asof_prior, attach_two_sided
from ratewright.sources.io import written


def _between(c: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(c, F.lit(high)), F.lit(low))


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def transition_features(games: DataFrame, units: list[str], k: float, cap: float, forms: tuple[str, ...] = (), usual_rest: float = 7.0) -> DataFrame:
    """`games` and, per unit, `prior_` and `current_`: home less away, each side's value parted by its games / (games + k), at most `cap`; per form `form_`.

    The schedule: home_field (not on neutral ground), rest_advantage (days, at most 7 either way; nulls are `usual_rest`), and of the away side travel_1000,
    extreme_travel, direction_burden and schedule_burden (flags back_to_back and three_of_four).  Sides carry home_ and away_; columns are home_games, home_<unit>,
    home_<form>, home_rest and so on, and neutral, travel_miles, far, west_east, back_to_back, three_of_four, of which nulls count as 0.
    """
    share = {side: F.least(F.col(f"{side}_games").cast("double") / (F.col(f"{side}_games") + k), F.lit(cap)) for side in ("home", "away")}
    side = lambda s, c: F.col(f"{s}_{c}").cast("double")
    out = {}
    for unit in units:
        out[f"prior_{unit}"] = (1 - share["home"]) * side("home", unit) - (1 - share["away"]) * side("away", unit)
        out[f"current_{unit}"] = share["home"] * side("home", unit) - share["away"] * side("away", unit)
    for form in forms:
        out[f"form_{form}"] = share["home"] * side("home", form) - share["away"] * side("away", form)
    rest = lambda s: F.coalesce(side(s, "rest"), F.lit(usual_rest))
    out["home_field"] = 1 - _between(_flag("neutral"), 0.0, 1.0)
    out["rest_advantage"] = _between(rest("home") - rest("away"), -7.0, 7.0)
    out["travel_1000"] = _between(_flag("travel_miles"), 0.0, 5000.0) / 1000
    out["extreme_travel"] = _between(_flag("far"), 0.0, 1.0)
    out["direction_burden"] = _between(_flag("west_east"), 0.0, 1.0)
    out["schedule_burden"] = _between(_flag("back_to_back") + _flag("three_of_four"), 0.0, 2.0)
    return games.withColumns(out)


PERSONNEL = ("last_game", "primary", "primary_share", "primary_rate", "changed_last", "changed_first", "overlap", "stability", "missing_core")


def personnel(usage: DataFrame, keys: list[str], period: str, player: str, volume: str, measure: str, decay: float = 0.85, core: float = 0.5, back: int = 4) -> DataFrame:
    """(keys, period, PERSONNEL) after each game of a team: `keys` are team and season, `usage` any number of rows a player and game.

    last_game: the period; primary: the player of most volume (ties: the least), with his share of it and his decayed measure per volume so far;
    changed_last and changed_first: whether he differs from the game before and from the first; overlap: least over greatest shares of this and the game before,
    stability: its mean over three games; missing_core: of the mean shares over the `back` games before, at least `core` a player, the part of players who now
    have no share.  The first game has nulls where there is nothing to compare.

    Games are numbered and totalled in a small table.  The rows of players are sorted once, by player and game, and each looks at its neighbours: at the game
    before for the overlap, and, for each of the next `back` games up to the player's next one, at the rows that count for it.  Only sums leave that step.
    Rates are added up for those who were primary once.
    """
    each = written(usage.groupBy(*keys, period, player).agg(F.sum(volume).cast("double").alias("_v"), F.sum(measure).cast("double").alias("_m")).where("_v > 0"))
    order = Window.partitionBy(*keys).orderBy("_g")
    games = each.groupBy(*keys, period).agg(F.sum("_v").alias("_all"), F.max("_v").alias("_most")).withColumn("_g", F.row_number().over(Window.partitionBy(*keys).orderBy(period)))
    games = written(games)
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in (*keys, period)))
    each = each.join(games.select(*(F.col(c).alias(f"_k_{c}") for c in (*keys, period)), "_all", "_most", "_g"), same)
    each = each.select(*keys, player, "_g", "_v", "_m", (F.col("_v") / F.col("_all")).alias("_share"), (F.col("_v") == F.col("_most")).alias("_top"))

    primary = written(each.where("_top").groupBy(*keys, "_g").agg(F.min_by(F.struct(F.col(player).alias("p"), "_share"), F.struct(player)).alias("_b")))
    once = primary.select(*(F.col(c).alias(f"_k_{c}") for c in keys), F.col("_b.p").alias("_k_p")).distinct()
    theirs = each.join(once, reduce(and_, (F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys), F.col(player).eqNullSafe(F.col("_k_p"))))
    so_far = Window.partitionBy(*keys, player).orderBy("_g").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    weight = F.pow(F.lit(decay), -F.col("_g"))  # the power of a later game divides out
    theirs = theirs.withColumn("_rate", F.sum(F.col("_m") * weight).over(so_far) / F.sum(F.col("_v") * weight).over(so_far))
    rates = theirs.select(*(F.col(c).alias(f"_k_{c}") for c in keys), F.col(player).alias("_k_p"), F.col("_g").alias("_k_g"), "_rate")
    now = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys), (F.col("_g") == F.col("_k_g")) & F.col("_b.p").eqNullSafe(F.col("_k_p")))
    primary = primary.join(rates, now).select(*(F.col(c).alias(f"_h_{c}") for c in keys), F.col("_g").alias("_h_g"), "_b", "_rate")

    own = Window.partitionBy(*keys, player).orderBy("_g")  # a null player is the same as nobody
    past = [(F.col("_g"), F.col("_share")), *((F.lag("_g", k).over(own), F.lag("_share", k).over(own)) for k in range(1, max(back, 2)))]
    seen = each.select(*keys, "_g", "_share", F.lead("_g").over(own).alias("_next"), F.col(player).isNotNull().alias("_named"), *(x.alias(f"_{n}{k}") for k, p in enumerate(past) for n, x in zip("gs", p, strict=True)))
    entries = [F.struct(F.col("_g").alias("_to"), F.col("_share").alias("_sum"), F.when(F.col("_named") & (F.col("_g1") == F.col("_g") - 1), F.least("_share", "_s1")).alias("_least"), F.lit(None).cast("double").alias("_core"), F.lit(None).cast("double").alias("_missing"))]
    for j in range(1, back + 1):
        to = F.col("_g") + j
        mean = sum((F.when(F.col(f"_g{k}") >= to - back, F.col(f"_s{k}")).otherwise(0.0) for k in reversed(range(back))), F.lit(0.0)) / F.least(to - 1, F.lit(back))
        gone = ~(F.col("_named") & F.coalesce(F.col("_next") == to, F.lit(False)))
        counts = (mean >= core) & (F.col("_next").isNull() | (F.col("_next") >= to))
        none = F.lit(None).cast("double")
        entries.append(F.when(counts, F.struct(to.alias("_to"), none.alias("_sum"), none.alias("_least"), mean.alias("_core"), F.when(gone, mean).otherwise(0.0).alias("_missing"))))
    sums = seen.select(*keys, F.explode(F.array_compact(F.array(*entries))).alias("_x")).select(*keys, "_x.*").groupBy(*keys, F.col("_to").alias("_g")).agg(*(F.sum(c).alias(c) for c in ("_sum", "_least", "_core", "_missing")))

    out = games.join(primary, reduce(and_, (F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in keys), F.col("_g") == F.col("_h_g"))).drop("_h_g", *(f"_h_{c}" for c in keys))
    out = out.join(sums, [*keys, "_g"], "left")
    first = F.first("_b.p").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    least = F.coalesce("_least", F.lit(0.0))
    out = out.withColumns({
        "changed_last": (F.col("_b.p") != F.lag("_b.p").over(order)).cast("int"), "changed_first": F.when(F.col("_g") > 1, (F.col("_b.p") != first).cast("int")),
        "overlap": F.when(F.col("_g") > 1, least / (F.col("_sum") + F.lag("_sum").over(order) - least)), "missing_core": F.col("_missing") / F.col("_core"),
    })
    out = out.withColumn("stability", F.avg("overlap").over(order.rowsBetween(-2, Window.currentRow)))
    named = {"last_game": F.col(period), "primary": F.col("_b.p"), "primary_share": F.col("_b._share"), "primary_rate": F.col("_rate")}
    return out.select(*keys, period, *(named.get(c, F.col(c)).alias(c) for c in PERSONNEL))


def personnel_before(grid: DataFrame, facts: DataFrame, keys: list[str], period: str) -> DataFrame:
    """(keys, period, PERSONNEL) of `grid` as they stood after the last game strictly before the period; nulls where there was none."""
    prior = asof_prior(grid.select(*keys, period).distinct(), facts, keys, period, list(PERSONNEL), depth=1)
    return prior.select(*keys, period, *(F.try_element_at("prior", F.lit(1))[c].alias(c) for c in PERSONNEL))


def personnel_advantages(games: DataFrame, before: DataFrame, season: str, period: str, team: str) -> DataFrame:
    """`games` with both sides' facts and home less away (changes and missing players: away less home) as `<fact>_advantage`."""
    out = attach_two_sided(games, before, [season, period], team)
    more = ("primary_rate", "primary_share", "overlap", "stability")
    less = ("changed_last", "changed_first", "missing_core")
    return out.withColumns({f"{c}_advantage": F.col(f"home_{c}") - F.col(f"away_{c}") for c in more} | {f"{c}_advantage": F.col(f"away_{c}") - F.col(f"home_{c}") for c in less})
