"""Identities across providers: as-of resolution, cascades of unique keys, conflict quarantine, scored names, slots.

Where evidence is not unique the row says so in a status column; nothing is guessed.
"""

from __future__ import annotations

from difflib import SequenceMatcher
from functools import reduce
from itertools import combinations, permutations
from operator import and_

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratewright.sources.io import written


def asof_identity(asked: DataFrame, seen: DataFrame, keys: list[str], period: str, identity: str) -> DataFrame:
    """The id that `seen` gives a name at the asked period, else at earlier ones; several ids are a conflict.

    Names and periods of `seen` are reduced to their least and greatest id, which says whether there is one, and put on one time line with the questions, a
    period's questions before its ids.  Running minima and maxima then tell of one earlier id or several: no question meets all rows of its name.  Nulls
    in keys or periods match nothing, and null ids count as none.
    """
    there = F.col(period).isNotNull() & F.col(identity).isNotNull()
    for k in keys:
        there &= F.col(k).isNotNull()
    ids = seen.where(there).groupBy(*keys, F.col(period).alias("_at")).agg(F.min(identity).alias("_lo"), F.max(identity).alias("_hi")).withColumn("_kind", F.lit(1))
    none = F.lit(None).cast(seen.schema[identity].dataType)
    questions = asked.select(*keys, F.col(period).alias("_at"), none.alias("_lo"), none.alias("_hi"), F.lit(0).alias("_kind"))
    line = questions.unionByName(ids)
    now = Window.partitionBy(*keys).orderBy("_at").rangeBetween(Window.currentRow, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = line.withColumns({"_e": F.min("_lo").over(now), "_e2": F.max("_hi").over(now), "_p": F.min("_lo").over(before), "_p2": F.max("_hi").over(before)}).where("_kind = 0")
    status = F.when(F.col("_e") == F.col("_e2"), "exact").when(F.col("_e").isNotNull(), "conflict").when(F.col("_p") == F.col("_p2"), "prior").when(F.col("_p").isNotNull(), "ambiguous").otherwise("missing")
    value = F.when(status == "exact", F.col("_e")).when(status == "prior", F.col("_p"))
    return line.select(*keys, F.col("_at").alias(period), value.alias(identity), status.alias("status"))


def match_cascade(rows: DataFrame, reference: DataFrame, identity: str, tiers: dict[str, list[str]], row_id: str) -> DataFrame:
    """Each row's `matched` id by the first tier whose key has exactly one id in `reference`; `method` names the tier, or "unmatched".

    A tier's key columns are in both tables; a null in the key never matches.
    """
    out = rows.withColumn("matched", F.lit(None).cast(reference.schema[identity].dataType)).withColumn("method", F.lit(None).cast("string"))
    for name, keys in tiers.items():
        one = reference.where(F.col(identity).isNotNull()).groupBy(*(F.col(k).alias(f"_k_{k}") for k in keys)).agg(F.min(identity).alias("_id"), F.max(identity).alias("_id2")).where("_id = _id2").drop("_id2")
        same = F.col("matched").isNull()
        for k in keys:
            same &= F.col(k) == F.col(f"_k_{k}")
        out = out.join(one, same, "left").withColumn("method", F.coalesce("method", F.when(F.col("_id").isNotNull(), F.lit(name)))).withColumn("matched", F.coalesce("matched", "_id")).drop("_id", *(f"_k_{k}" for k in keys))
    return out.withColumn("method", F.coalesce("method", F.lit("unmatched")))


def provider_conflicts(seen: DataFrame, canonical: str, providers: list[str]) -> DataFrame:
    """(provider, direction, value, others): provider ids with several canonical ids, and canonical ids with several of a provider."""
    long = seen.select(F.col(canonical).cast("string").alias("canonical"), F.explode(F.array(*(F.struct(F.lit(p).alias("provider"), F.col(p).cast("string").alias("value")) for p in providers))).alias("x"))
    long = long.select("canonical", "x.*").where("canonical is not null and value is not null").distinct()
    a = long.groupBy("provider", "value").agg(F.count("*").alias("others")).where("others > 1").select("provider", F.lit("provider").alias("direction"), "value", "others")
    b = long.groupBy("provider", "canonical").agg(F.count("*").alias("others")).where("others > 1").select("provider", F.lit("canonical").alias("direction"), F.col("canonical").alias("value"), "others")
    return a.unionByName(b)


def provider_map(seen: DataFrame, canonical: str, provider: str) -> DataFrame:
    """provider id -> canonical id where the pair is one to one."""
    pairs = seen.where(F.col(canonical).isNotNull() & F.col(provider).isNotNull()).select(provider, canonical).distinct()
    by = lambda c: F.count("*").over(Window.partitionBy(c))
    return pairs.withColumns({"_a": by(provider), "_b": by(canonical)}).where("_a = 1 and _b = 1").select(provider, canonical)


def scored_match(rows: DataFrame, profiles: DataFrame, row_id: str, profile_id: str, blocks: list[str], evidence: dict[str, int], accept: int = 65) -> DataFrame:
    """(row_id, profile_id, score, status): candidates share a blocking key; the best is taken if it reaches `accept` and is alone at the top.

    `evidence` gives the points, over 0, of each column in which a row and a profile are equal; nulls equal nothing, and `blocks` are some of its columns.
    No pair is made: profiles are counted, with their least id, by each set of columns that holds a block, and a row looks its own values up.  The sets of
    most points that find a profile give its score; their profiles agree in just those columns, else a larger set had found them, so the counts add up to the ties.
    """
    if not blocks or not set(blocks) <= set(evidence) or min(evidence.values()) <= 0:
        raise ValueError("blocks are columns of the evidence, and all evidence has points over 0")
    sets = [s for n in range(1, len(evidence) + 1) for s in combinations(evidence, n) if set(s) & set(blocks)]
    value = {c: f"_v{i}" for i, c in enumerate(evidence)}

    def keyed(df: DataFrame, identity: str) -> DataFrame:
        """A row for each set whose columns have values, those of the other columns being null."""
        null = lambda c: F.lit(None).cast(profiles.schema[c].dataType)
        each = [F.when(reduce(and_, (F.col(c).isNotNull() for c in s)), F.struct(F.lit(i).alias("_set"), F.lit(sum(evidence[c] for c in s)).alias("_points"), *((F.col(c) if c in s else null(c)).alias(v) for c, v in value.items()))) for i, s in enumerate(sets)]
        return df.select(F.col(identity).alias(f"_{identity}"), F.explode(F.array_compact(F.array(*each))).alias("_x")).select(f"_{identity}", "_x.*")

    one, other = f"_{row_id}", f"_{profile_id}"
    known = keyed(profiles, profile_id).groupBy("_set", *value.values()).agg(F.count("*").alias("_n"), F.min(other).alias("_pick"))
    known = known.select(F.col("_set").alias("_s"), *(F.col(v).alias(f"_p{v}") for v in value.values()), "_n", "_pick")
    same = F.col("_set") == F.col("_s")
    for v in value.values():
        same &= F.col(v).eqNullSafe(F.col(f"_p{v}"))
    found = keyed(rows, row_id).join(known, same).groupBy(one, "_points").agg(F.sum("_n").alias("_n"), F.min("_pick").alias("_pick"))
    top = found.groupBy(one).agg(F.max("_points").alias("score"), F.max_by(F.struct("_n", "_pick"), "_points").alias("_t"))
    status = F.when(F.col("score") < accept, "weak").when(F.col("_t._n") > 1, "tied").otherwise("accepted")
    return top.select(F.col(one).alias(row_id), F.when(status == "accepted", F.col("_t._pick")).alias(profile_id), F.col("score").cast("int").alias("score"), status.alias("status"))


def bridge(rows: DataFrame, history: DataFrame, exact: list[str], wide: list[str], source: str, target: str) -> DataFrame:
    """source -> target by exact keys, else by wide keys if unambiguous; a target claimed by two sources is given to none."""
    def unique(keys, name):
        return history.groupBy(*keys).agg(F.min(target).alias(name), F.count_distinct(target).alias("_n")).where("_n = 1").drop("_n")

    joined = rows.join(unique(exact, "_exact"), exact, "left").join(unique(wide, "_wide"), wide, "left").withColumn("_t", F.coalesce("_exact", "_wide"))
    claims = joined.where("_t is not null").groupBy("_t").agg(F.count_distinct(source).alias("_claims"))
    out = joined.join(claims, "_t", "left")
    status = F.when(F.col("_t").isNull(), "none").when(F.col("_claims") > 1, "contested").when(F.col("_exact").isNotNull(), "exact").otherwise("wide")
    return out.select(*rows.columns, F.when(F.col("_claims") == 1, F.col("_t")).alias(target), status.alias("bridge"))


def crosswalk_map(crosswalk: DataFrame, canonical: str, delimited: str, out: str = "provider_id") -> DataFrame:
    """One row per id of a pipe-delimited list; ids that two canonical rows list are dropped."""
    long = crosswalk.select(canonical, F.explode(F.split(delimited, r"\|")).alias(out)).where(f"trim({out}) <> ''").select(canonical, F.trim(out).alias(out)).distinct()
    return long.withColumn("_n", F.count("*").over(Window.partitionBy(out))).where("_n = 1").drop("_n")


def pair_key(a: str, b: str) -> Column:
    """A key of two names in any order."""
    return F.array_join(F.array_sort(F.array(F.col(a).cast("string"), F.col(b).cast("string"))), "|")


def ownership(seen: DataFrame, identity: str, team: str, is_owner: str) -> DataFrame:
    """Ids on several teams: owned if exactly one team really has them, else quarantined, with the teams as evidence."""
    owner = F.col(is_owner) == 1
    got = seen.groupBy(identity).agg(F.array_sort(F.collect_set(team)).alias("_teams"), F.count_distinct(F.when(owner, F.col(team))).alias("owners"), F.min(F.when(owner, F.col(team))).alias("_owner"))
    status = F.when(F.size("_teams") == 1, "single").when(F.col("owners") == 1, "owned").otherwise("quarantined")
    return got.select(identity, F.array_join("_teams", "|").alias("teams"), "owners", status.alias("status"), F.when(status != "quarantined", F.coalesce("_owner", F.col("_teams")[0])).alias("owner"))


def link_or_borrow(roster: DataFrame, feed: DataFrame, name: str, provider: str, prefix: str) -> DataFrame:
    """The roster's provider id, else the feed's if the name is unique there, else a synthetic one."""
    borrowed = feed.where(F.col(name).isNotNull()).groupBy(name).agg(F.min(provider).alias("_b"), F.count_distinct(provider).alias("_n")).where("_n = 1").drop("_n")
    out = roster.join(borrowed, name, "left")
    method = F.when(F.col(provider).isNotNull(), "own").when(F.col("_b").isNotNull(), "borrowed").otherwise("synthetic")
    made = F.concat(F.lit(prefix), F.replace(F.lower(name), F.lit(" "), F.lit("_")))
    return out.select(*(c for c in roster.columns if c != provider), F.coalesce(F.col(provider).cast("string"), F.col("_b").cast("string"), made).alias(provider), method.alias("method"))


def distinct_slots(candidates: DataFrame, keys: list[str], slots: list[str], slot: str, player: str, rank: str) -> DataFrame:
    """One distinct player per slot: as many rank-1 players kept as possible, then the least rank sum; equal bests are flagged as ties.

    Only candidates with fewer better ones in their slot than there are slots enter, which loses no optimum and no tie: else one of the better ones would be free
    and put in its place.  So the search is a self-join of at most len(slots) rows a slot where ranks differ.
    """
    w = Window.partitionBy(*keys, slot).orderBy(rank)
    short = candidates.withColumn("_rn", F.rank().over(w)).where(F.col("_rn") <= len(slots))
    out = None
    for i, s in enumerate(slots):
        part = short.where(F.col(slot) == s).select(*keys, F.col(player).alias(f"_p{i}"), F.col(rank).alias(f"_r{i}"))
        if out is None:
            out = part
        else:
            out = out.join(part, keys)
            for j in range(i):
                out = out.where(F.col(f"_p{i}") != F.col(f"_p{j}"))
    ranks = [F.col(f"_r{i}") for i in range(len(slots))]
    out = out.withColumns({"first_choices": sum((F.when(r == 1, 1).otherwise(0) for r in ranks), F.lit(0)), "rank_sum": sum(ranks, F.lit(0))})
    order = Window.partitionBy(*keys).orderBy(F.desc("first_choices"), "rank_sum")
    best = out.withColumn("_k", F.rank().over(order)).where("_k = 1").withColumn("ties", F.count("*").over(Window.partitionBy(*keys)))
    pick = Window.partitionBy(*keys).orderBy(*(F.col(f"_p{i}") for i in range(len(slots))))
    best = best.withColumn("_rn", F.row_number().over(pick)).where("_rn = 1")
    return best.select(*keys, *(F.col(f"_p{i}").alias(s) for i, s in enumerate(slots)), F.col("first_choices").cast("int").alias("first_choices"), F.col("rank_sum").cast("long").alias("rank_sum"), "ties")


def evidence_slots(players: DataFrame, evidence: DataFrame, keys: list[str], slots: list[str], player: str, slot: str, weight: str) -> DataFrame:
    """The top len(slots) players of a key to slots so that the summed evidence is largest (ties: the first permutation).

    `players` has the chosen players with `rn` 1..n; the permutations are a small constant table.
    """
    spark = players.sparkSession
    table = [(i, n + 1, s) for i, order in enumerate(permutations(slots)) for n, s in enumerate(order)]
    perms = spark.createDataFrame(table, f"perm int, rn int, {slot} string")
    scored = players.join(F.broadcast(perms), "rn").join(evidence, [*keys, player, slot], "left")  # len(slots)! x len(slots) constant rows
    total = scored.groupBy(*keys, "perm").agg(F.sum(F.coalesce(weight, F.lit(0))).alias("evidence"))
    best = total.groupBy(*keys).agg(F.max_by("perm", F.struct("evidence", -F.col("perm"))).alias("perm"), F.max("evidence").alias("evidence"))
    return players.join(best, keys).join(F.broadcast(perms), ["perm", "rn"]).select(*keys, player, slot, "evidence")


def _numbered_bigrams(text: str) -> Column:
    """The bigrams of a text between two end marks, each with its number among equal ones."""
    padded = F.concat(F.lit("\x02"), F.col(text), F.lit("\x03"))
    grams = F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substr(padded, i, F.lit(2)))
    return F.transform(grams, lambda g, i: F.concat(g, F.size(F.filter(F.slice(grams, F.lit(1), i + 1), lambda x: x == g)).cast("string")))


def _common_letters(x: str, y: str) -> int:
    """The length of the longest common subsequence, a bit for each letter of `x` and a step for each of `y`."""
    at: dict[str, int] = {}
    for i, c in enumerate(x):
        at[c] = at.get(c, 0) | 1 << i
    left = every = (1 << len(x)) - 1
    for c in y:
        used = left & at.get(c, 0)
        left = (left + used | left - used) & every
    return len(x) - left.bit_count()


@F.pandas_udf(T.DoubleType())
def _each_ratio(a: pd.Series, b: pd.Series, least: pd.Series) -> pd.Series:
    """Twice the letters in matching blocks over all letters of both; null where already the longest common subsequence, which holds the blocks, is too short."""
    matchers: dict[str, SequenceMatcher] = {}  # what is prepared for an alias serves all texts of a batch

    def ratio(x: str, y: str, least: float) -> float | None:
        if 2 * _common_letters(x, y) < least * (len(x) + len(y)) - 1e-9:
            return None
        if y not in matchers:
            matchers[y] = SequenceMatcher(None, "", y)
        matchers[y].set_seq1(x)
        return matchers[y].ratio()

    return pd.Series([ratio(*pair) for pair in zip(a, b, least, strict=True)], dtype=float)


_block_ratio = _each_ratio.asNondeterministic()  # it isn't, but so no filter on it moves below the distinct pairs or computes it twice


def similar_texts(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(text, alias, similarity): distinct non-null texts of `left.text` and `right.alias` whose matching-block ratio is at least `least`, which is over 2/3.

    M matched letters leave M + 1 places before, between and behind them; a place where neither text has other letters is a shared bigram (ends count
    as letters).  The other letters, at most M (2 / least - 2), spoil as many places, so M (3 - 2 / least) + 1 bigrams are shared.  Texts so meet only
    by their rarest bigrams, all but that number less one, and where their lengths allow the ratio.  Taking out and putting in the other letters turns
    one text into the other, so their edit distance is at most (1 - least) of all letters; only pairs within it are compared by blocks.
    """
    if least <= 2 / 3:
        raise ValueError("at 2/3 or below two texts may share no bigram")
    # Few bytes make many pairs, so tasks follow the stated number, not the bytes.  Tables have a known size: Spark broadcasts the aliases' while it is small.
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grams = lambda df, c: written(df.where(F.col(c).isNotNull()).select(c).repartition(tasks, c).distinct().withColumn("gram", _numbered_bigrams(c)))
    a, b = grams(left, "text"), grams(right, "alias")
    common = a.select(F.explode("gram").alias("gram")).unionByName(b.select(F.explode("gram").alias("gram"))).groupBy("gram").agg(F.count("*").alias("_n"))
    per_letter = least / (2 - least) * (3 - 2 / least)  # of a text whose partner is as short as may be

    def rare(df: DataFrame, c: str) -> DataFrame:
        needed = F.ceil(F.length(c) * per_letter + 1 - 1e-9)
        ranked = df.select(c, F.explode("gram").alias("gram")).join(common, "gram").groupBy(c).agg(F.array_sort(F.collect_list(F.struct("_n", "gram"))).alias("_g"))  # a text's letters
        return ranked.select(c, F.explode(F.slice("_g", F.lit(1), F.greatest(F.size("_g") - needed + 1, F.lit(1)).cast("int"))["gram"]).alias("gram"))

    lengths = 2 * F.least(F.length("text"), F.length("alias")) >= least * (F.length("text") + F.length("alias")) - 1e-9
    edits = F.levenshtein("text", "alias") <= (1 - least) * (F.length("text") + F.length("alias")) + 1e-9
    met = rare(a, "text").repartition(tasks, "text").join(written(rare(b, "alias")), "gram").where(lengths & edits)
    pairs = met.select("text", "alias").repartition(tasks, "text", "alias").distinct()
    return pairs.withColumn("similarity", _block_ratio("text", "alias", F.lit(float(least)))).where(F.col("similarity") >= least)


def token_match(tokens: DataFrame, aliases: DataFrame, token_id: str, text: str, entity: str, alias: str, least: float = 0.68) -> DataFrame:
    """Greedy one-to-one match of noisy tokens to entities by matching-block ratio of `least` (over 2/3) or more, best pairs first, until no pair is left.

    Ties go to the lesser token, then to the lesser entity.  A round keeps the pairs that are best for both sides, so no order of rows matters; the best
    pair of all is one, so the rounds end.  Of tokens with one text only as many take part as there are entities that it fits.  Nulls match nothing.
    """
    left = written(tokens.select(F.col(token_id).alias("token"), F.col(text).alias("text")).where("token is not null and text is not null"))
    right = aliases.select(F.col(entity).alias("entity"), F.col(alias).alias("alias")).where("entity is not null and alias is not null")
    fits = written(similar_texts(left, right, least).join(right, "alias").groupBy("text", "entity").agg(F.max("similarity").alias("similarity")))
    many = fits.groupBy("text").agg(F.count("*").alias("_many"))
    place = F.row_number().over(Window.partitionBy("text").orderBy("token"))
    chosen = left.distinct().join(many, "text").withColumn("_place", place).where(F.col("_place") <= F.col("_many")).select("token", "text")
    pairs, done = written(chosen.join(fits, "text").groupBy("token", "entity").agg(F.max("similarity").alias("similarity"))), None
    while done is None or not pairs.isEmpty():
        by_token = pairs.groupBy("token").agg(F.min(F.struct(-F.col("similarity"), "entity")).alias("_a"))
        by_entity = pairs.groupBy("entity").agg(F.min(F.struct(-F.col("similarity"), "token")).alias("_b"))
        best = written(pairs.join(by_token, "token").join(by_entity, "entity").where("_a.entity = entity and _b.token = token").select("token", "entity", "similarity"))
        done = best if done is None else done.unionByName(best)
        pairs = written(pairs.join(best.select("token"), "token", "left_anti").join(best.select("entity"), "entity", "left_anti"))
    return done.select(F.col("token").alias(token_id), F.col("entity").alias(entity), "similarity")
