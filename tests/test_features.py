"""Personnel and transition features against loops, and what they must not see."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ratewright.operators import features as FT

COLUMNS = "season int, team string, period int, player int, volume long, epa double"


def sample(seed=1):
    rng = random.Random(seed)
    rows = [(2000 + s, t, p, rng.randint(1, 5), rng.randint(0, 4), rng.gauss(0, 1)) for s in range(2) for t in "ab" for p in (1, 2, 4, 5, 6, 8) for _ in range(4)]
    return rows + [(2000, "a", 9, None, 3, 1.0), (2000, "c", 1, 1, 0, 1.0)]


def after_games(rows, decay=0.85, core=0.3, back=4):
    """The facts of each team-game by loops."""
    games = defaultdict(lambda: defaultdict(lambda: [0.0, 0.0]))
    for s, t, p, who, v, m in rows:
        games[s, t, p][who][0] += v
        games[s, t, p][who][1] += m
    games = {k: {w: x for w, x in g.items() if x[0] > 0} for k, g in games.items()}
    games = {k: g for k, g in games.items() if g}
    out = {}
    for s, t in {(s, t) for s, t, _ in games}:
        periods, done, overlaps, firsts = sorted(p for a, b, p in games if (a, b) == (s, t)), [], [], []
        for p in periods:
            g = games[s, t, p]
            total = sum(v for v, _ in g.values())
            share = {w: v / total for w, (v, _) in g.items()}
            primary = min(g, key=lambda w: (-g[w][0], w is not None, w or 0))
            done.append((g, share, primary))
            n = len(done)
            top = sum(x[0][primary][1] * decay ** (n - 1 - i) for i, x in enumerate(done) if primary in x[0])
            bottom = sum(x[0][primary][0] * decay ** (n - 1 - i) for i, x in enumerate(done) if primary in x[0])
            overlap = missing = None
            if n > 1:
                last = done[-2][1]
                both = set(share) | set(last)
                overlap = sum(min(share.get(w, 0), last.get(w, 0)) for w in both) / sum(max(share.get(w, 0), last.get(w, 0)) for w in both)
                before = done[-1 - back : -1] if n > back else done[:-1]
                mean = {w: sum(x[1].get(w, 0) for x in before) / len(before) for w in set().union(*(x[1] for x in before))}
                mean = {w: v for w, v in mean.items() if v >= core}
                missing = sum(v for w, v in mean.items() if w not in share) / sum(mean.values()) if mean else None
            overlaps.append(overlap)
            firsts.append(primary)
            recent = [x for x in overlaps[-3:] if x is not None]
            out[s, t, p] = (p, primary, share[primary], top / bottom, int(primary != firsts[-2]) if n > 1 else None, int(primary != firsts[0]) if n > 1 else None, overlap, sum(recent) / len(recent) if recent else None, missing)
    return out


def same(a, b):
    return a == b if a is None or b is None or isinstance(b, int) else math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12)


def test_facts_equal_loops(spark):
    rows = [r for r in sample() if r[3] is not None]
    got = {(r.season, r.team, r.period): tuple(r[c] for c in FT.PERSONNEL) for r in FT.personnel(spark.createDataFrame(rows, COLUMNS).repartition(3), ["season", "team"], "period", "player", "volume", "epa", core=0.3).collect()}
    want = after_games(rows)
    assert got.keys() == want.keys()
    for k, facts in want.items():
        assert all(same(a, b) for a, b in zip(got[k], facts)), (k, got[k], facts)


def test_nothing_of_the_period_or_later_is_seen(spark):
    rows = [r for r in sample(2) if r[3] is not None]
    grid = spark.createDataFrame([(s, t, p) for s in (2000, 2001) for t in "abz" for p in range(1, 11)], "season int, team string, period int")
    facts = lambda data: FT.personnel(spark.createDataFrame(data, COLUMNS), ["season", "team"], "period", "player", "volume", "epa", core=0.3)
    before = lambda data: {(r.season, r.team, r.period): tuple(r) for r in FT.personnel_before(grid, facts(data), ["season", "team"], "period").collect()}
    one = before(rows)
    two = before([(*r[:4], 1000, -50.0) if r[2] >= 5 else r for r in rows] + [(2000, "a", 5, 99, 10**6, 1.0)])
    assert len(one) == 60 and all(one[k] == two[k] for k in one if k[2] <= 5) and one != two
    for (_, _, p), r in one.items():
        assert r[3] is None or r[3] < p
    assert all(r[3] is None for k, r in one.items() if k[1] == "z" or k[2] == 1)


@pytest.mark.parametrize("games", [(0, 0), (3, 9), (50, 1)])
def test_transition_equals_its_formula(spark, games):
    row = dict(home_games=games[0], away_games=games[1], home_u=4.0, away_u=1.5, home_f=0.5, away_f=-2.0, home_rest=None, away_rest=20, neutral=None, travel_miles=9000.0, far=1, west_east=3, back_to_back=1, three_of_four=None)
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{c} double" if c[-1] in "uf" and "_of_" not in c or c == "travel_miles" else f"{c} int" for c in row))
    r = FT.transition_features(df, ["u"], 3.0, 0.65, ("f",)).first()
    h, a = (min(g / (g + 3.0), 0.65) for g in games)
    want = dict(prior_u=(1 - h) * 4 - (1 - a) * 1.5, current_u=h * 4 - a * 1.5, form_f=h * 0.5 + a * 2, home_field=1, rest_advantage=-7, travel_1000=5, extreme_travel=1, direction_burden=1, schedule_burden=1)
    assert all(abs(r[c] - v) < 1e-12 for c, v in want.items())


def test_no_games(spark):
    assert FT.personnel(spark.createDataFrame([], COLUMNS), ["season", "team"], "period", "player", "volume", "epa").count() == 0


def test_rows_of_players_are_not_joined_to_each_other(spark):
    """Neighbouring games are looked up in one sort of the players' rows: no row goes into a join with another game's, nor into a copy a game ahead."""
    rows = [r for r in sample() if r[3] is not None]
    facts = FT.personnel(spark.createDataFrame(rows, COLUMNS), ["season", "team"], "period", "player", "volume", "epa")
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "sequence(" not in plan
    by_player = [x for x in plan.splitlines() if "Window [" in x and "lag(_share" in x]
    assert len(by_player) == 1


def test_a_null_player_is_the_same_as_nobody(spark):
    rows = [(2000, "a", p, None, 1, 1.0) for p in (1, 2)] + [(2000, "a", p, 7, 1, 1.0) for p in (1, 2)]
    got = FT.personnel(spark.createDataFrame(rows, COLUMNS), ["season", "team"], "period", "player", "volume", "epa").where("period = 2").first()
    assert (got.overlap, got.missing_core, got.primary_share) == (0.5 / 1.5, 0.5, 0.5)
