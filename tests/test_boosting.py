"""Leaf-wise boosting against a learner that sorts and loops, both ways of training, and the grid's choice."""

import numpy as np
import pytest

from ratewright.operators import boosting as B
from ratewright.operators.phases import boosted

SETTING = B.Setting(leaves=5, l2=3.0, cap=2.5, iterations=6, rate=0.3, least=4)


def sample(seed=1, n=160, seasons=(2000, 2001, 2002, 2003)):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.normal(), float(rng.integers(0, 5)), rng.normal()
        y = 2 * np.sign(a) + b * (c > 0) + rng.normal(0, 0.3)
        rows.append((int(seasons[i % len(seasons)]), i, float(a), None if i % 11 == 0 else float(b), float("nan") if i % 17 == 0 else float(c), float(y) if i % 29 else None))
    return rows


COLUMNS = "season long, i long, a double, b double, c double, y double"


def brute_fit(rows, fold, s, bins):
    """Trees as nested tuples, by sorting and looping over rows, features and cut points."""
    train = [r for r in rows if r[0] < fold and r[5] is not None]
    past = [r for r in rows if r[0] < fold]
    columns = []
    for f in (2, 3, 4):
        known = sorted(r[f] for r in past if r[f] is not None and not np.isnan(r[f]))
        cuts = sorted({float(np.quantile(known, k / bins)) for k in range(1, bins)})
        columns.append((f, cuts, float(np.quantile(known, 0.5)), any(r[f] is None or np.isnan(r[f]) for r in past)))

    def vector(r):
        missing = [r[f] is None or np.isnan(r[f]) for f, *_ in columns]
        return [m[2] if gone else r[m[0]] for m, gone in zip(columns, missing)] + [float(gone) for m, gone in zip(columns, missing) if m[3]]

    x = np.array([vector(r) for r in train])
    y = np.clip([r[5] for r in train], -s.cap, s.cap)
    cuts = [m[1] for m in columns] + [[0.0]] * sum(m[3] for m in columns)
    base = y.mean()
    p, trees = np.full(len(y), base), []

    def best(own, g):
        found = None
        for f in range(x.shape[1]):
            for cut in cuts[f]:
                left = own & (x[:, f] <= cut)
                right = own & ~left
                if left.sum() >= s.least and right.sum() >= s.least:
                    gain = sum(g[m].sum() ** 2 / (m.sum() + s.l2) for m in (left, right)) - g[own].sum() ** 2 / (own.sum() + s.l2)
                    if found is None or gain > found[0] + 1e-9:
                        found = gain, f, cut, left, right
        return found if found and found[0] > 1e-9 else None

    for _ in range(s.iterations):
        g = p - y
        leaves = [(np.ones(len(y), bool), ())]
        while len(leaves) < s.leaves:
            options = [(best(own, g), k) for k, (own, _) in enumerate(leaves)]
            options = [(o, k) for o, k in options if o]
            if not options:
                break
            (_, f, cut, left, right), k = max(options, key=lambda z: z[0][0])
            path = leaves.pop(k)[1]
            leaves += [(left, (*path, (f, cut, True))), (right, (*path, (f, cut, False)))]
        tree = [(path, -s.rate * g[own].sum() / (own.sum() + s.l2)) for own, path in leaves]
        for (own, _), (_, value) in zip(leaves, tree):
            p[own] += value
        trees.append(tree)

    def predict(r):
        v = vector(r)
        return base + sum(value for tree in trees for path, value in tree if all((v[f] <= cut) == left for f, cut, left in path))

    return predict


@pytest.mark.parametrize("cells,bins", [(10**6, 8), (0, 8), (10**6, 64)])
def test_equals_a_learner_that_loops(spark, cells, bins):
    rows = sample()
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    binnings, models = B.fit(df, ["a", "b", "c"], "y", "season", [2002] if not cells else [2002, 2003], [SETTING], bins, cells)
    for fold in {k for k, _ in models}:
        want = brute_fit(rows, fold, SETTING, bins)
        got = {r["i"]: r["predicted"] for r in B.predict(df.where("season >= 2002"), ["a", "b", "c"], binnings[fold], models[fold, SETTING]).collect()}
        assert len(got) == 80
        for r in rows:
            if r[0] >= 2002:
                assert abs(got[r[1]] - want(r)) < 1e-9
        assert all(len(tree) <= SETTING.leaves for tree in models[fold, SETTING]["trees"])


def test_jobs_go_on_after_a_rebase(spark, monkeypatch):
    monkeypatch.setattr(B, "REBASE", 2)
    df = spark.createDataFrame(sample(), COLUMNS)
    s = B.Setting(leaves=3, l2=1.0, iterations=5, rate=0.5, least=5)
    models = [B.fit(df, ["a", "b"], "y", "season", [2003], [s], 6, cells)[1][2003, s] for cells in (10**6, 0)]
    assert [len(m["trees"]) for m in models] == [5, 5]
    for one, two in zip(models[0]["trees"], models[1]["trees"]):
        assert sorted(p for p, _ in one) == sorted(p for p, _ in two)
        assert np.allclose(*([v for _, v in sorted(t)] for t in (one, two)))


def test_grid_equals_brute_force(spark):
    rows = sample(4)
    settings = [B.Setting(leaves, l2, cap, 4, 0.3, 4) for leaves in (3, 6) for l2 in (0.5, 20.0) for cap in (1.0, 9.0)]
    got = {(r.test_season, r.leaves, r.l2, r.target_cap): r for r in B.grid_select(spark.createDataFrame(rows, COLUMNS), ["a", "b", "c"], "y", settings, bins=8).collect()}
    want = {}
    for s in settings:
        miss = {}
        for fold in (2001, 2002, 2003):
            predict = brute_fit([r for r in rows if r[5] is not None], fold, s, 8)
            miss[fold] = [abs(predict(r) - r[5]) for r in rows if r[0] == fold and r[5] is not None]
        for test in (2002, 2003):
            want[test, s.leaves, s.l2, s.cap] = np.mean(sum((m for fold, m in miss.items() if fold < test), []))
    assert got.keys() == want.keys() and all(abs(got[k].mae - v) < 1e-9 for k, v in want.items())
    for test in (2002, 2003):
        best = min((round(v, 9), -k[2], k[1], k[3]) for k, v in want.items() if k[0] == test)
        assert [(-k[2], k[1], k[3]) for k, r in got.items() if r.chosen and k[0] == test] == [best[1:]]


def test_later_rows_change_nothing_and_no_past_gives_null(spark):
    rows = sample()
    df, s = spark.createDataFrame(rows, COLUMNS), B.Setting(iterations=3, least=5)
    wild = spark.createDataFrame([(*r[:2], *(1e6 if v is not None else None for v in r[2:5]), 99.0) if r[0] >= 2002 else r for r in rows], COLUMNS)
    one, two = (B.fit(d, ["a", "b", "c"], "y", "season", [2002], [s])[1][2002, s] for d in (df, wild))
    assert one == two
    assert {r.predicted for r in boosted(df, ["a"], "y", "season", 1999, s).collect()} == {None}
    assert boosted(df.limit(0), ["a"], "y", "season", 2001, s).count() == 0
