"""Histogram learners against loops over single rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkline.operators import binned, booster, forest, tuning
from inkline.session import cut


def rows_of(n, seed, hot=True):
    """Two useful features, one constant, one noisy, gaps; a third of the rows equal."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        x = [rng.choice([0.0, 0.5, 1.0, 2.0]), rng.gauss(0, 1), 1.0, rng.random() if rng.random() < 0.9 else None]
        if hot and i % 3 == 0:
            x = [0.5, 0.25, 1.0, 0.75]
        y = int(x[0] + x[1] + rng.gauss(0, 0.5) > 1)
        out.append((i, x, y, int(i % 5 == 0)))
    return out


@pytest.fixture(scope="module")
def data(spark):
    rows = rows_of(600, 3)
    df = spark.createDataFrame(rows, "id long, x array<double>, y int, fold int")
    edges = binned.fit_edges(df, "x", 4)
    return rows, edges, {n: cut(binned.pack(df.repartition(n), "x", "y", "id", edges, F.col("fold"))) for n in (1, 5)}


def bin_rows(rows, edges):
    return binned.codes(np.array([[math.nan if v is None else v for v in r[1]] for r in rows]), edges)


def test_bins_keep_the_order(data):
    rows, edges, _ = data
    assert edges[2] == [] and edges[0] == [0.0, 0.5, 1.0]
    codes = bin_rows(rows, edges)
    for (_, x, _, _), code in zip(rows, codes):
        for f in range(4):
            for b, e in enumerate(edges[f]):
                assert (x[f] is None or x[f] <= e) == (code[f] <= b)


def one_tree(codes, y, margin, inside, columns, p, depth):
    """Split the rows of one node by trying every cut; returns (leaf value per row)."""
    prob = 1 / (1 + np.exp(-margin))
    g, h = np.rint((prob - y) * booster.UNIT) / booster.UNIT, np.rint(prob * (1 - prob) * booster.UNIT) / booster.UNIT
    value = np.zeros(len(y))

    def score(rows):
        a = max(abs(g[rows].sum()) - p.l1, 0)
        return a * a / (h[rows].sum() + p.l2)

    def leaf(rows):
        s = g[rows].sum()
        return -math.copysign(max(abs(s) - p.l1, 0), s) / (h[rows].sum() + p.l2) * p.rate

    def split(rows, depth):
        here = rows & inside
        best = (0.0, None)
        if depth:
            for f in columns:
                for b in range(binned.BINS):
                    left, right = here & (codes[:, f] <= b), here & (codes[:, f] > b)
                    if h[left].sum() < p.least_hessian or h[right].sum() < p.least_hessian:
                        continue
                    gain = (score(left) + score(right) - score(here)) / 2 - p.least_gain
                    if gain > best[0] + 1e-12:
                        best = (gain, (f, b))
        if best[1] is None or h[here].sum() < 2 * p.least_hessian:
            value[rows] = leaf(here)
            return
        f, b = best[1]
        split(rows & (codes[:, f] <= b), depth - 1)
        split(rows & (codes[:, f] > b), depth - 1)

    split(np.ones(len(y), bool), depth)
    return value


def test_boosting_matches_a_loop_over_rows(data, monkeypatch):
    rows, edges, tables = data
    p = booster.Params(depth=3, rate=0.3, rounds=6, least_hessian=2.0)
    codes, y = bin_rows(rows, edges), np.array([r[2] for r in rows], float)
    held, key = np.array([r[3] for r in rows]) == 1, np.array([r[0] for r in rows], np.uint64)
    margin = np.full(len(y), booster.base_margin(y[~held].sum(), (~held).sum()))
    want = [float(np.mean(np.logaddexp(0, margin[held]) - y[held] * margin[held]))]
    for k in range(6):
        inside = ~held & binned.drawn(key, p.seed * 1_000_003 + k, p.row_share)
        margin = margin + one_tree(codes, y, margin, inside, booster.columns_of(k, 4, p), p, p.depth)
        want.append(float(np.mean(np.logaddexp(0, margin[held]) - y[held] * margin[held])))
    local = booster.fit(tables[1], edges, p, patience=50)
    monkeypatch.setattr(booster, "LOCAL_ROWS", 0)
    monkeypatch.setattr(booster, "ROUNDS_PER_CUT", 4)
    spread = booster.fit(tables[5], edges, p, patience=50)
    monkeypatch.setattr(binned, "DIRECT", 0)
    exchanged = booster.fit(tables[5], edges, booster.Params(depth=3, rate=0.3, rounds=2, least_hessian=2.0), patience=50)
    assert local.losses == pytest.approx(want, abs=1e-6) and spread.losses == pytest.approx(local.losses, abs=1e-9)
    assert [t.feature for t in local.trees] == [t.feature for t in spread.trees] and [t.cut for t in local.trees] == [t.cut for t in spread.trees]
    assert exchanged.losses == pytest.approx(local.losses[:3], abs=1e-9)
    assert len(local.trees) == int(np.argmin(local.losses))


def test_patience_keeps_the_best_round(data):
    _, edges, tables = data
    model = booster.fit(tables[1], edges, booster.Params(depth=6, rate=0.8, rounds=200, least_hessian=0.5, l2=0.1), patience=5)
    best = int(np.argmin(model.losses))
    assert len(model.losses) - 1 == best + 5 < 200 and len(model.trees) == best
    again = booster.Boosted.from_dict(model.to_dict())
    codes = np.zeros((3, 4), np.uint8)
    assert (again.margin(codes) == model.margin(codes)).all() and sum(model.importance()) == pytest.approx(1.0)


def test_forest_levels_match_a_loop(data, monkeypatch):
    rows, edges, tables = data
    codes, y = bin_rows(rows, edges), np.array([r[2] for r in rows])
    key, train = np.array([r[0] for r in rows], np.uint64), np.array([r[3] for r in rows]) == 0
    made = forest.fit(tables[1], edges, trees=3, depth=3)
    monkeypatch.setattr(forest, "SLOTS", 1)
    monkeypatch.setattr(binned, "DIRECT", 0)
    again = forest.fit(tables[5], edges, trees=3, depth=3)
    assert made.to_dict() == again.to_dict()
    sizes = [len(e) for e in edges]
    for t, tree in enumerate(made.trees):
        w = forest.weights(key, 42, t) * train

        def gini(rows_):
            n = [(w * (y == c))[rows_].sum() for c in (0, 1)]
            return sum(n) - sum(v * v for v in n) / sum(n)

        at = np.zeros(len(y), int)
        for node in range(len(tree.feature)):
            here = at == node
            assert tree.value[node] == pytest.approx((w * y)[here].sum() / w[here].sum())
            if tree.feature[node] < 0:
                continue
            opened = forest.sample(t, [node], sizes, 42, forest.THRESHOLDS)
            tried = []
            for f, cuts in zip(opened.features[0], opened.cuts[0]):
                for c in cuts[cuts < 255]:
                    left, right = here & (codes[:, f] <= c), here & (codes[:, f] > c)
                    if w[left].sum() >= forest.LEAST_ROWS and w[right].sum() >= forest.LEAST_ROWS:
                        tried.append(gini(left) + gini(right))
            f, c = tree.feature[node], tree.cut[node]
            left, right = here & (codes[:, f] <= c), here & (codes[:, f] > c)
            assert gini(left) + gini(right) == pytest.approx(min(tried))
            assert tree.gain[node] == pytest.approx(gini(here) - min(tried))
            at[left], at[right] = tree.left[node], tree.left[node] + 1


def test_forest_scores_are_vote_shares(spark, data):
    rows, edges, tables = data
    model = forest.fit(tables[1], edges, trees=7, depth=4)
    df = spark.createDataFrame(rows, "id long, x array<double>, y int, fold int")
    got = {r["id"]: r for r in df.select("id", model.score("x").alias("s")).select("id", "s.*").collect()}
    leaves = np.stack([np.array(t.value)[t.locate(bin_rows(rows, edges))] for t in model.trees])
    for k, r in enumerate(rows):
        assert got[r[0]]["vote_share"] == pytest.approx((leaves[:, k] > 0.5).mean()) and got[r[0]]["leaf_share"] == pytest.approx(leaves[:, k].mean())
    assert forest.Forest.from_dict(model.to_dict()).to_dict() == model.to_dict()


def test_bootstrap_weights_are_poisson():
    w = forest.weights(np.arange(200_000, dtype=np.uint64), 42, 3)
    assert w.mean() == pytest.approx(1.0, abs=0.01) and w.var() == pytest.approx(1.0, abs=0.02)


def test_tuning_with_rungs_finds_the_unpruned_best(spark):
    rows = [(i, x, y, i % 3) for i, x, y, _ in rows_of(240, 8)]
    df = cut(spark.createDataFrame(rows, "id long, x array<double>, y int, fold int"))
    full, all_ = tuning.tune(df, "x", 4, "y", "id", "fold", trials=12, rungs=None)
    best, some = tuning.tune(df, "x", 4, "y", "id", "fold", trials=12)
    assert best == full and len(some) == 12
    assert [t["stopped_at"] for t in all_] == [None] * 12
    assert any(t["stopped_at"] for t in some)
    for a, b in zip(all_, some):
        if b["stopped_at"] is None:
            assert a == b
    small, _ = tuning.tune(df, "x", 4, "y", "id", "fold", trials=2, max_rows=100)
    assert 1 <= small.rounds <= 500


def test_matthews_by_hand():
    y = np.array([True] * 5 + [False] * 5)
    assert tuning.matthews(y, np.array([True] * 4 + [False] * 6)) == pytest.approx(20 / math.sqrt(600))
    assert tuning.matthews(y, np.zeros(10, bool)) == 0.0


def test_tables_without_rows(spark):
    df = spark.createDataFrame([], "id long, x array<double>, y int")
    edges = binned.fit_edges(df, "x", 2)
    table = cut(binned.pack(df, "x", "y", "id", edges))
    assert edges == [[], []] and booster.fit(table, edges, booster.Params(rounds=2)).margin(np.zeros((1, 2), np.uint8)).tolist() == [0.0]
    assert forest.fit(table, edges, trees=2, depth=2).trees[0].value == [0.0]


# --- exact binary trees -----------------------------------------------------------

def brute_tree(rows, classes, path="root", out=None):
    """Nodes of the fully grown tree by trying every cut of every feature: path -> (feature, cut, gini, counts)."""
    out = {} if out is None else out

    def gini(part):
        n = [sum(r[3] == c for r in part) for c in classes]
        return sum(n) - sum(v * v for v in n) / sum(n) if part else 0.0

    counts = tuple(sum(r[3] == c for r in rows) for c in classes)
    tried = []
    if sum(c > 0 for c in counts) > 1:
        for pos, f in enumerate(("p", "q")):
            known = [r for r in rows if r[pos] is not None]
            values = sorted({r[pos] for r in known})
            for a, b in zip(values, values[1:]):
                cut_ = (a + b) / 2
                left, right = [r for r in known if r[pos] <= cut_], [r for r in known if r[pos] > cut_]
                tried.append((round((gini(left) + gini(right)) / len(known), 12), pos, cut_, None))
        known = [r for r in rows if r[2] is not None]
        for v in sorted({r[2] for r in known}):
            left, right = [r for r in known if r[2] == v], [r for r in known if r[2] != v]
            if right:
                tried.append((round((gini(left) + gini(right)) / len(known), 12), 2, v, v))
    if not tried:
        out[path] = (None, None, None, counts)
        return out
    g, pos, cut_, _ = min(tried, key=lambda t: (t[0], t[1], t[2]))
    out[path] = (("p", "q", "s")[pos], cut_, g, counts)
    goes = [r[pos] is not None and (r[pos] == cut_ if pos == 2 else r[pos] <= cut_) for r in rows]
    brute_tree([r for r, left in zip(rows, goes) if left], classes, path + "/L", out)
    brute_tree([r for r, left in zip(rows, goes) if not left], classes, path + "/R", out)
    return out


@pytest.mark.parametrize("local,spread", [(1 << 17, 40), (60, 20)])
def test_cart_matches_every_cut_tried(spark, monkeypatch, local, spread):
    from inkline.operators import cart

    monkeypatch.setattr(cart, "LOCAL_ROWS", local)
    monkeypatch.setattr(cart, "SPREAD_ROWS", spread)
    rng = random.Random(3)
    rows = [(rng.choice([None, 1.0, 2.0, 3.0, rng.random()]), 0.5 if i % 3 == 0 else round(rng.gauss(0, 1), 2), rng.choice(["a", "b", "c", None]), rng.choice("ANR"))
            for i in range(150)]
    df = spark.createDataFrame(rows, "p double, q double, s string, label string").repartition(3)
    nodes, enc = cart.grow(df, ["p", "q"], ["s"], ["A", "N", "R"])
    want = brute_tree(rows, "ANR")
    got = {r.node_id: (r.feature, r.threshold if r.value is None else r.value, r.score, tuple(r.counts)) for r in nodes.collect()}
    assert set(got) == set(want)
    for k, (f, cut_, g, counts) in want.items():
        assert got[k][0] == f and got[k][3] == counts and (f is None or (got[k][1] == pytest.approx(cut_) and got[k][2] == pytest.approx(g)))
    pred = cart.predict(df, nodes, enc)
    wrong = pred.filter("pred <> label").count()
    mixed_ = sum(sum(c) - max(c) for f, _, _, c in want.values() if f is None)
    assert wrong == mixed_


def test_cart_without_rows_and_with_one_class(spark):
    from inkline.operators import cart

    schema = "x double, k string, label string"
    for rows, n in (([], 0), ([(1.0, "a", "A"), (2.0, None, "A")], 2)):
        nodes, enc = cart.grow(spark.createDataFrame(rows, schema), ["x"], ["k"], ["A", "N"])
        shown = cart.show(nodes, enc).collect()
        assert len(shown) == 1 and shown[0].is_leaf and shown[0].n == n and shown[0].distribution == {"A": n, "N": 0}


def test_bin_bounds_hold_for_every_cut_inside():
    from inkline.operators import cart

    rng = np.random.default_rng(2)
    for _ in range(200):
        before, inside, after = rng.integers(0, 6, (3, 3))
        total = before + inside + after
        bound = cart.bin_bounds(before, inside, total)
        for s in np.ndindex(*(inside + 1)):
            left = before + np.array(s)
            if 0 < left.sum() < total.sum() and inside.sum() > 1:
                assert cart.split_gini(left, total) >= bound - 1e-9


# --- boosted stumps over terms -----------------------------------------------------

def boosted_by_hand(x, y, rounds):
    """(term, threshold, error, alpha) per round on a dense matrix, every cut of every column tried."""
    w, out = np.full(len(y), 1 / len(y)), []
    for _ in range(rounds):
        tried = []
        for t in range(x.shape[1]):
            values = sorted(set(x[:, t]))
            for a, b in zip(values, values[1:]):
                left = x[:, t] <= (a + b) / 2
                cost = 0.0
                for side in (left, ~left):
                    n = w[side].sum()
                    cost += n - sum(w[side & (y == c)].sum() ** 2 for c in (0, 1)) / n
                tried.append((round(cost, 12), f"t{t:02d}", (a + b) / 2, t))
        _, name, cut_, t = min(tried)
        left = x[:, t] <= cut_
        vote = [int(w[side & (y == 1)].sum() > w[side & (y == 0)].sum()) for side in (left, ~left)]
        wrong = np.where(left, vote[0], vote[1]) != y
        error = w[wrong].sum()
        alpha = math.log((1 - error) / error)
        out.append((name, cut_, error, alpha))
        w = w * np.where(wrong, math.exp(alpha), 1.0)
        w /= w.sum()
    return out


@pytest.mark.parametrize("documents", [10**6, 0])
def test_term_stumps_match_every_cut_tried(spark, monkeypatch, documents):
    from inkline.operators import term_boost

    monkeypatch.setattr(term_boost, "MAX_DOCUMENTS", documents)
    rng = np.random.default_rng(4)
    x = np.where(rng.random((60, 12)) < 0.3, np.round(rng.random((60, 12)), 1) + 0.1, 0.0)
    x[::3] = x[0]
    x[5] = 0.0
    y = ((x[:, 1] + x[:, 4] > 0.6) ^ (rng.random(60) < 0.2)).astype(int)
    rounds = 8 if documents else 3
    want = boosted_by_hand(x, y, rounds)
    entries = spark.createDataFrame([(int(i), f"t{t:02d}", float(x[i, t])) for i, t in zip(*np.nonzero(x))], "id long, term string, weight double").repartition(3)
    labels = spark.createDataFrame([(i, int(v)) for i, v in enumerate(y)], "id long, label int")
    model = term_boost.fit(entries, labels, "id", rounds)
    for s, (term, cut_, error, alpha) in zip(model, want, strict=True):
        assert s.term == term and (s.threshold, s.error, s.alpha) == pytest.approx((cut_, error, alpha))
    got = {r["id"]: r["p"] for r in term_boost.predict(entries, labels, model, "id").collect()}
    for i in range(60):
        votes = sum(s.alpha * (s.above if x[i, int(s.term[1:])] > s.threshold else s.below) for s in model)
        assert got[i] == pytest.approx(votes / sum(s.alpha for s in model))


# --- resampling and least squares ---------------------------------------------------

def test_bootstrap_draws_exactly_n(spark, monkeypatch):
    import hashlib

    from inkline.operators import split

    for n, block in ((500, 64), (500, 8192), (0, 64)):
        monkeypatch.setattr(split, "BLOCK", block)
        df = spark.createDataFrame([(i, "hot" if i % 3 == 0 else "x") for i in range(n)], "id long, k string")
        got = {r["id"]: r["copies"] for r in split.bootstrap(df.repartition(5), "id").collect()}
        assert sum(got.values()) == n and got == {r["id"]: r["copies"] for r in split.bootstrap(df.coalesce(1), "id").collect()}
        depth = max(0, (n // block).bit_length())
        md5 = lambda i: hashlib.md5(str(i).encode()).hexdigest()
        blocks = [[] for _ in range(1 << depth)]
        for i in sorted(range(n), key=lambda i: (md5(i), i)):
            blocks[int(md5(i)[:8], 16) >> (32 - depth) if depth else 0].append(i)
        want = {}
        for b, (rows, k) in enumerate(zip(blocks, split.draws_per_block([len(x) for x in blocks], n, 42))):
            for place in np.random.default_rng([42, 1, b]).integers(0, len(rows), k) if rows else []:
                want[rows[place]] = want.get(rows[place], 0) + 1
        assert got == want


def test_bootstrap_shares_are_multinomial():
    from inkline.operators import split

    drawn = np.array([split.draws_per_block([100, 300, 0, 600], 1000, s) for s in range(400)])
    assert (drawn.sum(1) == 1000).all() and (drawn[:, 2] == 0).all()
    assert drawn.mean(0) == pytest.approx([100, 300, 0, 600], abs=4) and drawn[:, 0].var() == pytest.approx(90, rel=0.3)


def test_least_squares_matches_numpy(spark):
    from inkline.operators import linear

    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 3))
    y = 4 + x @ [1.0, -2.0, 0.5] + rng.normal(size=80) / 10
    rows = [(*map(float, v), float(v[0] + v[1]), 7.0, float(t)) for v, t in zip(x, y)] + [(None, 0.0, 0.0, 0.0, 7.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, s double, k double, y double").repartition(3)
    want = np.linalg.lstsq(np.column_stack([np.ones(80), x]), y, rcond=None)[0]
    intercept, coef = linear.least_squares(df, ["a", "b", "c", "s", "k"], "y")
    assert [intercept, *coef[:3]] == pytest.approx(want.tolist()) and coef[3:] == [0.0, 0.0]
    assert linear.least_squares(df.filter("a > 99"), ["a"], "y") == (0.0, [0.0])


# --- networks -----------------------------------------------------------------------

def net_rows(spark, n, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = [float(v) for v in rng.normal(size=3)]
        index = sorted(rng.choice(12, 4, replace=False).tolist()) if i % 5 else []
        value = [float(v) for v in rng.random(len(index))]
        y = int(x[0] - x[1] + (2.0 if 3 in index else 0.0) > 0.3)
        rows.append((i, x, index, value, y, int(i % 4 == 0)))
    return spark.createDataFrame(rows, "id long, x array<double>, i array<int>, v array<double>, y int, fold int")


def packed(spark, n, shape, parts):
    from inkline.operators import network

    return network.written(net_rows(spark, n).repartition(parts), shape, "x", "y", "id", F.col("fold"), "i", "v")


@pytest.mark.parametrize("layers", [((4, 3), (5,), (6, 2)), ((), (), (4,)), ((), (3,), ())])
def test_gradients_match_differences(spark, layers):
    from inkline.operators import network

    shape = network.Shape(3, 12, *layers)
    w = network.start(shape, 1)
    rng = np.random.default_rng(4)
    dense, sparse, y = rng.normal(size=(9, 3)), rng.random((9, 12)) * (rng.random((9, 12)) < 0.4), rng.integers(0, 2, 9).astype(float)
    weights = (0.7, 2.0)
    loss = lambda: network.cross_entropy(network.forward(w, shape, dense, sparse)[0], y, weights).sum()
    for x, g in zip(w, network.gradients(w, shape, dense, sparse, y, weights), strict=True):
        for at in list(np.ndindex(x.shape))[:40]:
            kept, step = x[at], 1e-6
            x[at] = kept + step
            up = loss()
            x[at] = kept - step
            down = loss()
            x[at] = kept
            assert g[at] == pytest.approx((up - down) / (2 * step), abs=1e-5)


def test_gradient_sums_do_not_depend_on_the_tasks(spark, monkeypatch):
    from inkline.operators import network

    monkeypatch.setattr(network, "CHUNK", 7)
    shape = network.Shape(3, 12, (4,), (5,), (3,))
    w, t = network.start(shape, 1), network.Training()
    one, n = network.gradient_of(packed(spark, 150, shape, 1), w, shape, t)
    many, m = network.gradient_of(packed(spark, 150, shape, 6), w, shape, t)
    assert n == m == 112
    for a, b in zip(one, many):
        assert a == pytest.approx(b)


@pytest.mark.parametrize("local", [1 << 14, 0])
def test_training_beats_the_class_prior(spark, monkeypatch, local):
    from inkline.operators import network

    monkeypatch.setattr(network, "LOCAL_ROWS", local)
    shape = network.Shape(3, 12, (8,), (8,), (8,))
    table = packed(spark, 300, shape, 3)
    t = network.Training(rate=0.02, batch=32, epochs=30 if local else 12, patience=6, l2=1e-4)
    model = network.fit(table, shape, t)
    rows = net_rows(spark, 300)
    held = rows.filter("fold = 1").select("y", model.probability("x", "i", "v").alias("p")).toPandas()
    share = held["y"].mean()
    prior = -(share * math.log(share) + (1 - share) * math.log(1 - share))
    loss = -np.mean(np.where(held["y"] == 1, np.log(held["p"]), np.log(1 - held["p"])))
    assert loss == pytest.approx(min(model.losses)) and loss < (0.6 if local else 0.95) * prior


def test_networks_without_rows_and_class_weights(spark):
    from inkline.operators import network

    shape = network.Shape(3)
    table = packed(spark, 8, shape, 1).limit(0)
    assert len(network.fit(table, shape).weights) == 8
    assert network.balanced(net_rows(spark, 0), "y") == (1.0, 1.0)
    df = spark.createDataFrame([(1,), (1,), (1,), (0,)], "y int")
    assert network.balanced(df, "y") == (2.0, pytest.approx(4 / 6))


def test_cart_grows_140000_rows_in_few_jobs(spark):
    """Rows without a pattern make deep trees; above 131,072 rows each level used to be several jobs."""
    from inkline.operators import cart

    df = spark.range(0, 140_000, 1, 4).select(
        (F.xxhash64("id") / 1e9).alias("x"), (F.xxhash64("id", F.lit(1)) % 7).cast("double").alias("k"), F.when(F.xxhash64("id", F.lit(2)) % 2 == 0, "A").otherwise("N").alias("label"))
    spark.sparkContext.setJobGroup("cart-deep", "test")
    try:
        nodes, _ = cart.grow(df, ["x", "k"], [], ["A", "N"])
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("cart-deep")) < 40
    ends = nodes.filter("feature is null").agg(F.sum(F.expr("counts[0] + counts[1]")), F.max(F.expr("least(counts[0], counts[1])")), F.max("depth")).first()
    assert ends[0] == 140_000 and ends[1] == 0 and ends[2] > 40


def test_cart_grows_several_roots_side_by_side():
    import numpy as np

    from inkline.operators import cart

    x = np.array([[1.0, 0.0], [2.0, 0.0], [5.0, 1.0], [6.0, 1.0], [7.0, 0.0], [np.nan, 0.0]])
    grown = cart.grow_here(x, np.array([0, 1, 0, 1, 0, 1]), np.array([0, 0, 1, 1, 1, 1]), np.array([3, 4]), 1, 2, None, 2)
    listed = dict(zip(cart.paths(grown, ["a", "b"]), zip(grown["feature"].tolist(), grown["cut"].tolist(), grown["counts"].tolist(), grown["depth"].tolist())))
    assert listed["a"] == (0, 1.5, [1, 1], 3) and listed["a/L"] == (-1, 0.0, [1, 0], 4)
    assert listed["b"] == (0, 5.5, [2, 2], 4) and listed["b/L"] == (-1, 0.0, [1, 0], 5)
    assert listed["b/R"] == (0, 6.5, [1, 2], 5) and listed["b/R/R"][2] == [1, 1]  # the row without a number goes right


def test_bagged_tree_tries_every_cut(monkeypatch):
    """A sparse tree against a plain one on the written-out table, entries looked at whole and in pieces of three."""
    import numpy as np

    from inkline.operators import bagging

    rng = np.random.default_rng(5)
    x = np.round(rng.random((60, 5)), 1) * (rng.random((60, 5)) < 0.5)
    y, weight = rng.integers(0, 2, 60), rng.integers(0, 3, 60)
    sizes, places = (x != 0).sum(1), np.nonzero(x)[1]
    block = {"key": np.arange(60), "y": y.astype(np.int8), "sizes": sizes, "places": places.astype(np.int32), "values": x[x != 0]}
    held = bagging.Entries([{k: v.tobytes() for k, v in block.items()}])

    def purity(rows):
        n, k = weight[rows].sum(), (weight * y)[rows].sum()
        return (k * k + (n - k) * (n - k)) / n

    def plain(rows, depth):
        n, k = weight[rows].sum(), (weight * y)[rows].sum()
        best = (purity(rows) * (1 + 1e-12), None)
        for f in range(5) if depth and 0 < k < n else ():
            values = np.unique(np.append(x[rows, f], 0.0)) if (x[rows, f] == 0).any() else np.unique(x[rows, f])
            for a, b in zip(values[:-1], values[1:]):
                right = x[rows, f] > (a + b) / 2
                score = purity(rows[right]) + purity(rows[~right])
                if score > best[0]:
                    best = (score, (f, (a + b) / 2, right))
        if best[1] is None:
            return (round(k / n, 9), int(n))
        f, cut_, right = best[1]
        return (f, round(cut_, 9), plain(rows[~right], depth - 1), plain(rows[right], depth - 1))

    def told(tree, at, rows):
        f = int(tree["feature"][at])
        if f < 0:
            return (round(float(tree["share"][at]), 9), int(weight[rows].sum()))
        right, left = x[rows, f] > tree["cut"][at], int(tree["left"][at])
        return (f, round(float(tree["cut"][at]), 9), told(tree, left, rows[~right]), told(tree, left + 1, rows[right]))

    drawn = np.flatnonzero(weight > 0)
    for chunk, depth in ((1 << 18, 30), (3, 30), (7, 2)):
        monkeypatch.setattr(bagging, "CHUNK", chunk)
        tree = bagging.grow(held, weight, depth)
        assert told(tree, 0, drawn) == plain(drawn, depth)
        shares = bagging.Bagged([tree, tree], "features").shares(sizes, places, x[x != 0])
        for row in range(60):
            at = 0
            while tree["feature"][at] >= 0:
                at = tree["left"][at] + (x[row, tree["feature"][at]] > tree["cut"][at])
            assert shares[row] == tree["share"][at]


def test_bagging_grows_in_tasks_and_leaves_negative_values_to_mllib(spark):
    from pyspark.ml.linalg import Vectors

    from inkline.operators import bagging, models

    rows = [(i, i % 2, Vectors.sparse(4, [i % 2, 2], [1.0, 0.1 + i])) for i in range(40)] + [(7, 1, Vectors.dense(0.0, 1.0, 0.0, 2.0))]
    df = spark.createDataFrame(rows, ["doc_id", "label", "features"])
    model = models.bagging(trees=5).fit(df)
    assert isinstance(model, bagging.Bagged) and len(model.trees) == 5
    assert models.scored(model, df, ["label"]).filter("pred <> label").count() == 0
    again = models.bagging(trees=5).fit(df.repartition(7))
    assert all((a["feature"] == b["feature"]).all() and (a["cut"] == b["cut"]).all() for a, b in zip(model.trees, again.trees))
    other = spark.createDataFrame([(i, i % 2, Vectors.dense(i % 2 - 0.5)) for i in range(20)], ["doc_id", "label", "features"])
    assert not isinstance(models.bagging(trees=2, depth=2).fit(other), bagging.Bagged)
