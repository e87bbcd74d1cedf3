"""Operators against brute force on small fixtures, and the fixed metric goldens."""

import hashlib
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkline.operators import blocks, clean, cluster, curves, encode, ensemble, logs, metrics, neighbours, ranking, scoring, selection, split, trees
from inkline.plans import QUERIES
from inkline.session import checkpoint_dir, cut
from inkline.sources import tables
from inkline.streaming import score_stream as ss


def skewed(spark, n=600, seed=1):
    """A third of the rows share one key."""
    rng = random.Random(seed)
    rows = [(i, "hot" if rng.random() < 0.34 else f"k{rng.randint(0, 20)}", round(rng.random(), 2), rng.randint(0, 1)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, k string, x double, y int").repartition(5)


def md5(i):
    return hashlib.md5(str(i).encode()).hexdigest()


def test_hash_rank_is_exact(spark):
    rows, df = skewed(spark)
    got = {r["id"]: (r["rn"], r["t"]) for r in ranking.hash_rank(df, "id", ["k"], "rn", "t").collect()}
    for key in {r[1] for r in rows}:
        ids = sorted((r[0] for r in rows if r[1] == key), key=lambda i: (md5(i), i))
        assert [got[i] for i in ids] == [(n + 1, len(ids)) for n in range(len(ids))]


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals_are_exact(spark, descending):
    rows, df = skewed(spark)
    grouped = df.groupBy("k", "x").agg(F.sum("y").alias("s"))
    out = ranking.running_totals(grouped, "x", ["s"], ["k"], descending, "nxt")
    got = {(r["k"], r["x"]): (r["cum_s"], r["all_s"], r["nxt"]) for r in out.collect()}
    for key in {r[1] for r in rows}:
        xs = sorted({r[2] for r in rows if r[1] == key}, reverse=descending)
        run = 0
        for i, x in enumerate(xs):
            run += sum(r[3] for r in rows if r[1] == key and r[2] == x)
            nxt = xs[i + 1] if i + 1 < len(xs) else None
            assert got[key, x] == (run, sum(r[3] for r in rows if r[1] == key), nxt)


def test_splits_are_disjoint_and_exact(spark):
    rows, df = skewed(spark)
    parts = split.three_way(df, "id", "k").select("id", "k", "split").collect()
    assert len(parts) == len(rows) == len({r["id"] for r in parts})
    for key in {r[1] for r in rows}:
        n = sum(r[1] == key for r in rows)
        assert sum(r["k"] == key and r["split"] == "test" for r in parts) == max(1, round(n * 0.1))
    folds = split.k_folds(df, "id", "k", 4).groupBy("k").pivot("fold").count().collect()
    for r in folds:
        sizes = [r[str(i)] or 0 for i in range(4)]
        assert max(sizes) - min(sizes) <= 1


def test_keep_first_keeps_the_smallest_id(spark):
    df = spark.createDataFrame([(3, "a"), (1, "b"), (2, "a"), (9, "b")] + [(i, "hot") for i in range(20, 60)], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in clean.keep_first(df.repartition(4)).collect()) == [1, 2, 20]


def test_label_spellings(spark):
    df = spark.createDataFrame([("1",), ("1.0",), ("ai",), ("AI",), ("bot",), ("machine",), ("0",), ("human",), (None,)], "label_id string")
    assert [r["label_binary"] for r in clean.with_binary_label(df).collect()] == [1, 1, 1, 1, 1, 1, 0, 0, 0]


GOLDEN = [(1, 1, .9), (1, 1, .8), (1, 1, .7), (1, 1, .6), (1, 0, .45), (0, 0, .4), (0, 0, .3), (0, 0, .2), (0, 0, .1), (0, 0, .05)]


def test_metric_golden(spark):
    df = spark.createDataFrame(GOLDEN, "label int, pred int, p double")
    m = metrics.binary_metrics(df).first()
    assert (m["tp"], m["fn"], m["tn"], m["fp"]) == (4, 1, 5, 0)
    assert m["accuracy"] == pytest.approx(.9) and m["precision"] == 1.0 and m["recall"] == pytest.approx(.8)
    assert m["f1"] == pytest.approx(8 / 9) and m["mcc"] == pytest.approx(20 / math.sqrt(600))
    t = curves.threshold_table(df)
    assert curves.roc_auc(t).first()["auc"] == 1.0 and curves.average_precision(t).first()["average_precision"] == pytest.approx(1.0)


def test_rates_from_counts(spark):
    m = metrics.rates(spark.createDataFrame([(497, 108, 82, 471)], "tp long, fp long, fn long, tn long")).first()
    assert m["accuracy"] == pytest.approx(968 / 1158) and m["precision"] == pytest.approx(.821488, abs=1e-6)
    assert m["recall"] == pytest.approx(.858377, abs=1e-6) and m["specificity"] == pytest.approx(.813472, abs=1e-6)


def test_auc_survives_monotone_transform(spark):
    _, df = skewed(spark)
    a, b = (curves.roc_auc(curves.threshold_table(df.withColumn("p", c), "y", "p")).first()["auc"] for c in (F.col("x"), F.exp(3 * F.col("x"))))
    assert a == pytest.approx(b)


def test_ema_over_many_blocks(spark):
    rng = random.Random(3)
    xs = [rng.random() * 10 for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(xs)), "step long, loss double").repartition(4)
    got = [r["ema"] for r in logs.ema_smooth(df, "step", "loss", 20).orderBy("step").collect()]
    num = den = 0.0
    want = []
    for x in xs:
        num, den = x + num * 19 / 21, 1 + den * 19 / 21
        want.append(num / den)
    assert got == pytest.approx(want, rel=1e-12)


def test_ema_leaves_nulls_out(spark):
    import pandas as pd

    rng = random.Random(4)
    xs = [None if rng.random() < 0.2 or i < 2 else rng.random() for i in range(400)]
    df = spark.createDataFrame(list(enumerate(xs)), "step long, loss double").repartition(4)
    got = [math.nan if r["ema"] is None else r["ema"] for r in logs.ema_smooth(df, "step", "loss", 20).orderBy("step").collect()]
    assert got == pytest.approx(pd.Series(xs, dtype=float).ewm(span=20, adjust=True).mean().tolist(), rel=1e-9, nan_ok=True)


def test_logs_in_blocks_match_one_pass(spark):
    rng = random.Random(6)
    rows = [("hot" if i < 400 else None if i < 430 else "b", i, rng.random(), 5 / (i % 200 + 1) + rng.random()) for i in range(500)]
    df = spark.createDataFrame(rows, "run string, step long, train_loss double, val_loss double").repartition(7)
    for by in (["run"], None):
        runs = {}
        for run, step, train, val in rows:
            runs.setdefault(run if by else "all", []).append((step, train, val))
        got = {r["step"]: r for r in logs.loss_deltas(df, by=by).collect()}
        stops = {(r["run"] if by else "all"): r for r in logs.early_stop(df, patience=12, by=by).collect()}
        assert set(stops) == set(runs)
        for run, log in runs.items():
            best, since, n, stop = None, 0, 0, None
            for i, (step, train, val) in enumerate(log):
                assert got[step]["gap"] == val - train
                assert got[step]["improvement"] == (log[i - 1][2] - val if i else None)
            for step, _, val in log:
                n += 1
                if best is None or val < best[1]:
                    best, since = (step, val), 0
                else:
                    since += 1
                if since >= 12:
                    stop = step
                    break
            r = stops[run]
            assert (r["best_step"], r["best_loss"], r["stop_step"], r["steps_run"]) == (*best, stop, n)


def test_codes_over_many_categories(spark):
    values = [f"c{i * 7919 % 3000}" for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in values + values[:50]], "k string").repartition(6)
    want = {v: i for i, v in enumerate(sorted(values))}
    got = encode.label_encode(df, "k", "code").collect()
    assert len(got) == 3050 and all(r["code"] == want[r["k"]] for r in got)
    with pytest.raises(ValueError):
        encode.one_hot(df, "k")


def test_asof_join(spark):
    left = spark.createDataFrame([(i, float(i)) for i in (0, 5, 9, 10, 31)], "step long, a double")
    right = spark.createDataFrame([(i, float(-i)) for i in (3, 9, 20)], "step long, b double")
    got = {r["step"]: r["step_matched"] for r in logs.asof_join(left, right, "step").collect()}
    assert got == {0: None, 5: 3, 9: 9, 10: 9, 31: 20}


def test_early_stop(spark):
    df = spark.createDataFrame(list(enumerate([5.0, 4.0, 4.0, 3.0, 3.5, 3.2, 3.0, 1.0])), "step int, val_loss double")
    r = logs.early_stop(df, patience=3).first()
    assert (r["best_step"], r["best_loss"], r["stop_step"], r["steps_run"]) == (3, 3.0, 6, 7)


def points(spark, n, dims=3, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    y = rng.integers(0, 3, n)
    return x, y, spark.createDataFrame([(i, [float(v) for v in x[i]], int(y[i])) for i in range(n)], "id long, v array<double>, label int")


def test_knn_in_small_blocks(spark):
    x, y, df = points(spark, 70)
    test, train = df.filter("id < 20"), df.filter("id >= 20").withColumnRenamed("id", "tid")
    got = {r["id"]: r["pred"] for r in neighbours.classify(test, train, "id", "tid", "v", "label", 3, rows_per_block=7).collect()}
    for i in range(20):
        near = sorted(range(20, 70), key=lambda j: (np.sqrt(((x[j] - x[i]) ** 2).sum()), j))[:3]
        votes = [int(y[j]) for j in near]
        assert got[i] == min(set(votes), key=lambda c: (-votes.count(c), c))


def test_knn_ties_go_to_the_smallest_id(spark):
    rows = [(i, [1.0, 2.0], i % 2) for i in range(200)] + [(200 + i, [1.0 + i, 2.0], 0) for i in range(1, 40)]
    df = spark.createDataFrame(rows, "tid long, v array<double>, label int")
    test = spark.createDataFrame([(1, [1.0, 2.0])], "id long, v array<double>")
    near = neighbours.nearest(test, df, "id", "tid", "v", "label", 3, rows_per_block=50).collect()
    assert sorted(r["tid"] for r in near) == [0, 1, 2] and all(r["distance"] == 0 for r in near)


def test_silhouette_in_small_blocks(spark):
    x, y, df = points(spark, 50)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    vals = []
    for i in range(50):
        same = [j for j in range(50) if y[j] == y[i] and j != i]
        a = d[i, same].mean()
        b = min(d[i, y == c].mean() for c in set(y) if c != y[i])
        vals.append((b - a) / max(a, b))
    got = cluster.silhouette_exact(df, "id", "v", "label", rows_per_block=8).first()
    assert got["silhouette"] == pytest.approx(np.mean(vals)) and got["n"] == 50


def gini(ys):
    return 1 - sum((ys.count(c) / len(ys)) ** 2 for c in set(ys)) if ys else 0.0


def test_binary_split_matches_brute_force(spark):
    rows, df = skewed(spark, 200)
    cand = selection.split_candidates(df.withColumnRenamed("y", "label"), ["x"], ["k"], [0, 1])
    got = {r["feature"]: r for r in selection.best_split_per_feature(cand).collect()}
    xs = sorted({r[2] for r in rows})
    best = min((round((len(l) * gini(l) + len(r) * gini(r)) / 200, 12), t) for t in ((a + b) / 2 for a, b in zip(xs, xs[1:]))
               for l, r in [([q[3] for q in rows if q[2] <= t], [q[3] for q in rows if q[2] > t])])
    assert (got["x"]["gini"], got["x"]["threshold"]) == pytest.approx(best)
    ks = min(round((len(l) * gini(l) + len(r) * gini(r)) / 200, 12) for v in {r[1] for r in rows}
             for l, r in [([q[3] for q in rows if q[1] == v], [q[3] for q in rows if q[1] != v])])
    assert got["k"]["gini"] == pytest.approx(ks)


def test_tree_shape_and_missing_values(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["LOW", "HIGH", None]), rng.choice(["a", "b", "c"]), rng.choice(["u", "v"])) for _ in range(300)]
    rows = [(a, b, c, 1 if a == "HIGH" or (a is None and b == "a") else 0) for a, b, c in rows]
    df = spark.createDataFrame(rows, "f string, g string, h string, label int")
    tree = trees.grow_categorical(df, ["f", "g", "h"], max_depth=3, criterion="gain_ratio")
    nodes = tree.collect()
    ids = {n["node_id"] for n in nodes}
    assert len(ids) == len(nodes) and sum(n["parent_id"] is not None for n in nodes) == len(nodes) - 1
    assert all(n["parent_id"] in ids for n in nodes if n["parent_id"] is not None)
    assert trees.node_edges(tree).count() == len(nodes)
    full = df.filter("f is not null")
    p = trees.predict_c45(full, trees.grow_categorical(full, ["f", "g", "h"], criterion="gain_ratio"))
    assert p.filter("pred <> label").count() == 0


def test_id3_unseen_value_follows_the_heaviest_branch(spark):
    df = spark.createDataFrame([("a", 0)] * 5 + [("b", 1)] * 3, "f string, label int")
    tree = trees.grow_categorical(df, ["f"])
    assert trees.predict_id3(spark.createDataFrame([("zzz",)], "f string"), tree).first()["pred"] == 0


def test_full_trees_fit_distinct_rows(spark):
    rng = random.Random(5)
    rows = [(a, b, c, rng.randrange(2)) for a in "pqr" for b in "xyz" for c in "uvw"]
    df = spark.createDataFrame(rows, "f string, g string, h string, label int")
    assert trees.predict_id3(df, trees.grow_categorical(df, ["f", "g", "h"])).filter("pred <> label").count() == 0


def test_null_categories_and_steps_stay(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "k string")
    assert {r["k"]: r["c"] for r in encode.label_encode(df, "k", "c").collect()} == {"a": 0, "b": 1, None: None}
    left = spark.createDataFrame([(3,), (None,)], "step int")
    right = spark.createDataFrame([(1, 0.5)], "step int, loss double")
    assert {r["step"]: r["step_matched"] for r in logs.asof_join(left, right, "step").collect()} == {3: 1, None: None}


def test_scaling_of_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "a double, b double")
    out = encode.standard_scale(df, encode.fit_standard(df, ["a", "b"])).collect()
    assert [tuple(r) for r in out] == [(0.0, -1.0), (0.0, 1.0)]


def test_weight_search_first_best_wins(spark):
    df = spark.createDataFrame([(1, .9, .9), (0, .1, .1)], "y int, a double, b double")
    assert ensemble.best_weight(df, "y", "a", "b") == 0.2


def test_csv_lines_and_log_sources(spark, tmp_path):
    (tmp_path / "c.csv").write_text("sr_no,f1,f2,label_id\n1, LOW ,,1.0\n2,HIGH,x,0.0\n")
    df = tables.read_categorical_csv(spark, str(tmp_path / "c.csv"), blank_is_missing=True)
    assert [tuple(r) for r in df.collect()] == [("LOW", None, "1.0"), ("HIGH", "x", "0.0")]
    (tmp_path / "e.csv").write_text("f,label_id\n")
    with pytest.raises(ValueError):
        tables.read_categorical_csv(spark, str(tmp_path / "e.csv"))
    (tmp_path / "t.txt").write_text("one\n\n  two \n")
    assert [r["text"] for r in tables.read_text_lines(spark, str(tmp_path / "t.txt")).collect()] == ["one", "two"]
    log = {"train": [{"step": 1, "loss": .5, "lr": .1, "epoch": 0.1}, {"step": 2, "loss": .4, "lr": .1, "epoch": .2}],
           "eval": [{"step": 2, "eval_loss": .3, "accuracy": .9, "f1": .8, "f1_ai": .7, "f1_human": .6}], "best_step": 2, "best_f1": .8}
    (tmp_path / "log.json").write_text(json.dumps(log, indent=2))
    train, evals = tables.read_training_log(spark, str(tmp_path / "log.json"))
    assert train.count() == 2 and evals.first()["f1_human"] == .6 and evals.first()["best_step"] == 2
    for fmt in ("parquet", "csv", "json"):
        tables.write_table(train, str(tmp_path / fmt), fmt)
        assert spark.read.schema(train.schema).option("header", True).format(fmt).load(str(tmp_path / fmt)).count() == 2


def test_cut_survives_and_is_reused(spark):
    df = cut(spark.range(10).withColumn("r", F.rand()))
    assert df.collect() == df.collect() and checkpoint_dir(spark)


def test_stream_equals_batch_and_model_reload(spark, sf, tmp_path):
    from inkline.plans.text_q import labelled, text_docs

    scorer, test = scoring.fit_scorer(labelled(spark, sf), trees=5, rounds=2, depth=3)
    assert test.count() > 0 and len(scorer.selected) == 40
    scorer.save(spark, str(tmp_path / "model"))
    loaded = scoring.TextScorer.load(spark, str(tmp_path / "model"))
    docs = text_docs(spark, sf).limit(60)
    batch = sorted(map(tuple, scorer.transform(docs).collect()))
    docs.repartition(2).write.parquet(str(tmp_path / "in"))
    source = ss.text_stream(spark, str(tmp_path / "in"), files_per_trigger=1)
    ss.score_stream(source, loaded, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == batch


def test_block_pairs_cover_every_pair_once(spark):
    import pandas as pd

    df = spark.range(23).withColumnRenamed("id", "a")
    pairs = blocks.block_pairs(df, df, "a", "a", lambda x, y: pd.DataFrame({"n": [len(x) * len(y)]}), "n long", rows_per_block=5)
    assert pairs.agg(F.sum("n")).first()[0] == 23 * 23


def test_queries_read_declared_tables():
    assert len(QUERIES) > 120


def test_registered_models_use_the_full_settings(spark, sf, monkeypatch):
    """What each query hands to its estimator, caught at fit."""
    from pyspark.ml.classification import OneVsRest, RandomForestClassifier

    from inkline.operators import booster, forest, network, term_boost, tuning
    from inkline.plans import models_q as q

    made = q.style_frame(spark, sf)
    monkeypatch.setattr(q, "style_frame", lambda spark, sf: made)

    class Seen(Exception):
        pass

    def caught(*args, **kwargs):
        raise Seen(args, kwargs)

    def call(name):
        with pytest.raises(Seen) as e:
            getattr(q, name)(spark, sf)
        return e.value.args

    for kind in (OneVsRest, RandomForestClassifier):
        monkeypatch.setattr(kind, "fit", caught)
    monkeypatch.setattr(term_boost, "fit", caught)
    (bagged, _), _ = call("bagging")
    assert (bagged.getNumTrees(), bagged.getMaxDepth()) == (50, 30)
    _, named = call("adaboost")
    assert named.get("rounds", 50) == 50
    (machine, lifted), _ = call("svm_rbf")
    assert machine.getClassifier().getMaxIter() == 50 and lifted.first()["features"].size == 256
    monkeypatch.setattr(network, "fit", caught)
    (_, shape, t), _ = call("mlp")
    assert shape.joined_layers == (64, 32, 16) and (t.epochs, t.patience, t.batch) == (500, 20, 64)
    (_, shape, t), _ = call("mlp_hybrid")
    assert shape.sparse > 100 and (shape.dense_layers, shape.sparse_layers, t.epochs) == ((64, 32), (512, 256, 128), 15)
    for owner, name in ((tuning, "tune"), (booster, "fit"), (forest, "fit")):
        monkeypatch.setattr(owner, name, caught)
    args, named = call("tune_gbt")
    assert len(args) == 6 and not named  # trials, folds and rungs stay at their defaults
    (_, _, p, patience), _ = call("gbt")
    assert (p, patience) == (booster.Params(), 50) and p.rounds == 500
    _, named = call("random_forest")
    assert not named
    _, named = call("score_batch")  # the stream fits the same scorer
    assert (named["trees"], named["depth"]) == (100, 10)


def test_silhouette_sends_no_vectors_through_an_exchange(spark):
    """Block pairs come from reading the written blocks; before, every block was copied once for each other block."""
    import numpy as np

    from inkline.operators import cluster

    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=3)], i % 4) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label int").repartition(4)
    out = cluster.silhouette_exact(df, "id", "v", "label", rows_per_block=7)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "CartesianProduct" in plan
    assert out.first()["silhouette"] == pytest.approx(cluster.silhouette_exact(df, "id", "v", "label").first()["silhouette"])
