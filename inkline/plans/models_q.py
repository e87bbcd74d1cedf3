"""Fitted models. Estimators are not SQL, so these are rows-only; tests cover their behaviour."""

from __future__ import annotations

import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import stylometry as st, text as tx
from ..operators import binned, booster, encode, forest, linear, metrics, models, network, scoring, selection as sel, split, term_boost, tfidf, tuning
from ..session import checkpoint_dir, cut
from ..sources.tables import load
from ..streaming import score_stream as ss
from .registry import query, r6, tidy
from .sqltext import r
from .select_q import SCORED_FEATURES
from .text_q import labelled, text_docs
from .tfidf_q import SPLIT_SQL, terms_sql, vocab_sql, weights_sql
from .vectors_q import vectors


def style_frame(spark, sf):
    """Scaled stylometric features of the labelled documents with an 80/20 split, written once."""
    docs = labelled(spark, sf)
    feats = {**st.basic(), **st.lexical(), **st.sentence(), **st.punctuation(), **st.char_classes()}
    data = cut(st.select_features(st.prepare(docs), ["doc_id", "label"], feats))
    parts = split.stratified(data.select("doc_id", "label"), "doc_id", "label")
    data = data.join(parts.select("doc_id", "split"), "doc_id")
    fitted = encode.fit_standard(data.filter("split = 'train'"), SCORED_FEATURES)
    return cut(models.assemble(encode.standard_scale(data, fitted), SCORED_FEATURES).select("doc_id", "label", "split", "features"))


def halves(frame):
    return frame.filter("split = 'train'"), frame.filter("split = 'test'")


def evaluate(model, test):
    return tidy(metrics.binary_metrics(models.scored(model, test, ["label"])))


@query("decision_tree")
def decision_tree(spark, sf):
    """Gini tree on the 20 features with the best chi-square score on the training rows."""
    docs = labelled(spark, sf)
    feats = {**st.basic(), **st.lexical(), **st.sentence(), **st.punctuation(), **st.char_classes()}
    data = cut(st.select_features(st.prepare(docs), ["doc_id", "label"], feats))
    data = cut(split.stratified(data, "doc_id", "label"))
    train = encode.shift_nonneg(data.filter("split = 'train'"), encode.fit_shift(data.filter("split = 'train'"), SCORED_FEATURES))
    best = [r["feature"] for r in sel.select_k_best(sel.chi2_scores(train, SCORED_FEATURES), SCORED_FEATURES, 20).collect()]
    model = models.decision_tree().fit(models.assemble(train, best))
    return tidy(models.importance_table(model, best, spark))


def array_frame(spark, sf):
    """The style frame with its features as an array column ``x``."""
    return style_frame(spark, sf).withColumn("x", models.vector_to_array("features"))


@query("random_forest")
def random_forest(spark, sf):
    train, test = halves(array_frame(spark, sf))
    model = scoring.fit_forest(train, "x", len(SCORED_FEATURES), "label", "doc_id")
    out = test.select("doc_id", "label", model.score("x").alias("s"))
    return tidy(out.select("doc_id", "label", F.col("s.leaf_share").alias("p"), (F.col("s.vote_share") > 0.5).cast("int").alias("pred"), "s.vote_share"))


@query("gbt")
def gbt(spark, sf):
    """500 rounds at most, stopped by the loss on an eighth of the training rows; metrics on the test rows."""
    train, test = halves(array_frame(spark, sf))
    model = scoring.fit_boosted(train, "x", len(SCORED_FEATURES), "label", "doc_id", eighth(F.col("doc_id")))
    return tidy(metrics.binary_metrics(test.select(F.col("label").cast("int").alias("label"), (model.probability("x") >= 0.5).cast("int").alias("pred"))))


def eighth(id_col):
    """1 for the rows of an md5 eighth."""
    return (F.conv(F.substring(F.md5(id_col.cast("string")), 1, 6), 16, 10).cast("long") % 8 == 0).cast("int")


FLAG_FEATURES = ("l_quantity", "l_discount", "l_tax")


def flag_blocks(spark, sf):
    """Lines with few distinct values per feature, so that bins are values; class 1 are the returned ones."""
    items = load(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("key"), F.array(*FLAG_FEATURES).alias("x"), (F.col("l_returnflag") == "R").cast("int").alias("label"))
    edges = binned.fit_edges(items, "x", len(FLAG_FEATURES))
    return cut(binned.pack(items, "x", "label", "key", edges)), edges


CUTS_SQL = """WITH items AS (SELECT row_number() OVER () AS rid, l_orderkey * 8 + l_linenumber AS key, l_quantity::DOUBLE AS q, l_discount::DOUBLE AS d, l_tax::DOUBLE AS t,
  (l_returnflag = 'R')::INT AS y FROM lineitem),
long AS (SELECT rid, y, unnest(['l_quantity', 'l_discount', 'l_tax']) AS feature, unnest([q, d, t]) AS x FROM items)"""


@query("boost_root_split", CUTS_SQL + f""",
base AS (SELECT sum(y)::DOUBLE / count(*) AS p FROM items),
g AS (SELECT feature, x, sum(round((p - y) * {booster.UNIT})) / {booster.UNIT} AS g, sum(round(p * (1 - p) * {booster.UNIT})) / {booster.UNIT} AS h
      FROM long, base GROUP BY feature, x),
c AS (SELECT feature, x, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(g) OVER f AS gt, sum(h) OVER f AS ht, max(x) OVER f AS top FROM g
      WINDOW w AS (PARTITION BY feature ORDER BY x), f AS (PARTITION BY feature)),
s AS (SELECT feature, x, gl, hl, gt - gl AS gr, ht - hl AS hr,
        (greatest(abs(gl) - 0.1, 0) ** 2 / (hl + 1) + greatest(abs(gt - gl) - 0.1, 0) ** 2 / (ht - hl + 1) - greatest(abs(gt) - 0.1, 0) ** 2 / (ht + 1)) / 2 - 0.1 AS gain
      FROM c WHERE x < top AND hl >= 3 AND ht - hl >= 3)
SELECT feature, round(x, 6) AS threshold, round(gain, 6) + 0.0 AS gain,
       round(-sign(gl) * greatest(abs(gl) - 0.1, 0) / (hl + 1) * 0.05, 6) + 0.0 AS left_value,
       round(-sign(gr) * greatest(abs(gr) - 0.1, 0) / (hr + 1) * 0.05, 6) + 0.0 AS right_value
FROM s QUALIFY row_number() OVER (PARTITION BY feature ORDER BY round(gain, 9) DESC, x) = 1""")
def boost_root_split(spark, sf):
    """The first split of each feature in the first round of boosting, with its Newton leaves."""
    table, edges = flag_blocks(spark, sf)
    p = booster.Params(row_share=1.0, column_share=1.0)
    return tidy(spark.createDataFrame(booster.root_splits(table, edges, p, FLAG_FEATURES), "feature string, threshold double, gain double, left_value double, right_value double"))


def forest_sql(trees: int, seed: int = 42) -> str:
    """A row's draws in a tree: a splitmix hash of key and tree, read as a uniform number, against the Poisson distribution."""
    def wrapped(x: str) -> str:
        return f"(({x}) % 18446744073709551616::UHUGEINT)::UBIGINT"

    def times(x: str, by: int) -> str:
        return wrapped(f"({x})::UHUGEINT * {by}::UHUGEINT")

    starts = [(seed * 1_000_003 + t) * 0x9E3779B97F4A7C15 % (1 << 64) for t in range(trees)]
    drawn = [f"SELECT {t} AS tree, rid, y, {wrapped(f'key::UHUGEINT + {start}::UHUGEINT')} AS z0 FROM items" for t, start in enumerate(starts)]
    cumulative = ", ".join(repr(float(c)) for c in forest.POISSON)
    return CUTS_SQL + f""",
z0 AS ({" UNION ALL ".join(drawn)}),
z1 AS (SELECT tree, rid, y, {times("xor(z0, z0 >> 30)", 0xBF58476D1CE4E5B9)} AS z FROM z0),
z2 AS (SELECT tree, rid, y, {times("xor(z, z >> 27)", 0x94D049BB133111EB)} AS z FROM z1),
w AS (SELECT tree, rid, y, len(list_filter([{cumulative}]::DOUBLE[], lambda c: c <= (xor(z, z >> 31) >> 11)::DOUBLE / 9007199254740992)) AS w FROM z2),
v AS (SELECT tree, feature, x, w.y, sum(w) AS n FROM w JOIN long USING (rid) GROUP BY ALL),
p AS (SELECT tree, feature, x, coalesce(sum(n) FILTER (y = 0), 0) AS n0, coalesce(sum(n) FILTER (y = 1), 0) AS n1 FROM v GROUP BY ALL),
c AS (SELECT tree, feature, x, (sum(n0) OVER o)::BIGINT AS left_0, (sum(n1) OVER o)::BIGINT AS left_1, (sum(n0) OVER f)::BIGINT AS all_0, (sum(n1) OVER f)::BIGINT AS all_1,
        max(x) OVER f AS top FROM p WINDOW o AS (PARTITION BY tree, feature ORDER BY x), f AS (PARTITION BY tree, feature)),
s AS (SELECT *, (left_0 ** 2 + left_1 ** 2) / (left_0 + left_1) + ((all_0 - left_0) ** 2 + (all_1 - left_1) ** 2) / (all_0 + all_1 - left_0 - left_1)
        - (all_0 ** 2 + all_1 ** 2) / (all_0 + all_1) AS gain FROM c WHERE x < top AND left_0 + left_1 >= 5 AND all_0 + all_1 - left_0 - left_1 >= 5)
SELECT tree::BIGINT AS tree, feature, round(x, 6) AS threshold, round(gain, 6) + 0.0 AS gain, left_0, left_1, all_0, all_1
FROM s QUALIFY row_number() OVER (PARTITION BY tree, feature ORDER BY round(gain, 9) DESC, x) = 1"""


@query("forest_root_split", forest_sql(4))
def forest_root_split(spark, sf):
    """The best first split of every feature in each of four trees' bootstraps, all thresholds tried."""
    table, edges = flag_blocks(spark, sf)
    rows = forest.root_splits(table, edges, 4, FLAG_FEATURES)
    return tidy(spark.createDataFrame(rows, "tree int, feature string, threshold double, gain double, left_0 long, left_1 long, all_0 long, all_1 long"))


def tfidf_frame(spark, sf, size):
    docs = labelled(spark, sf).select("doc_id", "label", tx.term_tokens(F.col("text")).alias("tokens"))
    docs = cut(docs)
    vec = models.fit_tfidf(docs, "tokens", "features", size).transform(docs)
    parts = split.random_split(docs.select("doc_id"), "doc_id", 0.2)
    return cut(vec.join(parts, "doc_id").select("doc_id", "label", "split", "features"))


@query("bagging")
def bagging(spark, sf):
    train, test = halves(tfidf_frame(spark, sf, 5000))
    return evaluate(models.bagging().fit(train), test)


@query("adaboost")
def adaboost(spark, sf):
    """50 stumps over the TF-IDF weights of 5,000 terms, fitted on four fifths of the labelled documents."""
    docs = cut(split.random_split(labelled(spark, sf), "doc_id", 0.2))
    train, test = halves(docs)
    vocab = cut(tfidf.fit_vocabulary(tfidf.term_frequencies(train, "doc_id", "text", tfidf.PLAIN_5000), train.count(), tfidf.PLAIN_5000))
    weights = cut(tfidf.weigh(tfidf.term_frequencies(docs, "doc_id", "text", tfidf.PLAIN_5000, ("split",)), vocab, "doc_id", tfidf.PLAIN_5000))
    model = term_boost.fit(weights, train.select("doc_id", "label"), "doc_id")
    return tidy(metrics.binary_metrics(term_boost.predict(weights, test.select("doc_id", "label"), model, "doc_id")))


def flag_frame(spark, sf, scale_price=True):
    """Return flag as class code, scaled numbers and one-hot line status."""
    num = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    items = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *num, "l_returnflag", "l_linestatus")
    items = encode.one_hot(encode.label_encode(items, "l_returnflag", "label"), "l_linestatus")
    cols = [*num, *[c for c in items.columns if c.startswith("l_linestatus_")]]
    scaled = [c for c in cols if scale_price or c != "l_extendedprice"]
    return encode.standard_scale(items, encode.fit_standard(items, scaled)), cols


@query("logistic_regression")
def logistic_regression(spark, sf):
    """Fitted on four fifths of the lines, reported on the others."""
    items, cols = flag_frame(spark, sf)
    parts = split.random_split(items.withColumn("_id", F.col("l_orderkey") * 8 + F.col("l_linenumber")), "_id", 0.2)
    data = cut(models.assemble(parts, cols).select(F.col("label").cast("double").alias("label"), "split", "features"))
    train, test = halves(data)
    model = models.logistic(train.count()).fit(train)
    out = model.transform(test).select(F.col("label").cast("int").alias("label"), F.col("prediction").cast("int").alias("pred"))
    return tidy(metrics.classification_report(out))


@query("linear_regression")
def linear_regression(spark, sf):
    """Price on scaled numbers and one-hot status, fitted on four fifths of the lines, scored on the others."""
    items, cols = flag_frame(spark, sf, scale_price=False)
    cols = [c for c in cols if c != "l_extendedprice"]
    data = cut(split.random_split(items.withColumn("_id", F.col("l_orderkey") * 8 + F.col("l_linenumber")), "_id", 0.2))
    train, test = halves(data)
    fitted = linear.least_squares(train, cols, "l_extendedprice")
    return tidy(metrics.regression_metrics(linear.predict_linear(test, cols, *fitted).select(F.col("l_extendedprice").alias("y"), "yhat")))


@query("least_squares_fit", f"""WITH o AS (SELECT o_totalprice::DOUBLE AS y, o_custkey::DOUBLE AS a, date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::DOUBLE AS b, o_orderkey,
  row_number() OVER (ORDER BY md5(o_orderkey::VARCHAR), o_orderkey) AS rn, count(*) OVER () AS n FROM orders),
tr AS (SELECT * FROM o WHERE rn > round_even(n * 0.2, 0)),
s AS (SELECT var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS by_, avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM tr),
k AS (SELECT (ay * bb - by_ * ab) / (aa * bb - ab * ab) AS ca, (by_ * aa - ay * ab) / (aa * bb - ab * ab) AS cb, * FROM s),
e AS (SELECT y, my - ca * ma - cb * mb + ca * a + cb * b AS yhat FROM o, k WHERE rn <= round_even(n * 0.2, 0))
SELECT {r('any_value(ca)', 4)} AS coef_customer, {r('any_value(cb)', 4)} AS coef_day, {r('any_value(my - ca * ma - cb * mb)', 2)} AS intercept,
  (SELECT {r('avg((y - yhat) ** 2)', 0)} FROM e) AS mse FROM k""")
def least_squares_fit(spark, sf):
    """Coefficients of two features and the squared error on held-out orders."""
    orders = load(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").cast("double").alias("y"), F.col("o_custkey").cast("double").alias("a"),
                                              F.unix_date(F.to_date("o_orderdate")).cast("double").alias("b"))
    train, test = halves(split.random_split(orders, "o_orderkey", 0.2))
    intercept, (ca, cb) = linear.least_squares(train, ["a", "b"], "y")
    mse = linear.predict_linear(test, ["a", "b"], intercept, [ca, cb]).agg(F.avg((F.col("y") - F.col("yhat")) ** 2)).first()[0]
    row = spark.createDataFrame([(ca, cb, intercept, mse)], "coef_customer double, coef_day double, intercept double, mse double")
    return row.select(*[r6(F.col(c), k).alias(c) for c, k in (("coef_customer", 4), ("coef_day", 4), ("intercept", 2), ("mse", 0))])


@query("svm_rbf")
def svm_rbf(spark, sf):
    parts = split.random_split(vectors(spark, sf), "vec_id", 0.2)
    gamma = models.gamma_scale(parts, "v", 64)
    lifted = cut(models.rbf_features(parts, "v", "features", 64, gamma).select("label", "split", "features"))
    train, test = halves(lifted)
    model = models.rbf_svm(train.count()).fit(train)
    out = model.transform(test).select("label", F.col("prediction").cast("int").alias("pred"))
    return tidy(metrics.classification_report(out))


def vector_frame(spark, sf):
    cols = [f"v{i}" for i in range(64)]
    wide = vectors(spark, sf).select("vec_id", "label", *[F.col("v")[i].alias(n) for i, n in enumerate(cols)])
    scaled = encode.standard_scale(wide, encode.fit_standard(wide, cols))
    return models.assemble(scaled, cols).cache(), cols


@query("kmeans")
def kmeans(spark, sf):
    data, _ = vector_frame(spark, sf)
    model = models.kmeans(3).fit(data)
    return tidy(model.transform(data).groupBy(F.col("prediction").alias("cluster")).agg(
        F.count("*").alias("n"), F.lit(float(model.summary.trainingCost)).alias("inertia")))


@query("kmeans_elbow")
def kmeans_elbow(spark, sf):
    data, cols = vector_frame(spark, sf)
    return tidy(models.elbow(data, cols))


@query("silhouette")
def silhouette(spark, sf):
    data, _ = vector_frame(spark, sf)
    clustered = models.kmeans(3).fit(data).transform(data)
    value = models.squared_silhouette(clustered)
    return tidy(clustered.groupBy(F.col("prediction").alias("cluster")).agg(F.count("*").alias("n"), F.lit(value).alias("silhouette")))


@query("mlp")
def mlp(spark, sf):
    """64, 32 and 16 units over the scaled style features, classes weighted, stopped by the loss on an eighth of the training rows."""
    train, test = halves(array_frame(spark, sf))
    shape = network.Shape(len(SCORED_FEATURES))
    table = network.written(train, shape, "x", "label", "doc_id", eighth(F.col("doc_id")))
    model = network.fit(table, shape, network.Training(weights=network.balanced(train, "label")))
    return tidy(metrics.binary_metrics(test.select("label", (model.probability("x") > 0.5).cast("int").alias("pred"))))


def hybrid_frame(spark, sf):
    """(doc_id, label, split, x, indices, values): scaled style features, and the TF-IDF weights of the training vocabulary as a sparse row; and its size."""
    style = array_frame(spark, sf).select("doc_id", "label", "split", "x")
    docs = cut(labelled(spark, sf).select("doc_id", "text").join(style.select("doc_id", "split"), "doc_id"))
    terms = cut(tfidf.term_frequencies(docs, "doc_id", "text", tfidf.HYBRID_10000, ("split",)))
    vocab = tfidf.fit_vocabulary(terms.filter("split = 'train'"), docs.filter("split = 'train'").count(), tfidf.HYBRID_10000)
    place = F.row_number().over(W.partitionBy(F.lit(0)).orderBy("term")) - 1  # at most 10,000 terms
    vocab = cut(vocab.withColumn("place", place))
    weights = tfidf.weigh(terms, vocab, "doc_id", tfidf.HYBRID_10000).join(vocab.select("term", "place"), "term")
    rows = weights.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("place", "weight"))).alias("e"))
    rows = rows.select("doc_id", F.transform("e", lambda e: e["place"]).alias("indices"), F.transform("e", lambda e: e["weight"]).alias("values"))
    return cut(style.join(rows, "doc_id", "left")), vocab.count()


@query("hybrid_vector", f"""WITH {SPLIT_SQL}, {terms_sql('t', 'train', tfidf.HYBRID_10000)}, {vocab_sql('vo', 't', 'train', tfidf.HYBRID_10000)},
{terms_sql('ta', 'ld', tfidf.HYBRID_10000)}, {weights_sql('we', 'ta', 'vo', tfidf.HYBRID_10000)},
pl AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS place FROM vo)
SELECT ld.doc_id, count(term) AS n_terms, (SELECT count(*) FROM vo) + {len(SCORED_FEATURES)} AS size, {r('coalesce(sum(weight), 0)', 5)} AS weight_sum,
  coalesce(sum(place), 0)::BIGINT AS place_sum FROM ld LEFT JOIN we USING (doc_id) LEFT JOIN pl USING (term) GROUP BY ld.doc_id""")
def hybrid_vector(spark, sf):
    """What the hybrid vector of each document holds: its size, its TF-IDF entries, their sum and the sum of their places."""
    frame, terms = hybrid_frame(spark, sf)
    some = F.coalesce(F.col("indices"), F.array().cast("array<int>"))
    add = lambda name, zero: F.aggregate(F.coalesce(F.col(name), F.array().cast(f"array<{zero}>")), F.lit(0).cast(zero), lambda a, v: a + v)
    return frame.select("doc_id", F.size(some).cast("long").alias("n_terms"), (F.lit(terms) + F.size("x")).cast("long").alias("size"),
                        r6(add("values", "double"), 5).alias("weight_sum"), F.aggregate(some, F.lit(0).cast("long"), lambda a, v: a + v).alias("place_sum"))


HYBRID = network.Training(rate=0.001, epochs=15, patience=3, l2=0.0, plateau=2)  # fixed values: training of the two-branch network


@query("mlp_hybrid")
def mlp_hybrid(spark, sf):
    """Two branches, 512-256-128 over the TF-IDF weights and 64-32 over the style features, joined by 128 and 64 units."""
    frame, terms = hybrid_frame(spark, sf)
    train, test = halves(frame)
    shape = network.Shape(len(SCORED_FEATURES), terms, (64, 32), (512, 256, 128), (128, 64))
    table = network.written(train, shape, "x", "label", "doc_id", eighth(F.col("doc_id")), "indices", "values")
    model = network.fit(table, shape, HYBRID)
    pred = (model.probability("x", "indices", "values") > 0.5).cast("int")
    return tidy(metrics.binary_metrics(test.select("label", pred.alias("pred"))))


@query("tune_gbt")
def tune_gbt(spark, sf):
    """25 trials on 3 folds; ``stopped_at`` is the rung that ended a trial, 0 if none did."""
    train, _ = halves(array_frame(spark, sf))
    folds = split.k_folds(train.select("doc_id", "label"), "doc_id", "label", 3).select("doc_id", "fold")
    data = cut(train.join(folds, "doc_id"))
    _, trials = tuning.tune(data, "x", len(SCORED_FEATURES), "label", "doc_id", "fold")
    rows = [(t["trial"], t["depth"], t["rate"], t["rounds"], t["best_rounds"], t["stopped_at"] or 0, t["mcc"]) for t in trials]
    return tidy(spark.createDataFrame(rows, "trial int, max_depth int, step_size double, rounds int, best_rounds int, stopped_at int, mcc double"))


def full_scorer(spark, sf):
    return scoring.fit_scorer(labelled(spark, sf))


@query("score_batch")
def score_batch(spark, sf):
    scorer, _ = full_scorer(spark, sf)
    return tidy(scorer.transform(text_docs(spark, sf)))


@query("score_stream")
def score_stream(spark, sf):
    """All documents arrive as files, are scored by one availableNow run and read back."""
    scorer, _ = full_scorer(spark, sf)
    base = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    text_docs(spark, sf).write.parquet(f"{base}/in")
    ss.score_stream(ss.text_stream(spark, f"{base}/in"), scorer, f"{base}/out", f"{base}/state").awaitTermination()
    return tidy(spark.read.parquet(f"{base}/out"))
