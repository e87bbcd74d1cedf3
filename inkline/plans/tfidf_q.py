"""TF-IDF and naive Bayes over the whole documents table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import naive_bayes as nb, split, tfidf as tf
from ..session import cut
from ..sources.tables import load, spread
from .registry import query, tidy
from .sqltext import big, r, words_list
from .text_q import LABELLED, documents, labelled, text_docs


def terms_sql(name: str, source: str, v: tf.Vectoriser) -> str:
    toks = f"regexp_extract_all(lower(text), '{tx.TERM}')"
    if v.stopwords:
        toks = f"list_filter({toks}, lambda x: x NOT IN {words_list(v.stopwords)})"
    a = "a"
    if v.bigrams:
        a = "list_concat(a, list_transform(range(1, len(a)), lambda i: a[i] || ' ' || a[i+1]))"
    return f"""{name} AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({a}) AS term
  FROM (SELECT doc_id, {toks} AS a FROM {source})) GROUP BY doc_id, term)"""


def vocab_sql(name: str, terms: str, source: str, v: tf.Vectoriser) -> str:
    n = f"(SELECT count(*) FROM {source})"
    limit = f"ORDER BY cf DESC, term LIMIT {v.max_features}" if v.max_features else ""
    return f"""{name} AS (SELECT term, df, cf, ln((1.0::double + {n}) / (1.0::double + df)) + 1.0 AS idf FROM (
  SELECT term, count(*) AS df, sum(tf)::bigint AS cf FROM {terms} GROUP BY term)
  WHERE df >= {v.min_df} AND df <= {v.max_df}::double * {n} {limit})"""


def weights_sql(name: str, terms: str, vocab: str, v: tf.Vectoriser) -> str:
    w = "ln(tf) + 1.0" if v.sublinear else "tf"
    return f"""{name} AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM (
  SELECT doc_id, term, ({w})::double * idf AS w FROM {terms} JOIN {vocab} USING (term)))"""


def full_sql(v: tf.Vectoriser) -> str:
    return (f"WITH {terms_sql('t', 'documents', v)}, {vocab_sql('vo', 't', 'documents', v)}, {weights_sql('we', 't', 'vo', v)} "
            f"SELECT doc_id, term, {r('weight')} AS weight FROM we")


def full(spark, sf, v):
    return tidy(tf.fit_transform(text_docs(spark, sf), "doc_id", "text", v))


@query("tfidf", full_sql(tf.PLAIN_5000))
def tfidf(spark, sf):
    return full(spark, sf, tf.PLAIN_5000)


@query("tfidf_topk_vocab", f"""WITH {terms_sql('t', 'documents', tf.PLAIN_5000)}, {vocab_sql('vo', 't', 'documents', tf.PLAIN_5000)}
SELECT term, df, cf, {r('idf')} AS idf FROM vo""")
def tfidf_topk_vocab(spark, sf):
    docs = text_docs(spark, sf)
    return tidy(tf.fit_vocabulary(tf.term_frequencies(docs, "doc_id", "text"), docs.count(), tf.PLAIN_5000))


@query("tfidf_ngrams", full_sql(tf.BAYES_10000))
def tfidf_ngrams(spark, sf):
    return full(spark, sf, tf.BAYES_10000)


UNCAPPED = tf.Vectoriser(min_df=2, max_df=0.95)


@query("tfidf_df_filter", full_sql(UNCAPPED))
def tfidf_df_filter(spark, sf):
    return full(spark, sf, UNCAPPED)


@query("tfidf_sublinear", full_sql(tf.HYBRID_10000))
def tfidf_sublinear(spark, sf):
    return full(spark, sf, tf.HYBRID_10000)


SPLIT_SQL = f"""ld AS ({LABELLED}), rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(doc_id::varchar), doc_id) AS rn,
  count(*) OVER (PARTITION BY label) AS nc FROM ld),
train AS (SELECT doc_id, text, label FROM rk WHERE rn > greatest(1, round_even(nc * 0.2::double, 0))),
test AS (SELECT doc_id, text, label FROM rk WHERE rn <= greatest(1, round_even(nc * 0.2::double, 0)))"""


def train_test(spark, sf):
    """Stratified 80/20 of the labelled documents; the split ranks ids and labels, not texts."""
    labels = load(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = labelled(spark, sf).drop("label")
    parts = split.stratified(labels, "doc_id", "label")
    joined = docs.join(parts, "doc_id")
    return tuple(joined.filter(F.col("split") == k).drop("split") for k in ("train", "test"))


@query("tfidf_transform", f"""WITH {SPLIT_SQL}, {terms_sql('t', 'train', tf.HYBRID_10000)}, {vocab_sql('vo', 't', 'train', tf.HYBRID_10000)},
{terms_sql('tt', 'test', tf.HYBRID_10000)}, {weights_sql('we', 'tt', 'vo', tf.HYBRID_10000)} SELECT doc_id, term, {r('weight')} AS weight FROM we""")
def tfidf_transform(spark, sf):
    train, test = train_test(spark, sf)
    return tidy(tf.transform(train, test, "doc_id", "text", tf.HYBRID_10000))


V = tf.BAYES_10000
NB_SQL = f"""{SPLIT_SQL}, {terms_sql('t', 'train', V)}, {vocab_sql('vo', 't', 'train', V)}, {weights_sql('we', 't', 'vo', V)},
sums AS (SELECT vo.term, coalesce(sum(CASE WHEN label = 0 THEN weight END), 0) AS s0, coalesce(sum(CASE WHEN label = 1 THEN weight END), 0) AS s1
  FROM vo LEFT JOIN we ON we.term = vo.term LEFT JOIN train ON train.doc_id = we.doc_id GROUP BY vo.term),
model AS (SELECT term, ln((s0 + 1) / (SELECT sum(s0) + count(*) FROM sums)) AS theta_0, ln((s1 + 1) / (SELECT sum(s1) + count(*) FROM sums)) AS theta_1 FROM sums),
prior AS (SELECT ln(count(*) FILTER (label = 0) / count(*)::double) AS b0, ln(count(*) FILTER (label = 1) / count(*)::double) AS b1 FROM train)"""


def nb_parts(spark, sf):
    """Split, term table (written once, read by vocabulary, weights and scoring), vocabulary and model."""
    labels = load(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    parts = cut(split.stratified(labels.join(documents(spark, sf).select("doc_id"), "doc_id"), "doc_id", "label"))
    docs = spread(documents(spark, sf).select("doc_id", "text"), "doc_id").join(parts.select("doc_id", "split"), "doc_id")
    terms = cut(tf.term_frequencies(docs, "doc_id", "text", V, ("split",)))
    train_terms, test_terms = (terms.filter(F.col("split") == k).drop("split") for k in ("train", "test"))
    train, test = (parts.filter(F.col("split") == k).select("doc_id", "label") for k in ("train", "test"))
    vocab = cut(tf.fit_vocabulary(train_terms, train.count(), V))
    model = nb.fit(tf.weigh(train_terms, vocab, "doc_id", V), train, vocab, "doc_id", [0, 1])
    return train, test, test_terms, vocab, model


@query("naive_bayes_fit", f"WITH {NB_SQL} SELECT term, {r('theta_0')} AS theta_0, {r('theta_1')} AS theta_1 FROM model")
def naive_bayes_fit(spark, sf):
    model = nb_parts(spark, sf)[4]
    return tidy(model.select("term", F.col("theta")[0].alias("theta_0"), F.col("theta")[1].alias("theta_1")))


@query("naive_bayes_score", f"""WITH {NB_SQL}, {terms_sql('tt', 'test', V)}, {weights_sql('wt', 'tt', 'vo', V)},
j AS (SELECT test.doc_id, coalesce(sum(weight * theta_0), 0) + any_value(b0) AS j0, coalesce(sum(weight * theta_1), 0) + any_value(b1) AS j1
  FROM test CROSS JOIN prior LEFT JOIN wt ON wt.doc_id = test.doc_id LEFT JOIN model ON model.term = wt.term GROUP BY test.doc_id),
p AS (SELECT doc_id, exp(j0 - greatest(j0, j1)) AS e0, exp(j1 - greatest(j0, j1)) AS e1 FROM j)
SELECT doc_id, (CASE WHEN e1 > e0 THEN 1 ELSE 0 END)::bigint AS pred, CASE WHEN e1 > e0 THEN 'AI Generated' ELSE 'Human Written' END AS class_name,
{r('greatest(e0, e1) / (e0 + e1)', 5)} AS confidence, {r('e0 / (e0 + e1)', 5)} AS p_0, {r('e1 / (e0 + e1)', 5)} AS p_1 FROM p""")
def naive_bayes_score(spark, sf):
    train, test, test_terms, vocab, model = nb_parts(spark, sf)
    weights = tf.weigh(test_terms, vocab, "doc_id", V)
    out = nb.score(test, weights, model, nb.priors(train, [0, 1]), "doc_id", [0, 1], V.max_features)
    name = F.when(F.col("pred") == 1, "AI Generated").otherwise("Human Written")
    return tidy(out.withColumn("class_name", name), 5)
