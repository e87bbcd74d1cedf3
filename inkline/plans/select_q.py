"""Encoding, scaling and feature-scoring queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import stylometry as st
from ..operators import encode, selection as sel
from ..sources.tables import load, spread
from . import features_q as fq
from .registry import query, tidy
from .sqltext import BASE, big, exact, freq_cte, r

# categorical view of lineitem; both engines read the same expressions
CAT = {
    "qty": "CASE WHEN l_quantity <= 17 THEN 'LOW' WHEN l_quantity <= 34 THEN 'MEDIUM' ELSE 'HIGH' END",
    "price": "CASE WHEN l_extendedprice <= 20000 THEN 'LOW' WHEN l_extendedprice <= 50000 THEN 'MEDIUM' ELSE 'HIGH' END",
    "disc": "CASE WHEN l_tax = 0 THEN NULL WHEN l_discount <= 0.03 THEN 'LOW' WHEN l_discount <= 0.07 THEN 'MEDIUM' ELSE 'HIGH' END",
    "status": "l_linestatus",
}
CATS = list(CAT)
CAT_SQL = ("cat AS (SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, "
           + ", ".join(f"{e} AS {k}" for k, e in CAT.items()) + ", l_returnflag AS label FROM lineitem)")
FULL_SQL = CAT_SQL + """,
full_cat AS (SELECT l_orderkey, l_linenumber, qty, price, coalesce(disc, 'NONE') AS disc, status, label FROM cat)"""


def cat(spark, sf):
    return load(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "cast(l_linenumber as bigint) as l_linenumber", *[f"{e} as {k}" for k, e in CAT.items()],
        "l_returnflag as label")


def full_cat(spark, sf):
    return cat(spark, sf).withColumn("disc", F.coalesce("disc", F.lit("NONE")))


def unpivot_sql(source: str, features=CATS, keys: str = "", cast: str = "") -> str:
    return " UNION ALL ".join(f"SELECT {keys}'{f}' AS feature, {f}{cast} AS value, label FROM {source}" for f in features)


# --- encoding -----------------------------------------------------------------
@query("label_encode", "SELECT c_custkey, c_mktsegment, (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::bigint AS code FROM customer")
def label_encode(spark, sf):
    return tidy(encode.label_encode(load(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_mktsegment", "code"))


@query("one_hot", """SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, (l_returnflag = 'N')::bigint AS "l_returnflag_N",
(l_returnflag = 'R')::bigint AS "l_returnflag_R" FROM lineitem""")
def one_hot(spark, sf):
    return tidy(encode.one_hot(load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"), "l_returnflag"))


NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def numbers(spark, sf):
    return load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *NUM)


def scale_sql(expr: str) -> str:
    return "SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, " + ", ".join(
        f"{r(expr.format(c=c))} AS {c}" for c in NUM) + " FROM lineitem"


@query("standard_scale", scale_sql("({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem)"))
def standard_scale(spark, sf):
    df = numbers(spark, sf)
    return tidy(encode.standard_scale(df, encode.fit_standard(df, NUM)))


@query("minmax_scale", scale_sql("({c} - (SELECT min({c}) FROM lineitem)) / (SELECT max({c}) - min({c}) FROM lineitem)"))
def minmax_scale(spark, sf):
    df = numbers(spark, sf)
    return tidy(encode.minmax_scale(df, encode.fit_minmax(df, NUM)))


SHIFT = "(SELECT min(c_acctbal) FROM customer)"


@query("shift_nonneg", f"""SELECT c_custkey, {r(f'CASE WHEN {SHIFT} < 0 THEN c_acctbal + (abs({SHIFT}) + 1e-9) ELSE c_acctbal END')}
AS c_acctbal FROM customer""")
def shift_nonneg(spark, sf):
    df = load(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return tidy(encode.shift_nonneg(df, encode.fit_shift(df, ["c_acctbal"])))


@query("class_weights", f"""WITH c AS (SELECT quality AS label, count(*) AS n FROM labels GROUP BY 1)
SELECT label::bigint AS label, n, {r('sum(n) OVER () / (count(*) OVER () * n)')} AS weight,
(max(n) OVER () - min(n) OVER () > 0.1 * sum(n) OVER ()) AS imbalanced FROM c""")
def class_weights(spark, sf):
    return tidy(encode.class_weights(load(spark, sf, "labels"), "quality"))


# --- impurity and gain ------------------------------------------------------------
@query("label_entropy", f"WITH {CAT_SQL} SELECT {r('entropy(label)')} AS entropy, count(*) AS n FROM cat")
def label_entropy(spark, sf):
    return tidy(sel.label_entropy(cat(spark, sf)))


@query("gini_impurity", f"""WITH {CAT_SQL}, c AS (SELECT count(*)::double AS n FROM cat GROUP BY label)
SELECT {r('1 - sum((n / (SELECT count(*) FROM cat)) ** 2)')} AS gini, {big('sum(n)')} AS n FROM c""")
def gini_impurity(spark, sf):
    return tidy(sel.gini_impurity(cat(spark, sf)))


@query("info_gain", f"""WITH {FULL_SQL}, u AS ({unpivot_sql('full_cat')}),
v AS (SELECT feature, value, entropy(label) AS h, count(*) AS n FROM u GROUP BY 1, 2)
SELECT feature, {r('(SELECT entropy(label) FROM cat) - sum(n * h) / sum(n)')} AS gain FROM v GROUP BY feature""")
def info_gain(spark, sf):
    return tidy(sel.gain_table(sel.value_class_counts(full_cat(spark, sf), CATS)).select("feature", "gain"))


GAIN_CTE = f"""{CAT_SQL}, u AS ({unpivot_sql('cat')}),
t AS (SELECT feature, count(*) AS total, count(value) AS k FROM u GROUP BY 1),
h AS (SELECT feature, entropy(label) AS h, entropy(value) AS hv FROM u WHERE value IS NOT NULL GROUP BY 1),
v AS (SELECT feature, sum(n * h) / sum(n) AS cond FROM (SELECT feature, value, entropy(label) AS h, count(*) AS n FROM u
  WHERE value IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
g AS (SELECT feature, k::double / total * (h - cond) AS gain,
  hv + CASE WHEN k < total THEN -(1 - k::double / total) * log2(1 - k::double / total) ELSE 0 END AS split_info
  FROM t JOIN h USING (feature) JOIN v USING (feature)),
gr AS (SELECT feature, gain, split_info, CASE WHEN split_info > 0 THEN gain / split_info ELSE 0 END AS gain_ratio FROM g)"""


@query("gain_ratio", f"""WITH {GAIN_CTE} SELECT feature, {r('gain')} AS gain, {r('split_info')} AS split_info,
{r('gain_ratio')} AS gain_ratio FROM gr""")
def gain_ratio(spark, sf):
    return tidy(sel.gain_table(sel.value_class_counts(cat(spark, sf), CATS)))


@query("best_feature_c45", f"""WITH {GAIN_CTE} SELECT feature, {r('gain')} AS gain, {r('split_info')} AS split_info,
{r('gain_ratio')} AS gain_ratio FROM gr WHERE gain >= (SELECT avg(gain) FROM gr) ORDER BY gain_ratio DESC LIMIT 1""")
def best_feature_c45(spark, sf):
    return tidy(sel.best_by_gain_ratio(sel.gain_table(sel.value_class_counts(cat(spark, sf), CATS)), CATS))


@query("gini_vs_entropy", f"""WITH {CAT_SQL}, u AS ({unpivot_sql('cat')}),
c AS (SELECT feature, value, label, count(*)::double AS w FROM u WHERE value IS NOT NULL GROUP BY ALL),
v AS (SELECT feature, value, sum(w) AS n, 1 - sum(w * w) / (sum(w) * sum(w)) AS g FROM c GROUP BY 1, 2),
e AS (SELECT feature, value, entropy(label) AS h FROM u WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT feature, {r('sum(n * g) / sum(n)')} AS gini, {r('sum(n * h) / sum(n)')} AS entropy FROM v JOIN e USING (feature, value) GROUP BY 1""")
def gini_vs_entropy(spark, sf):
    return tidy(sel.gini_vs_entropy(sel.value_class_counts(cat(spark, sf), CATS)))


@query("feature_class_counts", f"""WITH {CAT_SQL}, u AS ({unpivot_sql('cat')})
SELECT feature, value, label, count(*) AS n FROM u WHERE value IS NOT NULL GROUP BY ALL""")
def feature_class_counts(spark, sf):
    return tidy(sel.feature_class_counts(cat(spark, sf), CATS))


PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@query("numeric_detect", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, bool_and(try_cast({c}::varchar AS double) IS NOT NULL) AS is_numeric FROM part WHERE {c} IS NOT NULL"
    for c in PART_COLUMNS))
def numeric_detect(spark, sf):
    return sel.numeric_columns(load(spark, sf, "part").select(*PART_COLUMNS))


# --- binary splits ---------------------------------------------------------------
MIXED_NUM = ["l_quantity", "l_discount", "l_extendedprice"]
CLASSES = ["A", "N", "R"]


def mixed(spark, sf):
    return load(spark, sf, "lineitem").select(*MIXED_NUM, F.col("l_linestatus").alias("status"), F.col("l_returnflag").alias("label"))


def gini_sql(side: str) -> str:
    return f"(1 - ({side}a * {side}a + {side}n * {side}n + {side}r * {side}r) / (({side}a + {side}n + {side}r) ** 2))"


SPLIT_SQL = "WITH nu AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {f} AS v, l_returnflag AS label FROM lineitem" for f in MIXED_NUM) + f"""),
agg AS (SELECT feature, v, count(*) FILTER (label = 'A')::double AS a, count(*) FILTER (label = 'N')::double AS n,
  count(*) FILTER (label = 'R')::double AS r FROM nu GROUP BY 1, 2),
cum AS (SELECT feature, (v + lead(v) OVER w) / 2 AS threshold, NULL::varchar AS value, sum(a) OVER w AS la, sum(n) OVER w AS ln, sum(r) OVER w AS lr,
  sum(a) OVER (PARTITION BY feature) - sum(a) OVER w AS ra, sum(n) OVER (PARTITION BY feature) - sum(n) OVER w AS rn,
  sum(r) OVER (PARTITION BY feature) - sum(r) OVER w AS rr FROM agg WINDOW w AS (PARTITION BY feature ORDER BY v)),
ca AS (SELECT l_linestatus AS value, count(*) FILTER (l_returnflag = 'A')::double AS a, count(*) FILTER (l_returnflag = 'N')::double AS n,
  count(*) FILTER (l_returnflag = 'R')::double AS r FROM lineitem GROUP BY 1),
alls AS (SELECT feature, threshold, value, la, ln, lr, ra, rn, rr FROM cum WHERE threshold IS NOT NULL
  UNION ALL SELECT 'status', NULL, value, a, n, r, sum(a) OVER () - a, sum(n) OVER () - n, sum(r) OVER () - r FROM ca),
sc AS (SELECT feature, threshold, value, la + ln + lr AS n_left, ra + rn + rr AS n_right,
  round(((la + ln + lr) * {gini_sql('l')} + (ra + rn + rr) * {gini_sql('r')}) / (la + ln + lr + ra + rn + rr), 12) AS gini FROM alls),
bs AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY gini, threshold, value) AS k FROM sc WHERE n_left > 0 AND n_right > 0)
"""


@query("best_binary_split", SPLIT_SQL + f"""SELECT feature, {r('threshold')} AS threshold, value, {r('gini')} AS gini,
{r('n_left')} AS n_left, {r('n_right')} AS n_right FROM bs WHERE k = 1""")
def best_binary_split(spark, sf):
    return tidy(sel.best_split_per_feature(sel.split_candidates(mixed(spark, sf), MIXED_NUM, ["status"], CLASSES)))


# --- scores over stylometric features ------------------------------------------------
SCORE_SQL = {**fq.SQL_BASIC, **fq.SQL_LEXICAL, **fq.SQL_SENTENCE, **fq.SQL_PUNCT, **fq.SQL_CHARCLASS}
SCORED_FEATURES = list(SCORE_SQL)
STYLE_SQL = f"""{BASE}{',' + freq_cte('w', 'lwords')}{',' + freq_cte('a', 'atoks')}{fq.SENT_CTE},
style AS (SELECT l.quality AS label, {', '.join(f'{exact(e)} AS {k}' for k, e in SCORE_SQL.items())}
  FROM toks t JOIN labels l ON l.doc_id = t.doc_id {fq.left('w', 'a', 'sl')})"""


def style(spark, sf):
    """Labelled documents with the scored features; the labels prune the texts before featurising."""
    labels = load(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = spread(load(spark, sf, "documents").select("doc_id", "text"), "doc_id").join(labels, "doc_id")
    feats = {**st.basic(), **st.lexical(), **st.sentence(), **st.punctuation(), **st.char_classes()}
    return st.select_features(st.prepare(docs), ["label"], feats)


def chi_long(features) -> str:
    return " UNION ALL ".join(f"SELECT '{f}' AS feature, label, count(*) AS nc, sum({f}::double) AS o FROM style GROUP BY label" for f in features)


CHI_CTE = f"""{STYLE_SQL}, o AS ({chi_long(SCORED_FEATURES)}),
e AS (SELECT *, nc::double / (SELECT count(*) FROM style) * sum(o) OVER (PARTITION BY feature) AS e FROM o),
chi AS (SELECT feature, coalesce(sum((o - e) * (o - e) / nullif(e, 0)), 0) AS score FROM e GROUP BY feature)"""


def chi(spark, sf):
    return sel.chi2_scores(style(spark, sf), SCORED_FEATURES)


@query("chi2_scores", f"WITH {CHI_CTE} SELECT feature, {r('score', 4)} AS score FROM chi")
def chi2_scores(spark, sf):
    return tidy(chi(spark, sf), 4)


@query("select_k_best", f"""WITH {CHI_CTE}, p AS (SELECT feature, score, list_position({SCORED_FEATURES}, feature) AS position FROM chi),
k AS (SELECT *, row_number() OVER (ORDER BY score DESC, position) AS rank FROM p)
SELECT feature, position::bigint AS position, rank, {r('score', 4)} AS score FROM k WHERE rank <= 20""")
def select_k_best(spark, sf):
    return tidy(sel.select_k_best(chi(spark, sf), SCORED_FEATURES, 20), 4)


@query("top_features", f"WITH {CHI_CTE} SELECT feature, {r('score', 4)} AS score FROM chi ORDER BY chi.score DESC, feature LIMIT 10")
def top_features(spark, sf):
    return tidy(sel.top_features(chi(spark, sf), 10), 4)


@query("mutual_info_binned", f"""WITH {STYLE_SQL}, u AS ({' UNION ALL '.join(
    f"SELECT '{f}' AS feature, {f}::double AS v, label FROM style" for f in SCORED_FEATURES)}),
b AS (SELECT feature, label, least(floor((rank() OVER (PARTITION BY feature ORDER BY v) - 1) * 10 / count(*) OVER (PARTITION BY feature)), 9) AS bin FROM u),
j AS (SELECT feature, bin, label, count(*)::double AS nxy FROM b GROUP BY ALL),
m AS (SELECT feature, nxy, sum(nxy) OVER (PARTITION BY feature, bin) AS nx, sum(nxy) OVER (PARTITION BY feature, label) AS ny,
  sum(nxy) OVER (PARTITION BY feature) AS n FROM j)
SELECT feature, {r('sum(nxy / n * ln(nxy * n / (nx * ny)))')} AS score FROM m GROUP BY feature""")
def mutual_info_binned(spark, sf):
    return tidy(sel.binned_mutual_information(style(spark, sf), SCORED_FEATURES))
