"""Evaluation tables over a deterministic score table derived from ``orders``."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import curves, ensemble, metrics
from ..sources.tables import load
from .registry import query, tidy
from .sqltext import big, r

LABEL = "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END"


def _u_spark(salt: str) -> str:
    return f"cast(conv(substr(md5(concat(cast(o_orderkey as string), '{salt}')), 1, 6), 16, 10) as double) / 16777216D"


def _u_duck(salt: str) -> str:
    return f"('0x' || substr(md5(o_orderkey::varchar || '{salt}'), 1, 6))::bigint::double / 16777216::double"


def scored(spark, sf):
    """(id, label, p1, p2, pred): two model scores with many ties, correlated with the label."""
    base = load(spark, sf, "orders").selectExpr(
        "o_orderkey as id", f"{LABEL} as label", f"{_u_spark('a')} as ua", f"{_u_spark('b')} as ub")
    return base.selectExpr(
        "id", "label", "floor((0.3D * label + 0.7D * ua) * 10000D) / 10000D as p1",
        "floor((0.4D * label + 0.6D * ub) * 10000D) / 10000D as p2").withColumn("pred", F.when(F.col("p1") >= 0.5, 1).otherwise(0))


SCORED = f"""base AS (SELECT o_orderkey AS id, {LABEL} AS label, {_u_duck('a')} AS ua, {_u_duck('b')} AS ub FROM orders),
sc0 AS (SELECT id, label, floor((0.3::double * label + 0.7::double * ua) * 10000::double) / 10000::double AS p1,
  floor((0.4::double * label + 0.6::double * ub) * 10000::double) / 10000::double AS p2 FROM base),
sc AS (SELECT *, CASE WHEN p1 >= 0.5 THEN 1 ELSE 0 END AS pred FROM sc0)"""
CNT = """cnt AS (SELECT sum(CASE WHEN label = 1 AND pred = 1 THEN 1 ELSE 0 END)::double AS tp,
  sum(CASE WHEN label = 0 AND pred = 1 THEN 1 ELSE 0 END)::double AS fp,
  sum(CASE WHEN label = 1 AND pred = 0 THEN 1 ELSE 0 END)::double AS fn,
  sum(CASE WHEN label = 0 AND pred = 0 THEN 1 ELSE 0 END)::double AS tn FROM sc)"""
PAIRS = """k AS (SELECT unnest([0, 1]) AS c),
cm AS (SELECT a.c AS label, b.c AS pred, (SELECT count(*) FROM sc WHERE sc.label = a.c AND sc.pred = b.c) AS n FROM k a, k b)"""
THR = """tt AS (SELECT p1 AS threshold, sum(label) AS pos, sum(1 - label) AS neg FROM sc GROUP BY p1),
cu AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER () AS P, sum(neg) OVER () AS N
  FROM tt WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)),
roc AS (SELECT threshold, pos, neg, tp, fp, fp::double / N AS fpr, tp::double / P AS tpr, P, N,
  tp::double / (tp + fp) AS precision FROM cu)"""


def with_scores(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join((SCORED, *ctes)) + "\n" + body


def table(spark, sf, p: str = "p1"):
    return curves.threshold_table(scored(spark, sf), "label", p)


@query("confusion_matrix", with_scores("SELECT label::bigint AS label, pred::bigint AS pred, n::bigint AS n FROM cm", PAIRS))
def confusion_matrix(spark, sf):
    return tidy(metrics.confusion_matrix(scored(spark, sf)))


@query("confusion_matrix_norm", with_scores(
    f"SELECT label::bigint AS label, pred::bigint AS pred, n::bigint AS n, {r('n / sum(n) OVER (PARTITION BY label)')} AS share FROM cm", PAIRS))
def confusion_matrix_norm(spark, sf):
    return tidy(metrics.row_normalised(metrics.confusion_matrix(scored(spark, sf))))


MCC_SQL = "coalesce((tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0)"
METRICS_SQL = f"""{r('(tp + tn) / (tp + fp + fn + tn)')} AS accuracy, {r('coalesce(tp / nullif(tp + fp, 0), 0)')} AS precision,
{r('tp / (tp + fn)')} AS recall, {r('2 * tp / (2 * tp + fp + fn)')} AS f1, {r(MCC_SQL)} AS mcc,
{r('tn / (tn + fp)')} AS specificity, {r('fp / (tn + fp)')} AS fpr, {r('fn / (tp + fn)')} AS fnr"""


@query("binary_metrics", with_scores(
    f"SELECT {big('tp')} AS tp, {big('fp')} AS fp, {big('fn')} AS fn, {big('tn')} AS tn, {METRICS_SQL} FROM cnt", CNT))
def binary_metrics(spark, sf):
    return tidy(metrics.binary_metrics(scored(spark, sf)))


@query("roc_curve", with_scores(f"SELECT {r('threshold')} AS threshold, {r('fpr')} AS fpr, {r('tpr')} AS tpr FROM roc", THR))
def roc_curve(spark, sf):
    return tidy(curves.roc_curve(table(spark, sf)))


AUC_SQL = "sum(neg * (tp - pos / 2.0::double)) / (max(P)::double * max(N))"


@query("roc_auc", with_scores(f"SELECT {r(AUC_SQL)} AS auc FROM roc", THR))
def roc_auc(spark, sf):
    return tidy(curves.roc_auc(table(spark, sf)))


@query("youden_threshold", with_scores(
    f"""SELECT {r('threshold')} AS threshold, {r('fpr')} AS fpr, {r('tpr')} AS tpr, {r('tpr - fpr')} AS j
    FROM roc ORDER BY tpr - fpr DESC, threshold DESC LIMIT 1""", THR))
def youden_threshold(spark, sf):
    return tidy(curves.youden_threshold(table(spark, sf)))


@query("threshold_sweep", with_scores(
    f"""SELECT {r('threshold')} AS threshold, {r('tpr')} AS tpr, {r('1 - fpr')} AS tnr,
    {r('2 * tpr * (1 - fpr) / (tpr + (1 - fpr) + 1e-9)')} AS harmonic FROM roc""", THR))
def threshold_sweep(spark, sf):
    return tidy(curves.threshold_sweep(table(spark, sf)))


@query("pr_curve", with_scores(
    f"SELECT {r('threshold')} AS threshold, {r('precision')} AS precision, {r('tpr')} AS recall FROM roc", THR))
def pr_curve(spark, sf):
    return tidy(curves.pr_curve(table(spark, sf)))


AP_SQL = "sum(pos::double / P * precision)"


@query("average_precision", with_scores(f"SELECT {r(AP_SQL)} AS average_precision FROM roc", THR))
def average_precision(spark, sf):
    return tidy(curves.average_precision(table(spark, sf)))


F1_SQL = "2 * precision * tpr / (precision + tpr + 1e-9)"


@query("best_f1_threshold", with_scores(
    f"""SELECT {r('threshold')} AS threshold, {r('precision')} AS precision, {r('tpr')} AS recall, {r(F1_SQL)} AS f1
    FROM roc ORDER BY {F1_SQL} DESC, threshold LIMIT 1""", THR))
def best_f1_threshold(spark, sf):
    return tidy(curves.best_f1_threshold(table(spark, sf)))


@query("calibration_bins", with_scores(
    f"""SELECT least(floor(p1 * 10), 9)::bigint AS bin, {r('avg(p1)')} AS mean_confidence, {r('avg(label)')} AS observed_rate,
    count(*) AS n FROM sc GROUP BY 1"""))
def calibration_bins(spark, sf):
    return tidy(curves.calibration_bins(scored(spark, sf), "label", "p1"))


def hist_sql(source: str, value: str, bins: int, by: str) -> str:
    return f"""WITHSPAN AS (SELECT {by} AS g, {value}::double AS v, min({value}::double) OVER (PARTITION BY {by}) AS lo,
      max({value}::double) OVER (PARTITION BY {by}) AS hi FROM {source})""".replace("WITHSPAN", "span")


BIN_SQL = "(CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / (hi - lo) * {n}), {m}) END)::bigint"


@query("confidence_hist", with_scores(
    f"SELECT g AS series, {BIN_SQL.format(n=50, m=49)} AS bin, count(*) AS n FROM span WHERE g IN ('human', 'ai') GROUP BY 1, 2"
    f" UNION ALL SELECT g, {BIN_SQL.format(n=40, m=39)}, count(*) FROM span WHERE g IN ('correct', 'wrong') GROUP BY 1, 2",
    "u AS (SELECT CASE WHEN label = 1 THEN 'ai' ELSE 'human' END AS series, p1 AS value FROM sc UNION ALL "
    "SELECT CASE WHEN label = pred THEN 'correct' ELSE 'wrong' END, greatest(p1, 1 - p1) FROM sc)",
    hist_sql("u", "value", 50, "series")))
def confidence_hist(spark, sf):
    s = scored(spark, sf)
    by_class = s.select(F.when(F.col("label") == 1, "ai").otherwise("human").alias("series"), F.col("p1").alias("value"))
    by_hit = s.select(F.when(F.col("label") == F.col("pred"), "correct").otherwise("wrong").alias("series"),
                      F.greatest("p1", 1 - F.col("p1")).alias("value"))
    return tidy(curves.equal_width_histogram(by_class, "value", 50, ["series"]).unionByName(
        curves.equal_width_histogram(by_hit, "value", 40, ["series"])))


@query("per_class_metrics", with_scores(
    f"""SELECT 1::bigint AS class, {r('tp / (tp + fp)')} AS precision, {r('tp / (tp + fn)')} AS recall,
      {r('2 * tp / (2 * tp + fp + fn)')} AS f1, {r('(SELECT ' + AUC_SQL + ' FROM roc)')} AS auc FROM cnt
    UNION ALL SELECT 0, {r('tn / (tn + fn)')}, {r('tn / (tn + fp)')}, {r('2 * tn / (2 * tn + fp + fn)')},
      {r('(SELECT ' + AUC_SQL + ' FROM roc)')} FROM cnt""", CNT, THR))
def per_class_metrics(spark, sf):
    """Both classes as the positive one: flip label, prediction and score for class 0."""
    both = scored(spark, sf).select(F.explode(F.array(
        F.struct(F.lit(1).alias("class"), "label", "pred", F.col("p1").alias("p")),
        F.struct(F.lit(0).alias("class"), (1 - F.col("label")).alias("label"), (1 - F.col("pred")).alias("pred"),
                 (1 - F.col("p1")).alias("p")))).alias("x")).select("x.*")
    m = metrics.binary_metrics(both, by=["class"]).select("class", "precision", "recall", "f1")
    auc = curves.roc_auc(curves.threshold_table(both, "label", "p", ["class"]), ["class"])
    return tidy(m.join(auc, "class"))


REPORT_CTES = (PAIRS, """per AS (SELECT k.c::varchar AS class, (SELECT sum(n) FROM cm WHERE label = k.c)::double AS support,
  (SELECT sum(n) FROM cm WHERE pred = k.c)::double AS predicted, (SELECT sum(n) FROM cm WHERE label = k.c AND pred = k.c)::double AS tp FROM k),
pm AS (SELECT class, tp / predicted AS precision, tp / support AS recall, 2 * tp / (predicted + support) AS f1, support, tp FROM per)""")


def report_row(name: str, exprs: tuple[str, str, str]) -> str:
    return (f"SELECT '{name}' AS class, {r(exprs[0])} AS precision, {r(exprs[1])} AS recall, {r(exprs[2])} AS f1, "
            f"{big('sum(support)')} AS support FROM pm")


@query("classification_report", with_scores(
    f"SELECT class, {r('precision')} AS precision, {r('recall')} AS recall, {r('f1')} AS f1, {big('support')} AS support FROM pm UNION ALL "
    + report_row("accuracy", ("sum(tp) / sum(support)",) * 3) + " UNION ALL "
    + report_row("macro avg", ("avg(precision)", "avg(recall)", "avg(f1)")) + " UNION ALL "
    + report_row("weighted avg", tuple(f"sum({m} * support) / sum(support)" for m in ("precision", "recall", "f1"))),
    *REPORT_CTES))
def classification_report(spark, sf):
    return tidy(metrics.classification_report(scored(spark, sf)))


@query("softmax", with_scores(
    f"""SELECT id, {r('e0 / (e0 + e1)')} AS prob_0, {r('e1 / (e0 + e1)')} AS prob_1, (CASE WHEN p1 > p2 THEN 1 ELSE 0 END)::bigint AS pred
    FROM (SELECT *, exp(p2 - greatest(p1, p2)) AS e0, exp(p1 - greatest(p1, p2)) AS e1 FROM sc)"""))
def softmax(spark, sf):
    logits = [F.col("p2"), F.col("p1")]
    p0, p1 = metrics.softmax(logits)
    return tidy(scored(spark, sf).select("id", p0.alias("prob_0"), p1.alias("prob_1"), metrics.argmax(logits).alias("pred")))


@query("error_rows", with_scores("SELECT id, label::bigint AS label, pred::bigint AS pred FROM sc WHERE label <> pred"))
def error_rows(spark, sf):
    return tidy(metrics.error_rows(scored(spark, sf)).select("id", "label", "pred"))


CW = "cw AS (SELECT label, (SELECT count(*) FROM sc)::double / (2 * count(*)) AS w FROM sc GROUP BY label)"
BCE = "-(label * ln(q) + (1 - label) * ln(1 - q))"


@query("bce_loss", with_scores(
    f"SELECT {r(f'avg({BCE})')} AS bce, {r(f'avg(w * {BCE})')} AS weighted_bce FROM "
    "(SELECT label, greatest(least(p1, 1 - 1e-7), 1e-7) AS q, w FROM sc JOIN cw USING (label))", CW))
def bce_loss(spark, sf):
    s = scored(spark, sf)
    n = s.groupBy("label").agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy(F.lit(0)))  # one row per class
    weights = n.select("label", (total / (2 * F.col("n"))).alias("w"))
    y, p = F.col("label"), F.col("p1")
    return tidy(s.join(weights, "label").agg(
        metrics.bce_loss(y, p).alias("bce"), metrics.bce_loss(y, p, F.col("w")).alias("weighted_bce")))


# --- ensemble ------------------------------------------------------------------
ENS = """en AS (SELECT *, 0.4::double * p1 + 0.6::double * p2 AS p,
  CASE WHEN 0.4::double * p1 + 0.6::double * p2 >= 0.5 THEN 1 ELSE 0 END AS ep FROM sc)"""


@query("ensemble_score", with_scores(
    f"SELECT id, {r('p')} AS p, ep::bigint AS pred, {r('abs(p - 0.5) * 2')} AS confidence FROM en", ENS))
def ensemble_score(spark, sf):
    return tidy(ensemble.score(scored(spark, sf), "p1", "p2", 0.4).select("id", "p", "pred", "confidence"))


@query("ensemble_weight_search", with_scores(
    f"""SELECT {r('w')} AS weight, {r('mcc')} AS mcc, {r('f1')} AS f1, (rn = 1) AS best FROM (
      SELECT w, {MCC_SQL} AS mcc, 2 * tp / (2 * tp + fp + fn) AS f1, row_number() OVER (ORDER BY {MCC_SQL} DESC, w) AS rn FROM cnt)""",
    """wp AS (SELECT w, label, CASE WHEN w * p1 + (1 - w) * p2 >= 0.5 THEN 1 ELSE 0 END AS pred
      FROM sc, (SELECT unnest([0.2::double, 0.3::double, 0.4::double, 0.5::double, 0.6::double, 0.7::double, 0.8::double]) AS w))""",
    CNT.replace("AS (SELECT sum", "AS (SELECT w, sum").replace("FROM sc", "FROM wp GROUP BY w")))
def ensemble_weight_search(spark, sf):
    return tidy(ensemble.weight_search(scored(spark, sf), "label", "p1", "p2"))


REC = """rec AS (SELECT e.id, CASE WHEN length(t.text) > 100 THEN substr(t.text, 1, 100) || '...' ELSE t.text END AS preview,
  CASE WHEN ep = 1 THEN 'AI-Generated' ELSE 'Human-Written' END AS prediction, abs(p - 0.5) * 2 AS confidence, p,
  CASE WHEN p1 >= 0.5 THEN 'AI' ELSE 'Human' END AS rf_prediction, CASE WHEN p2 >= 0.5 THEN 'AI' ELSE 'Human' END AS gbt_prediction,
  CASE WHEN (p1 >= 0.5) = (p2 >= 0.5) THEN 'Yes' ELSE 'No' END AS agreement
  FROM en e JOIN documents t ON t.doc_id = e.id)"""


def records(spark, sf):
    texts = load(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return ensemble.prediction_record(ensemble.score(scored(spark, sf), "p1", "p2", 0.4).join(texts, "id"), "p1", "p2")


@query("prediction_record", with_scores(
    f"""SELECT id, preview, prediction, {r('confidence')} AS confidence, {r('p')} AS ai_probability, {r('1 - p')} AS human_probability,
    rf_prediction, gbt_prediction, agreement FROM rec""", ENS, REC))
def prediction_record(spark, sf):
    return tidy(records(spark, sf))


@query("prediction_summary", with_scores(
    f"""SELECT count(*) AS total, {big("sum(CASE WHEN prediction = 'AI-Generated' THEN 1 ELSE 0 END)")} AS ai_count,
    {big("sum(CASE WHEN prediction = 'AI-Generated' THEN 0 ELSE 1 END)")} AS human_count,
    {r("avg(CASE WHEN prediction = 'AI-Generated' THEN 1.0 ELSE 0.0 END)")} AS ai_share, {r('avg(confidence)')} AS avg_confidence,
    {r("avg(CASE WHEN agreement = 'Yes' THEN 1.0 ELSE 0.0 END)")} AS agreement_rate FROM rec""", ENS, REC))
def prediction_summary(spark, sf):
    return tidy(metrics.prediction_summary(records(spark, sf)))


# --- model comparison, folds, split gap ---------------------------------------------
def model_sql(name: str, p: str) -> str:
    cte = CNT.replace("cnt AS", f"cnt_{name} AS").replace("FROM sc", f"FROM (SELECT label, CASE WHEN {p} >= 0.5 THEN 1 ELSE 0 END AS pred FROM sc)")
    thr = THR.replace("tt AS", f"tt_{name} AS").replace("FROM tt", f"FROM tt_{name}").replace("cu AS", f"cu_{name} AS").replace(
        "FROM cu", f"FROM cu_{name}").replace("roc AS", f"roc_{name} AS").replace("p1", p)
    return cte + ",\n" + thr


def model_row(name: str) -> str:
    return (f"SELECT '{name}' AS model, {METRICS_SQL}, {r(f'(SELECT {AUC_SQL} FROM roc_{name})')} AS auc_roc, "
            f"{r(f'(SELECT {AP_SQL} FROM roc_{name})')} AS auc_pr FROM cnt_{name}")


@query("model_comparison", with_scores(model_row("first") + " UNION ALL " + model_row("second"),
                                        model_sql("first", "p1"), model_sql("second", "p2")))
def model_comparison(spark, sf):
    return tidy(ensemble.compare_models(scored(spark, sf), "label", {"first": "p1", "second": "p2"}))


FOLD = "(('0x' || substr(md5(id::varchar), 1, 6))::bigint % 5)"


@query("cv_summary", with_scores(
    " UNION ALL ".join(f"SELECT '{m}' AS metric, {r(f'avg({m})')} AS mean, {r(f'stddev_pop({m})')} AS std FROM fm"
                       for m in ("accuracy", "precision", "recall", "f1", "mcc", "auc")),
    f"fs AS (SELECT *, {FOLD} AS fold FROM sc)",
    CNT.replace("AS (SELECT sum", "AS (SELECT fold, sum").replace("FROM sc", "FROM fs GROUP BY fold"),
    """ft AS (SELECT fold, p1 AS threshold, sum(label) AS pos, sum(1 - label) AS neg FROM fs GROUP BY fold, p1),
    fc AS (SELECT *, sum(pos) OVER (PARTITION BY fold ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS tp,
      sum(pos) OVER (PARTITION BY fold) AS P, sum(neg) OVER (PARTITION BY fold) AS N FROM ft),""" +
    f"fa AS (SELECT fold, {AUC_SQL} AS auc FROM fc GROUP BY fold)",
    f"""fm AS (SELECT (tp + tn) / (tp + fp + fn + tn) AS accuracy, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall,
      2 * tp / (2 * tp + fp + fn) AS f1, {MCC_SQL} AS mcc, auc FROM cnt JOIN fa USING (fold))"""))
def cv_summary(spark, sf):
    fold = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 6), 16, 10).cast("long") % 5
    return tidy(ensemble.cv_summary(scored(spark, sf).withColumn("fold", fold), "label", "pred", "p1", "fold"))


@query("train_test_gap", with_scores(
    f"""SELECT {r('max(CASE WHEN split = 0 THEN a END)')} AS train_accuracy, {r('max(CASE WHEN split = 1 THEN a END)')} AS test_accuracy,
    {r('max(CASE WHEN split = 0 THEN a END) - max(CASE WHEN split = 1 THEN a END)')} AS gap FROM (
    SELECT CASE WHEN {FOLD} = 0 THEN 1 ELSE 0 END AS split, avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) AS a FROM sc GROUP BY 1)"""))
def train_test_gap(spark, sf):
    fold = F.conv(F.substring(F.md5(F.col("id").cast("string")), 1, 6), 16, 10).cast("long") % 5
    s = scored(spark, sf).withColumn("split", F.when(fold == 0, "test").otherwise("train"))
    return tidy(ensemble.train_test_gap(s, "label", "pred", "split"))
