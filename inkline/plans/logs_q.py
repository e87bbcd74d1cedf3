"""Exploratory aggregates, training-log analytics and simple regression."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import curves, eda, linear, logs, metrics, split
from ..sources.tables import load
from .registry import query, r6, tidy
from .sqltext import big, r
from .text_q import labelled

LEN_SQL = f"""lens AS (SELECT l.quality AS label, length(text) AS chars,
  len(list_filter(regexp_split_to_array(text, '{tx.SPACE}+'), lambda x: x <> '')) AS words FROM documents d JOIN labels l USING (doc_id))"""


def lengths(spark, sf):
    docs = labelled(spark, sf)
    return docs.select("doc_id", "label", F.length("text").alias("chars"), F.size(tx.blank_tokens(F.col("text"))).alias("words"))


@query("class_balance", f"SELECT quality::bigint AS label, count(*) AS n, {r('count(*) * 100.0 / sum(count(*)) OVER ()')} AS share FROM labels GROUP BY 1")
def class_balance(spark, sf):
    return tidy(eda.class_balance(load(spark, sf, "labels"), "quality"))


@query("label_by_split", """WITH k AS (SELECT quality AS label, row_number() OVER (PARTITION BY quality ORDER BY md5(doc_id::varchar), doc_id) AS rn,
  count(*) OVER (PARTITION BY quality) AS nc FROM labels)
SELECT CASE WHEN rn <= greatest(1, round_even(nc * 0.2::double, 0)) THEN 'test' ELSE 'train' END AS split, label::bigint AS label,
count(*) AS n FROM k GROUP BY ALL""")
def label_by_split(spark, sf):
    labels = load(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return tidy(eda.label_by_split(split.stratified(labels, "doc_id", "label")))


def hist(value: str, bins: int) -> str:
    return (f"SELECT '{value}' AS measure, label::bigint AS label, (CASE WHEN hi = lo THEN 0 ELSE least(floor((v - lo) / (hi - lo) * {bins}), {bins - 1}) END)::bigint AS bin, count(*) AS n "
            f"FROM (SELECT label, {value}::double AS v, min({value}::double) OVER (PARTITION BY label) AS lo, "
            f"max({value}::double) OVER (PARTITION BY label) AS hi FROM lens) GROUP BY ALL")


@query("length_hist", f"WITH {LEN_SQL} {hist('chars', 60)} UNION ALL {hist('words', 50)}")
def length_hist(spark, sf):
    lens = lengths(spark, sf)
    parts = [curves.equal_width_histogram(lens, v, n, ["label"]).withColumn("measure", F.lit(v)) for v, n in (("chars", 60), ("words", 50))]
    return tidy(parts[0].unionByName(parts[1]))


@query("length_quartiles", f"""WITH {LEN_SQL}, q AS (SELECT label, quantile_cont(chars, 0.25) AS q1, quantile_cont(chars, 0.5) AS m,
  quantile_cont(chars, 0.75) AS q3, count(*) AS n FROM lens GROUP BY 1)
SELECT label::bigint AS label, {r('any_value(q1)')} AS q1, {r('any_value(m)')} AS median, {r('any_value(q3)')} AS q3, any_value(n) AS count,
  {big('min(CASE WHEN chars >= q1 - 1.5 * (q3 - q1) THEN chars END)')} AS whisker_low,
  {big('max(CASE WHEN chars <= q3 + 1.5 * (q3 - q1) THEN chars END)')} AS whisker_high FROM lens JOIN q USING (label) GROUP BY label""")
def length_quartiles(spark, sf):
    return tidy(eda.box_statistics(lengths(spark, sf), "chars"))


@query("word_cdf", f"""WITH {LEN_SQL} SELECT DISTINCT label::bigint AS label, words::bigint AS words,
{r('cume_dist() OVER (PARTITION BY label ORDER BY words)')} AS cdf FROM lens""")
def word_cdf(spark, sf):
    return tidy(eda.empirical_cdf(lengths(spark, sf), "words"))


@query("dataset_summary", f"""WITH {LEN_SQL} SELECT count(*) AS total, count(*) FILTER (label = 0) AS n_class0, count(*) FILTER (label = 1) AS n_class1,
{r('avg(words) FILTER (label = 0)')} AS avg_words_class0, {r('avg(words) FILTER (label = 1)')} AS avg_words_class1, max(chars)::bigint AS max_chars FROM lens""")
def dataset_summary(spark, sf):
    return tidy(eda.dataset_summary(lengths(spark, sf), "words", "chars"))


# --- logs: the hourly mean of click values is the train loss, six-hourly views the evaluation ----
STEP_SPARK = "datediff(to_date(ts), date'2024-01-01') * 24 + hour(ts)"
STEP_DUCK = "(date_diff('day', DATE '2024-01-01', ts::date) * 24 + hour(ts))"
TRAIN_SQL = f"""tr AS (SELECT {STEP_DUCK}::bigint AS step, avg(value) AS loss FROM events WHERE event_type = 'click' GROUP BY 1)"""
EVAL_SQL = f"""ev AS (SELECT ({STEP_DUCK} // 6 * 6)::bigint AS step, avg(value) AS eval_loss, avg(CASE WHEN value < 20 THEN 1.0 ELSE 0.0 END) AS accuracy,
  avg(CASE WHEN value < 25 THEN 1.0 ELSE 0.0 END) AS f1, avg(CASE WHEN value < 30 THEN 1.0 ELSE 0.0 END) AS f1_ai,
  avg(CASE WHEN value < 15 THEN 1.0 ELSE 0.0 END) AS f1_human FROM events WHERE event_type = 'view' GROUP BY 1)"""
EMA_SQL = f"""{TRAIN_SQL}, nr AS (SELECT *, row_number() OVER (ORDER BY step) AS i FROM tr),
em AS (SELECT a.step, any_value(a.loss) AS loss, sum(pow(19::double / 21, a.i - b.i) * b.loss) / sum(pow(19::double / 21, a.i - b.i)) AS ema
  FROM nr a JOIN nr b ON b.i <= a.i GROUP BY a.step)"""


def train_log(spark, sf):
    clicks = load(spark, sf, "events").filter("event_type = 'click'")
    return clicks.groupBy(F.expr(f"cast({STEP_SPARK} as bigint)").alias("step")).agg(F.avg("value").alias("loss"))


def eval_log(spark, sf):
    views = load(spark, sf, "events").filter("event_type = 'view'")

    def below(cut):
        return F.avg(F.when(F.col("value") < cut, 1.0).otherwise(0.0))

    return views.groupBy(F.expr(f"cast(({STEP_SPARK}) div 6 * 6 as bigint)").alias("step")).agg(
        F.avg("value").alias("eval_loss"), below(20).alias("accuracy"), below(25).alias("f1"), below(30).alias("f1_ai"),
        below(15).alias("f1_human"))


@query("ema_smooth", f"WITH {EMA_SQL} SELECT step, {r('loss')} AS loss, {r('ema')} AS ema FROM em")
def ema_smooth(spark, sf):
    return tidy(logs.ema_smooth(train_log(spark, sf), "step", "loss", 20))


@query("asof_loss_gap", f"""WITH {EMA_SQL}, {EVAL_SQL} SELECT ev.step, em.step AS step_matched, {r('eval_loss')} AS eval_loss,
{r('ema')} AS train_loss, {r('eval_loss - ema')} AS gap FROM ev ASOF JOIN em ON ev.step >= em.step""")
def asof_loss_gap(spark, sf):
    smooth = logs.ema_smooth(train_log(spark, sf), "step", "loss", 20).select("step", F.col("ema").alias("train_loss"))
    joined = logs.asof_join(eval_log(spark, sf).select("step", "eval_loss"), smooth, "step").filter("step_matched is not null")
    return tidy(joined.withColumn("gap", F.col("eval_loss") - F.col("train_loss")))


METRIC_COLS = ["eval_loss", "accuracy", "f1", "f1_ai", "f1_human"]


def norm_sql(c: str) -> str:
    x = f"({c} - (SELECT min({c}) FROM ev)) / (SELECT max({c}) - min({c}) FROM ev)"
    return r(f"1 - {x}" if c == "eval_loss" else x) + f" AS {c}"


@query("checkpoint_norm", f"WITH {EVAL_SQL} SELECT step, {', '.join(norm_sql(c) for c in METRIC_COLS)} FROM ev")
def checkpoint_norm(spark, sf):
    return tidy(logs.normalise_columns(eval_log(spark, sf), METRIC_COLS, flip=("eval_loss",)))


@query("best_checkpoint", f"""WITH {EVAL_SQL} SELECT step, {', '.join(r(c) + ' AS ' + c for c in METRIC_COLS)}
FROM ev ORDER BY ev.f1 DESC, step LIMIT 1""")
def best_checkpoint(spark, sf):
    return tidy(logs.best_checkpoint(eval_log(spark, sf)))


RUN_SQL = f"""{TRAIN_SQL}, {EVAL_SQL}, run AS (SELECT ev.step, loss AS train_loss, eval_loss AS val_loss FROM ev JOIN tr ON tr.step = ev.step)"""


def run_log(spark, sf):
    return eval_log(spark, sf).join(train_log(spark, sf), "step").select(
        "step", F.col("loss").alias("train_loss"), F.col("eval_loss").alias("val_loss"))


@query("loss_deltas", f"""WITH {RUN_SQL} SELECT step, {r('train_loss')} AS train_loss, {r('val_loss')} AS val_loss,
{r('val_loss - train_loss')} AS gap, {r('lag(val_loss) OVER (ORDER BY step) - val_loss')} AS improvement FROM run""")
def loss_deltas(spark, sf):
    return tidy(logs.loss_deltas(run_log(spark, sf)))


@query("early_stop", f"""WITH {RUN_SQL},
a AS (SELECT step, val_loss, row_number() OVER (ORDER BY step) AS n,
  min(val_loss) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM run),
b AS (SELECT *, max(CASE WHEN m IS NULL OR val_loss < m THEN n END) OVER (ORDER BY step) AS last FROM a),
s AS (SELECT min(n) AS stop_n FROM b WHERE n - last >= 3),
k AS (SELECT b.* FROM b, s WHERE s.stop_n IS NULL OR n <= s.stop_n)
SELECT arg_min(step, val_loss)::bigint AS best_step, {r('min(val_loss)')} AS best_loss,
max(CASE WHEN n - last >= 3 THEN step END)::bigint AS stop_step, count(*) AS steps_run FROM k""")
def early_stop(spark, sf):
    return tidy(logs.early_stop(run_log(spark, sf), patience=3))


# --- regression ---------------------------------------------------------------------
FIT_SQL = """fit AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
pr AS (SELECT l_extendedprice AS y, a + b * l_quantity AS yhat FROM lineitem, fit)"""


def fitted_line(spark, sf):
    items = load(spark, sf, "lineitem").select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"))
    slope, intercept = linear.fit_line(items, "x", "y")
    return items.withColumn("yhat", F.lit(intercept) + F.lit(slope) * F.col("x"))


@query("linreg_simple", f"""SELECT {r('regr_slope(l_extendedprice, l_quantity)', 4)} AS slope,
{r('regr_intercept(l_extendedprice, l_quantity)', 4)} AS intercept, {r('regr_r2(l_extendedprice, l_quantity)')} AS r2 FROM lineitem""")
def linreg_simple(spark, sf):
    items = load(spark, sf, "lineitem")
    return items.agg(
        F.round(F.regr_slope("l_extendedprice", "l_quantity"), 4).alias("slope"),
        F.round(F.regr_intercept("l_extendedprice", "l_quantity"), 4).alias("intercept"),
        F.round(F.regr_r2("l_extendedprice", "l_quantity"), 6).alias("r2"))


@query("regression_metrics", f"""WITH {FIT_SQL} SELECT {r('avg((y - yhat) ** 2)', 2)} AS mse,
{r('1 - avg((y - yhat) ** 2) / var_pop(y)')} AS r2 FROM pr""")
def regression_metrics(spark, sf):
    found = tidy(metrics.regression_metrics(fitted_line(spark, sf)))
    return found.withColumn("mse", r6(F.col("mse"), 2))


@query("residual_hist", f"""WITH {FIT_SQL}, e AS (SELECT y - yhat AS v, min(y - yhat) OVER () AS lo, max(y - yhat) OVER () AS hi FROM pr)
SELECT least(floor((v - lo) / (hi - lo) * 30), 29)::bigint AS bin, count(*) AS n FROM e GROUP BY 1""")
def residual_hist(spark, sf):
    resid = fitted_line(spark, sf).select((F.col("y") - F.col("yhat")).alias("residual"))
    return tidy(curves.equal_width_histogram(resid, "residual", 30))


@query("residual_rows", f"WITH {FIT_SQL} SELECT {r('y', 2)} AS y, {r('yhat', 2)} AS yhat, {r('y - yhat', 2)} AS residual FROM pr")
def residual_rows(spark, sf):
    return tidy(fitted_line(spark, sf).select("y", "yhat", (F.col("y") - F.col("yhat")).alias("residual")), 2)


# --- one sigmoid unit, three full-batch steps -------------------------------------------
GD_FEATURES = {"x1": "(l_quantity - 25) / 25", "x2": "(l_discount - 0.05) * 10"}
GD_DATA = "gd AS (SELECT (l_quantity - 25) / 25 AS x1, (l_discount - 0.05::double) * 10 AS x2, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y FROM lineitem)"


def gd_steps_sql(steps: int, lr: str = "0.05::double") -> str:
    ctes = [GD_DATA, "w0 AS (SELECT 0.0::double AS b, 0.0::double AS w1, 0.0::double AS w2)"]
    for k in range(steps):
        ctes.append(f"""w{k + 1} AS (SELECT any_value(b) - {lr} * avg(e) AS b, any_value(w1) - {lr} * avg(e * x1) AS w1, any_value(w2) - {lr} * avg(e * x2) AS w2
          FROM (SELECT b, w1, w2, x1, x2, 1 / (1 + exp(-(b + w1 * x1 + w2 * x2))) - y AS e FROM gd, w{k}))""")
    rows = " UNION ALL ".join(f"SELECT {k}::bigint AS step, {r('b')} AS bias, {r('w1')} AS w_x1, {r('w2')} AS w_x2 FROM w{k}" for k in range(1, steps + 1))
    return "WITH " + ", ".join(ctes) + " " + rows


@query("gd_logistic_step", gd_steps_sql(3))
def gd_logistic_step(spark, sf):
    data = load(spark, sf, "lineitem").selectExpr(
        "(l_quantity - 25) / 25 as x1", "(l_discount - 0.05D) * 10 as x2", "case when l_returnflag = 'R' then 1 else 0 end as y")
    return tidy(linear.gradient_descent_log(data, ["x1", "x2"], "y", steps=3, lr=0.05))
