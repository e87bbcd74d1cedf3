"""Classification, regression and clustering report tables.

Everything here is a map-side combined aggregate into a table whose size
depends on the number of classes, never on the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import ratio


def pair_counts(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "pred", classes: list | None = None) -> DataFrame:
    """Dense over the class set: pairs that never occur have n = 0."""
    pairs = pair_counts(df, label, pred)
    if classes is None:
        seen = pairs.select(F.array_sort(F.array("label", "pred")).alias("k")).agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("k")))).alias("k"))
    else:
        seen = df.sparkSession.range(1).select(F.array(*[F.lit(k) for k in classes]).alias("k"))
    grid = seen.select(F.explode("k").alias("label"), "k").select("label", F.explode("k").alias("pred"))
    return grid.join(pairs, ["label", "pred"], "left").select("label", "pred", F.coalesce("n", F.lit(0)).alias("n"))


def row_normalised(matrix: DataFrame) -> DataFrame:
    share = ratio(F.col("n"), F.sum("n").over(W.partitionBy("label")))
    return matrix.select("label", "pred", "n", share.alias("share"))


def binary_counts(label: Column, pred: Column) -> list[Column]:
    def total(test):
        return F.sum(F.when(test, 1).otherwise(0)).cast("long")

    return [
        total((label == 1) & (pred == 1)).alias("tp"), total((label == 0) & (pred == 1)).alias("fp"),
        total((label == 1) & (pred == 0)).alias("fn"), total((label == 0) & (pred == 0)).alias("tn"),
    ]


def mcc(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    """Matthews correlation, 0 when a margin is empty."""
    a, b, c, d = (x.cast("double") for x in (tp, fp, fn, tn))
    den = F.sqrt((a + b) * (a + c) * (d + b) * (d + c))
    return ratio(a * d - b * c, den)


def rates(counts: DataFrame) -> DataFrame:
    """Metric columns from tp, fp, fn, tn (zero division gives 0)."""
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return counts.withColumns({
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "mcc": mcc(tp, fp, fn, tn),
        "specificity": ratio(tn, tn + fp),
        "fpr": ratio(fp, fp + tn),
        "fnr": ratio(fn, fn + tp),
    })


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "pred", by: list[str] | None = None) -> DataFrame:
    return rates(df.groupBy(*(by or [])).agg(*binary_counts(F.col(label), F.col(pred))))


def classification_report(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Precision, recall, F1 and support per class, plus accuracy, macro and weighted rows."""
    pairs = pair_counts(df, label, pred)
    role = F.explode(F.array(
        F.struct(F.col("label").cast("string").alias("k"), F.col("n").alias("support"), F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col("pred").cast("string").alias("k"), F.lit(0).cast("long").alias("support"), F.col("n").alias("predicted")),
    ))
    hit = F.when((F.col("label") == F.col("pred")) & (F.col("r.support") > 0), F.col("n")).otherwise(0)
    per = (pairs.select("label", "pred", "n", role.alias("r"))
           .groupBy(F.col("r.k").alias("class"))
           .agg(F.sum("r.support").alias("support"), F.sum("r.predicted").alias("predicted"), F.sum(hit).alias("tp")))
    per = per.select(
        "class", ratio(F.col("tp"), F.col("predicted")).alias("precision"), ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"), "support", "tp")
    names = ("precision", "recall", "f1")
    macro = per.agg(*[F.avg(m).alias(m) for m in names], F.sum("support").alias("support"))
    weighted = per.agg(*[ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in names],
                       F.sum("support").alias("support"))
    acc = per.agg(ratio(F.sum("tp"), F.sum("support")).alias("a"), F.sum("support").alias("support"))
    acc = acc.select(F.lit("accuracy").alias("class"), *[F.col("a").alias(m) for m in names], "support")
    out = per.select("class", *names, "support").unionByName(acc)
    out = out.unionByName(macro.select(F.lit("macro avg").alias("class"), *names, "support"))
    return out.unionByName(weighted.select(F.lit("weighted avg").alias("class"), *names, "support"))


def softmax(logits: list[Column]) -> list[Column]:
    top = F.greatest(*logits)
    exps = [F.exp(x - top) for x in logits]
    total = exps[0]
    for e in exps[1:]:
        total = total + e
    return [e / total for e in exps]


def argmax(values: list[Column]) -> Column:
    """0-based position of the first maximum."""
    arr = F.array(*values)
    return (F.array_position(arr, F.array_max(arr)) - 1).cast("int")


def error_rows(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    return df.filter(F.col(label) != F.col(pred))


def bce_loss(label: Column, p: Column, weight: Column | None = None, eps: float = 1e-7) -> Column:
    """Mean (class-weighted) binary cross-entropy with clamped probabilities."""
    q = F.greatest(F.least(p, F.lit(1 - eps)), F.lit(eps))
    y = label.cast("double")
    loss = -(y * F.ln(q) + (1 - y) * F.ln(1 - q))
    return F.avg(loss if weight is None else loss * weight)


def regression_metrics(df: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """MSE and R^2 in one pass (R^2 from centred second moments)."""
    err = F.col(y) - F.col(yhat)
    agg = df.agg(F.avg(err * err).alias("mse"), F.var_pop(y).alias("_v"))
    return agg.select("mse", (1 - F.try_divide(F.col("mse"), F.col("_v"))).alias("r2"))


def prediction_summary(df: DataFrame) -> DataFrame:
    """Totals of a scored batch: class shares, mean confidence, agreement rate."""
    ai = F.sum(F.when(F.col("prediction") == "AI-Generated", 1).otherwise(0))
    n = F.count("*")
    return df.agg(
        n.alias("total"), ai.alias("ai_count"), (n - ai).alias("human_count"), ratio(ai, n).alias("ai_share"),
        F.avg("confidence").alias("avg_confidence"),
        F.avg(F.when(F.col("agreement") == "Yes", 1.0).otherwise(0.0)).alias("agreement_rate"))
