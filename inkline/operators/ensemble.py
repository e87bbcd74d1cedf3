"""Two-model ensemble: scoring, weight search, prediction records, model tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import curves, metrics

WEIGHT_GRID = (0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)


def blend(p1: Column, p2: Column, w: Column | float) -> Column:
    return w * p1 + (1 - w) * p2


def score(df: DataFrame, p1: str, p2: str, w: float = 0.5) -> DataFrame:
    """Blended probability, 0.5 cut and confidence (distance from 0.5, doubled)."""
    p = blend(F.col(p1), F.col(p2), F.lit(w))
    return df.withColumn("p", p).withColumns({
        "pred": F.when(F.col("p") >= 0.5, 1).otherwise(0), "confidence": F.abs(F.col("p") - 0.5) * 2})


def weight_search(df: DataFrame, label: str, p1: str, p2: str, grid: tuple[float, ...] = WEIGHT_GRID) -> DataFrame:
    """MCC and F1 for every weight in one pass; ``best`` marks the first maximum of MCC.

    Confusion counts are first taken per distinct pattern of the grid's votes,
    so rows are neither multiplied by the grid nor shuffled.
    """
    mask = F.lit(0).cast("long")
    for i, w in enumerate(grid):
        mask = mask + F.when(blend(F.col(p1), F.col(p2), F.lit(w)) >= 0.5, F.lit(2**i)).otherwise(0)
    pattern = df.select(F.col(label).alias("label"), mask.alias("m")).groupBy("label", "m").agg(F.count("*").alias("n"))
    votes = F.transform(F.sequence(F.lit(0), F.lit(len(grid) - 1)), lambda i: F.floor(F.col("m") / F.pow(F.lit(2), i)).cast("long") % 2)
    long = pattern.select("label", "n", F.posexplode(votes).alias("i", "pred"))

    def cell(y, p):
        return F.sum(F.when((F.col("label") == y) & (F.col("pred") == p), F.col("n")).otherwise(0))

    weights = F.array(*[F.lit(w) for w in grid])
    counts = long.groupBy("i").agg(cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn"))
    out = metrics.rates(counts).select(F.get(weights, F.col("i")).alias("weight"), "mcc", "f1")
    first = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.desc("mcc"), "weight"))  # one row per grid point
    return out.withColumn("best", first == 1)


def best_weight(df: DataFrame, label: str, p1: str, p2: str, grid: tuple[float, ...] = WEIGHT_GRID) -> float:
    return weight_search(df, label, p1, p2, grid).filter("best").first()["weight"]


def prediction_record(df: DataFrame, p1: str, p2: str, text: str = "text", id_col: str = "id") -> DataFrame:
    """Preview, class name, confidence, probabilities and the two models' votes."""
    long_text = F.concat(F.substring(text, 1, 100), F.lit("..."))
    a, b = F.col(p1) >= 0.5, F.col(p2) >= 0.5
    return df.select(
        id_col, F.when(F.length(text) > 100, long_text).otherwise(F.col(text)).alias("preview"),
        F.when(F.col("pred") == 1, "AI-Generated").otherwise("Human-Written").alias("prediction"), "confidence",
        F.col("p").alias("ai_probability"), (1 - F.col("p")).alias("human_probability"),
        F.when(a, "AI").otherwise("Human").alias("rf_prediction"), F.when(b, "AI").otherwise("Human").alias("gbt_prediction"),
        F.when(a == b, "Yes").otherwise("No").alias("agreement"))


def compare_models(df: DataFrame, label: str, models: dict[str, str], cut: float = 0.5) -> DataFrame:
    """One metric row per model: confusion-based rates, ROC AUC, average precision."""
    long = df.select(F.col(label).alias("label"), F.explode(F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(p).alias("p")) for name, p in models.items()])).alias("m"))
    long = long.select("label", "m.model", "m.p").withColumn("pred", F.when(F.col("p") >= cut, 1).otherwise(0))
    base = metrics.binary_metrics(long, by=["model"]).drop("tp", "fp", "fn", "tn")
    thresholds = curves.threshold_table(long, "label", "p", ["model"])
    auc = curves.roc_auc(thresholds, ["model"]).withColumnRenamed("auc", "auc_roc")
    ap = curves.average_precision(thresholds, ["model"]).withColumnRenamed("average_precision", "auc_pr")
    return base.join(auc, "model").join(ap, "model")


def cv_summary(df: DataFrame, label: str, pred: str, p: str, fold: str) -> DataFrame:
    """Mean and population deviation over folds of accuracy, precision, recall, F1, MCC, AUC."""
    per = metrics.binary_metrics(df, label, pred, [fold])
    auc = curves.roc_auc(curves.threshold_table(df, label, p, [fold]), [fold])
    names = ["accuracy", "precision", "recall", "f1", "mcc", "auc"]
    long = per.join(auc, fold).select(*names).unpivot([], names, "metric", "value")
    return long.groupBy("metric").agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def train_test_gap(df: DataFrame, label: str, pred: str, split: str) -> DataFrame:
    hit = F.when(F.col(label) == F.col(pred), 1.0).otherwise(0.0)
    train, test = (F.avg(F.when(F.col(split) == k, hit)) for k in ("train", "test"))
    return df.agg(train.alias("train_accuracy"), test.alias("test_accuracy"), (train - test).alias("gap"))
