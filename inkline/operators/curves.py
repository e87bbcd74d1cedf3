"""Threshold curves and histograms of a score column, exact for every distinct score.

Ties collapse first (a map-side combined group-by on the score), so a score
shared by a third of the rows is one row from then on; running totals are
bucketed, so no curve needs a single-task sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import ratio
from .ranking import running_totals


def threshold_table(df: DataFrame, label: str = "label", p: str = "p", by: list[str] | None = None) -> DataFrame:
    """Per distinct score, descending: cumulative true and false positives and the class totals.

    ``by`` names a few series (models, classes, folds).
    """
    keys = list(by or [])
    ties = df.groupBy(*keys, F.col(p).alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum(1 - F.col(label).cast("long")).alias("neg"))
    cum = running_totals(ties, "threshold", ["pos", "neg"], keys, descending=True, few_keys=True)
    return cum.select(*keys, "threshold", "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                      F.col("all_pos").alias("P"), F.col("all_neg").alias("N"))




def roc_curve(table: DataFrame) -> DataFrame:
    return table.select("threshold", ratio(F.col("fp"), F.col("N")).alias("fpr"), ratio(F.col("tp"), F.col("P")).alias("tpr"))


def roc_auc(table: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Trapezoid area as a sum over ties: each negative scores the positives above it, half of those beside it."""
    area = F.sum(F.col("neg").cast("double") * (F.col("tp").cast("double") - F.col("pos") / 2))
    return table.groupBy(*(by or [])).agg(ratio(area, F.max("P").cast("double") * F.max("N")).alias("auc"))


def youden_threshold(table: DataFrame) -> DataFrame:
    roc = roc_curve(table).withColumn("j", F.col("tpr") - F.col("fpr"))
    return roc.orderBy(F.desc("j"), F.desc("threshold")).limit(1)


def threshold_sweep(table: DataFrame) -> DataFrame:
    """True positive rate, true negative rate and their harmonic mean."""
    roc = roc_curve(table).select("threshold", "tpr", (1 - F.col("fpr")).alias("tnr"))
    h = 2 * F.col("tpr") * F.col("tnr") / (F.col("tpr") + F.col("tnr") + 1e-9)
    return roc.withColumn("harmonic", F.when(F.col("tpr") + F.col("tnr") > 0, h).otherwise(0.0))


def pr_curve(table: DataFrame) -> DataFrame:
    return table.select("threshold", ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                        ratio(F.col("tp"), F.col("P")).alias("recall"))


def average_precision(table: DataFrame, by: list[str] | None = None) -> DataFrame:
    step = ratio(F.col("pos"), F.col("P")) * ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    return table.groupBy(*(by or [])).agg(F.sum(step).alias("average_precision"))


def best_f1_threshold(table: DataFrame) -> DataFrame:
    p, r = F.col("precision"), F.col("recall")
    pr = pr_curve(table).withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r + 1e-9)).otherwise(0.0))
    return pr.orderBy(F.desc("f1"), F.asc("threshold")).limit(1)


def calibration_bins(df: DataFrame, label: str = "label", p: str = "p", bins: int = 10) -> DataFrame:
    """Equal bins ``[lo, hi)``; the last one includes 1."""
    b = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(b.alias("bin")).agg(
        F.avg(p).alias("mean_confidence"), F.avg(F.col(label).cast("double")).alias("observed_rate"), F.count("*").alias("n"))


def equal_width_histogram(df: DataFrame, value: str, bins: int, by: list[str] | None = None) -> DataFrame:
    """Counts over equal bins between each group's minimum and maximum; the last bin is closed.

    The range joins back as one row per group, the rows themselves are counted
    with a map-side combine.
    """
    keys = list(by or ["_all"])
    base = df if by else df.withColumn("_all", F.lit(0))
    base = base.select(*keys, F.col(value).cast("double").alias("_v")).groupBy(*keys, "_v").agg(F.count("*").alias("_n"))
    span = base.groupBy(*keys).agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    width = F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0))
    place = F.least(F.floor((F.col("_v") - F.col("lo")) / width * bins), F.lit(bins - 1))
    b = F.when(width.isNull(), 0).otherwise(place).cast("int")
    out = base.join(span if by else F.broadcast(span), keys).groupBy(*keys, b.alias("bin")).agg(F.sum("_n").alias("n"))
    return out if by else out.drop("_all")
