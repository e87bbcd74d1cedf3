"""Exploratory tables. Rows collapse to counts per distinct length first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import ratio


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", ratio(F.col("n") * 100, F.sum("n").over(W.partitionBy(F.lit(0)))))  # one row per class


def label_by_split(df: DataFrame, label: str = "label", split: str = "split") -> DataFrame:
    return df.groupBy(F.col(split).alias("split"), F.col(label).alias("label")).agg(F.count("*").alias("n"))


def length_counts(df: DataFrame, value: str, label: str = "label") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(value).alias("v")).agg(F.count("*").alias("n"))


def box_statistics(df: DataFrame, value: str, label: str = "label") -> DataFrame:
    """Exact quartiles and 1.5 IQR whiskers per class from counts per distinct length."""
    c = length_counts(df, value, label)
    q = c.groupBy("label").agg(F.percentile("v", [0.25, 0.5, 0.75], F.col("n")).alias("q"), F.sum("n").alias("count"))
    q = q.select("label", F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"), "count")
    iqr = F.col("q3") - F.col("q1")
    low, high = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    whisk = c.join(q, "label").groupBy("label").agg(
        F.min(F.when(F.col("v") >= low, F.col("v"))).alias("whisker_low"),
        F.max(F.when(F.col("v") <= high, F.col("v"))).alias("whisker_high"))
    return q.join(whisk, "label")


def empirical_cdf(df: DataFrame, value: str, label: str = "label") -> DataFrame:
    """Cumulative share per class and distinct length (the window sees distinct lengths only)."""
    c = length_counts(df, value, label)
    w = W.partitionBy("label").orderBy("v")
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    return c.select("label", F.col("v").alias(value),
                    ratio(F.sum("n").over(upto), F.sum("n").over(W.partitionBy("label"))).alias("cdf"))


def dataset_summary(df: DataFrame, words: str, chars: str, label: str = "label") -> DataFrame:
    def of(k):
        return F.sum(F.when(F.col(label) == k, 1).otherwise(0))

    return df.agg(
        F.count("*").alias("total"), of(0).alias("n_class0"), of(1).alias("n_class1"),
        F.avg(F.when(F.col(label) == 0, F.col(words))).alias("avg_words_class0"),
        F.avg(F.when(F.col(label) == 1, F.col(words))).alias("avg_words_class1"), F.max(chars).alias("max_chars"))
