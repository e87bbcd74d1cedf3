"""AdaBoost (SAMME) with decision stumps."""

from __future__ import annotations

import math

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut


def round_summary(df: DataFrame, label: str, pred: str, weight: str, classes: int = 2, rate: float = 1.0) -> DataFrame:
    """Weighted error and the round's vote weight alpha."""
    wrong = F.sum(F.when(F.col(label) != F.col(pred), F.col(weight)).otherwise(0.0))
    err = df.agg((wrong / F.sum(weight)).alias("error"))
    e = F.greatest(F.least(F.col("error"), F.lit(1 - 1e-10)), F.lit(1e-10))
    return err.withColumn("alpha", F.lit(rate) * (F.ln((1 - e) / e) + math.log(classes - 1)))


def reweigh(df: DataFrame, label: str, pred: str, weight: str, alpha: float, total: float) -> DataFrame:
    """Misclassified rows gain ``exp(alpha)``; weights sum to 1 again."""
    up = F.when(F.col(label) != F.col(pred), F.col(weight) * F.lit(math.exp(alpha))).otherwise(F.col(weight))
    return df.withColumn(weight, up / F.lit(total))


def boosted_total(df: DataFrame, label: str, pred: str, weight: str, alpha: float) -> float:
    up = F.when(F.col(label) != F.col(pred), F.col(weight) * F.lit(math.exp(alpha))).otherwise(F.col(weight))
    return df.agg(F.sum(up).alias("t")).first()["t"]


def fit(df: DataFrame, features: str, label: str, rounds: int = 50, rate: float = 1.0, seed: int = 42, cut_every: int = 5) -> list[tuple]:
    """``[(stump, alpha), ...]``; stops when a stump is perfect or no better than chance.

    A row's weight is a product over the rounds, so lineage grows by one
    projection a round; it is cut every few rounds.
    """
    n = df.count()
    data = df.withColumn("_w", F.lit(1.0 / n))
    model = []
    for k in range(rounds):
        stump = DecisionTreeClassifier(featuresCol=features, labelCol=label, weightCol="_w", maxDepth=1, seed=seed,
                                       predictionCol="_p", probabilityCol="_pp", rawPredictionCol="_pr").fit(data)
        scored = stump.transform(data).drop("_pp", "_pr")
        row = round_summary(scored, label, "_p", "_w", 2, rate).first()
        if row["error"] >= 0.5:
            if not model:
                model.append((stump, 1.0))
            break
        model.append((stump, row["alpha"]))
        if row["error"] <= 1e-10:
            break
        total = boosted_total(scored, label, "_p", "_w", row["alpha"])
        data = reweigh(scored, label, "_p", "_w", row["alpha"], total).drop("_p")
        if (k + 1) % cut_every == 0:
            data = cut(data)
    return model


def predict(df: DataFrame, model: list[tuple], out: str = "pred") -> DataFrame:
    """Sign of the alpha-weighted votes; the vote share is the probability."""
    votes: Column = F.lit(0.0)
    work, names = df, []
    for i, (stump, alpha) in enumerate(model):
        name = f"_v{i}"
        stump = stump.copy().setPredictionCol(name).setProbabilityCol("").setRawPredictionCol("")
        work = stump.transform(work)
        votes = votes + F.lit(alpha) * F.col(name)
        names.append(name)
    p = votes / F.lit(sum(a for _, a in model))
    return work.withColumn("p", p).withColumn(out, F.when(F.col("p") >= 0.5, 1).otherwise(0)).drop(*names)
