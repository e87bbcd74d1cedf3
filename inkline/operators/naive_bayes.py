"""Multinomial naive Bayes on TF-IDF weights, as joins and sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tfidf import BROADCAST_TERMS


def fit(weights: DataFrame, labels: DataFrame, vocab: DataFrame, id_col: str, classes: list, alpha: float = 1.0) -> DataFrame:
    """``(term, theta)`` with one smoothed log likelihood per class, in class order.

    ``ln((sum w_ct + alpha) / (sum w_c + alpha V))`` over the whole vocabulary.
    """
    joined = weights.join(labels, id_col)
    sums = [F.sum(F.when(F.col("label") == F.lit(k), F.col("weight")).otherwise(0.0)).alias(f"s{i}") for i, k in enumerate(classes)]
    per_term = vocab.select("term").join(joined.groupBy("term").agg(*sums), "term", "left")
    s = [F.coalesce(f"s{i}", F.lit(0.0)) for i in range(len(classes))]
    totals = per_term.agg(F.count("*").alias("v"), *[F.sum(x).alias(f"t{i}") for i, x in enumerate(s)]).first()
    theta = [F.ln((x + alpha) / F.lit(totals[f"t{i}"] + alpha * totals["v"])) for i, x in enumerate(s)]
    return per_term.select("term", F.array(*theta).alias("theta"))


def priors(labels: DataFrame, classes: list) -> list[float]:
    """Class log priors, not smoothed (one count per class on the driver)."""
    import math

    n = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    return [math.log(n[k] / sum(n.values())) for k in classes]


def score(docs: DataFrame, weights: DataFrame, model: DataFrame, log_priors: list[float], id_col: str, classes: list, capped: int | None) -> DataFrame:
    """Posterior per class, predicted class and its confidence; term-free documents get the priors."""
    table = F.broadcast(model) if capped is not None and capped <= BROADCAST_TERMS else model
    sums = [F.sum(F.col("weight") * F.col("theta")[i]).alias(f"j{i}") for i in range(len(classes))]
    joint = weights.join(table, "term").groupBy(id_col).agg(*sums)
    out = docs.select(id_col).join(joint, id_col, "left")
    js = [F.coalesce(f"j{i}", F.lit(0.0)) + F.lit(p) for i, p in enumerate(log_priors)]
    out = out.select(id_col, F.array(*js).alias("j")).withColumn("top", F.array_max("j"))
    total = F.aggregate("j", F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("top")))
    best = F.array_position("j", F.col("top")) - 1
    labels = F.array(*[F.lit(k) for k in classes])
    return out.select(
        id_col, F.get(labels, best.cast("int")).alias("pred"), (1 / total).alias("confidence"),
        *[(F.exp(F.col("j")[i] - F.col("top")) / total).alias(f"p_{k}") for i, k in enumerate(classes)])
