"""AdaBoost (SAMME, two classes) with stumps over sparse term weights.

The weights are kept by column: per term the documents that hold it, in order of their weight. A round
adds up the row weights of both classes along each column; documents without the term are one block below it, the class totals less
the column. So the best stump of every term takes one prefix sum over its
documents, and the driver gets one candidate per task. Row weights reach the
tasks as one array while it is within MAX_DOCUMENTS; beyond that they are a
table, joined to the entries, and the prefix sums are windows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut

MAX_DOCUMENTS = 4_000_000  # 32 MB of row weights a round
DIGITS = 12
ROUNDS = 50


@dataclass(frozen=True)
class Stump:
    term: str
    threshold: float
    below: int  # class of the documents whose weight of the term is at most the threshold
    above: int
    error: float
    alpha: float


def columns(entries: DataFrame) -> DataFrame:
    """(term, docs, weights), both in order of the weights, from (number, term, weight); terms are dealt evenly."""
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    pairs = F.sort_array(F.collect_list(F.struct("weight", "number")))
    rows = entries.repartition(parts, "term").groupBy("term").agg(pairs.alias("p"))
    return rows.select("term", F.transform("p", lambda e: e["number"]).alias("docs"), F.transform("p", lambda e: e["weight"]).alias("weights"))


def best_cut(terms: list[str], sizes: np.ndarray, values: np.ndarray, rows: np.ndarray, total: np.ndarray) -> tuple | None:
    """(Gini, term, threshold, class weights at or below it) of the best cut of all columns, which stand in a row, values ascending.

    ``rows`` holds the weight of each entry's document under its class. Zeros come first in every column.
    """
    if not len(values):
        return None
    of = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.cumsum(sizes) - sizes
    upto = np.cumsum(rows, axis=0)
    before = upto[starts] - rows[starts]
    zero = total - (upto[starts + sizes - 1] - before)
    inner = np.flatnonzero((of[1:] == of[:-1]) & (values[1:] != values[:-1]))
    left = np.vstack([zero, zero[of[inner]] + upto[inner] - before[of[inner]]])
    cut_ = np.concatenate([values[starts] / 2, (values[inner] + values[inner + 1]) / 2])
    column = np.concatenate([np.arange(len(sizes)), of[inner]])
    right = total - left
    ok = (left.sum(1) > 1e-15) & (right.sum(1) > 1e-15)
    if not ok.any():
        return None
    left, right, cut_, column = left[ok], right[ok], cut_[ok], column[ok]
    cost = np.round(sum(s.sum(1) - (s * s).sum(1) / s.sum(1) for s in (left, right)), DIGITS)
    k = min(np.flatnonzero(cost == cost.min()), key=lambda i: (terms[column[i]], cut_[i]))
    return float(cost[k]), terms[column[k]], float(cut_[k]), *left[k].tolist()


def best_of_columns(table: DataFrame, weights: np.ndarray, labels: np.ndarray) -> tuple | None:
    total = np.bincount(labels, weights, 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in batches:
            docs = batch.column("docs").flatten().to_numpy()
            rows = np.zeros((len(docs), 2))
            rows[np.arange(len(docs)), labels[docs]] = weights[docs]
            found.append(best_cut(batch.column("term").to_pylist(), batch.column("docs").value_lengths().to_numpy().astype(np.int64),
                                  batch.column("weights").flatten().to_numpy(), rows, total))
        best = min((f for f in found if f), default=None)
        if best:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in best], ["gini", "term", "threshold", "l0", "l1"])

    return min((tuple(r) for r in table.mapInArrow(run, "gini double, term string, threshold double, l0 double, l1 double").collect()), default=None)


def best_by_join(entries: DataFrame, rows: DataFrame) -> tuple | None:
    """The same from (number, term, weight) and (number, label, w) as tables."""
    total = rows.groupBy().agg(*[F.sum(F.when(F.col("label") == k, F.col("w")).otherwise(0.0)).alias(f"t{k}") for k in (0, 1)]).first()
    per = entries.join(rows, "number").groupBy("term", F.col("weight").alias("v")).agg(
        *[F.sum(F.when(F.col("label") == k, F.col("w")).otherwise(0.0)).alias(f"c{k}") for k in (0, 1)])
    zero = per.groupBy("term").agg(*[(F.lit(total[f"t{k}"]) - F.sum(f"c{k}")).alias(f"c{k}") for k in (0, 1)]).withColumn("v", F.lit(0.0))
    order = W.partitionBy("term").orderBy("v")  # a term's distinct weights
    left = [F.sum(f"c{k}").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)).alias(f"l{k}") for k in (0, 1)]
    cuts = per.unionByName(zero).select("term", "v", F.lead("v").over(order).alias("next"), *left).filter("next is not null")

    def cost(a: Column, b: Column) -> Column:
        return a + b - (a * a + b * b) / (a + b)

    right = [F.lit(total[f"t{k}"]) - F.col(f"l{k}") for k in (0, 1)]
    cuts = cuts.filter((F.col("l0") + F.col("l1") > 1e-15) & (right[0] + right[1] > 1e-15))
    one = F.struct(F.round(cost(F.col("l0"), F.col("l1")) + cost(*right), DIGITS).alias("gini"), "term", ((F.col("v") + F.col("next")) / 2).alias("threshold"), "l0", "l1")
    best = cuts.agg(F.min(one).alias("b")).first()["b"]
    return tuple(best) if best else None


def stump_of(best: tuple, total: np.ndarray) -> Stump:
    """Each side votes for its heavier class, the first of equals; error and vote weight follow from the four sums."""
    _, term, threshold, *left = best
    left = np.array(left)
    right = total - left
    below, above = int(left[1] > left[0]), int(right[1] > right[0])
    error = float((left[1 - below] + right[1 - above]) / total.sum())
    e = min(max(error, 1e-10), 1 - 1e-10)
    return Stump(term, threshold, below, above, error, math.log((1 - e) / e))


def fit(entries: DataFrame, labels: DataFrame, id_col: str, rounds: int = ROUNDS) -> list[Stump]:
    """Stumps of up to ``rounds`` rounds over (id, term, weight > 0) and (id, label 0 or 1); ends with a perfect stump or one no better than chance.

    Documents without entries take part with the weights of their zeros. Ties go to the first term, then to the smallest threshold.
    """
    n = labels.count()
    return fit_by_columns(entries, labels, id_col, rounds) if n <= MAX_DOCUMENTS else fit_by_joins(entries, labels, id_col, rounds, n)


def fit_by_columns(entries: DataFrame, labels: DataFrame, id_col: str, rounds: int) -> list[Stump]:
    spark = labels.sparkSession
    listed = labels.select(F.col(id_col).alias("id"), F.col("label").cast("int")).orderBy("id").toArrow()
    y = listed.column("label").to_numpy().astype(np.int64)
    numbers = spark.createDataFrame(pa.table({id_col: listed.column("id"), "number": np.arange(len(y))}))
    table = cut(columns(entries.join(numbers, id_col).select("number", "term", "weight"))).persist()
    w, out = np.full(len(y), 1.0 / max(len(y), 1)), []
    for _ in range(rounds):
        best = best_of_columns(table, w, y)
        if best is None:
            break
        s = stump_of(best, np.bincount(y, w, 2))
        if s.error >= 0.5 and out:
            break
        out.append(s)
        if s.error <= 1e-10 or s.error >= 0.5:
            break
        held = table.filter(F.col("term") == s.term).select("docs", "weights").first()
        pred = np.full(len(y), s.below)
        pred[np.array(held["docs"])[np.array(held["weights"]) > s.threshold]] = s.above
        w = w * np.where(pred != y, math.exp(s.alpha), 1.0)
        w /= w.sum()
    table.unpersist()
    return out


def fit_by_joins(entries: DataFrame, labels: DataFrame, id_col: str, rounds: int, n: int) -> list[Stump]:
    entries = cut(entries.select(F.col(id_col).alias("number"), "term", "weight"))
    rows, out = cut(labels.select(F.col(id_col).alias("number"), F.col("label").cast("int").alias("label"), F.lit(1.0 / max(n, 1)).alias("w"))), []
    for _ in range(rounds):
        best = best_by_join(entries, rows)
        if best is None:
            break
        total = rows.agg(*[F.sum(F.when(F.col("label") == k, F.col("w")).otherwise(0.0)) for k in (0, 1)]).first()
        s = stump_of(best, np.array(total, float))
        if s.error >= 0.5 and out:
            break
        out.append(s)
        if s.error <= 1e-10 or s.error >= 0.5:
            break
        high = entries.filter((F.col("term") == s.term) & (F.col("weight") > s.threshold)).select("number", F.lit(True).alias("_high"))
        wrong = F.when(F.col("_high"), s.above).otherwise(s.below) != F.col("label")
        up = rows.join(high, "number", "left").select("number", "label", (F.col("w") * F.when(wrong, math.exp(s.alpha)).otherwise(1.0)).alias("w"))
        up = cut(up)
        scale = up.agg(F.sum("w")).first()[0]
        rows = up.withColumn("w", F.col("w") / scale)
    return out


def predict(entries: DataFrame, ids: DataFrame, model: list[Stump], id_col: str) -> DataFrame:
    """``ids`` with the alpha-weighted vote share of class 1 as ``p`` and its class ``pred``; only entries of the stumps' terms are read."""
    total = sum(s.alpha for s in model)
    start = sum(s.alpha * s.below for s in model)
    change = F.lit(0.0)
    for s in model:
        change = change + F.when((F.col("term") == s.term) & (F.col("weight") > s.threshold), s.alpha * (s.above - s.below)).otherwise(0.0)
    used = entries.filter(F.col("term").isin(sorted({s.term for s in model}))).groupBy(id_col).agg(F.sum(change).alias("_change"))
    p = (F.lit(start) + F.coalesce("_change", F.lit(0.0))) / F.lit(total)
    return ids.join(used, id_col, "left").withColumn("p", p).drop("_change").withColumn("pred", (F.col("p") > 0.5).cast("int"))
