"""Exact k-nearest-neighbour classification."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import ROWS_PER_BLOCK, block_pairs

ROWS_AT_ONCE = 64  # bounds the candidates of one product, also where all distances are equal
SLACK = 1e-9


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype("float64")


def nearest(test: DataFrame, train: DataFrame, test_id: str, train_id: str, vector: str, label: str, k: int, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``(test_id, rank, train_id, label, distance)``: the k nearest training rows by Euclidean distance, ties by id."""

    def fold(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if len(x) == 0 or len(y) == 0:
            return pd.DataFrame({"_t": [], "_i": [], "_y": [], "_d": []})
        own, ids, labels = x[test_id].to_numpy(), y[train_id].to_numpy(), y[label].to_numpy()
        p, q = _matrix(x[vector]), _matrix(y[vector])
        norms, last, out = (q * q).sum(axis=1), min(k, len(q)) - 1, []
        for a in range(0, len(p), ROWS_AT_ONCE):
            part = p[a : a + ROWS_AT_ONCE]
            size = (part * part).sum(axis=1)[:, None]
            near = size + norms - 2 * part @ q.T
            # the product is inexact: all that may belong to the k nearest are measured by their differences
            within = np.partition(near, last, axis=1)[:, last][:, None] + SLACK * (size + norms.max())
            i, j = np.nonzero(near <= within)
            d = np.sqrt(((q[j] - part[i]) ** 2).sum(axis=1))
            order = np.lexsort((ids[j], d, i))
            i, j, d = i[order], j[order], d[order]
            best = np.arange(len(i)) - np.searchsorted(i, i) < k
            out.append(pd.DataFrame({"_t": own[a + i[best]], "_i": ids[j[best]], "_y": labels[j[best]], "_d": d[best]}))
        return pd.concat(out)

    found = block_pairs(test.select(test_id, vector), train.select(train_id, vector, label), test_id, train_id, fold,
                        "_t long, _i long, _y int, _d double", rows_per_block)
    # k candidates per training block and test row; a test row's group is k * blocks small structs
    ranked = found.groupBy("_t").agg(F.slice(F.array_sort(F.collect_list(F.struct("_d", "_i", "_y"))), 1, k).alias("n"))
    return ranked.select(F.col("_t").alias(test_id), F.posexplode("n").alias("rank", "n")).select(
        test_id, (F.col("rank") + 1).alias("rank"), F.col("n._i").alias(train_id), F.col("n._y").alias(label), F.col("n._d").alias("distance"))


def classify(test: DataFrame, train: DataFrame, test_id: str, train_id: str, vector: str, label: str, k: int = 3, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Majority vote of the k nearest; ties go to the smallest label."""
    near = nearest(test, train, test_id, train_id, vector, label, k, rows_per_block)
    votes = near.groupBy(test_id, label).agg(F.count("*").alias("v"))
    return votes.groupBy(test_id).agg(F.min_by(label, F.struct(-F.col("v"), F.col(label))).alias("pred"))
