"""Reproducible splits: exact class counts, membership by md5 of the id."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ranking import hash_order, hash_rank

BLOCK = 8192  # rows of a bootstrap block, about


def stratified(df: DataFrame, id_col: str, label: str, ratio: float = 0.2, out: str = "split") -> DataFrame:
    """``test`` gets ``max(1, round(n_c * ratio))`` rows of each class c, ``train`` the rest."""
    ranked = hash_rank(df, id_col, [label], "_rn", "_nc")
    quota = F.greatest(F.lit(1), F.bround(F.col("_nc") * F.lit(ratio)))
    return ranked.withColumn(out, F.when(F.col("_rn") <= quota, "test").otherwise("train")).drop("_rn", "_nc")


def three_way(df: DataFrame, id_col: str, label: str, test: float = 0.1, val: float = 0.1, out: str = "split") -> DataFrame:
    """Stratified train / val / test; val is a share of what the test split leaves.

    Both stages cut the same md5 order, so one ranking serves both.
    """
    ranked = hash_rank(df, id_col, [label], "_rn", "_nc")
    n_test = F.greatest(F.lit(1), F.bround(F.col("_nc") * F.lit(test)))
    rest = F.col("_nc") - n_test
    n_val = F.greatest(F.lit(1), F.bround(rest * F.lit(val / (1 - test))))
    kind = F.when(F.col("_rn") <= n_test, "test").when(F.col("_rn") <= n_test + n_val, "val").otherwise("train")
    return ranked.withColumn(out, kind).drop("_rn", "_nc")


def random_split(df: DataFrame, id_col: str, test: float = 0.2, val: float = 0.0, out: str = "split") -> DataFrame:
    """Unstratified split with exact sizes; ``val`` is a share of the non-test rows."""
    ranked = hash_rank(df, id_col, None, "_rn", "_nc")
    n_test = F.bround(F.col("_nc") * F.lit(test))
    n_val = F.bround((F.col("_nc") - n_test) * F.lit(val))
    kind = F.when(F.col("_rn") <= n_test, "test").when(F.col("_rn") <= n_test + n_val, "val").otherwise("train")
    return ranked.withColumn(out, kind).drop("_rn", "_nc")


def k_folds(df: DataFrame, id_col: str, label: str, k: int = 5, out: str = "fold") -> DataFrame:
    """Stratified fold number 0..k-1."""
    ranked = hash_rank(df, id_col, [label], "_rn")
    return ranked.withColumn(out, ((F.col("_rn") - 1) % k).cast("int")).drop("_rn")


def bootstrap(df: DataFrame, id_col: str, seed: int = 42, out: str = "copies") -> DataFrame:
    """Draws with replacement, exactly as many as there are rows: every row drawn and how often.

    The draws are split between hashed blocks of about BLOCK rows by binomials, half against half, and each
    block then draws among its rows in md5 order. The driver holds one count per block; the result depends on ids and
    seed alone. Rows that share an id are told apart by their order within the block only, so ids should differ.
    """
    n = df.count()
    depth = max(0, (n // BLOCK).bit_length())
    marked = df.withColumn("_h", hash_order(id_col))
    if depth:
        marked = marked.withColumn("_block", F.shiftright(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long"), 32 - depth).cast("int"))
    else:
        marked = marked.withColumn("_block", F.lit(0))
    sizes = [0] * (1 << depth)
    for r in marked.groupBy("_block").count().collect():
        sizes[r["_block"]] = r["count"]
    spark = df.sparkSession
    shares = spark.createDataFrame([(b, m, k) for b, (m, k) in enumerate(zip(sizes, draws_per_block(sizes, n, seed))) if m], "_b int, _m long, _k long")

    def drawn(parts):
        for part in parts:
            for b, m, k in part.itertuples(index=False):
                places, times = np.unique(np.random.default_rng([seed, 1, b]).integers(0, m, k), return_counts=True)
                yield pd.DataFrame({"_b": b, "_rank": places + 1, "_times": times})

    picks = shares.mapInPandas(drawn, "_b int, _rank long, _times long")
    ranked = marked.withColumn("_rank", F.row_number().over(W.partitionBy("_block").orderBy("_h", id_col)).cast("long"))
    joined = ranked.withColumnRenamed("_block", "_b").join(picks, ["_b", "_rank"])
    return joined.select(*df.columns, F.col("_times").cast("long").alias(out))


def draws_per_block(sizes: list[int], n: int, seed: int) -> list[int]:
    """A multinomial draw of ``n`` over the blocks, by binomials down a binary tree of them."""
    if len(sizes) == 1:
        return [n]
    half = len(sizes) // 2
    left, right = sum(sizes[:half]), sum(sizes[half:])
    rng = np.random.default_rng([seed, 0, len(sizes), n, left, right])
    k = int(rng.binomial(n, left / (left + right))) if left + right else 0
    return draws_per_block(sizes[:half], k, seed + 1) + draws_per_block(sizes[half:], n - k, seed + 2)
