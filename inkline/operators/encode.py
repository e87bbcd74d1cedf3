"""Label and one-hot encoding, scaling, class weights.

``fit`` reads the training rows once and keeps one row of statistics; applying
it is a projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ranking import add_per_block, ordered_blocks


def label_encode(df: DataFrame, column: str, out: str) -> DataFrame:
    """Codes 0, 1, ... in sorted order of the distinct values; NULL keeps a NULL code.

    The distinct values are numbered inside range blocks, so no task holds all categories.
    """
    kinds = ordered_blocks(df.select(column).filter(F.col(column).isNotNull()).distinct(), column)
    earlier = W.orderBy("_block").rowsBetween(W.unboundedPreceding, -1)  # one row per block
    sizes = kinds.groupBy("_block").agg(F.count("*").alias("_n")).select("_block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy("_block").orderBy(column))
    codes = add_per_block(kinds.withColumn("_in", inside), sizes, []).select(column, (F.col("_before") + F.col("_in") - 1).cast("int").alias(out))
    return df.join(codes, column, "left")


def one_hot(df: DataFrame, column: str, categories: list[str] | None = None, most: int = 1000) -> DataFrame:
    """Indicator columns ``<column>_<category>``, the first category in sorted order dropped.

    Each category is a column, so more than ``most`` of them are an error.
    """
    if categories is None:
        found = df.select(column).filter(F.col(column).isNotNull()).distinct().limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"{column} has more than {most} categories; use label_encode")
        categories = sorted(r[0] for r in found)
    made = {f"{column}_{k}": F.when(F.col(column) == k, 1).otherwise(0) for k in categories[1:]}
    return df.withColumns(made).drop(column)


def _stats(df: DataFrame, columns: list[str], fns: dict) -> dict[str, dict[str, float]]:
    row = df.agg(*[fn(c).alias(f"{k}__{c}") for k, fn in fns.items() for c in columns]).first()
    return {k: {c: row[f"{k}__{c}"] for c in columns} for k in fns}


def fit_standard(df: DataFrame, columns: list[str]) -> dict:
    """Mean and population deviation; a constant column is divided by 1."""
    return _stats(df, columns, {"mean": F.avg, "std": F.stddev_pop})


def standard_scale(df: DataFrame, fitted: dict) -> DataFrame:
    mean, std = fitted["mean"], fitted["std"]
    return df.withColumns({c: (F.col(c) - F.lit(mean[c])) / F.lit(std[c] or 1.0) for c in mean})


def fit_vector(df: DataFrame, vector: str) -> dict[str, list[float]]:
    """Mean and population deviation of each dimension of an array column; a constant dimension is divided by 1."""
    per = df.select(F.posexplode(vector).alias("_d", "_x")).groupBy("_d").agg(F.avg("_x").alias("m"), F.stddev_pop("_x").alias("s"))
    rows = per.orderBy("_d").collect()  # one row per dimension
    return {"mean": [r["m"] for r in rows], "std": [r["s"] or 1.0 for r in rows]}


def scale_vector(df: DataFrame, vector: str, fitted: dict[str, list[float]]) -> DataFrame:
    stats = F.array(*[F.struct(F.lit(m).alias("m"), F.lit(s).alias("s")) for m, s in zip(fitted["mean"], fitted["std"])])
    return df.withColumn(vector, F.zip_with(vector, stats, lambda x, f: (x - f["m"]) / f["s"]))


def fit_minmax(df: DataFrame, columns: list[str]) -> dict:
    return _stats(df, columns, {"lo": F.min, "hi": F.max})


def minmax_scale(df: DataFrame, fitted: dict) -> DataFrame:
    lo, hi = fitted["lo"], fitted["hi"]
    return df.withColumns({c: (F.col(c) - F.lit(float(lo[c]))) / F.lit(float(hi[c] - lo[c]) or 1.0) for c in lo})


def fit_shift(df: DataFrame, columns: list[str]) -> dict:
    return _stats(df, columns, {"lo": F.min})


def shift_nonneg(df: DataFrame, fitted: dict, eps: float = 1e-9) -> DataFrame:
    """Columns with a negative minimum move up by ``|min| + eps``; unseen lower values clip at 0."""
    moved = {}
    for c, lo in fitted["lo"].items():
        x = F.col(c).cast("double")
        moved[c] = F.greatest(x + F.lit(abs(lo) + eps), F.lit(0.0)) if lo < 0 else F.greatest(x, F.lit(0.0))
    return df.withColumns(moved)


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """``n / (k n_c)`` per class and whether the largest and the smallest class differ by more than 10% of the rows."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    every = W.partitionBy(F.lit(0))  # one row per class
    n, k = F.sum("n").over(every), F.count("*").over(every)
    gap = F.max("n").over(every) - F.min("n").over(every)
    return counts.select("label", "n", (n / (k * F.col("n"))).alias("weight"), (gap > 0.1 * n).alias("imbalanced"))
