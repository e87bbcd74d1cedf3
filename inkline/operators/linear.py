"""Regression line, least squares, and a single sigmoid unit trained by full-batch descent."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fit_line(df: DataFrame, x: str, y: str) -> tuple[float, float]:
    row = df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")).first()
    return row["slope"], row["intercept"]


def least_squares(df: DataFrame, features: list[str], y: str, tolerance: float = 1e-10) -> tuple[float, list[float]]:
    """(intercept, coefficients) of ordinary least squares: one aggregate of means and covariances, then a Cholesky factor on the driver.

    A feature whose variance the features before it explain but for ``tolerance`` is dependent and gets 0, as do constant
    ones. Rows with a null in any column are left out; without rows all are 0.
    """
    names = [*features, y]
    known = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)]).dropna()
    pairs = [(i, j) for i in range(len(names)) for j in range(i + 1)]
    row = known.agg(*[F.avg(f"x{i}").alias(f"m{i}") for i in range(len(names))], *[F.covar_pop(f"x{i}", f"x{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    d = len(features)
    cov = np.zeros((d + 1, d + 1))
    for i, j in pairs:
        cov[i, j] = cov[j, i] = row[f"c{i}_{j}"] or 0.0
    factor, kept = np.zeros((d, d)), []
    for i in range(d):
        for j in kept:
            factor[i, j] = (cov[i, j] - factor[i, :j] @ factor[j, :j]) / factor[j, j]
        rest = cov[i, i] - factor[i, :i] @ factor[i, :i]
        if rest > tolerance * max(cov[i, i], 1e-300):
            factor[i, i] = np.sqrt(rest)
            kept.append(i)
        else:
            factor[i] = 0.0
    lower = factor[np.ix_(kept, kept)]
    coefficients = np.zeros(d)
    if kept:
        coefficients[kept] = np.linalg.solve(lower.T, np.linalg.solve(lower, cov[kept, d]))
    intercept = (row[f"m{d}"] or 0.0) - float(sum(c * (row[f"m{i}"] or 0.0) for i, c in enumerate(coefficients)))
    return intercept, coefficients.tolist()


def predict_linear(df: DataFrame, features: list[str], intercept: float, coefficients: list[float], out: str = "yhat") -> DataFrame:
    value = F.lit(intercept)
    for name, c in zip(features, coefficients, strict=True):
        value = value + F.lit(c) * F.col(name)
    return df.withColumn(out, value)


def sigmoid(features: list[str], bias: float, weights: list[float]) -> Column:
    z = F.lit(bias)
    for name, w in zip(features, weights):
        z = z + F.lit(w) * F.col(name)
    return 1 / (1 + F.exp(-z))


def gradient_descent(df: DataFrame, features: list[str], y: str, steps: int, lr: float):
    """Yield ``(step, bias, weights, mse)``; one aggregate of d + 2 means per step, zero start.

    Each step reads the training rows once; cache them when they fit.
    """
    bias, weights = 0.0, [0.0] * len(features)
    for k in range(1, steps + 1):
        err = sigmoid(features, bias, weights) - F.col(y)
        row = df.agg(F.avg(err).alias("b"), F.avg(err * err).alias("mse"),
                     *[F.avg(err * F.col(f)).alias(f"g{i}") for i, f in enumerate(features)]).first()
        bias -= lr * row["b"]
        weights = [w - lr * row[f"g{i}"] for i, w in enumerate(weights)]
        yield k, bias, list(weights), row["mse"]


def gradient_descent_log(df: DataFrame, features: list[str], y: str, steps: int, lr: float) -> DataFrame:
    """Parameters after every step."""
    rows = [(k, b, *w) for k, b, w, _ in gradient_descent(df, features, y, steps, lr)]
    schema = "step int, bias double, " + ", ".join(f"w_{f} double" for f in features)
    return df.sparkSession.createDataFrame(rows, schema)


def predict_unit(df: DataFrame, features: list[str], bias: float, weights: list[float]) -> DataFrame:
    p = sigmoid(features, bias, weights)
    return df.withColumns({"p": p, "pred": F.when(p > 0.5, 1).otherwise(0)})
