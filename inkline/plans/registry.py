"""Query registry: a Spark callable and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def r6(col, digits: int = 6):
    """Rounded double, free of negative zero."""
    return F.round(col.cast("double"), digits) + F.lit(0.0)


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Uniform output types: whole numbers as long, doubles rounded."""
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("integer", "short", "byte"):
            out.append(f"cast(`{f.name}` as bigint) as `{f.name}`")
        elif kind in ("double", "float") or kind.startswith("decimal"):
            out.append(f"round(cast(`{f.name}` as double), {digits}) + 0D as `{f.name}`")
        else:
            out.append(f"`{f.name}`")
    return df.selectExpr(*out)
