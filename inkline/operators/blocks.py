"""Exact all-against-all work in bounded blocks.

Rows are numbered into blocks of a fixed size by md5 rank, so no key, however
frequent, makes a block large. Every pair of a left and a right block is one
group of at most ``2 * rows_per_block`` rows; its result is folded inside the
task (nearest k, or sums per cluster), so pairs of rows are never emitted.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import hash_rank

ROWS_PER_BLOCK = 4096


def numbered(df: DataFrame, id_col: str, rows_per_block: int) -> tuple[DataFrame, int]:
    n = df.count()
    blocks = max(1, -(-n // rows_per_block))
    ranked = hash_rank(df, id_col, rank="_rn")
    return ranked.withColumn("_block", ((F.col("_rn") - 1) % blocks).cast("int")).drop("_rn"), blocks


def block_pairs(left: DataFrame, right: DataFrame, left_id: str, right_id: str, fold: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
                schema: str, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Apply ``fold(left_rows, right_rows)`` to every pair of blocks.

    Each left row is sent once per right block and the other way round; with
    n and m rows that is ``n * m / rows_per_block`` rows each way, against
    ``n * m`` for a cross join.
    """
    a, na = numbered(left, left_id, rows_per_block)
    b, nb = numbered(right, right_id, rows_per_block)
    a = a.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(nb - 1)))).withColumnsRenamed({"_block": "_l", "_other": "_r"})
    b = b.withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(na - 1)))).withColumnsRenamed({"_block": "_r", "_other": "_l"})
    b = b.select(*[F.col(c).alias(f"b_{c}") for c in b.columns])  # both sides may be the same table
    pairs = a.groupBy("_l", "_r").cogroup(b.groupBy("b__l", "b__r"))
    return pairs.applyInPandas(lambda x, y: fold(x, y.rename(columns=lambda name: name[2:])), schema)
