"""Exact ranks and running totals without a single-task window.

A window over a whole table, or over one class that holds a third of it, sorts
everything in one task. Here rows first fall into ordered buckets, the window
runs inside a bucket, and the totals of the earlier buckets are added back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut

HASH_BUCKET_DIGITS = 3  # 4096 buckets, uniform because md5 is


def ordered_blocks(df: DataFrame, *order: str) -> DataFrame:
    """Rows in range partitions of their order, with the partition's number as ``_block``; written, so the numbers hold.

    Windows then run inside a block, and what earlier blocks add is one row per key and block.
    """
    return cut(df.repartitionByRange(*order).withColumn("_block", F.spark_partition_id()))


def add_per_block(rows: DataFrame, per: DataFrame, keys: list[str]) -> DataFrame:
    """Adds the columns of ``per``, which has one row per key and block; NULL keys match."""
    names = [*keys, "_block"]
    per = per.withColumnsRenamed({k: f"_j_{k}" for k in names})
    match = F.lit(True)
    for k in names:
        match = match & F.col(k).eqNullSafe(F.col(f"_j_{k}"))
    return rows.join(per, match, "left").drop(*[f"_j_{k}" for k in names])


def hash_order(id_col: str) -> Column:
    """Reproducible shuffle order: md5 of the id as text."""
    return F.md5(F.col(id_col).cast("string"))


def hash_rank(df: DataFrame, id_col: str, keys: list[str] | None = None, rank: str = "rn", total: str | None = None) -> DataFrame:
    """Exact ``row_number`` (and group size) in md5 order, over all rows or per key."""
    by = list(keys or [])
    h = df.withColumn("_h", hash_order(id_col)).withColumn("_b", F.substring("_h", 1, HASH_BUCKET_DIGITS))
    sizes = h.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    # at most 4096 rows per key from here to the join
    earlier = W.partitionBy(*by).orderBy("_b").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(k).alias(f"_k_{k}") for k in by],
        F.col("_b").alias("_kb"),
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(W.partitionBy(*by)).alias("_total"),
    )
    match = F.col("_b") == F.col("_kb")
    for k in by:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = F.row_number().over(W.partitionBy(*by, "_b").orderBy("_h", id_col))
    ranked = h.withColumn("_in", inside).join(offsets if by else F.broadcast(offsets), match, "left")
    out = [*df.columns, (F.col("_before") + F.col("_in")).alias(rank)]
    if total:
        out.append(F.col("_total").alias(total))
    return ranked.select(*out)


def running_totals(
    df: DataFrame, order: str, sums: list[str], keys: list[str] | None = None, descending: bool = False,
    next_value: str | None = None, few_keys: bool = False,
) -> DataFrame:
    """Running sums ``cum_<x>`` and key totals ``all_<x>`` in the order of a numeric column.

    Rows must be distinct in ``(keys, order)``. Bucket bounds are approximate
    quantiles of the data, so buckets stay even whatever the distribution; the
    sums are exact for any bounds. ``next_value`` names an extra column with
    the following value of ``order``. Without keys, or with keys the caller knows
    to be few (features, classes, models), the cut points and offsets are a
    bounded table and are broadcast; otherwise the optimiser sizes them.
    """
    spark = df.sparkSession
    buckets = max(2, min(256, int(spark.conf.get("spark.sql.shuffle.partitions", "200"))))
    by = list(keys or ["_all"])
    hint = F.broadcast if few_keys or not keys else (lambda x: x)
    base = df if keys else df.withColumn("_all", F.lit(0))
    cuts = [i / buckets for i in range(1, buckets)]
    # one row per key with a bounded array of cut points
    bounds = base.groupBy(*by).agg(F.percentile_approx(order, cuts, 1000).alias("_cuts"))
    cut = base.join(hint(bounds), by).withColumn(
        "_b", F.size(F.filter("_cuts", lambda x: x < F.col(order)))).drop("_cuts")
    sign = F.col(order).desc() if descending else F.col(order).asc()
    bucket_order = F.col("_b").desc() if descending else F.col("_b").asc()
    edge = F.max(order) if descending else F.min(order)
    summary = cut.groupBy(*by, "_b").agg(edge.alias("_edge"), *[F.sum(x).alias(f"_s_{x}") for x in sums])
    w = W.partitionBy(*by).orderBy(bucket_order)
    offsets = summary.select(
        *by, "_b", F.lead("_edge").over(w).alias("_next"),
        *[F.coalesce(F.sum(f"_s_{x}").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias(f"_o_{x}") for x in sums],
        *[F.sum(f"_s_{x}").over(W.partitionBy(*by)).alias(f"all_{x}") for x in sums],
    )
    inner = W.partitionBy(*by, "_b").orderBy(sign)
    upto = inner.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = cut.select(
        *base.columns, "_b", F.lead(order).over(inner).alias("_lead"),
        *[F.sum(x).over(upto).alias(f"_c_{x}") for x in sums],
    )
    out = [*df.columns]
    for x in sums:
        out += [(F.col(f"_c_{x}") + F.col(f"_o_{x}")).alias(f"cum_{x}"), F.col(f"all_{x}")]
    if next_value:
        out.append(F.coalesce("_lead", "_next").alias(next_value))
    return local.join(hint(offsets), [*by, "_b"]).select(*out)
