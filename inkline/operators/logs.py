"""Training-log analytics: smoothing, as-of join, checkpoints, early stopping."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ranking import add_per_block, ordered_blocks, running_totals


def ema_smooth(df: DataFrame, order: str, value: str, span: int = 20, by: list[str] | None = None, out: str = "ema") -> DataFrame:
    """Exponentially weighted mean with bias-adjusted weights, exact to double precision.

    A series is cut into blocks of rows. Inside a block the recurrence is a
    running sum of rescaled values; a block's end value then reaches the next
    four blocks with its decay. With blocks of 24 / -ln(decay) rows anything
    older has weight below e^-96, far under double precision, so one long
    series is smoothed by many tasks. A NULL value has no weight but ages the
    ones before it; a row without any value in reach gets NULL.
    """
    keys = list(by or [])
    decay = 1 - 2.0 / (span + 1)
    size = max(1, math.ceil(24 / -math.log(decay)))
    d = F.lit(decay)
    pos = running_totals(df.withColumn("_one", F.lit(1)), order, ["_one"], keys)
    rows = pos.withColumn("_pos", F.col("cum__one") - 1).drop("_one", "cum__one", "all__one")
    rows = rows.withColumns({"_block": F.floor(F.col("_pos") / size), "_o": F.col("_pos") % size})
    upto = W.partitionBy(*keys, "_block").orderBy("_pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    parts = {"_value": F.coalesce(F.col(value).cast("double"), F.lit(0.0)), "_weight": F.col(value).isNotNull().cast("double")}
    rows = rows.withColumns({k: F.sum(x * F.pow(d, -F.col("_o"))).over(upto) * F.pow(d, F.col("_o")) for k, x in parts.items()})
    ends = rows.groupBy(*keys, "_block").agg(F.max_by(F.struct(*parts), "_o").alias("_end"))
    reach = ends.select(*keys, "_block", "_end", F.explode(F.array(*[F.lit(j) for j in range(1, 5)])).alias("_j"))
    carry = reach.groupBy(*keys, (F.col("_block") + F.col("_j")).alias("_block")).agg(
        *[F.sum(F.col(f"_end.{k}") * F.pow(d, (F.col("_j") - 1) * size)).alias(f"_carry{k}") for k in parts])
    num, den = (F.col(k) + F.coalesce(f"_carry{k}", F.lit(0.0)) * F.pow(d, F.col("_o") + 1) for k in parts)
    return rows.join(carry, [*keys, "_block"], "left").select(*df.columns, F.try_divide(num, den).alias(out))


def asof_join(left: DataFrame, right: DataFrame, on: str, by: list[str] | None = None) -> DataFrame:
    """Each left row with the latest right row at or before it.

    The number of right rows up to a point is that row's rank, so after one
    bucketed running count the as-of join is an equi-join on the rank. Right
    rows must be distinct in ``(by, on)``; their other columns are added. A left
    row whose ``on`` is NULL is kept without a match.
    """
    keys = list(by or [])
    points = left.select(*keys, on, F.lit(0).alias("_r")).unionByName(right.select(*keys, on, F.lit(1).alias("_r")))
    points = points.filter(F.col(on).isNotNull()).groupBy(*keys, on).agg(F.max("_r").alias("_r"))
    ranks = running_totals(points, on, ["_r"], keys).select(*keys, on, F.col("cum__r").alias("_rank"))
    values = [c for c in right.columns if c not in (*keys, on)]
    found = right.join(ranks, [*keys, on]).select(*keys, "_rank", F.col(on).alias(f"{on}_matched"), *values)
    return left.join(ranks, [*keys, on], "left").join(found, [*keys, "_rank"], "left").drop("_rank")


def normalise_columns(df: DataFrame, columns: list[str], flip: tuple[str, ...] = ()) -> DataFrame:
    """Min-max scale of metric columns; those where lower is better are flipped."""
    row = df.agg(*[f(c).alias(f"{k}_{c}") for c in columns for k, f in (("lo", F.min), ("hi", F.max))]).first()
    out = {}
    for c in columns:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        x = (F.col(c) - F.lit(lo)) / F.lit((hi - lo) or 1.0)
        out[c] = 1 - x if c in flip else x
    return df.withColumns(out)


def best_checkpoint(df: DataFrame, step: str = "step", metric: str = "f1") -> DataFrame:
    """The step with the highest metric; the earliest one on ties."""
    return df.agg(F.max_by(F.struct(*df.columns), F.struct(F.col(metric), -F.col(step))).alias("x")).select("x.*")


def loss_deltas(df: DataFrame, step: str = "step", train: str = "train_loss", val: str = "val_loss", by: list[str] | None = None) -> DataFrame:
    """Generalisation gap and step-to-step improvement (one row per logged step of a run).

    The log is read in range blocks; a block's first row takes the last value of the block before.
    """
    keys = list(by or [])
    rows = ordered_blocks(df, *keys, step)
    inner = W.partitionBy(*keys, "_block").orderBy(step)
    ends = rows.groupBy(*keys, "_block").agg(F.max_by(val, F.struct(step)).alias("_end"))
    ends = ends.select(*keys, "_block", F.lag("_end").over(W.partitionBy(*keys).orderBy("_block")).alias("_before"))  # one row per block
    rows = add_per_block(rows.withColumns({"_lag": F.lag(val).over(inner), "_in": F.row_number().over(inner)}), ends, keys)
    earlier = F.when(F.col("_in") == 1, F.col("_before")).otherwise(F.col("_lag"))
    return rows.select(*df.columns, (F.col(val) - F.col(train)).alias("gap"), (earlier - F.col(val)).alias("improvement"))


def early_stop(df: DataFrame, step: str = "step", loss: str = "val_loss", patience: int = 3, by: list[str] | None = None) -> DataFrame:
    """Best step before training stops, and the step at which patience runs out (NULL if it never does).

    A step is an improvement when its loss is strictly below all earlier ones;
    patience counts the steps since. The log is read in range blocks: row
    numbers, the least loss and the last improvement of earlier blocks are added
    to what a window inside the block finds.
    """
    keys = list(by or ["_all"])
    rows = ordered_blocks(df if by else df.withColumn("_all", F.lit(0)), *keys, step)
    inner = W.partitionBy(*keys, "_block").orderBy(step)
    past = inner.rowsBetween(W.unboundedPreceding, -1)
    earlier = W.partitionBy(*keys).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)  # one row per block
    sizes = rows.groupBy(*keys, "_block").agg(F.count("*").alias("_s"), F.min(loss).alias("_m"))
    sizes = sizes.select(*keys, "_block", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_before"), F.min("_m").over(earlier).alias("_least"))
    rows = add_per_block(rows, sizes, keys)
    rows = rows.withColumns({"_n": F.row_number().over(inner) + F.col("_before"), "_min": F.least(F.min(loss).over(past), F.col("_least"))})
    rows = rows.withColumn("_hit", F.when(F.col("_min").isNull() | (F.col(loss) < F.col("_min")), F.col("_n")))
    hits = rows.groupBy(*keys, "_block").agg(F.max("_hit").alias("_h"))
    rows = add_per_block(rows, hits.select(*keys, "_block", F.max("_h").over(earlier).alias("_found")), keys)
    last = F.greatest(F.max("_hit").over(inner.rowsBetween(W.unboundedPreceding, W.currentRow)), F.col("_found"))
    rows = rows.withColumn("_late", F.col("_n") - last >= patience)
    stops = rows.groupBy(*keys).agg(F.min(F.when(F.col("_late"), F.col("_n"))).alias("_stop")).withColumnsRenamed({k: f"_k_{k}" for k in keys})
    match = F.lit(True)
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    kept = rows.join(stops, match).filter(F.col("_stop").isNull() | (F.col("_n") <= F.col("_stop")))
    return kept.groupBy(*(by or [])).agg(
        F.min_by(step, F.when(F.col(loss).isNotNull(), F.struct(F.col(loss), F.col(step)))).alias("best_step"), F.min(loss).alias("best_loss"),
        F.max(F.when(F.col("_n") == F.col("_stop"), F.col(step))).alias("stop_step"), F.count("*").alias("steps_run"))
