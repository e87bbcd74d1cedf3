"""Feature scoring: entropy, gain, Gini, chi-square, mutual information, binary splits.

All features are scored in one job. Rows first collapse to distinct value
combinations, then go long as ``(feature, value, label, w)``; scores come from
tables with one row per distinct value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import ratio
from .ranking import running_totals


def xlog2x(x: Column) -> Column:
    x = x.cast("double")
    return F.when(x > 0, x * F.ln(x) / F.ln(F.lit(2.0))).otherwise(0.0)


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))


def entropy_of(total: Column, sum_xlogx: Column) -> Column:
    """Entropy in bits from the total and the sum of ``n log2 n`` over classes."""
    return F.when(total > 0, xlog2x(total) / total - sum_xlogx / total).otherwise(0.0)


def label_entropy(df: DataFrame, label: str = "label") -> DataFrame:
    c = label_counts(df, label)
    return c.agg(entropy_of(F.sum("n"), F.sum(xlog2x(F.col("n")))).alias("entropy"), F.sum("n").alias("n"))


def gini_impurity(df: DataFrame, label: str = "label") -> DataFrame:
    c = label_counts(df, label)
    n = F.sum("n").cast("double")
    return c.agg((1 - F.sum(F.col("n").cast("double") * F.col("n")) / (n * n)).alias("gini"), F.sum("n").alias("n"))


def value_class_counts(df: DataFrame, features: list[str], label: str = "label", weight: str | None = None, by: list[str] | None = None) -> DataFrame:
    """``(by..., feature, value, label, w)``; a NULL value is a missing one."""
    keys = list(by or [])
    w = F.sum(weight) if weight else F.count("*")
    packed = df.groupBy(*keys, *features, F.col(label).alias("label")).agg(w.cast("double").alias("w"))
    cells = packed.select(*keys, *[F.col(f).cast("string").alias(f) for f in features], "label", "w")
    long = cells.unpivot([*keys, "label", "w"], features, "feature", "value")
    return long.groupBy(*keys, "feature", "value", "label").agg(F.sum("w").alias("w"))


def feature_class_counts(df: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """Rows per feature value and class, missing values left out."""
    out = value_class_counts(df, features, label).filter(F.col("value").isNotNull())
    return out.select("feature", "value", "label", F.col("w").cast("long").alias("n"))


def gain_table(counts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Gain, split information and gain ratio per feature, with the missing share discounted."""
    keys = [*(by or []), "feature"]
    known = F.col("value").isNotNull()
    per_value = counts.groupBy(*keys, "value").agg(
        F.sum("w").alias("nv"), F.sum(xlog2x(F.col("w"))).alias("s"))
    per_value = per_value.withColumn("known", known)
    cond = per_value.groupBy(*keys).agg(
        F.sum("nv").alias("total"), F.sum(F.when(known, F.col("nv")).otherwise(0.0)).alias("k"),
        F.sum(F.when(known, xlog2x(F.col("nv")) - F.col("s"))).alias("cond"),
        F.sum(F.when(known, xlog2x(F.col("nv")))).alias("vlog"))
    base = counts.filter(known).groupBy(*keys, "label").agg(F.sum("w").alias("nl"))
    base = base.groupBy(*keys).agg(F.sum(xlog2x(F.col("nl"))).alias("llog"))
    m = 1 - F.col("k") / F.col("total")
    miss = F.when(m > 0, -m * F.ln(m) / F.ln(F.lit(2.0))).otherwise(0.0)
    gain = F.col("k") / F.col("total") * (entropy_of(F.col("k"), F.col("llog")) - F.col("cond") / F.col("k"))
    info = entropy_of(F.col("k"), F.col("vlog")) + miss
    out = cond.join(base, keys, "left").select(
        *keys, F.when(F.col("k") > 0, gain).otherwise(0.0).alias("gain"), F.when(F.col("k") > 0, info).otherwise(0.0).alias("split_info"))
    # a difference of logs that should be zero is noise of about 1e-16
    out = out.withColumns({"gain": F.round("gain", 12), "split_info": F.round("split_info", 12)})
    return out.withColumn("gain_ratio", F.when(F.col("split_info") > 0, F.col("gain") / F.col("split_info")).otherwise(0.0))


def position(features: list[str]) -> Column:
    """Index of the feature in the caller's order, the tie-break everywhere."""
    return F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature"))


def best_by_gain(gains: DataFrame, features: list[str], by: list[str] | None = None) -> DataFrame:
    order = F.struct(-F.col("gain"), position(features))
    return _pick(gains, order, by)


def best_by_gain_ratio(gains: DataFrame, features: list[str], by: list[str] | None = None) -> DataFrame:
    """Highest gain ratio among the features whose gain reaches the mean gain."""
    keys = by or [F.lit(0)]
    with_mean = gains.withColumn("_mean", F.avg("gain").over(W.partitionBy(*keys)))  # one row per feature
    good = with_mean.filter(F.col("gain") >= F.col("_mean") - 1e-12).drop("_mean")
    return _pick(good, F.struct(-F.round(F.col("gain_ratio"), 12), position(features)), by)


def _pick(table: DataFrame, order: Column, by: list[str] | None) -> DataFrame:
    value = F.struct(*[c for c in table.columns if c not in (by or [])])
    return table.groupBy(*(by or [])).agg(F.min_by(value, order).alias("_x")).select(*(by or []), "_x.*")


def gini_vs_entropy(counts: DataFrame) -> DataFrame:
    """Multiway weighted Gini and entropy per feature."""
    known = counts.filter(F.col("value").isNotNull())
    per = known.groupBy("feature", "value").agg(
        F.sum("w").alias("n"), F.sum(xlog2x(F.col("w"))).alias("s"), F.sum(F.col("w") * F.col("w")).alias("q"))
    n = F.sum("n")
    return per.groupBy("feature").agg(
        (F.sum(F.col("n") - F.col("q") / F.col("n")) / n).alias("gini"),
        (F.sum(xlog2x(F.col("n")) - F.col("s")) / n).alias("entropy"))


def numeric_columns(df: DataFrame) -> DataFrame:
    """Per column: do all non-empty values read as numbers?"""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    long = text.unpivot([], df.columns, "feature", "value").filter(F.coalesce(F.col("value"), F.lit("")) != "")
    return long.groupBy("feature").agg(F.bool_and(F.col("value").try_cast("double").isNotNull()).alias("is_numeric"))


def gini_from(parts: list[Column], total: Column) -> Column:
    q = parts[0] * parts[0]
    for p in parts[1:]:
        q = q + p * p
    return 1 - q / (total * total)


def add(parts: list[Column]) -> Column:
    out = parts[0]
    for p in parts[1:]:
        out = out + p
    return out


def class_columns(long: DataFrame, keys: list[str], classes: list) -> DataFrame:
    """One row per key with a weight column ``c0, c1, ...`` per class."""
    sums = [F.sum(F.when(F.col("label") == F.lit(k), F.col("w")).otherwise(0.0)).alias(f"c{i}") for i, k in enumerate(classes)]
    return long.groupBy(*keys).agg(*sums)


def split_candidates(df: DataFrame, numeric: list[str], categorical: list[str], classes: list, label: str = "label", by: list[str] | None = None) -> DataFrame:
    """All binary splits with their weighted Gini: midpoints of neighbouring
    distinct values for numeric features, one value against the rest otherwise.

    Class counts left of every cut are running totals over the distinct values
    (bucketed, so one feature's values never meet in one task).
    """
    by = list(by or [])
    cs = [f"c{i}" for i in range(len(classes))]
    keys = [*by, "feature"]
    out = None
    if numeric:
        wide = df.select(*by, F.col(label).alias("label"), *[F.col(f).cast("double").alias(f) for f in numeric])
        long = wide.unpivot([*by, "label"], numeric, "feature", "v").filter(F.col("v").isNotNull()).withColumn("w", F.lit(1.0))
        table = running_totals(class_columns(long, [*keys, "v"], classes), "v", cs, keys, next_value="nxt", few_keys=not by)
        left = [F.col(f"cum_{c}") for c in cs]
        right = [F.col(f"all_{c}") - F.col(f"cum_{c}") for c in cs]
        out = table.filter(F.col("nxt").isNotNull()).select(
            *keys, ((F.col("v") + F.col("nxt")) / 2).alias("threshold"), F.lit(None).cast("string").alias("value"),
            *_gini_columns(left, right))
    if categorical:
        counts = value_class_counts(df, categorical, label, by=by).filter(F.col("value").isNotNull())
        per = class_columns(counts, [*keys, "value"], classes)
        every = W.partitionBy(*keys)  # one row per distinct category
        left = [F.col(c) for c in cs]
        right = [F.sum(c).over(every) - F.col(c) for c in cs]
        cat = per.select(*keys, F.lit(None).cast("double").alias("threshold"), "value", *_gini_columns(left, right))
        out = cat if out is None else out.unionByName(cat)
    return out.filter((F.col("n_left") > 0) & (F.col("n_right") > 0))


def _gini_columns(left: list[Column], right: list[Column]) -> list[Column]:
    nl, nr = add(left), add(right)
    gl = F.when(nl > 0, gini_from(left, F.nullif(nl, F.lit(0.0)))).otherwise(0.0)
    gr = F.when(nr > 0, gini_from(right, F.nullif(nr, F.lit(0.0)))).otherwise(0.0)
    g = (nl * gl + nr * gr) / F.nullif(nl + nr, F.lit(0.0))
    return [F.round(g, 12).alias("gini"), nl.alias("n_left"), nr.alias("n_right")]


def best_split_per_feature(candidates: DataFrame, by: list[str] | None = None) -> DataFrame:
    return _pick(candidates, F.struct("gini", "threshold", "value"), [*(by or []), "feature"])


def best_split(candidates: DataFrame, features: list[str], by: list[str] | None = None) -> DataFrame:
    return _pick(candidates, F.struct(F.col("gini"), position(features), F.col("threshold"), F.col("value")), by)


def chi2_scores(df: DataFrame, features: list[str], label: str = "label") -> DataFrame:
    """Chi-square of per-class feature sums against the class priors (features must be non-negative)."""
    sums = df.groupBy(F.col(label).alias("label")).agg(
        F.count("*").alias("nc"), *[F.sum(F.col(f).cast("double")).alias(f) for f in features])
    n_all = F.sum("nc").over(W.partitionBy(F.lit(0)))  # one row per class from here on
    long = sums.withColumn("prior", F.col("nc") / n_all).unpivot(["label", "prior"], features, "feature", "observed")
    expected = F.col("prior") * F.sum("observed").over(W.partitionBy("feature"))
    term = F.try_divide((F.col("observed") - F.col("expected")) * (F.col("observed") - F.col("expected")), F.col("expected"))
    return long.withColumn("expected", expected).groupBy("feature").agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("score"))


def binned_mutual_information(df: DataFrame, features: list[str], label: str = "label", bins: int = 10) -> DataFrame:
    """Mutual information (nats) of the label with rank-based bins of each feature.

    The bin of a value follows from the share of rows strictly below it, so
    equal values share a bin.
    """
    wide = df.select(F.col(label).alias("label"), *[F.col(f).cast("double").alias(f) for f in features])
    cells = wide.unpivot(["label"], features, "feature", "v").groupBy("feature", "v", "label").agg(F.count("*").alias("w"))
    values = running_totals(cells.groupBy("feature", "v").agg(F.sum("w").alias("n")), "v", ["n"], ["feature"], few_keys=True)
    b = F.least(F.floor((F.col("cum_n") - F.col("n")) * bins / F.col("all_n")), F.lit(bins - 1)).cast("int")
    joint = cells.join(values.select("feature", "v", b.alias("bin")), ["feature", "v"])
    joint = joint.groupBy("feature", "bin", "label").agg(F.sum("w").alias("nxy"))
    nx, ny = (F.sum("nxy").over(W.partitionBy("feature", k)) for k in ("bin", "label"))
    n = F.sum("nxy").over(W.partitionBy("feature"))
    terms = joint.select("feature", (F.col("nxy") / n * F.ln(F.col("nxy").cast("double") * n / (nx.cast("double") * ny))).alias("t"))
    return terms.groupBy("feature").agg(F.sum("t").alias("score"))


def select_k_best(scores: DataFrame, features: list[str], k: int) -> DataFrame:
    """The k best features in the original column order (ties: earlier column first)."""
    one = W.partitionBy(F.lit(0)).orderBy(F.desc("score"), "position")  # one row per feature
    ranked = scores.withColumn("position", position(features)).withColumn("rank", F.row_number().over(one))
    return ranked.filter(F.col("rank") <= k).select("feature", "position", "rank", "score").orderBy("position")


def top_features(scores: DataFrame, n: int) -> DataFrame:
    return scores.orderBy(F.desc("score"), "feature").limit(n)
