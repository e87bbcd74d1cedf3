"""Cleaning, filtering, de-duplication and label normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .ranking import running_totals

LABEL_COLUMNS = ("label", "label_id", "is_ai", "class")
POSITIVE_LABELS = ("1", "ai", "AI", "machine", "bot")
MISDECODED = "Â"


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def repair(text: Column) -> Column:
    """Remove the mis-decoded mark, turn line breaks into blanks, strip."""
    return tx.flatten_lines(F.replace(text, F.lit(MISDECODED), F.lit("")))


def min_words(df: DataFrame, text: str = "text", least: int = 5) -> DataFrame:
    return df.filter(tx.count_pattern(F.col(text), tx.WORD) >= least)


def min_chars(df: DataFrame, text: str = "text", more_than: int = 10) -> DataFrame:
    return df.filter(F.length(tx.strip(F.col(text))) > more_than)


def not_blank(df: DataFrame, text: str = "text") -> DataFrame:
    return df.filter(tx.strip(F.col(text)) != "")


def keep_first(df: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """One row per distinct text: the one with the smallest ``order`` value.

    Grouping a digest combines on the map side, so a text that makes up a third
    of the corpus costs its reducer one row per map task; the texts themselves
    move only in the semi join on the unique ``order`` column.
    """
    winners = df.groupBy(F.sha2(F.col(text), 256).alias("_digest")).agg(F.min(order).alias(order)).select(order)
    return df.join(winners, order, "left_semi")


def binary_label(label: Column) -> Column:
    """1 for the positive spellings and for numeric 1, else 0 (NULL counts as 0)."""
    as_text = label.cast("string")
    hit = as_text.isin(*POSITIVE_LABELS) | (F.expr("1D") == as_text.try_cast("double"))
    return F.when(F.coalesce(hit, F.lit(False)), 1).otherwise(0)


def with_binary_label(df: DataFrame, out: str = "label_binary") -> DataFrame:
    """Use the first label column present."""
    for name in LABEL_COLUMNS:
        if name in df.columns:
            return df.withColumn(out, binary_label(F.col(name)))
    raise ValueError(f"no label column among {df.columns}")


def cleaning_chain(df: DataFrame, text: str = "text", label: str = "label", order: str = "doc_id", max_chars: int | None = None) -> DataFrame:
    """Select, drop missing, cast, drop blank, de-duplicate, truncate, collapse whitespace."""
    out = drop_missing(df.select(order, text, label), [text, label])
    out = out.select(order, F.col(text).cast("string").alias(text), F.col(label).cast("int").alias(label))
    out = keep_first(not_blank(out, text), text, order)
    if max_chars is not None:
        out = out.withColumn(text, F.substring(text, 1, max_chars))
    return out.withColumn(text, tx.collapse_spaces(F.col(text)))


def tertile_cuts(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Exact lower and upper tertile of each column: the smallest values that cover 1/3 and 2/3 of the rows."""
    freq = df.select(*[F.col(n).cast("double").alias(n) for n in columns]).unpivot([], columns, "k", "v")
    freq = freq.filter(F.col("v").isNotNull()).groupBy("k", "v").agg(F.count("*").alias("n"))
    cum = running_totals(freq, "v", ["n"], ["k"], few_keys=True)

    def cover(part):
        return F.min(F.when(F.col("cum_n") * 3 >= F.col("all_n") * part, F.col("v")))

    rows = cum.groupBy("k").agg(cover(1).alias("lo"), cover(2).alias("hi")).collect()  # one row per column
    return {row["k"]: (row["lo"], row["hi"]) for row in rows}


def tertile_bins(df: DataFrame, columns: list[str], cuts: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """``LOW`` / ``MEDIUM`` / ``HIGH`` by the fitted cut points; NULL stays NULL."""
    cuts = cuts or tertile_cuts(df, columns)
    binned = {}
    for n in columns:
        lo, hi = cuts[n]
        binned[n] = (F.when(F.col(n).isNull(), F.lit(None).cast("string"))
                     .when(F.col(n) <= lo, "LOW").when(F.col(n) <= hi, "MEDIUM").otherwise("HIGH"))
    return df.withColumns(binned)
