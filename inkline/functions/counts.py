"""Frequency tables of one array, computed inside the row.

A document is one row, so its token frequencies need no exchange: sort the
array, find where runs end, take differences. That is O(n log n) per row, and
a corpus-wide feature pass stays a narrow scan -> project plan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def run_ends(ordered: Column) -> Column:
    """1-based positions at which a run of equal values ends in a sorted array.

    ``ordered`` must be a plain column reference: it is read once per element.
    """
    n = F.size(ordered)
    ends = F.filter(
        F.sequence(F.lit(1), n),
        lambda i: (i == n) | (F.get(ordered, i - 1) != F.get(ordered, i)),
    )
    return F.when(n > 0, ends).otherwise(F.array().cast("array<int>"))


def run_lengths(ends: Column) -> Column:
    """Frequencies of the distinct values, in sorted order of the values."""
    starts = F.slice(F.concat(F.array(F.lit(0)), ends), F.lit(1), F.size(ends))
    return F.zip_with(ends, starts, lambda e, s: e - s)


def term_counts(ordered: Column, ends: Column, lengths: Column) -> Column:
    """``array<struct<term, tf>>`` from a sorted array and its runs."""
    return F.zip_with(
        ends,
        lengths,
        lambda e, c: F.struct(F.get(ordered, e - 1).alias("term"), c.cast("long").alias("tf")),
    )


def sum_squares(freqs: Column) -> Column:
    return F.aggregate(freqs, F.lit(0).cast("long"), lambda acc, c: acc + c.cast("long") * c.cast("long"))


def entropy_nats(freqs: Column, total: Column) -> Column:
    """``ln n - (sum f ln f) / n``: the Shannon entropy of the frequencies."""
    flogf = F.aggregate(freqs, F.lit(0.0), lambda acc, c: acc + c * F.ln(c.cast("double")))
    n = total.cast("double")
    return F.when(total > 0, F.ln(n) - flogf / n).otherwise(F.lit(0.0))


def char_frequencies(text: Column) -> Column:
    """Frequencies of the distinct characters: sort them, then measure the runs."""
    ordered = F.array_join(F.sort_array(F.split(text, "")), "")
    return F.transform(F.regexp_extract_all(ordered, F.lit(r"(?s)(.)\1*+"), F.lit(0)), F.length)
