"""Bounded samples that don't depend on how the rows are spread."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARGIN, RANGE = 4, 1 << 31


def first_by_hash(rows: DataFrame, key: Column, most: int, count: int) -> DataFrame:
    """At most ``most`` rows, the first in md5 order of the key.

    Of a larger table (``count`` rows) a hash first leaves about MARGIN times as
    many, so that tasks don't each send ``most`` rows to the driver.
    """
    text = key.cast("string")
    if count > MARGIN * most:
        rows = rows.filter(F.pmod(F.xxhash64(text), F.lit(RANGE)) < int(RANGE * MARGIN * most / count))
    return rows.orderBy(F.md5(text.cast("binary")), text).limit(most)
