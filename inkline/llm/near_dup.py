"""Near duplicates by b-bit MinHash over word shingles.

One pass over the texts makes, for each document, the set of its distinct
shingle hashes, ``HASHES`` minima of that set, one key per band of ``ROWS``
minima, and a packed signature that keeps ``BITS`` low bits of each minimum.
Documents of one shingle set are one class from then on. Bands propose pairs
of classes; the bits that two signatures share, corrected for the share that
agrees by chance, estimate their similarity; and pairs whose estimate is not
clearly too low are confirmed on the full shingle sets.

Pairs inside a bucket are never listed in full. First each class meets the
smallest class of each of its buckets, which joins a group of any size with
one pair per member and band. Only classes that are still apart afterwards meet
each other, on blocks of a bucket, and only pairs that pass the estimate leave
the join.

Bands of 4 minima, 24 times, miss a pair at similarity 0.75 with probability
1.1e-4; an estimate 3.5 standard deviations below the threshold adds 2.3e-4. The
signature is longer than the bands need, so that the estimate tells the many
pairs of a large group that are nearly similar from those that are.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import words as wd
from .graph import components

SHINGLE, PERCENT = 5, 75
ROWS, BANDS = 4, 24
HASHES = 384  # the first ROWS x BANDS of them make the bands
BITS, FIELDS = 2, 32  # fields of BITS bits to a long
PACKS = HASHES // FIELDS
DEVIATIONS = 3.5
BLOCK = 1024  # classes of one bucket that meet in one piece of the join
LOW_BITS = 0x5555555555555555

_rng = np.random.default_rng(7)
FACTOR = _rng.integers(0, 1 << 64, HASHES, dtype=np.uint64) | np.uint64(1)
SHIFT = _rng.integers(0, 1 << 64, HASHES, dtype=np.uint64)
SIGNATURE = [f"s{k}" for k in range(PACKS)]
SIGNED = f"doc_id long, n_shingles long, f1 long, f2 long, {' '.join(f'{s} long,' for s in SIGNATURE)} bands array<long>"


def minima(sets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """HASHES x rows: the minima of each non-empty set under each hash, 32 bits each."""
    starts = np.cumsum(sizes) - sizes
    out, work = np.empty((HASHES, len(sizes)), np.uint64), np.empty(len(sets), np.uint64)
    for k in range(HASHES):
        np.multiply(sets, FACTOR[k], out=work)
        np.add(work, SHIFT[k], out=work)
        out[k] = np.minimum.reduceat(work, starts)
    return out >> np.uint64(32)


def packed(lows: np.ndarray) -> np.ndarray:
    """PACKS x rows of BITS low bits of each minimum."""
    fields = (lows & np.uint64((1 << BITS) - 1)).reshape(PACKS, FIELDS, -1)
    out = np.zeros((PACKS, lows.shape[1]), np.uint64)
    for k in range(FIELDS):
        out |= fields[:, k] << np.uint64(BITS * k)
    return out


def band_keys(lows: np.ndarray) -> np.ndarray:
    """rows x BANDS keys, the band's number hashed in."""
    grouped = lows[: ROWS * BANDS].reshape(BANDS, ROWS, -1)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)[:, None] * np.uint64(wd.STEP[20])
    for k in range(ROWS):
        key = key + grouped[:, k] * np.uint64(wd.STEP[21 + k])
    return wd.mix(key).T


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures of (doc_id, text) batches; empty sets have no bands."""
    for batch in batches:
        data, offsets = wd.text_bytes(batch.column(1))
        for i, j in wd.row_blocks(offsets):
            at = offsets[i : j + 1]
            sets, sizes = wd.shingle_sets(data[at[0] : at[-1]], at - at[0], SHINGLE)
            rows, some = j - i, np.flatnonzero(sizes)
            cols = np.zeros((2 + PACKS, rows), np.uint64)
            keys = np.zeros((0, BANDS), np.uint64)
            if len(some):
                starts = (np.cumsum(sizes) - sizes)[some]
                cols[0, some] = np.add.reduceat(wd.mix(sets ^ np.uint64(wd.STEP[30])), starts)
                cols[1, some] = np.add.reduceat(wd.mix(sets ^ np.uint64(wd.STEP[31])), starts)
                lows = minima(sets, sizes[some])
                cols[2:, some], keys = packed(lows), band_keys(lows)
            ends = np.concatenate(([0], np.cumsum(np.where(sizes > 0, BANDS, 0)))).astype(np.int32)
            bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(keys).reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(i, rows), pa.array(sizes.astype(np.int64)), *[pa.array(c.view(np.int64)) for c in cols], bands],
                names=["doc_id", "n_shingles", "f1", "f2", *SIGNATURE, "bands"])


def least_matches(percent: int) -> int:
    """Fields that two signatures of a pair at the threshold share, less DEVIATIONS standard deviations."""
    chance = 0.5**BITS
    p = chance + (1 - chance) * percent / 100
    return max(0, ceil(HASHES * p - DEVIATIONS * sqrt(HASHES * p * (1 - p))))


def matches(left: str, right: str) -> Column:
    """Fields that agree, by bit counts: a field differs if any of its bits does."""
    differ = F.lit(0)
    for k in range(PACKS):
        x = F.col(f"{left}{k}").bitwiseXOR(F.col(f"{right}{k}"))
        differ = differ + F.bit_count((x.bitwiseOR(F.shiftrightunsigned(x, 1))).bitwiseAND(F.lit(LOW_BITS)))
    return F.lit(HASHES) - differ


def similarity(left: str, right: str) -> Column:
    """Estimated Jaccard similarity, corrected for fields that agree by chance."""
    chance = 0.5**BITS
    return F.greatest(F.lit(0.0), (matches(left, right) / HASHES - chance) / (1 - chance))


def confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Keeps (a, b) of (a, b, text_a, text_b) whose sets pass the threshold."""
        for batch in batches:
            sides = [wd.text_bytes(batch.column(k)) for k in (2, 3)]
            lengths = sides[0][1] + sides[1][1]
            good = np.zeros(batch.num_rows, bool)
            for i, j in wd.row_blocks(lengths):
                (x, nx), (y, ny) = (wd.shingle_sets(d[o[i] : o[j]], o[i : j + 1] - o[i], SHINGLE) for d, o in sides)
                ex, ey = np.cumsum(nx), np.cumsum(ny)
                for k in range(j - i):
                    both = len(np.intersect1d(x[ex[k] - nx[k] : ex[k]], y[ey[k] - ny[k] : ey[k]], assume_unique=True))
                    good[i + k] = both > 0 and 100 * both >= percent * (int(nx[k] + ny[k]) - both)
            keep = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], names=["a", "b"])

    return run


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of class ids whose documents' full sets pass. The texts cross the network, not the sets."""
    b = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("_tb"))
    a = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("_ta"))
    both = pairs.select("a", "b").join(b, "b").join(a, "a").select("a", "b", "_ta", "_tb")
    return cut(both.mapInArrow(confirm(percent), "a long, b long").distinct())


def near_duplicates(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Null, empty and blank texts have an empty set and link with nothing. A text
    of fewer than five words is one shingle. Rows that repeat a doc_id are one
    document with several texts, linked through any of them. A row without
    doc_id links with nothing and is kept, its component null. Other columns of
    ``docs`` are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = cut(docs.mapInArrow(sign, SIGNED))
    key = ["n_shingles", "f1", "f2"]
    some = signed.filter("n_shingles > 0 and doc_id is not null")
    classes = cut(some.groupBy(*key).agg(F.min("doc_id").alias("node"), F.count("*").alias("n_copies")))
    firsts = cut(some.join(classes.select(F.col("node").alias("doc_id"), *key), [*key, "doc_id"], "left_semi").dropDuplicates(["doc_id", *key]))

    posted = firsts.select(F.explode("bands").alias("band"), F.col("doc_id").alias("node"))
    buckets = cut(posted.groupBy("band").agg(F.min("node").alias("first"), F.count("*").alias("n")).filter("n > 1"))
    held = cut(posted.join(buckets, "band"))
    least = least_matches(percent)

    def bits(name: str, prefix: str, *more: str) -> DataFrame:
        return firsts.select(F.col("doc_id").alias(name), *[F.col(p).alias(f"{prefix}{k}") for k, p in enumerate(SIGNATURE)], *more)

    stars = held.filter("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
    stars = stars.join(bits("b", "y"), "b").join(bits("a", "x"), "a").filter(matches("x", "y") >= least).select("a", "b").distinct()
    links = confirmed(cut(stars), docs, percent)
    # one document with several texts joins their classes
    own = some.join(classes.select(*key, "node"), key).groupBy("doc_id").agg(F.min("node").alias("a"), F.collect_set("node").alias("_all")).filter(F.size("_all") > 1)
    own = own.select("a", F.explode("_all").alias("b")).filter("a <> b")
    roots = components(links.unionByName(own))

    # what is still apart: buckets with classes of two components or more
    root = roots.select("node", F.col("to").alias("root"))
    placed = cut(held.select("band", "node", "n").join(root, "node", "left").withColumn("root", F.coalesce("root", "node")))
    mixed = placed.groupBy("band").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).filter("_lo < _hi").select("band")
    mixed = placed.join(cut(mixed), "band")
    near = bits("node", "s", "bands")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / BLOCK)).cast("int")
    at = F.pmod(F.xxhash64("node"), blocks).cast("int")
    sized = cut(mixed.join(near, "node").withColumn("_of", blocks).withColumn("_at", at))
    others = F.sequence(F.lit(0), F.col("_of") - 1)
    x = sized.select("band", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("_at").alias("i"), F.explode(others).alias("j"), F.col("bands").alias("ba"),
                     *[F.col(p).alias(f"x{k}") for k, p in enumerate(SIGNATURE)])
    y = sized.select("band", F.col("node").alias("b"), F.col("root").alias("rb"), F.col("_at").alias("j"), F.explode(others).alias("i"), F.col("bands").alias("bb"),
                     *[F.col(p).alias(f"y{k}") for k, p in enumerate(SIGNATURE)])
    # a pair that shares several bands leaves the join in one of them
    once = F.array_min(F.array_intersect("ba", "bb")) == x.band
    meet = x.join(y, (x.band == y.band) & (x.i == y.i) & (x.j == y.j) & (x.a < y.b) & (x.ra != y.rb) & (matches("x", "y") >= least) & once)
    apart = cut(meet.select("a", "b"))
    if not apart.isEmpty():
        more = confirmed(apart, docs, percent)
        if not more.isEmpty():
            # the roots found so far and the new links are the graph of what remains
            roots = components(roots.select(F.col("node").alias("a"), F.col("to").alias("b")).unionByName(more))
    members = cut(signed.select("doc_id", *key).join(classes.select(*key, "node"), key, "left")
                  .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("node", "doc_id")).alias("node")))
    to = roots.select("node", F.col("to").alias("_to"))
    component = F.coalesce("_to", "node")
    return (members.join(to, "node", "left")
            .select("doc_id", "n_shingles", component.alias("component_id"),
                    F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")))
