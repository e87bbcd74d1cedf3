"""Per-document measures that walk the tokens or characters: folds, sliding windows, runs of two and three, and a codec over the text.

Tokens cross to Python as arrays of 64-bit hashes, whole Arrow batches at a time. One sort of a batch finds
each token's nearest equal tokens; fold and window read only those. (The same as JVM
expressions took five seconds more each on 10,000 documents, as higher-order functions are interpreted.)
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

THRESHOLD, LEAST, WINDOW = 0.72, 50, 10


def codes_of(joined: Column) -> Column:
    """Hashes of blank-joined tokens."""
    return F.transform(F.array_remove(F.split(joined, " "), ""), lambda w: F.xxhash64(w))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All rows' codes in a row, and the number of codes of each row; a missing row is an empty one."""
    sizes = pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), sizes


def neighbours(codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token its place before and its place after in the row with the same code; -1 and the row's length where there is none."""
    rows, starts = np.repeat(np.arange(len(sizes)), sizes), np.cumsum(sizes) - sizes
    place = np.arange(len(codes)) - starts[rows]
    before, after = np.full(len(codes), -1), sizes[rows]
    order = np.lexsort((codes, rows))
    first, then = order[:-1], order[1:]
    same = (codes[first] == codes[then]) & (rows[first] == rows[then])
    before[then[same]], after[first[same]] = place[first[same]], place[then[same]]
    return before, after


def stretches(before: list[int], threshold: float) -> float:
    """How many stretches a sequence holds; the unfinished last one counts by how far its ratio has come down from 1.

    A stretch ends with the token that takes its share of different tokens
    below the threshold. A token is new in its stretch exactly if its place before
    lies ahead of the stretch, so the fold carries four numbers.
    """
    ended = start = length = kinds = 0
    for place in before:
        kinds += place < start
        length += 1
        if kinds < threshold * length:
            ended, start, length, kinds = ended + 1, start + length, 0, 0
    return ended + ((1 - kinds / length) / (1 - threshold) if length else 0.0)


def mtld_of(before: np.ndarray, after: np.ndarray, threshold: float = THRESHOLD, least: int = LEAST) -> float:
    n = len(before)
    if n < least:
        return float((before < 0).sum())
    ways = [stretches(x.tolist(), threshold) for x in (before, (n - 1 - after)[::-1])]
    return sum(n / k if k > 0 else float(n) for k in ways) / 2


@F.arrow_udf(DoubleType())
def mtld_of_codes(column: pa.Array) -> pa.Array:
    codes, sizes = flat(column)
    before, after = neighbours(codes, sizes)
    cuts = np.cumsum(sizes)[:-1]
    return pa.array([mtld_of(b, a) for b, a in zip(np.split(before, cuts), np.split(after, cuts), strict=True)] if len(sizes) else [], pa.float64())


@F.arrow_udf(DoubleType())
def cohesion_of_codes(column: pa.Array) -> pa.Array:
    codes, sizes = flat(column)
    return pa.array(cohesion(*neighbours(codes, sizes), sizes))


def cohesion(before: np.ndarray, after: np.ndarray, sizes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Mean overlap per row.

    The token j places into a window is new in it if its gap, the distance to its place before, exceeds j; it is new in the
    second half and repeats the first if the gap lies above its place in the half and not above j.
    """
    half, room = window // 2, np.maximum(sizes - window, 0)
    starts = np.cumsum(sizes) - sizes
    rows = np.repeat(np.arange(len(sizes)), room)
    at = np.arange(len(rows)) - (np.cumsum(room) - room)[rows] + starts[rows]
    place = np.arange(len(before)) - np.repeat(starts, sizes)
    gap = np.where(before < 0, len(before) + window, place - before)
    union, shared = np.zeros(len(at)), np.zeros(len(at))
    for j in range(window):
        g = gap[at + j]
        union += g > j
        if j >= half:
            shared += (g > j - half) & (g <= j)
    total = np.bincount(rows, shared / np.maximum(union, 1), len(sizes))
    return np.divide(total, room, out=np.zeros(len(sizes)), where=room > 0)


def kinds_of(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different runs of n tokens in each row: (row, how often), and the number of runs of each row."""
    codes, sizes = flat(column)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    found, token = np.unique(codes, return_inverse=True)
    gram, of = token, rows
    for k in range(1, n):
        inside = of[:-1] == rows[k:] if len(of) else np.zeros(0, bool)
        _, gram = np.unique(gram[:-1] * len(found) + token[k:], return_inverse=True)
        gram, of = np.where(inside, gram, -1), np.where(inside, of[:-1], -1)
    gram, of = gram[of >= 0], of[of >= 0]
    width = int(gram.max(initial=0)) + 1
    kinds, often = np.unique(of * width + gram, return_counts=True)
    return kinds // width, often, np.maximum(sizes - n + 1, 0)


def kinds_udf(n: int):
    @F.arrow_udf(DoubleType())
    def kinds(column: pa.Array) -> pa.Array:
        rows, _, total = kinds_of(column, n)
        return pa.array(np.bincount(rows, minlength=len(total)).astype(float))

    return kinds


@F.arrow_udf(DoubleType())
def pair_entropy_of_codes(column: pa.Array) -> pa.Array:
    rows, often, total = kinds_of(column, 2)
    sums = np.bincount(rows, often * np.log(often), len(total))
    n = np.maximum(total, 1)
    return pa.array(np.where(total > 0, np.log(n) - sums / n, 0.0))


KINDS = {n: kinds_udf(n) for n in (2, 3)}


def gram_kinds(joined: Column, n: int) -> Column:
    """How many different runs of n tokens a blank-joined token string has."""
    return KINDS[n](codes_of(joined))


def pair_entropy(joined: Column) -> Column:
    """Shannon entropy (nats) of the pairs of neighbouring tokens."""
    return pair_entropy_of_codes(codes_of(joined))


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def point_entropy(text: str | None) -> float:
    if not text:
        return 0.0
    at = points(text)
    often = np.bincount(at) if at.max() < 1 << 16 else np.unique(at, return_counts=True)[1]
    often = often[often > 0]
    return float(np.log(len(at)) - (often * np.log(often)).sum() / len(at))


def triple_share(text: str | None) -> float:
    at = points(text or "").astype(np.int64)
    if len(at) < 3:
        return 0.0
    triples = np.sort((at[:-2] << 42) | (at[1:-1] << 21) | at[2:])
    return (1 + int((triples[1:] != triples[:-1]).sum())) / len(triples)


@F.arrow_udf(DoubleType())
def char_entropy(column: pa.Array) -> pa.Array:
    """Shannon entropy (nats) of the characters; 0 for no text."""
    return pa.array([point_entropy(s) for s in column.to_pylist()], pa.float64())


@F.arrow_udf(DoubleType())
def char_trigram_share(column: pa.Array) -> pa.Array:
    """Different runs of three characters over all of them; 0 where there are none."""
    return pa.array([triple_share(s) for s in column.to_pylist()], pa.float64())


def vowel_groups(column: pa.Array, vowels: str) -> tuple[np.ndarray, np.ndarray]:
    """Row and syllables of each token of blank-padded strings of lower-cased tokens: its vowel groups less a final e, and at least one."""
    texts = [s or "" for s in column.to_pylist()]
    at = points(" ".join(texts) + " ")
    small = np.minimum(at, 127).astype(np.uint8)
    blank, table = small == 32, np.zeros(128, bool)
    table[[ord(v) for v in vowels]] = True
    vowel = table[small]
    first = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    group = vowel.copy()
    group[1:] &= ~vowel[:-1]
    upto = np.cumsum(group, dtype=np.int64)
    last = np.flatnonzero(~blank & np.append(blank[1:], True))
    groups = upto[last] - upto[first] + group[first]
    ends = np.cumsum([len(s) + 1 for s in texts])
    return np.searchsorted(ends, first, side="right"), np.maximum(groups - (small[last] == ord("e")), 1)


def syllable_udf(vowels: str, least: int):
    @F.arrow_udf(IntegerType())
    def counted(column: pa.Array) -> pa.Array:
        rows, n = vowel_groups(column, vowels)
        sums = np.bincount(rows, np.where(n >= least, 1, 0) if least else n, len(column))
        return pa.array(sums.astype(np.int32), mask=column.is_null().to_numpy(zero_copy_only=False))

    return counted


SYLLABLES = {(vowels, least): syllable_udf(vowels, least) for vowels in ("aeiou", "aeiouy") for least in (0, 3)}


def syllables(padded: Column, vowels: str) -> Column:
    """Syllables of all tokens of a padded string of lower-cased tokens."""
    return SYLLABLES[vowels, 0](padded)


def complex_words(padded: Column, vowels: str) -> Column:
    """Its tokens with three or more syllables."""
    return SYLLABLES[vowels, 3](padded)


def mtld(joined: Column) -> Column:
    """Measure of textual lexical diversity of blank-joined tokens: tokens per stretch, the mean of both reading directions.

    Fewer than LEAST tokens give the number of different ones.
    """
    return mtld_of_codes(codes_of(joined))


def lexical_cohesion(joined: Column) -> Column:
    """Mean Jaccard overlap of the two halves of every window of blank-joined tokens but the last; 0 without a window."""
    return cohesion_of_codes(codes_of(joined))


def deflate_share(text: str) -> float:
    raw = text.encode("utf-8", errors="ignore")
    return len(zlib.compress(raw)) / len(raw) if raw else 0.0


@F.pandas_udf(DoubleType())
def compression_ratio(text: pd.Series) -> pd.Series:
    """Deflated bytes over UTF-8 bytes."""
    return text.map(deflate_share)
