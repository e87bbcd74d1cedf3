"""Words and shingles of many texts at once, as numpy arrays over an Arrow buffer.

A word is a run of bytes other than blank and the five control characters
\\x09-\\x0D. Texts stay UTF-8 bytes: neither the word bounds nor the lower-casing
of A-Z depends on anything beyond ASCII.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLOCK_BYTES = 1 << 20

_rng = np.random.default_rng(20240229)
BYTE_VALUE = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
STEP = [int(x) | 1 for x in _rng.integers(0, 1 << 64, 64, dtype=np.uint64)]
BASE = STEP.pop()
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, so that every bit depends on every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64 for i < n."""
    if len(_powers["up"]) < n:
        for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps)
    return _powers["up"][:n], _powers["down"][:n]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and row offsets; a null text is an empty one."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def row_blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes; a longer text is a range of its own."""
    i, rows = 0, len(offsets) - 1
    while i < rows:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), rows)
        yield i, j
        i = j


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words (within ``data``), and how many each row has."""
    inside = ~IS_SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    at = np.searchsorted(starts, offsets)
    return starts, ends, np.diff(at)


def run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run ``values[start:end]``, from one prefix sum."""
    up, down = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word in order, and the number of words per row; offsets start at 0."""
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    starts, ends, counts = word_bounds(data, offsets)
    return run_hashes(BYTE_VALUE[LOWER[data] if lower else data], starts, ends), counts


def shingles(words: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word windows, row after row; a row of fewer words is one window."""
    total, ends = len(words), np.cumsum(counts)
    starts = ends - counts
    value = np.zeros(total, np.uint64)
    whole = np.zeros(total, bool)
    if total >= n:
        windows = total - n + 1
        for k in range(n):
            value[:windows] += words[k : k + windows] * np.uint64(STEP[k])
        whole[:windows] = np.arange(windows) + n <= np.repeat(ends, counts)[:windows]
    short = np.flatnonzero((counts > 0) & (counts < n))
    value[starts[short]] = counts[short].astype(np.uint64) * np.uint64(STEP[n])
    for k in range(n - 1):
        has = short[counts[short] > k]
        value[starts[has]] += words[starts[has] + k] * np.uint64(STEP[k])
    whole[starts[short]] = True
    return mix(value[whole]), np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))


def distinct_per_row(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's values sorted, without repeats; sorts ``values`` in place."""
    ends = np.cumsum(counts)
    starts = ends - counts
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        values[a:b].sort()
    keep = np.ones(len(values), bool)
    keep[1:] = values[1:] != values[:-1]
    keep[starts[counts > 0]] = True
    sums = np.concatenate(([0], np.cumsum(keep)))
    return values[keep], sums[ends] - sums[starts]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of the rows and the size of each row's set."""
    words, counts = word_hashes(data, offsets)
    return distinct_per_row(*shingles(words, counts, n))
