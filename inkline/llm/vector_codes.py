"""Vectors as short codes: one byte per part, the nearest entry of that part's codebook.

Components become whole numbers, vectors are cut into equal parts, and each
part's codebook is learnt by k-means. The first assignment compares a part with all
entries; the later ones are those of ball k-means. The parts of an entry form a
ball, in a block of rows: its centre is the entry, its radius the distance of
the farthest part. Only entries within twice the radius are neighbours of the ball. A
part nearer to its entry than half the way to the nearest neighbour lies in
the ball's stable core and needs no comparison; neighbours in order of distance
bound rings around it, and a part in the k-th ring is compared with the first
k. A ball whose entry and neighbours stayed where they were isn't looked at. All
bounds are squared whole numbers, so the outcome is that of comparing with every entry, ties included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LARGEST = 1 << 25  # scaled components below it keep all sums within 64 bits
BLOCK_VALUES = 1 << 20


def full_assign(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of every row, the lowest of equals, and its squared distance."""
    far = (x * x).sum(1)[:, None] - 2 * (x @ book.T) + (book * book).sum(1)
    code = far.argmin(1)
    return code, far[np.arange(len(x)), code]


def ball_assign(x: np.ndarray, own: np.ndarray, book: np.ndarray, moved: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The same from the entries so far, and how many entries were compared; ``moved`` marks entries that changed since."""
    between = ((book[:, None] - book[None]) ** 2).sum(2)
    np.fill_diagonal(between, -1)
    near = np.argsort(between, axis=1, kind="stable")[:, 1:]
    rings = np.take_along_axis(between, near, 1)
    best = ((x - book[own]) ** 2).sum(1)
    code, within = own.copy(), np.zeros(len(x), np.int64)
    order = np.argsort(own, kind="stable")
    bounds = np.searchsorted(own[order], np.arange(len(book) + 1))
    for e in np.flatnonzero(np.diff(bounds)):
        ball = order[bounds[e] : bounds[e + 1]]
        neighbours = near[e, : np.searchsorted(rings[e], 4 * best[ball].max(), side="right")]
        if moved[e] or moved[neighbours].any():
            within[ball] = np.searchsorted(rings[e], 4 * best[ball], side="right")
    open_, step, compared = np.flatnonzero(within), 0, 0
    while len(open_):
        entry = near[own[open_], step]
        d = ((x[open_] - book[entry]) ** 2).sum(1)
        compared += len(open_)
        better = (d < best[open_]) | ((d == best[open_]) & (entry < code[open_]))
        best[open_[better]], code[open_[better]] = d[better], entry[better]
        step += 1
        open_ = open_[within[open_] > step]
    return code, best, compared


def assign(x: np.ndarray, own: np.ndarray | None, books: np.ndarray, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes [rows, parts] and errors of the rows; x is [rows, parts, width of a part]."""
    codes, error = np.empty(x.shape[:2], np.int64), np.zeros(len(x), np.int64)
    for p in range(x.shape[1]):
        if own is None:
            codes[:, p], d = full_assign(x[:, p], books[p])
        else:
            codes[:, p], d, _ = ball_assign(x[:, p], own[:, p], books[p], (books[p] != before[p]).any(1))
        error += d
    return codes, error


def scaled(column: pa.Array, width: int) -> np.ndarray:
    """Whole numbers [rows, width]; short vectors are filled with zeros."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def coder(books: np.ndarray, before: np.ndarray | None, kind: str, last: bool) -> Callable:
    """Arrow batches of vec_id, label and either ``embedding`` or ``parts`` and ``codes``, with codes by ``books``."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = max(1, BLOCK_VALUES // max(1, parts * width))
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                block = batch.slice(at, rows)
                if before is None:
                    x, own = scaled(block.column("embedding"), parts * width), None
                else:
                    x = np.frombuffer(b"".join(block.column("parts").to_pylist()), kind).astype(np.int64)
                    own = np.frombuffer(b"".join(block.column("codes").to_pylist()), np.uint8).reshape(-1, parts).astype(np.int64)
                x = x.reshape(block.num_rows, parts, width)
                codes, error = assign(x, own, books, before)
                packed = [row.tobytes() for row in codes.astype(np.uint8)]
                columns = [block.column("vec_id"), block.column("label")]
                if last:
                    columns += [pa.array([c.hex() for c in packed], pa.string()), pa.array(error)]
                else:
                    columns += [pa.array([row.tobytes() for row in x.astype(kind)], pa.binary()), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", *(["code", "error"] if last else ["parts", "codes"])])

    return run


def summer(shape: tuple[int, int, int], kind: str) -> Callable:
    """Arrow batches as one task's sums (slot, position, total); position -1 counts the slot's parts."""
    parts, entries, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((parts * entries, width + 1), np.int64)
        for batch in batches:
            rows = max(1, BLOCK_VALUES // max(1, parts * width))
            for at in range(0, batch.num_rows, rows):
                block = batch.slice(at, rows)
                x = np.frombuffer(b"".join(block.column("parts").to_pylist()), kind).astype(np.int64).reshape(block.num_rows, parts, width)
                codes = np.frombuffer(b"".join(block.column("codes").to_pylist()), np.uint8).reshape(-1, parts)
                slots = codes + np.arange(parts) * entries
                np.add.at(totals[:, 1:], slots, x)
                totals[:, 0] += np.bincount(slots.ravel(), minlength=len(totals))
        used = np.flatnonzero(totals[:, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, width + 1)), pa.array(np.tile(np.arange(-1, width), len(used))), pa.array(totals[used].ravel())],
            ["slot", "position", "total"])

    return run


def updated(coded: DataFrame, books: np.ndarray, kind: str) -> np.ndarray:
    """Entries as the floored mean of their parts; entries without parts stay. The driver gets one number per component."""
    parts, entries, width = books.shape
    sums = coded.select("parts", "codes").mapInArrow(summer(books.shape, kind), "slot long, position long, total long")
    totals = np.zeros((parts * entries, width + 1), np.int64)
    for r in sums.groupBy("slot", "position").agg(F.sum("total").alias("total")).toLocalIterator():
        totals[r["slot"], r["position"] + 1] = r["total"]
    out, used = books.reshape(parts * entries, width).copy(), totals[:, 0] > 0
    out[used] = totals[used, 1:] // totals[used, :1]
    return out.reshape(books.shape)


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector is there and has only finite components."""
    x = F.col("embedding")
    return vectors.select("vec_id", "label", "embedding").filter(
        x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every usable row, and the codebooks [parts, entries, width of a part].

    ``code`` is two hex digits per part, ``error`` the summed squared distance of
    the parts from their entries. The codebooks begin with the rows of the smallest ids:
    ids that are null come last, equal ids in order of their vectors; of fewer rows
    than ``entries`` there are as many entries. Rows whose vector is null or holds
    null or non-finite components are left out; others may repeat, and equal
    vectors have equal codes. Vectors shorter than the widest, and all if its width is no
    multiple of ``parts``, are filled with zeros; empty ones are all zeros. No usable
    row gives no rows and codebooks without entries. Components of 2 ** 17 or more raise
    ValueError, as sums of their squares would not fit into 64 bits. Further
    columns are left out. Each round writes the coded rows, so lost executors cost no round.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code digit pair tells 256 entries apart")
    kept = usable(vectors)
    largest = F.array_max(F.transform("embedding", lambda v: F.abs(v).cast("double")))
    size = kept.agg(F.max(F.size("embedding")).alias("width"), F.max(largest).alias("largest")).first()
    width, top = -(-(size["width"] or 0) // parts), SCALE * (size["largest"] or 0.0) + 1
    if top > LARGEST:
        raise ValueError(f"components of magnitude {size['largest']} are too large to be coded")
    kind = "<i2" if top < 1 << 15 else "<i4"
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    seeds = scaled(pa.array([r["embedding"] for r in first], pa.list_(pa.float64())), parts * width)
    books, before = np.ascontiguousarray(seeds.reshape(len(first), parts, width).swapaxes(0, 1)), None
    ids = [kept.schema["vec_id"], kept.schema["label"]]
    state = T.StructType([*ids, T.StructField("parts", T.BinaryType()), T.StructField("codes", T.BinaryType())])
    rows = kept
    for _ in range(rounds):
        rows = cut(rows.mapInArrow(coder(books, before, kind, False), state))
        books, before = updated(rows, books, kind), books
    coded = T.StructType([*ids, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return cut(rows.mapInArrow(coder(books, before, kind, True), coded)), books


def with_label_error(coded: DataFrame) -> DataFrame:
    """``error`` summed over the rows of a label, nulls together. One row per label is joined back; it is broadcast only if Spark finds it small."""
    total = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(total, F.col("label").eqNullSafe(F.col("_label"))).drop("_label")


def reconstruct(code: str, books: np.ndarray) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([books[p, e] for p, e in enumerate(bytes.fromhex(code))]) / SCALE


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    sql = f"""
WITH kept AS (
  SELECT row_number() OVER () AS k, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS (SELECT k, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS x FROM kept, range({parts}) t(p)),
seeds AS (SELECT k, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {entries}),
book0 AS (SELECT p, e, x AS c FROM seeds JOIN cells USING (k))"""
    for n in range(rounds + 1):
        sql += f""",
near{n} AS (
  SELECT k, p, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT * {entries} + e) AS m
  FROM cells JOIN book{n} USING (p) GROUP BY k, p)"""
        if n < rounds:
            sql += f""",
mean{n} AS (
  SELECT p, e, list(floor(total / n)::BIGINT ORDER BY i) AS c FROM (
    SELECT p, m % {entries} AS e, i, sum(x[i + 1])::BIGINT AS total, count(*) AS n FROM near{n} JOIN cells USING (k, p), range(len(x)) t(i) GROUP BY p, m % {entries}, i)
  GROUP BY p, e),
book{n + 1} AS (SELECT p, e, coalesce(mean{n}.c, book{n}.c) AS c FROM book{n} LEFT JOIN mean{n} USING (p, e))"""
    return sql + f""",
coded AS (SELECT k, string_agg(printf('%02x', m % {entries}), '' ORDER BY p) AS code, sum(m // {entries})::BIGINT AS error FROM near{rounds} GROUP BY k)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (k)"""


ORACLE = oracle()
