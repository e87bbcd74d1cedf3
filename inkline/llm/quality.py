"""Quality classifier by nearest-neighbour voting in a latent-semantic space.

A text's features are hashed counts of its words and of their shapes (runs of
capitals, small letters and digits shortened to one, other signs as they are),
alone and in pairs, and of words that repeat the one before. Counts are scaled
by length and by how rare a feature is among all documents, and projected on
the leading singular directions of the labelled sample. The sample's vectors
are broadcast; each block of documents meets all of them in one product,
and the nearest vote with their labels, weighted by cosine.

The sample holds at most ``max_labelled`` documents, the first in md5 order of
their id, so the broadcast is bounded by max_labelled x RANK floats. Document
frequencies cover all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import words as wd
from .sample import first_by_hash

SHAPES, WORDS = 1536, 512
FEATURES = SHAPES + WORDS
RANK, NEIGHBOURS, MAX_LABELLED = 48, 15, 3000
PRIOR_WEIGHT = 0.01

KIND = np.arange(256, dtype=np.uint8)
KIND[65:91], KIND[97:123], KIND[48:58], KIND[128:] = 65, 97, 48, 97


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """rows x FEATURES: square roots of counts per word; offsets start at 0."""
    rows = len(offsets) - 1
    out = np.zeros((rows, FEATURES), np.float32)
    if not len(data):
        return out
    starts, ends, counts = wd.word_bounds(data, offsets)
    if not len(starts):
        return out
    lowered = wd.run_hashes(wd.BYTE_VALUE[wd.LOWER[data]], starts, ends)
    kind = KIND[data]
    change = np.ones(len(data), bool)
    change[1:] = kind[1:] != kind[:-1]
    change[starts] = True
    upto = np.concatenate(([0], np.cumsum(change)))
    shape = wd.run_hashes(wd.BYTE_VALUE[kind[change]], upto[starts], upto[ends])
    row = np.repeat(np.arange(rows), counts)
    same_row = row[1:] == row[:-1]
    pair = wd.mix(shape[1:] * np.uint64(wd.STEP[1]) + shape[:-1] * np.uint64(wd.STEP[2]))[same_row]
    again = same_row & (lowered[1:] == lowered[:-1])
    room = np.uint64(SHAPES - 1)
    for where, feature in ((row, shape % room), (row[1:][same_row], pair % room), (row, lowered % np.uint64(WORDS) + np.uint64(SHAPES)),
                           (row[1:][again], np.full(int(again.sum()), SHAPES - 1, np.uint64))):
        out += np.bincount(where * FEATURES + feature.astype(np.int64), minlength=rows * FEATURES).reshape(rows, FEATURES).astype(np.float32)
    return np.sqrt(out / np.maximum(counts, 1).astype(np.float32)[:, None])


@dataclass
class Model:
    weight: np.ndarray  # FEATURES, rarity
    directions: np.ndarray  # FEATURES x rank
    vectors: np.ndarray  # labelled x rank, unit length
    labels: np.ndarray
    prior: float
    neighbours: int

    def place(self, found: np.ndarray) -> np.ndarray:
        return unit((found * self.weight) @ self.directions)

    def score(self, found: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest, by cosine; the prior where nothing is near."""
        if not len(self.labels):
            return np.full(len(found), self.prior)
        cosine = self.place(found) @ self.vectors.T
        k = min(self.neighbours, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** 4
        return ((weight * self.labels[near]).sum(axis=1) + PRIOR_WEIGHT * self.prior) / (weight.sum(axis=1) + PRIOR_WEIGHT)


def unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 1e-9)


def directions(x: np.ndarray, rank: int) -> np.ndarray:
    """Leading right singular vectors, by subspace iteration from a fixed start."""
    basis = np.random.default_rng(3).standard_normal((x.shape[1], rank)).astype(np.float32)
    for _ in range(8):
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    return basis


def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (label, text): features of labelled rows, and per task how many rows have each feature."""
    seen, rows = np.zeros(FEATURES, np.int64), 0
    for batch in batches:
        data, offsets = wd.text_bytes(batch.column(1))
        labels = batch.column(0).to_pylist()
        for i, j in wd.row_blocks(offsets):
            found = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            seen += (found > 0).sum(axis=0)
            rows += j - i
            mine = [k for k in range(i, j) if labels[k] is not None]
            if mine:
                yield pa.RecordBatch.from_pydict({"label": pa.array([labels[k] for k in mine], pa.int32()),
                                                  "found": pa.array([found[k - i].tobytes() for k in mine], pa.binary()),
                                                  "seen": pa.nulls(len(mine), pa.list_(pa.int64()))})
    yield pa.RecordBatch.from_pydict({"label": pa.nulls(1, pa.int32()), "found": pa.nulls(1, pa.binary()),
                                      "seen": pa.array([[rows, *seen.tolist()]], pa.list_(pa.int64()))})


def held_out(doc_id: Column) -> Column:
    """A third of the ids, by a checksum of the id as text; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = MAX_LABELLED, rank: int = RANK,
        neighbours: int = NEIGHBOURS) -> Model:
    """Learns from labelled rows that are not held out. Where an id has several labels the largest counts."""
    sample = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("_label"))
              .filter(F.col("_id").isNotNull() & F.col("_label").isNotNull() & ~held_out(F.col("_id")))
              .groupBy("_id").agg(F.max("_label").alias("_label")))
    sample = first_by_hash(sample, F.col("_id"), max_labelled, sample.count())
    marked = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"), "left").select("_label", "text")
    passed = cut(marked.mapInArrow(gather, "label int, found binary, seen array<long>"))
    counts = passed.filter("seen is not null").select(F.posexplode("seen").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n"))
    seen = np.zeros(FEATURES + 1)
    for at, n in counts.collect():  # one row per feature
        seen[at] = n
    # rows that repeat an id can only add to the sample, so it is limited again
    rows = passed.filter("label is not null").orderBy(F.md5("found"), "label").limit(max_labelled).collect()
    weight = np.log((1 + seen[0]) / (1 + seen[1:])).astype(np.float32) + np.float32(0.1)
    y = np.array([r["label"] for r in rows], np.float64)
    x = np.array([np.frombuffer(r["found"], np.float32) for r in rows]).reshape(-1, FEATURES)
    prior = float(y.mean()) if len(y) else 0.5
    model = Model(weight, np.zeros((FEATURES, 0), np.float32), np.zeros((0, 0), np.float32), y, prior, neighbours)
    if len(y):
        model.directions = directions(unit(x * weight), min(rank, len(y)))
        model.vectors = model.place(x)
    return model


def scorer(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the score to whatever columns come along; the text is the last one."""
        m = Model(**model.value)
        for batch in batches:
            data, offsets = wd.text_bytes(batch.column(batch.num_columns - 1))
            scores = [m.score(features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])) for i, j in wd.row_blocks(offsets)]
            score = np.concatenate([*scores, np.zeros(0)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=[*batch.schema.names, "_score"])

    return run


def classify(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """All columns of ``docs`` and held_out, score, predicted.

    Null and empty texts have no features; their score is the share of label 1
    in the sample. Without any usable label every score is 0.5. Repeated rows
    are scored alike. A column of ``docs`` that has one of the three names is
    replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(vars(fit(docs, labels, **settings)))
    rest = [c for c in docs.columns if c != "text"]
    inner = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)], "text")
    schema = ", ".join([*[f"c{i} {t}" for i, (_, t) in enumerate(docs.select(*[f"`{c}`" for c in rest]).dtypes)], "text string", "_score double"])
    scored = inner.mapInArrow(scorer(model), schema)
    out = {c: F.col(f"c{i}") for i, c in enumerate(rest)} | {"text": F.col("text")}
    out |= {"held_out": held_out(out["doc_id"]), "score": F.col("_score"), "predicted": (F.col("_score") >= 0.5).cast("int")}
    return scored.select(*[v.alias(k) for k, v in out.items()])
