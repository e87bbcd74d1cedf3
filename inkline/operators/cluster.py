"""k-means steps, inertia and silhouettes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut

ROWS_AT_ONCE = 64
SILHOUETTE_ROWS, LEFT_BLOCKS, RIGHT_BLOCKS = 2048, 8, 64  # rows of a block, and blocks that a task holds of the left and reads of the right


def assign(df: DataFrame, vector: str, centres: list[list[float]]) -> DataFrame:
    """Nearest centre (first on ties) and squared distance; centres are k constants of the plan."""
    def dist(centre):
        c = F.array(*[F.lit(float(x)) for x in centre])
        return F.aggregate(F.zip_with(vector, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x)

    d = df.withColumn("_d", F.array(*[dist(c) for c in centres]))
    return d.withColumns({"cluster": F.array_position("_d", F.array_min("_d")).cast("int") - 1, "cost": F.array_min("_d")}).drop("_d")


def lloyd_step(df: DataFrame, vector: str, centres: list[list[float]]) -> DataFrame:
    """One Lloyd iteration: ``(cluster, dim, centre, n, cost)`` long form, one row per cluster and dimension."""
    a = assign(df, vector, centres).select("cluster", "cost", F.posexplode(vector).alias("dim", "x"))
    return a.groupBy("cluster", "dim").agg(F.avg("x").alias("centre"), F.count("*").alias("n"), F.sum("cost").alias("cost"))


def distance_sums(p: np.ndarray, q: np.ndarray, member: np.ndarray) -> np.ndarray:
    """For each row of ``p`` the summed Euclidean distances to the rows of ``q`` by cluster; ``member`` is ``[row of q, cluster]``."""
    norms, sums = (q * q).sum(axis=1), np.empty((len(p), member.shape[1]))
    for a in range(0, len(p), ROWS_AT_ONCE):
        part = p[a : a + ROWS_AT_ONCE]
        size = (part * part).sum(axis=1)[:, None] + norms
        d = size - 2 * part @ q.T
        # of near points the product keeps too few digits
        i, j = np.nonzero(d <= 1e-6 * size)
        d[i, j] = ((part[i] - q[j]) ** 2).sum(axis=1)
        sums[a : a + len(part)] = np.sqrt(d) @ member
    return sums


def packed(df: DataFrame, id_col: str, vector: str, cluster: str, rows_per_block: int) -> DataFrame:
    """Blocks of rows as single rows: number, ids, clusters, and the vectors as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, rows_per_block):
                part = batch.slice(at, rows_per_block)
                x = np.stack(part.column("_v").to_numpy(zero_copy_only=False)).astype("float64")
                lists = [pa.ListArray.from_arrays([0, part.num_rows], pa.concat_arrays([part.column(c)])) for c in ("_i", "_own")]
                yield pa.RecordBatch.from_arrays([pa.array([number]), *lists, pa.array([x.tobytes()], pa.binary())], ["block", "ids", "own", "x"])
                number += 1

    rows = df.select(F.col(id_col).cast("long").alias("_i"), F.col(cluster).cast("int").alias("_own"), F.col(vector).alias("_v"))
    return rows.mapInArrow(run, "block long, ids array<long>, own array<int>, x binary")


def silhouette_exact(df: DataFrame, id_col: str, vector: str, cluster: str, rows_per_block: int = SILHOUETTE_ROWS) -> DataFrame:
    """Mean Euclidean silhouette; single-member clusters count as 0.

    A task meets some left blocks with a run of right blocks that it reads from the written table, so vectors are
    not copied through an exchange; what it hands on is one sum per (row, other cluster).
    """
    table = cut(packed(df, id_col, vector, cluster, rows_per_block))
    blocks, cores = table.count(), df.sparkSession.sparkContext.defaultParallelism

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list] = {}
        for batch in batches:
            for pair in batch.to_pylist():
                own = np.array(pair["own"])
                kinds, code = np.unique(own, return_inverse=True)
                q = np.frombuffer(pair["x"]).reshape(len(own), -1)
                p = np.frombuffer(pair["left_x"]).reshape(-1, q.shape[1])
                found = distance_sums(p, q, (code[:, None] == np.arange(len(kinds))).astype("float64"))
                for k, (kind, n) in enumerate(zip(kinds.tolist(), np.bincount(code).tolist())):
                    total = sums.setdefault((pair["left_block"], kind), [0.0, 0])
                    total[0], total[1] = total[0] + found[:, k], total[1] + n
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in sums]), pa.array([k[1] for k in sums], pa.int32()), pa.array([v[0].tolist() for v in sums.values()], pa.list_(pa.float64())),
                 pa.array([v[1] for v in sums.values()])], ["block", "_c", "s", "n"])

    left = table.select(F.col("block").alias("left_block"), F.col("x").alias("left_x")).repartition(max(1, min(blocks, max(cores, blocks // LEFT_BLOCKS))))
    right = table.select("own", "x").coalesce(max(1, -(-blocks // RIGHT_BLOCKS)))
    # the hint keeps the pairs in tasks of their own, without a broadcast
    parts = left.hint("shuffle_replicate_nl").crossJoin(right).mapInArrow(run, "block long, _c int, s array<double>, n long")
    rows = parts.join(table.select("block", "ids", "own"), "block").select("_c", "n", F.posexplode("s").alias("_at", "_s"), "ids", "own")
    sums = rows.select(F.get("ids", "_at").alias("_i"), F.get("own", "_at").alias("_own"), "_c", "_s", F.col("n").alias("_n"))
    per = sums.groupBy("_i", "_own", "_c").agg(F.sum("_s").alias("s"), F.sum("_n").alias("n"))
    same = F.col("_own") == F.col("_c")
    ab = per.groupBy("_i").agg(
        F.max(F.when(same, F.try_divide(F.col("s"), F.col("n") - 1))).alias("a"),
        F.min(F.when(~same, F.col("s") / F.col("n"))).alias("b"), F.max(F.when(same, F.col("n"))).alias("size"))
    value = F.when(F.col("size") > 1, (F.col("b") - F.col("a")) / F.greatest("a", "b")).otherwise(0.0)
    return ab.agg(F.avg(value).alias("silhouette"), F.count("*").alias("n"))


def total_sse(df: DataFrame, columns: list[str]) -> float:
    """Inertia of a single cluster, which the iterative estimator does not accept."""
    row = df.agg(*[(F.var_pop(c) * F.count(c)).alias(f"v{i}") for i, c in enumerate(columns)]).first()
    return float(sum(x for x in row if x is not None))
