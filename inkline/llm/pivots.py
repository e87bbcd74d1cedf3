"""Near duplicates among vectors by a pivot-permutation index.

A vector is described by its ``NEAREST`` nearest pivots in order. Two vectors
are compared if their descriptions share at least ``SHARED`` pivots. Such a pair
must meet in one of the lists of each one's ``NEAREST - SHARED + 1`` rarest
pivots, so a vector is posted only there, rare pivots first, and the pair is
handled in the first list that holds both. Lists are cut into blocks of
``BLOCK`` vectors and a group is a pair of blocks: it counts shared pivots and
computes cosines in double precision as matrix products, and returns a link
count per vector and the edges that connect it, never the pairs.

Pivots are vectors themselves, for each width the first in md5 order of their
id: one to ``PER_PIVOT`` vectors of the width, MIN_PIVOTS to MAX_PIVOTS. A width
of at most MIN_PIVOTS vectors needs none: one list holds it whole. Vectors with
equal components are one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from .graph import components
from .sample import MARGIN, RANGE

COSINE = 0.95
NEAREST, SHARED = 10, 3
PER_PIVOT, MIN_PIVOTS, MAX_PIVOTS = 100, 128, 8192
BLOCK = 512


def usable(column: str) -> F.Column:
    """No null, only finite components, not all of them zero."""
    x = F.col(column)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(x.isNotNull() & fine & F.exists(x, lambda v: v != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # against overflow of squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def rows_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def describe(pivots, nearest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the numbers of the nearest pivots of the same width to (node, copies, vec, width); -width where the width has no pivots."""
        for batch in batches:
            width = batch.column(3).to_numpy(zero_copy_only=False)
            out: list = [None] * batch.num_rows
            for d in np.unique(width):
                mine = np.flatnonzero(width == d)
                if int(d) not in pivots.value:
                    for i in mine.tolist():
                        out[i] = [-int(d)]
                    continue
                numbers, points = pivots.value[int(d)]
                for part in np.array_split(mine, len(mine) // 1024 + 1):
                    x = unit(rows_of(batch.column(2).take(pa.array(part))))
                    k = min(nearest, len(numbers))
                    # a stable order: ties go to the smaller number
                    order = np.argsort(-(x @ points.T), axis=1, kind="stable")[:, :k]
                    for i, row in zip(part.tolist(), numbers[order].tolist(), strict=True):
                        out[i] = row
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.list_(pa.int32()))], names=["node", "copies", "vec", "near"])

    return run


def meet(cosine: float, shared: int):
    def run(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        """Links between block i and block j of one list."""
        side = group.column("side").to_numpy()
        near = np.array(group.column("near").to_pylist(), np.int64).reshape(group.num_rows, -1)
        ranks = np.array(group.column("posted").to_pylist(), np.int64).reshape(group.num_rows, -1)
        node, copies = group.column("node").to_numpy(), group.column("copies").to_numpy()
        x = unit(rows_of(group.column("vec").combine_chunks()))
        at = key[0].as_py()
        same = key[2].as_py() == key[3].as_py()
        left = np.flatnonzero(side == 0)
        right = left if same else np.flatnonzero(side == 1)

        def members(values: np.ndarray, rows: np.ndarray, columns: np.ndarray, count: np.ndarray | None = None) -> np.ndarray:
            out = np.zeros((len(rows), len(columns)), np.float32)
            place = np.searchsorted(columns, values[rows])
            ok = np.ones(place.shape, bool) if count is None else count[rows]
            out[np.repeat(np.arange(len(rows)), values.shape[1])[ok.ravel()], place.ravel()[ok.ravel()]] = 1
            return out

        columns = np.unique(near)
        common = members(near, left, columns) @ members(near, right, columns).T
        good = common >= min(shared, near.shape[1])
        earlier = ranks < at  # lists that come before this one: a pair that shares one was handled there
        lists = np.unique(ranks)
        good &= members(ranks, left, lists, earlier) @ members(ranks, right, lists, earlier).T == 0
        i, j = np.nonzero(good)
        i, j = left[i], right[j]
        if same:
            i, j = i[i < j], j[i < j]
        linked = np.zeros(len(i), bool)
        for part in np.array_split(np.arange(len(i)), len(i) // 50_000 + 1):
            linked[part] = np.einsum("ij,ij->i", x[i[part]], x[j[part]]) >= cosine
        i, j = i[linked], j[linked]
        links = np.bincount(i, copies[j], group.num_rows) + np.bincount(j, copies[i], group.num_rows)
        root = np.arange(group.num_rows)
        while True:  # smallest reachable row, by repeated minima over the links
            new = root.copy()
            np.minimum.at(new, i, root[j])
            np.minimum.at(new, j, root[i])
            new = new[new]
            if np.array_equal(new, root):
                break
            root = new
        some = np.flatnonzero(links)
        return pa.table({"node": pa.array(node[some]), "links": pa.array(links[some].astype(np.int64)), "other": pa.array(node[root[some]])})

    return run


def choose(classes: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Unit pivots by width, with their numbers; none for a width of at most MIN_PIVOTS vectors."""
    sizes = classes.groupBy("width").agg(F.count("*").alias("n")).filter(F.col("n") > MIN_PIVOTS)
    most = F.least(F.lit(MAX_PIVOTS), F.greatest(F.lit(MIN_PIVOTS), F.ceil(F.col("n") / PER_PIVOT)))
    text = F.col("node").cast("string")
    # of larger widths a hash first leaves about MARGIN times as many, so that the window of a width is bounded
    drawn = classes.select("node", "vec", "width").join(sizes.select("width", "n", most.alias("most")), "width")
    drawn = drawn.filter((F.col("n") <= MARGIN * F.col("most")) | (F.pmod(F.xxhash64(text), F.lit(RANGE)) < F.lit(RANGE) * MARGIN * F.col("most") / F.col("n")))
    nth = F.row_number().over(Window.partitionBy("width").orderBy(F.md5(text.cast("binary")), text))
    rows = drawn.withColumn("nth", nth).filter("nth <= most").select("width", "nth", "vec").collect()
    rows.sort(key=lambda r: (r["width"], r["nth"]))
    out = {}
    for d in sorted({r["width"] for r in rows}):
        mine = [(i, r["vec"]) for i, r in enumerate(rows) if r["width"] == d]
        out[d] = np.array([i for i, _ in mine], np.int32), unit(np.array([v for _, v in mine], np.float64))
    return out


def near_vectors(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors that are null, zero, empty or hold a null or non-finite component
    link with nothing: no links, a component of their own, kept. Vectors of
    different widths don't link. Rows that repeat a vec_id count as vectors of their
    own when links are counted. A row without vec_id is left
    out of the index: no links, a null component, kept.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("vec"))
    marked = rows.withColumn("_key", F.when(usable("vec") & F.col("vec_id").isNotNull(), F.sha2(F.to_json(F.struct(F.transform("vec", lambda v: F.when(v == 0, F.lit(0).cast("double")).otherwise(v.cast("double"))).alias("v"))), 256)))
    keyed = cut(marked)
    classes = cut(keyed.filter("_key is not null").groupBy("_key").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")))
    firsts = cut(keyed.join(classes.select("_key", "copies", F.col("node").alias("vec_id")), ["_key", "vec_id"]).dropDuplicates(["_key"])
                 .select(F.col("vec_id").alias("node"), "copies", "vec", F.size("vec").alias("width")))
    count = firsts.count()
    to_links = None
    if count > 1:
        pivots = vectors.sparkSession.sparkContext.broadcast(choose(firsts))
        kind = firsts.schema["vec"].dataType.simpleString()
        described = cut(firsts.mapInArrow(describe(pivots, NEAREST), f"node long, copies long, vec {kind}, near array<int>"))
        # rare pivots first: the place of a pivot in that order is the number of its list
        sizes = described.select(F.explode("near").alias("p")).filter("p >= 0").groupBy("p").agg(F.count("*").alias("n")).collect()  # one row per pivot
        order = {r["p"]: k for k, r in enumerate(sorted(sizes, key=lambda r: (r["n"], r["p"])))}
        place = F.lit([order.get(i, -1) for i in range(max(order, default=0) + 1)])
        ranked = described.withColumn("_all", F.sort_array(F.transform("near", lambda p: F.when(p < 0, p).otherwise(F.element_at(place, p + 1)))))
        ranked = ranked.withColumn("posted", F.slice("_all", F.lit(1), F.greatest(F.lit(1), F.size("_all") - (SHARED - 1)))).drop("_all")
        held = ranked.select(F.explode("posted").alias("at"), "node").groupBy("at").agg(F.count("*").alias("_n"))
        lists = cut(held.filter("_n > 1").withColumn("_of", F.ceil(F.col("_n") / BLOCK).cast("int")))
        posted = ranked.withColumn("at", F.explode("posted")).join(lists.select("at", "_of"), "at")
        block = F.pmod(F.xxhash64("node"), F.col("_of")).cast("int")
        pairs = posted.withColumn("_b", block).withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_of") - 1)))
        pairs = pairs.select("at", "node", "copies", "vec", "near", "posted", F.least("_b", "_o").alias("i"), F.greatest("_b", "_o").alias("j"),
                             F.when(F.col("_b") <= F.col("_o"), 0).otherwise(1).alias("side"), F.size("vec").alias("width"))
        found = cut(pairs.groupBy("at", "width", "i", "j").applyInArrow(meet(cosine, SHARED), "node long, links long, other long"))
        to_links = found.groupBy("node").agg(F.sum("links").alias("_links"))
        roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = keyed.select("vec_id", "_key").join(classes, "_key", "left").select("vec_id", F.coalesce("node", "vec_id").alias("node"), F.coalesce("copies", F.lit(1)).alias("copies"))
    if to_links is None:
        return named.select("vec_id", (F.col("copies") - 1).alias("n_links"), F.col("node").alias("component_id"),
                            F.coalesce(F.col("vec_id") == F.col("node"), F.lit(True)).alias("kept"))
    told = cut(classes.select("node").join(to_links, "node", "left").join(roots, "node", "left")
               .select(F.col("node").alias("_node"), F.coalesce("_links", F.lit(0)).alias("_links"), F.coalesce("to", "node").alias("_root")))
    out = cut(named).join(told, F.col("node") == F.col("_node"), "left")
    component = F.coalesce("_root", "node")
    return out.select("vec_id", (F.col("copies") - 1 + F.coalesce("_links", F.lit(0))).alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
