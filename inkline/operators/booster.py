"""Boosted trees on histograms: logistic loss, Newton leaves, L1 and L2, patience inside the loop.

A level of a tree is one pass over the block table: each task sums gradients and hessians
by (node, feature, bin), and the driver, which holds those sums and nothing
of the rows, picks each node's split. The loss on held-out rows comes with the first
pass of the next tree, so the best number of rounds is known without a second
fit. Margins are a column of the block table, written anew every few rounds; in between they are added up from
the trees since. A table of at most LOCAL_ROWS rows is trained on in one task by
the same steps; all sums are of whole numbers, so both ways give the same trees.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..session import cut
from . import binned

UNIT = 1 << 24  # gradients are whole numbers of this fraction
ROUNDS_PER_CUT = 16
LOCAL_ROWS = binned.BLOCK_ROWS
TRAIN, HELD_OUT = 0, 1


@dataclass(frozen=True)
class Params:
    """fixed values: the parameters when no search is asked for."""

    depth: int = 8
    rate: float = 0.05
    rounds: int = 500
    row_share: float = 0.8
    column_share: float = 0.8
    least_hessian: float = 3.0
    least_gain: float = 0.1
    l1: float = 0.1
    l2: float = 1.0
    seed: int = 42


@dataclass
class Tree:
    """Node arrays; a node without a feature (-1) is a leaf, the right child follows the left one."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut_: int, gain: float, values: tuple[float, float]) -> int:
        self.feature[node], self.cut[node], self.left[node], self.gain[node] = feature, cut_, len(self.feature), gain
        for value in values:
            for column, x in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.value, value), (self.gain, 0.0)):
                column.append(x)
        return self.left[node]

    def locate(self, bins: np.ndarray) -> np.ndarray:
        """The leaf, or open node, of every row."""
        feature, cuts, left = map(np.array, (self.feature, self.cut, self.left))
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while len(rows):
            at = node[rows]
            inner = feature[at] >= 0
            rows, at = rows[inner], at[inner]
            node[rows] = left[at] + (bins[rows, feature[at]] > cuts[at])
        return node


def newton(g: np.ndarray, h: np.ndarray, p: Params) -> np.ndarray:
    """Leaf values from sums of gradients and hessians."""
    shrunk = np.sign(g) * np.maximum(np.abs(g) - p.l1, 0.0)
    return -shrunk / (h + p.l2)


def score(g: np.ndarray, h: np.ndarray, p: Params) -> np.ndarray:
    shrunk = np.maximum(np.abs(g) - p.l1, 0.0)
    return shrunk * shrunk / (h + p.l2)


def split_gains(hist: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``[node, feature, bin]`` loss reductions of the cuts behind each bin (-inf where not allowed), and left and total sums."""
    sums = hist / UNIT
    left = np.cumsum(sums, axis=2)
    total = left[:, :, -1:]
    right = total - left
    gain = (score(left[..., 0], left[..., 1], p) + score(right[..., 0], right[..., 1], p) - score(total[..., 0], total[..., 1], p)) / 2 - p.least_gain
    allowed = (left[..., 1] >= p.least_hessian) & (right[..., 1] >= p.least_hessian)
    return np.where(allowed, gain, -np.inf), left, total[:, 0, 0]


def grow(histograms: Callable[[Tree, list[int], np.ndarray], np.ndarray], p: Params, columns: np.ndarray) -> Tree:
    """A tree over the given columns; ``histograms`` sums the rows of the open nodes. The first of equal gains wins."""
    tree, open_ = Tree(), [0]
    for _ in range(p.depth):
        if not open_:
            break
        gains, left, total = split_gains(histograms(tree, open_, columns), p)
        flat = gains.reshape(len(open_), -1)
        best = flat.argmax(1)
        children = []
        for k, node in enumerate(open_):
            if node == 0:
                tree.value[0] = float(newton(total[k, 0], total[k, 1], p) * p.rate)
            gain = flat[k, best[k]]
            if not gain > 0:
                continue
            f, b = divmod(int(best[k]), gains.shape[2])
            sides = left[k, f, b], total[k] - left[k, f, b]
            first = tree.split(node, int(columns[f]), b, float(gain), tuple(float(newton(s[0], s[1], p) * p.rate) for s in sides))
            children += [first + i for i, s in enumerate(sides) if s[1] >= 2 * p.least_hessian]
        open_ = children
    return tree


def gradients(margin: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers of 1 / UNIT."""
    prob = 1 / (1 + np.exp(-margin))
    return np.rint((prob - label) * UNIT), np.rint(prob * (1 - prob) * UNIT)


def losses(margin: np.ndarray, label: np.ndarray) -> np.ndarray:
    return np.rint((np.logaddexp(0.0, margin) - label * margin) * UNIT)


def columns_of(round_: int, width: int, p: Params) -> np.ndarray:
    """The round's share of the columns, by a seeded draw."""
    take = max(1, round(p.column_share * width))
    return np.sort(np.random.default_rng([p.seed, round_]).permutation(width)[:take])


def open_rows(tree: Tree, open_: list[int], bins: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Number of each row's open node, -1 for other rows."""
    place = np.full(len(tree.feature), -1, np.int64)
    place[open_] = np.arange(len(open_))
    return np.where(rows, place[tree.locate(bins)], -1)


def base_margin(positive: float, n: float) -> float:
    """Log odds of the training rows."""
    share = min(max(positive / n, 1e-6), 1 - 1e-6) if n else 0.5
    return float(np.log(share / (1 - share)))


@dataclass
class Boosted:
    edges: list[list[float]]
    base: float
    trees: list[Tree]
    params: Params
    losses: list[float]  # on held-out rows, after 0, 1, 2... rounds

    def margin(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for tree in self.trees:
            out += np.array(tree.value)[tree.locate(bins)]
        return out

    def probability(self, x: str) -> Column:
        """Of class 1, from an array column with the fitted features in order."""
        @F.pandas_udf(DoubleType())
        def of(values: pd.Series) -> pd.Series:
            if not len(values):
                return pd.Series([], dtype=float)
            return pd.Series(1 / (1 + np.exp(-self.margin(binned.codes(np.stack(values.to_numpy()).astype(float), self.edges)))))

        return of(F.transform(x, lambda v: F.coalesce(v.cast("double"), F.lit(float("nan")))))

    def importance(self) -> list[float]:
        """Summed gain per feature, as shares."""
        total = np.zeros(len(self.edges))
        for tree in self.trees:
            used = np.array(tree.feature) >= 0
            np.add.at(total, np.array(tree.feature)[used], np.array(tree.gain)[used])
        return (total / total.sum() if total.sum() else total).tolist()

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, d: dict) -> "Boosted":
        return cls(d["edges"], d["base"], [Tree(**t) for t in d["trees"]], Params(**d["params"]), d["losses"])


def with_margins(table: DataFrame, base: float, trees: list[Tree], started: bool) -> DataFrame:
    """The block table with margins that include the trees, written and kept in memory."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [current(binned.Block(row), base, trees).tobytes() for row in batch.to_pylist()]
            rest = batch.select([n for n in batch.schema.names if n != "margin"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(made, pa.binary())], [*rest.schema.names, "margin"])

    schema = binned.SCHEMA + ", margin binary"
    source = table if started else table.select("n", "bins", "label", "fold", "key")
    return cut(source.mapInArrow(run, schema)).persist()


def current(block: binned.Block, base: float, trees: list[Tree]) -> np.ndarray:
    margin = np.full(block.n, base) if block.margin is None else block.margin.copy()
    for tree in trees:
        margin += np.array(tree.value)[tree.locate(block.bins)]
    return margin


def class_counts(table: DataFrame) -> tuple[float, float, float]:
    """Positive labels and rows of the training part, and all rows."""
    def task(parts: Iterator[binned.Block]) -> tuple[np.ndarray, np.ndarray]:
        out = np.zeros((1, 3), np.int64)
        for b in parts:
            rows = b.fold == TRAIN
            out += [[int(b.label[rows].sum()), int(rows.sum()), b.n]]
        return np.zeros(1, np.int64), out

    _, totals = binned.summed(table, task, 3, binned.few_tasks(table))
    return tuple(map(float, totals[0])) if len(totals) else (0.0, 0.0, 0.0)


def level_sums(table: DataFrame, base: float, recent: list[Tree], tree: Tree, open_: list[int], columns: np.ndarray, p: Params, round_: int,
               direct: bool) -> tuple[np.ndarray, float]:
    """Histograms ``[node, column, bin, (g, h)]`` of the open nodes, and the mean held-out loss of the rounds before."""
    shape = (len(open_), len(columns), binned.BINS, 2)

    def task(parts: Iterator[binned.Block]) -> tuple[np.ndarray, np.ndarray]:
        hist, loss, seen = np.zeros(shape, np.int64), 0, 0
        for b in parts:
            margin, held = current(b, base, recent), b.fold == HELD_OUT
            if len(tree.feature) == 1 and held.any():
                loss, seen = loss + int(losses(margin[held], b.label[held]).sum()), seen + int(held.sum())
            rows = (b.fold == TRAIN) & binned.drawn(b.key, p.seed * 1_000_003 + round_, p.row_share)
            hist += binned.histogram(b.bins[:, columns], open_rows(tree, open_, b.bins, rows), gradients(margin, b.label), len(open_))
        flat = hist.reshape(-1, 2)
        used = np.flatnonzero(flat.any(1))
        return np.append(used, -1), np.vstack([flat[used], [[loss, seen]]])

    slots, totals = binned.summed(table, task, 2, direct)
    flat = np.zeros((int(np.prod(shape[:3])), 2), np.int64)
    flat[slots[slots >= 0]] = totals[slots >= 0]
    loss, seen = totals[slots < 0].sum(0) if (slots < 0).any() else (0, 0)
    return flat.reshape(shape), float(loss) / UNIT / seen if seen else float("nan")


class LocalRun:
    """Boosting on arrays that one task holds: margins of all rows, losses so far, margins at the best round."""

    def __init__(self, data: binned.Arrays, p: Params, held: np.ndarray):
        self.data, self.p, self.held, self.trees = data, p, held, []
        self.base = base_margin(float(data.label[~held].sum()), float((~held).sum()))
        self.margin = np.full(len(data.label), self.base)
        self.best_margin, self.history = self.margin, [self.loss()]

    def loss(self) -> float:
        n = int(self.held.sum())
        return float(losses(self.margin[self.held], self.data.label[self.held]).sum()) / UNIT / n if n else float("nan")

    def best(self) -> int:
        return 0 if np.isnan(self.history[0]) else int(np.argmin(self.history))

    def train(self, rounds: int, patience: int | None) -> bool:
        """Up to that many rounds in all; True once the run is over."""
        d, rounds = self.data, min(rounds, self.p.rounds)
        for k in range(len(self.history) - 1, rounds):
            if patience and not np.isnan(self.history[0]) and k - self.best() >= patience:
                return True
            weights = gradients(self.margin, d.label)
            rows = ~self.held & binned.drawn(d.key, self.p.seed * 1_000_003 + k, self.p.row_share)

            def sums(tree: Tree, open_: list[int], columns: np.ndarray) -> np.ndarray:
                return binned.histogram(d.bins[:, columns], open_rows(tree, open_, d.bins, rows), weights, len(open_))

            self.trees.append(grow(sums, self.p, columns_of(k, d.bins.shape[1], self.p)))
            self.margin = self.margin + np.array(self.trees[-1].value)[self.trees[-1].locate(d.bins)]
            self.history.append(self.loss())
            if self.best() == k + 1:
                self.best_margin = self.margin
        return rounds == self.p.rounds or bool(patience and len(self.history) - 1 - self.best() >= patience)


def fit_in_one_task(table: DataFrame, p: Params, patience: int | None) -> tuple[float, list[Tree], list[float]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = binned.Arrays(list(binned.blocks(batches)))
        one = LocalRun(data, p, data.fold == HELD_OUT)
        one.train(p.rounds, patience)
        made = json.dumps([one.base, [asdict(t) for t in one.trees], one.history])
        yield pa.RecordBatch.from_arrays([pa.array([made])], ["made"])

    base, trees, history = json.loads(table.coalesce(1).mapInArrow(run, "made string").first()["made"])
    return base, [Tree(**t) for t in trees], history


def fit_by_levels(table: DataFrame, width: int, base: float, p: Params, patience: int | None) -> tuple[float, list[Tree], list[float]]:
    trees, history, recent, best = [], [], [], 0
    rows = with_margins(table, base, [], False)
    direct = binned.few_tasks(rows)
    for round_ in range(p.rounds + 1):
        seen: list[float] = []

        def sums(tree: Tree, open_: list[int], columns: np.ndarray) -> np.ndarray:
            hist, loss = level_sums(rows, base, recent, tree, open_, columns, p, round_, direct)
            seen.append(loss)
            return hist

        columns = columns_of(round_, width, p)
        first = sums(Tree(), [0], columns)
        history.append(seen[0])
        if history[-1] < history[best]:
            best = round_
        if round_ == p.rounds or (patience and not np.isnan(history[0]) and round_ - best >= patience):
            break
        tree = grow(lambda t, o, c: first if len(t.feature) == 1 else sums(t, o, c), p, columns)
        trees.append(tree)
        recent.append(tree)
        if len(recent) == ROUNDS_PER_CUT:
            rows, old = with_margins(rows, base, recent, True), rows
            old.unpersist()
            recent = []
    rows.unpersist()
    return base, trees, history


def fit(table: DataFrame, edges: list[list[float]], p: Params = Params(), patience: int | None = 50) -> Boosted:
    """Boost on the rows of fold TRAIN until ``patience`` rounds pass without a lower loss on fold HELD_OUT; the best rounds are kept.

    Without held-out rows or patience all rounds are fitted; without training rows none is. ``table`` comes from
    ``binned.pack`` and is read many times, so hand in a written one.
    """
    positive, train, n = class_counts(table)
    if not train:
        return Boosted(edges, base_margin(0, 0), [], p, [])
    if n <= LOCAL_ROWS:
        base, trees, history = fit_in_one_task(table, p, patience)
    else:
        base, trees, history = fit_by_levels(table, len(edges), base_margin(positive, train), p, patience)
    held_out = patience and not np.isnan(history[0])
    return Boosted(edges, base, trees[: int(np.argmin(history))] if held_out else trees, p, history)


def root_splits(table: DataFrame, edges: list[list[float]], p: Params, names: tuple[str, ...]) -> list[tuple]:
    """(feature, threshold, gain, left value, right value) of each feature's best first split in the first round."""
    positive, train, _ = class_counts(table)
    columns = np.arange(len(edges))
    hist, _ = level_sums(table, base_margin(positive, train), [], Tree(), [0], columns, p, 0, binned.few_tasks(table))
    gains, left, total = split_gains(hist, p)
    out = []
    for f, name in enumerate(names):
        b = int(np.round(gains[0, f], 9).argmax())
        if np.isfinite(gains[0, f, b]):
            sides = left[0, f, b], total[0] - left[0, f, b]
            out.append((name, edges[f][b], float(gains[0, f, b]), *(float(newton(s[0], s[1], p) * p.rate) for s in sides)))
    return out
