"""Search of the booster's parameters: seeded draws, stratified folds, Matthews correlation, median stopping at rungs.

Every trial and fold is a row of a state table, trained on by Spark side by side; they share one binned
sample of bounded size. A rung trains all live rows to the same number of
rounds; then trials below the median of the rung's correlations stop for
good. The best parameters are meant for ``booster.fit`` on all rows.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Iterator
from dataclasses import asdict, replace
from statistics import median

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import binned
from .booster import LocalRun, Params

# fixed values: ranges of the search, rounds without a better loss before a fold ends, trials before any is stopped
LEARNING_RATE, ROUNDS, SHARES, LEAF_HESSIAN, GAIN, L1, L2, DEPTHS = (0.01, 0.2), (100, 500, 50), (0.7, 0.95), (1, 7), (0.0, 0.3), (0.0, 0.5), (0.5, 2.0), (4, 10)
PATIENCE, STARTUP = 20, 5
MAX_ROWS = 200_000  # rows that the search looks at; a bound, not a share
RUNGS = (100, 200, 500)  # no trial is judged before the fewest rounds that one may have
STATE = "trial int, fold int, done int, ended boolean, mcc double, best int, state binary"


def sample_params(trials: int, seed: int = 42) -> list[Params]:
    rng = random.Random(seed)
    return [Params(depth=rng.randint(*DEPTHS), rate=math.exp(rng.uniform(*map(math.log, LEARNING_RATE))), rounds=rng.randrange(ROUNDS[0], ROUNDS[1] + 1, ROUNDS[2]),
                   row_share=rng.uniform(*SHARES), column_share=rng.uniform(*SHARES), least_hessian=float(rng.randint(*LEAF_HESSIAN)),
                   least_gain=rng.uniform(*GAIN), l1=rng.uniform(*L1), l2=rng.uniform(*L2), seed=seed) for _ in range(trials)]


def matthews(label: np.ndarray, pred: np.ndarray) -> float:
    tp, tn = float((label & pred).sum()), float((~label & ~pred).sum())
    fp, fn = float((~label & pred).sum()), float((label & ~pred).sum())
    scale = (tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)
    return (tp * tn - fp * fn) / math.sqrt(scale) if scale else 0.0


class FoldRun(LocalRun):
    """One trial on one fold, which can be put down and taken up again."""

    def __init__(self, data: binned.Arrays, p: Params, fold: int, state: bytes | None):
        super().__init__(data, p, data.fold == fold)
        if state is not None:
            kept, n = np.frombuffer(state, np.float64), len(data.label)
            self.margin, self.best_margin, self.history = kept[:n].copy(), kept[n : 2 * n], kept[2 * n :].tolist()

    def state(self) -> bytes:
        return np.concatenate([self.margin, self.best_margin, self.history]).tobytes()

    def mcc(self) -> float:
        return matthews(self.data.label[self.held] > 0.5, self.best_margin[self.held] >= 0)


def bounded(df: DataFrame, id_col: str, max_rows: int) -> DataFrame:
    """At most about ``max_rows`` rows, by a hash of the id."""
    n = df.count()
    return df if n <= max_rows else df.filter(F.pmod(F.xxhash64(F.col(id_col).cast("string"), F.lit("tune")), F.lit(1 << 30)) < int(max_rows / n * (1 << 30)))


def advance(states: DataFrame, sample: binned.Arrays, params: list[Params], rounds: int, patience: int) -> DataFrame:
    """Train each row of the state table up to ``rounds``; the sample travels with the task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples():
                one = FoldRun(sample, params[row.trial], row.fold, row.state)
                ended = one.train(rounds, patience)
                out.append((row.trial, row.fold, len(one.history) - 1, ended, one.mcc(), one.best(), one.state()))
            yield pd.DataFrame(out, columns=["trial", "fold", "done", "ended", "mcc", "best", "state"])

    return states.mapInPandas(run, STATE)


def tune(df: DataFrame, x: str, width: int, label: str, id_col: str, fold: str, folds: int = 3, trials: int = 25, seed: int = 42,
         rungs: tuple[int, ...] | None = RUNGS, max_rows: int = MAX_ROWS, patience: int = PATIENCE) -> tuple[Params, list[dict]]:
    """(best parameters with the rounds of its folds' mean best, one record per trial: params, mcc, rounds, rung it was stopped at or None).

    ``x`` is an array column with ``width`` features, ``fold`` a column of 0 to
    ``folds - 1``. ``rungs=None`` trains every trial to its end. Ties go to the first trial.
    """
    rows = bounded(df, id_col, max_rows)
    edges = binned.fit_edges(rows, x, width)
    sample = binned.Arrays([binned.Block(r.asDict()) for r in binned.pack(rows, x, label, id_col, edges, F.col(fold)).collect()])
    spark, params = df.sparkSession, sample_params(trials, seed)
    live, done, results = set(range(trials)), {}, {}
    states = spark.createDataFrame([(t, f, 0, False, 0.0, 0, None) for t in range(trials) for f in range(folds)], STATE)
    for rung in rungs or (ROUNDS[1],):
        going = states.filter(F.col("trial").isin(sorted(live - done.keys()))).repartition(trials * folds, "trial", "fold")
        states = cut(advance(going, sample, params, rung, patience))
        per: dict[int, list] = {}
        for r in states.select("trial", "fold", "done", "ended", "mcc", "best").collect():
            per.setdefault(r["trial"], []).append(r)
        for t, of in per.items():
            results[t] = {"mcc": float(np.mean([r["mcc"] for r in of])), "rounds": max(1, round(np.mean([r["best"] for r in of]))), "stopped_at": None}
            if all(r["ended"] for r in of):
                done[t] = results[t]
        level = median(results[t]["mcc"] for t in live) if rungs and len(live) > STARTUP else -math.inf
        for t in sorted(live - done.keys()):
            if results[t]["mcc"] < level:
                live.discard(t)
                results[t]["stopped_at"] = rung
        if live <= done.keys():
            break
    best = max(sorted(live), key=lambda t: results[t]["mcc"])
    records = [{"trial": t, **json.loads(json.dumps(asdict(params[t]))), **{k: results[t][k] for k in ("mcc", "stopped_at")}, "best_rounds": results[t]["rounds"]} for t in range(trials)]
    return replace(params[best], rounds=results[best]["rounds"]), records
