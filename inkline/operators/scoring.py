"""Text scorer: features -> selection -> scaling -> two models -> prediction record.

``transform`` is a plain DataFrame function, so the same code scores a table
and a stream of files.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stylometry as st
from ..session import cut
from . import binned, booster, encode, ensemble, forest, selection, split


def fit_forest(rows: DataFrame, x: str, width: int, label: str, id_col: str, **settings) -> forest.Forest:
    edges = binned.fit_edges(rows, x, width)
    return forest.fit(cut(binned.pack(rows, x, label, id_col, edges)), edges, **settings)


def fit_boosted(rows: DataFrame, x: str, width: int, label: str, id_col: str, held_out: Column, patience: int | None = 50, **settings) -> booster.Boosted:
    """``held_out`` is 1 for the rows whose loss stops the rounds, else 0; bins are cut on the others."""
    edges = binned.fit_edges(rows.filter(held_out == 0), x, width)
    return booster.fit(cut(binned.pack(rows, x, label, id_col, edges, held_out)), edges, booster.Params(**settings), patience)


@dataclass
class TextScorer:
    selected: list[str]
    scores: dict[str, float]
    scaler: dict
    forest: forest.Forest
    boosted: booster.Boosted
    weight: float

    def features(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` and the selected, scaled features as an array ``_x``."""
        vec = st.vector_56(df, keep).select(*keep, *self.selected)
        return encode.standard_scale(vec, self.scaler).select(*keep, F.array(*self.selected).alias("_x"))

    def probabilities(self, featured: DataFrame, keep: list[str]) -> DataFrame:
        """``p1``, the forest's vote share, and ``p2``, the boosted trees' probability."""
        both = featured.select(*keep, self.forest.score("_x").alias("_s"), self.boosted.probability("_x").alias("p2"))
        return both.select(*keep, F.col("_s.vote_share").alias("p1"), "p2")

    def transform(self, df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
        keep = [id_col, text]
        scored = self.probabilities(self.features(df.select(*keep), keep), keep)
        return ensemble.prediction_record(ensemble.score(scored, "p1", "p2", self.weight), "p1", "p2", text, id_col)

    def save(self, spark: SparkSession, path: str) -> None:
        parts = {"selected": self.selected, "scores": self.scores, "scaler": self.scaler, "weight": self.weight,
                 "forest": self.forest.to_dict(), "boosted": self.boosted.to_dict()}
        spark.createDataFrame([(k, json.dumps(v)) for k, v in parts.items()], "part string, value string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TextScorer":
        parts = {r["part"]: json.loads(r["value"]) for r in spark.read.parquet(path).collect()}
        return cls(**{**parts, "forest": forest.Forest.from_dict(parts["forest"]), "boosted": booster.Boosted.from_dict(parts["boosted"])})


def fit_scorer(df: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "label", k: int = 40, trees: int = forest.TREES, rounds: int = 500,
               depth: int = forest.DEPTH, patience: int = 30, **boost) -> tuple[TextScorer, DataFrame]:
    """Fit on train, stop boosting and pick the ensemble weight on val; returns the scorer and the held-out test rows.

    Features are written once and read by every later step.
    """
    featured = cut(st.vector_56(df, [id_col, label], text))
    parts = split.three_way(featured.select(id_col, label), id_col, label)
    data = cut(featured.join(parts.select(id_col, "split"), id_col))
    train = data.filter(F.col("split") == "train")
    names = list(st.NAMES_56)
    table = selection.binned_mutual_information(train, names, label)
    ranked = selection.select_k_best(table, names, k).collect()  # k rows
    selected, scores = [r["feature"] for r in ranked], {r["feature"]: r["score"] for r in ranked}
    scaler = encode.fit_standard(train, selected)
    ready = cut(encode.standard_scale(data, scaler).select(id_col, label, "split", F.array(*selected).alias("_x")))
    trained, held_out = F.col("split") == "train", F.col("split") == "val"
    grown = fit_forest(ready.filter(trained), "_x", k, label, id_col, trees=trees, depth=depth)
    boosted = fit_boosted(ready.filter(trained | held_out), "_x", k, label, id_col, held_out.cast("int"), patience, rounds=rounds, **boost)
    scorer = TextScorer(selected, scores, scaler, grown, boosted, 0.5)
    val = scorer.probabilities(ready.filter(held_out), [id_col, label])
    scorer.weight = ensemble.best_weight(val, label, "p1", "p2")
    return scorer, scorer.probabilities(ready.filter(F.col("split") == "test"), [id_col, label])
