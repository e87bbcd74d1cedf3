"""Registered queries, each next to the SQL that checks it."""

from . import features_q, logs_q, models_q, scores_q, select_q, text_q, tfidf_q, trees_q, vectors_q  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
