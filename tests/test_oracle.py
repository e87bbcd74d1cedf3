"""Registered queries against DuckDB. INKLINE_FULL=1 runs every key instead of the short list."""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

SHORT = """feat_basic feat_lexical feat_readability feat_lexicons feat_entropy feat_repetition feat_cohesion clean_chain dedup_text
bin_features split_three_way kfold_assign ngrams tokenize_alpha roc_auc average_precision per_class_metrics classification_report
ensemble_weight_search cv_summary info_gain gain_ratio best_binary_split chi2_scores mutual_info_binned ema_smooth asof_loss_gap
early_stop tfidf naive_bayes_score id3_predict cart_level_split knn_classify silhouette_exact""".split()
KEYS = [k for k in entry.queries() if k in entry.oracle_sql()] if os.environ.get("INKLINE_FULL") else SHORT


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("key", KEYS)
def test_matches_sql(spark, con, sf, key):
    status, _, note = compare(spark, con, sf, entry.queries()[key], entry.oracle_sql()[key])
    assert status == "OK", note


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
