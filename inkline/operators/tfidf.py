"""TF-IDF as relational tables: ``(doc, term, tf)``, a vocabulary, ``(doc, term, weight)``.

Term frequencies are counted inside the document's row, so the first exchange
is the map-side combined document-frequency count. A capped vocabulary is
bounded by its cap and may be broadcast; an uncapped one is left to the
optimiser, which sizes it at run time and splits skewed terms.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import counts, lexicons as lx, text as tx

BROADCAST_TERMS = 100_000


@dataclass(frozen=True)
class Vectoriser:
    """Options of one vectoriser."""

    max_features: int | None = None
    bigrams: bool = False
    stopwords: tuple[str, ...] = field(default=())
    min_df: int = 1
    max_df: float = 1.0
    sublinear: bool = False


# fixed values: the three configurations in use
PLAIN_5000 = Vectoriser(max_features=5000)
BAYES_10000 = Vectoriser(max_features=10000, bigrams=True, stopwords=lx.ENGLISH_STOPWORDS)
HYBRID_10000 = Vectoriser(max_features=10000, bigrams=True, min_df=2, max_df=0.95, sublinear=True)


def term_frequencies(df: DataFrame, id_col: str, text: str, v: Vectoriser = Vectoriser(), carry: tuple[str, ...] = ()) -> DataFrame:
    """``(id, carried columns, term, tf)``; bigrams are taken after stop words are dropped."""
    keep = [id_col, *carry]
    out = df.select(*keep, tx.term_tokens(F.col(text), v.stopwords).alias("_t"))
    if v.bigrams:
        out = out.select(*keep, F.concat("_t", tx.word_ngrams(tx.joined(F.col("_t")), 2)).alias("_t"))
    out = out.select(*keep, F.sort_array("_t").alias("_s"))
    out = out.select(*keep, "_s", counts.run_ends(F.col("_s")).alias("_e"))
    out = out.select(*keep, F.explode(counts.term_counts(F.col("_s"), F.col("_e"), counts.run_lengths(F.col("_e")))).alias("x"))
    return out.select(*keep, "x.term", "x.tf")


def fit_vocabulary(terms: DataFrame, n_docs: int, v: Vectoriser = Vectoriser()) -> DataFrame:
    """``(term, df, cf, idf)`` with ``idf = ln((1 + n) / (1 + df)) + 1``."""
    vocab = terms.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))
    vocab = vocab.filter((F.col("df") >= v.min_df) & (F.col("df") <= v.max_df * n_docs))
    if v.max_features is not None:
        vocab = vocab.orderBy(F.desc("cf"), "term").limit(v.max_features)
    return vocab.withColumn("idf", F.ln((F.lit(1.0) + n_docs) / (1.0 + F.col("df"))) + 1.0)


def weigh(terms: DataFrame, vocab: DataFrame, id_col: str, v: Vectoriser = Vectoriser()) -> DataFrame:
    """``(id, term, weight)``, L2-normalised per document; unknown terms drop out."""
    small = v.max_features is not None and v.max_features <= BROADCAST_TERMS
    table = vocab.select("term", "idf")
    joined = terms.join(F.broadcast(table) if small else table, "term")
    tf = F.ln(F.col("tf").cast("double")) + 1.0 if v.sublinear else F.col("tf").cast("double")
    raw = joined.withColumn("_w", tf * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy(id_col)))  # one document's terms
    return raw.select(id_col, "term", (F.col("_w") / norm).alias("weight"))


def fit_transform(df: DataFrame, id_col: str, text: str, v: Vectoriser) -> DataFrame:
    terms = term_frequencies(df, id_col, text, v)
    return weigh(terms, fit_vocabulary(terms, df.count(), v), id_col, v)


def transform(train: DataFrame, test: DataFrame, id_col: str, text: str, v: Vectoriser) -> DataFrame:
    """Vocabulary and idf from ``train`` only, weights for ``test``."""
    vocab = fit_vocabulary(term_frequencies(train, id_col, text, v), train.count(), v)
    return weigh(term_frequencies(test, id_col, text, v), vocab, id_col, v)
