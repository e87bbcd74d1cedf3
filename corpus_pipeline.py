"""A corpus from classifier to tokens: five stages, each over all that the one before it kept.

Every stage but the last returns the columns of ``documents``, whatever further
columns these have: a stage hands its operator the four that operators read and the others as one
struct, so no column of an operator can take the place of one of the table.
Between the stages the rows are written as Parquet under the shared checkpoint
folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkline.llm import line_rules, mixing, near_dup, pieces, quality
from inkline.session import cut

READ = ("doc_id", "text", "lang", "source")


def carried(docs: DataFrame) -> DataFrame:
    others = [F.col(f"`{c}`") for c in docs.columns if c not in READ]
    return docs.select(*READ, (F.struct(*others) if others else F.lit(None).cast("int")).alias("_row"))


def restored(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The table's own columns, with ``changed`` ones in their places."""
    return rows.select(*[changed.get(c, F.col(c) if c in READ else F.col("_row")[c]).alias(c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that the neighbours call good; learns from labelled rows outside the held-out fold.

    Null and empty texts have a score like any other. Rows are judged one by one, so repeated ones
    stay or go together, and rows without doc_id are judged by their text. An empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return restored(quality.classify(carried(docs), labels).filter("predicted = 1"), docs)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that pass, without their failed lines.

    Null, empty and short texts fail. Rows are judged one by one, ids are not
    read. ``n_chars`` follows the new text. An empty table stays empty.
    """
    ruled = line_rules.apply_rules(carried(docs)).filter("kept")
    return restored(ruled, docs, text=F.col("cleaned"), n_chars=F.length("cleaned").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group, once.

    Of rows that repeat a kept doc_id the one with the least text, then the least other
    columns, stays. Texts without words link with nothing and stay, as do all rows without
    doc_id. An empty table stays empty.
    """
    kept = cut(near_dup.near_duplicates(docs).filter("kept and doc_id is not null").groupBy(F.col("doc_id").alias("_kept")).agg(F.count("*").alias("_n")))
    rows = carried(docs)
    found = rows.join(kept, F.col("doc_id") == F.col("_kept"))
    again = found.filter("_n > 1").groupBy("doc_id").agg(F.min(F.struct("text", "lang", "source", "_row")).alias("_least")).select("doc_id", "_least.*")
    once = found.filter("_n = 1").select(*rows.columns)
    return restored(once.unionByName(again).unionByName(rows.filter("doc_id is null")), docs)


def target_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture holds them.

    Null languages and sources are values of their own, rows without doc_id are placed by their text,
    and empty texts ride along. An empty table stays empty.
    """
    mixed = mixing.mix(carried(docs), mixing.domain_of_source(F.col("source")), epochs=mixing.EPOCHS, seed=mixing.SEED, share=mixing.SHARE, weights=mixing.WEIGHTS)
    times = mixed.filter("copies > 0").select(*READ, "_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"))
    return restored(times, docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text, one row per row; null and empty texts have no ids."""
    return pieces.digests(pieces.tokenise(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model")))


STAGES = [("quality_classifier", quality_classifier), ("quality_rules", quality_rules), ("near_duplicates", near_duplicates),
          ("target_mixture", target_mixture), ("tokens", tokens)]

# The classifier's votes and the tokens have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
