"""Registered queries of the training-data operators, with the SQL that checks them where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, licences, line_rules, mixing, near_dup, pieces, pivots, quality, runs, sharding, url_lists, vector_codes, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_licences")
def op1(spark, sf):
    return licences.summary(licences.scan_licences(table(spark, sf, "documents")))


@query("op2_quality_neighbours")
def op2(spark, sf):
    return quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels")).select("doc_id", "held_out", "score", "predicted")


@query("op3_mix_sources", mixing.ORACLE)
def op3(spark, sf):
    mixed = mixing.mix(table(spark, sf, "documents"), mixing.domain_of_source(F.col("source")), epochs=mixing.EPOCHS, seed=mixing.SEED,
                       share=mixing.SHARE, weights=mixing.WEIGHTS)
    return mixed.select("doc_id", "domain", "lang", "source", "n_tokens", "copies")


@query("op4_line_rules", line_rules.ORACLE)
def op4(spark, sf):
    return line_rules.apply_rules(table(spark, sf, "documents")).drop("text", "lang", "source", "n_chars", "cleaned")


@query("op5_url_lists", url_lists.ORACLE)
def op5(spark, sf):
    pages = table(spark, sf, "pages")
    judged = url_lists.judge(url_lists.page_captures(pages), url_lists.host_events(pages))
    return judged.withColumns({"fetched": F.col("fetched").cast("string"), "listed": F.col("listed").cast("string")})


@query("op6_near_vectors")
def op6(spark, sf):
    return pivots.near_vectors(table(spark, sf, "embeddings"))


@query("op7_warc")
def op7(spark, sf):
    return warc.archive(table(spark, sf, "pages"), with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_near_dup")
def op8(spark, sf):
    return near_dup.near_duplicates(table(spark, sf, "documents"))


@query("op9_shards")
def op9(spark, sf):
    return sharding.placement(sharding.shard(table(spark, sf, "documents")))


@query("op10_pieces")
def op10(spark, sf):
    return pieces.digests(pieces.tokenise(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model")))


@query("op11_periodic_runs", runs.ORACLE)
def op11(spark, sf):
    return runs.digests(runs.periodic_runs(runs.with_rounds(table(spark, sf, "documents"))))


@query("op12_vector_codes", vector_codes.ORACLE)
def op12(spark, sf):
    coded, books = vector_codes.compress(table(spark, sf, "embeddings"))
    return vector_codes.with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


@query("op13_chat_format", chat.ORACLE)
def op13(spark, sf):
    return chat.digests(chat.format_conversations(chat.with_planted(spark, table(spark, sf, "conversations"))))
