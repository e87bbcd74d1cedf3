"""Shuffled shards in two passes.

The first pass scatters the records: a record's shard follows from its doc_id
and the number of shards (highest of one hash per shard, so that a further shard takes
records only into itself), and a seeded hash sends it to one of the shard's
buckets, of which there are as many as keep a bucket to ``bucket_bytes`` on
average. The second pass puts each bucket in order of id, shuffles it by
Fisher-Yates with a generator seeded by the bucket, and writes it. Slots number a
shard's records over its buckets.
"""

from __future__ import annotations

import uuid
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir

LAW = "key"
SHARDS, SEED, BUCKET_BYTES = 16, 11, 32 << 20


def key_of(doc_id: Column, text: Column) -> Column:
    """The id as text; records without one are told apart by their text."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("text "), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))


def shard_of(key: Column, shards: int) -> Column:
    """The shard whose hash with the key is the largest."""
    marks = [F.struct(F.xxhash64(key, F.lit(k)).alias("h"), F.lit(k).alias("k")) for k in range(shards)]
    return F.array_max(F.array(*marks))["k"]


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    order = list(range(n))
    partner = np.random.default_rng(seed).integers(np.arange(n), n).tolist() if n else []
    for i, j in enumerate(partner):
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def shuffler(seed: int):
    def run(bucket: pa.Table) -> pa.Table:
        start = pc.sort_indices(bucket, [("_key", "ascending"), ("text_crc32", "ascending"), ("size", "ascending")])
        first = bucket.slice(0, 1).to_pylist()[0]
        order = start.take(pa.array(fisher_yates(bucket.num_rows, [seed, first["shard"], first["bucket"]])))
        return bucket.take(order).drop_columns(["_key"]).append_column("place", pa.array(np.arange(bucket.num_rows)))

    return run


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> None:
    """Writes (row, size, text_crc32, grown_shard, bucket, place) as Parquet, a folder per shard, in shuffled order.

    ``row`` holds all columns of the record, so none can clash.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    total = docs.agg(F.sum(size).alias("n")).first()["n"] or 0
    buckets = max(1, ceil(total / (shards * bucket_bytes)))
    key = key_of(F.col("doc_id"), F.col("text"))
    # the shard follows from the key alone; rows that share a key part again by what else they hold
    whole = [F.col(f"`{f.name}`") for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType)]
    scattered = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(key, shards + 1).cast("int").alias("grown_shard"), shard_of(key, shards).cast("int").alias("shard"),
        F.pmod(F.xxhash64(F.lit(seed), key, *whole), F.lit(buckets)).cast("int").alias("bucket"), key.alias("_key"))
    schema = T.StructType([f for f in scattered.schema.fields if f.name != "_key"] + [T.StructField("place", T.LongType())])
    # twice as many partitions as buckets, so that few tasks get more than one or two
    (scattered.repartition(2 * shards * buckets, "shard", "bucket").groupBy("shard", "bucket").applyInArrow(shuffler(seed), schema)
     .sortWithinPartitions("shard", "bucket", "place").write.partitionBy("shard").parquet(path))


def read_shards(spark, path: str, row: T.StructType) -> DataFrame:
    """The written shards with each record's slot: its place after all earlier buckets of the shard."""
    schema = T.StructType([T.StructField("row", row), T.StructField("size", T.LongType()), T.StructField("text_crc32", T.LongType()),
                           T.StructField("grown_shard", T.IntegerType()), T.StructField("bucket", T.IntegerType()),
                           T.StructField("place", T.LongType()), T.StructField("shard", T.IntegerType())])
    written = spark.read.schema(schema).parquet(path)
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = (written.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
              .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")))
    return written.join(starts, ["shard", "bucket"]).withColumn("slot", F.col("_start") + F.col("place")).drop("_start")


def shard(docs: DataFrame, path: str | None = None, **settings) -> DataFrame:
    """Writes the shards and returns them: all columns above and ``slot``.

    Null texts count as empty, and stay null in the written row. Records
    without doc_id are placed by their text. Rows that repeat a doc_id share its
    shard and have slots of their own; they part over its buckets unless all
    they hold is equal, and then they are interchangeable. Texts may be as long as a bucket or longer; such a one fills its bucket alone. An empty table gives no files and no rows.
    """
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark).rstrip('/')}/shards-{uuid.uuid4().hex}"
    write_shards(docs, path, **settings)
    return read_shards(spark, path, docs.schema)


def placement(shards: DataFrame) -> DataFrame:
    return shards.select(F.col("row.doc_id").alias("doc_id"), "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", "grown_shard")
