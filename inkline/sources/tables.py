"""Readers and writers with declared schemas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx

LABELLED_TEXT = "doc_id long, text string, label int"
TRAINING_LOG = (
    "train array<struct<step:int,loss:double,lr:double,epoch:double>>, "
    "eval array<struct<step:int,eval_loss:double,accuracy:double,f1:double,f1_ai:double,f1_human:double>>, "
    "best_step int, best_f1 double"
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use every core on a scan with fewer splits than cores.

    ``df`` is a plain scan, so counting its splits plans it but runs nothing.
    A scan that has a split for every core is returned as it is, however few
    its files are; one that is dealt anew holds less than a split's bytes per
    core. Hash partitioning keeps a retried task's input the same.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(4 * cores, key)


def read_csv(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """Header CSV with a declared schema. Quoted fields may hold line breaks, which makes a file one task; without them, files are split."""
    return spark.read.schema(schema).csv(path, header=True, multiLine=multi_line, escape='"')


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.strip() for name in df.columns])


def categorical_columns(df: DataFrame, skip: tuple[str, ...]) -> list[str]:
    return [name for name in df.columns if name.strip() and name not in skip]


def categorical_table(
    df: DataFrame, label: str, skip: tuple[str, ...] = (), keep: tuple[str, ...] = (), blank_is_missing: bool = False
) -> DataFrame:
    """Every feature as a trimmed string, the label as ``label``; blank becomes NULL on request."""

    def cell(name: str) -> Column:
        value = tx.strip(F.col(name).cast("string"))
        return F.nullif(value, F.lit("")) if blank_is_missing else value

    names = categorical_columns(df, (*skip, *keep, label))
    return df.select(*keep, *[cell(n).alias(n) for n in names], cell(label).alias("label"))


def read_categorical_csv(
    spark: SparkSession, path: str, label: str = "label_id", skip: tuple[str, ...] = ("sr_no",), blank_is_missing: bool = False
) -> DataFrame:
    """All-string CSV of categories; an empty file is an error."""
    raw = spark.read.csv(path, header=True, inferSchema=False)
    if raw.isEmpty():
        raise ValueError(f"no rows in {path}")
    raw = raw.na.fill("") if not blank_is_missing else raw
    return categorical_table(raw, label, skip, blank_is_missing=blank_is_missing)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """One document per line, blank lines dropped."""
    return spark.read.text(path).select(tx.strip(F.col("value")).alias("text")).filter(F.col("text") != "")


def read_training_log(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A nested JSON training log as its train rows and its evaluation rows."""
    raw = spark.read.schema(TRAINING_LOG).json(path, multiLine=True)
    best = ["best_step", "best_f1"]
    train = raw.select(F.inline("train"))
    evals = raw.select(*best, F.inline("eval"))
    return train, evals


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Feature, score or metric table; CSV carries a header."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)
