"""Run registered queries against DuckDB on the same parquet files.

    python tests/oracle_check.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def make_spark(cpus: str = "8"):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def canon(pdf):
    pdf = pdf[sorted(pdf.columns)]
    rows = [tuple(map(repr_value, row)) for row in pdf.itertuples(index=False, name=None)]
    return list(pdf.columns), sorted(rows)


def repr_value(v):
    if v is None or v is pd.NA or v != v:
        return "NULL"
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return f"f{v:.9g}"
    if isinstance(v, bool):
        return f"b{v}"
    if isinstance(v, int):
        return f"i{v}"
    return f"s{v}"


def plain(pdf):
    """Whole-number columns with gaps as float64, in the way Spark hands them over."""
    gaps = [c for c in pdf.columns if pd.api.types.is_extension_array_dtype(pdf[c].dtype) and pdf[c].dtype.kind == "i" and pdf[c].isna().any()]
    return pdf.astype(dict.fromkeys(gaps, "float64"))


def kinds(pdf):
    return {c: pdf[c].dtype.kind for c in pdf.columns}


def compare(spark, con, sf, fn, sql):
    t0 = time.time()
    got = fn(spark, sf).toPandas()
    spent = time.time() - t0
    if sql is None:
        return ("ROWS" if len(got) else "EMPTY"), spent, f"{len(got)} rows"
    want = plain(con.sql(sql).df())
    gc, gr = canon(got)
    wc, wr = canon(want)
    if gc != wc:
        return "COLUMNS", spent, f"{gc} vs {wc}"
    if len(gr) != len(wr):
        return "COUNT", spent, f"{len(gr)} vs {len(wr)}"
    if gr != wr:
        only_g, only_w = sorted(set(gr) - set(wr)), sorted(set(wr) - set(gr))
        return "VALUES", spent, f"{len(only_g)} differ\n   cols {gc}\n   got  {only_g[:2]}\n   want {only_w[:2]}"
    gk, wk = kinds(got), kinds(want)
    if gk != wk:
        return "TYPES", spent, f"{ {c: (gk[c], wk[c]) for c in gk if gk[c] != wk[c]} }"
    return "OK", spent, f"{len(gr)} rows"


def main():
    import __spark_entry__ as entry

    sf = sys.argv[1]
    queries, oracles = entry.queries(), entry.oracle_sql()
    keys = sys.argv[2:] or list(queries)
    spark, con = make_spark(), duck(sf)
    bad = []
    for k in keys:
        try:
            status, spent, note = compare(spark, con, sf, queries[k], oracles.get(k))
        except Exception as e:  # noqa: BLE001 - report every key
            status, spent, note = "ERROR", 0.0, f"{type(e).__name__}: {str(e)[:900]}"
        print(f"{status:8}{k:26}{spent:7.2f}s  {note}", flush=True)
        if status not in ("OK", "ROWS"):
            bad.append(k)
    print(f"{len(keys) - len(bad)}/{len(keys)} good; bad: {bad}")


if __name__ == "__main__":
    main()
