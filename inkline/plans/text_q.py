"""Scans, cleaning, de-duplication, splits and tokenisers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import clean, split
from ..sources.tables import categorical_table, load, spread, strip_column_names
from .registry import query, tidy
from .sqltext import CLEAN, FLAT, alpha_sql, big, quote, r, sentences_sql, sentences_term_sql, strip_sql


def documents(spark, sf):
    return load(spark, sf, "documents")


def text_docs(spark, sf):
    return spread(documents(spark, sf).select("doc_id", "text"), "doc_id")


def labelled(spark, sf, label: str = "quality"):
    """Documents with a binary label; the label table is the smaller side by far."""
    labels = load(spark, sf, "labels").select("doc_id", F.col(label).alias("label"))
    return text_docs(spark, sf).join(labels, "doc_id")


LABELLED = "SELECT d.doc_id, d.text, l.quality AS label FROM documents d JOIN labels l USING (doc_id)"


@query("scan_documents", "SELECT doc_id, lang, source, n_chars FROM documents WHERE lang = 'en' AND n_chars > 100")
def scan_documents(spark, sf):
    return (documents(spark, sf).filter((F.col("lang") == "en") & (F.col("n_chars") > 100))
            .select("doc_id", "lang", "source", "n_chars"))


@query("load_categorical", """SELECT o_orderkey, trim(o_orderstatus) AS o_orderstatus, trim(o_orderpriority) AS label
FROM orders""")
def load_categorical(spark, sf):
    orders = load(spark, sf, "orders")
    return categorical_table(orders, "o_orderpriority", ("o_custkey", "o_totalprice", "o_orderdate"), ("o_orderkey",))


@query("clean_text", f"""SELECT doc_id, {strip_sql("translate(replace(text, 'Â', ''), chr(10) || chr(13), '  ')")} AS repaired,
{CLEAN} AS collapsed FROM documents""")
def clean_text(spark, sf):
    return text_docs(spark, sf).select(
        "doc_id", clean.repair(F.col("text")).alias("repaired"), tx.collapse_spaces(F.col("text")).alias("collapsed"))


@query("filter_min_words", f"SELECT doc_id FROM documents WHERE len(regexp_extract_all(text, '{tx.WORD}')) >= 5")
def filter_min_words(spark, sf):
    return clean.min_words(text_docs(spark, sf)).select("doc_id")


@query("filter_min_chars", f"SELECT doc_id FROM documents WHERE length({strip_sql('text')}) > 10")
def filter_min_chars(spark, sf):
    return clean.min_chars(text_docs(spark, sf)).select("doc_id")


@query("clean_chain", f"""WITH s AS (
  SELECT doc_id, text, label::int AS label FROM ({LABELLED}) WHERE text IS NOT NULL AND label IS NOT NULL
  AND {strip_sql('text')} <> ''),
d AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM s),
t AS (SELECT doc_id, label, text FROM d WHERE rn = 1)
SELECT doc_id, label::bigint AS label, {CLEAN} AS text FROM t""")
def clean_chain(spark, sf):
    return tidy(clean.cleaning_chain(labelled(spark, sf)))


@query("truncate_chars", "SELECT doc_id, substr(text, 1, 3000) AS head FROM documents")
def truncate_chars(spark, sf):
    """Truncation as an operator of its own; the cleaning chain keeps whole texts."""
    return documents(spark, sf).select("doc_id", F.substring("text", 1, 3000).alias("head"))


@query("dedup_text", """SELECT doc_id, lang, source FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""")
def dedup_text(spark, sf):
    return clean.keep_first(documents(spark, sf)).select("doc_id", "lang", "source")


LABEL_WORDS = "CASE event_type WHEN 'signup' THEN '1' WHEN 'purchase' THEN 'AI' WHEN 'error' THEN 'bot' WHEN 'view' THEN '1.0' ELSE 'human' END"


@query("binarize_label", f"""SELECT event_id, (CASE WHEN lab IN ('1', 'ai', 'AI', 'machine', 'bot') OR try_cast(lab AS double) = 1
THEN 1 ELSE 0 END)::bigint AS label_binary FROM (SELECT event_id, {LABEL_WORDS} AS lab FROM events)""")
def binarize_label(spark, sf):
    events = load(spark, sf, "events").select("event_id", F.expr(LABEL_WORDS).alias("label_id"))
    return tidy(clean.with_binary_label(events).select("event_id", "label_binary"))


@query("missing_to_null", """SELECT c_custkey, nullif(trim(CASE WHEN c_mktsegment = 'BUILDING' THEN '  ' ELSE c_mktsegment END), '')
AS segment, trim(c_name) AS label FROM customer""")
def missing_to_null(spark, sf):
    blanked = F.when(F.col("c_mktsegment") == "BUILDING", "  ").otherwise(F.col("c_mktsegment"))
    customers = load(spark, sf, "customer").select("c_custkey", blanked.alias(" segment "), "c_name")
    return categorical_table(strip_column_names(customers), "c_name", (), ("c_custkey",), blank_is_missing=True)


BIN_COLS = ("l_quantity", "l_extendedprice", "l_discount")


def tertile_sql(col: str, table: str, part: int) -> str:
    return (f"(SELECT min(v) FROM (SELECT {col} AS v, sum(count(*)) OVER (ORDER BY {col}) AS cum FROM {table} "
            f"WHERE {col} IS NOT NULL GROUP BY {col}) WHERE cum * 3 >= {part} * (SELECT count({col}) FROM {table}))")


def bin_sql(col: str, table: str) -> str:
    return (f"CASE WHEN {col} IS NULL THEN NULL WHEN {col} <= {tertile_sql(col, table, 1)} THEN 'LOW' "
            f"WHEN {col} <= {tertile_sql(col, table, 2)} THEN 'MEDIUM' ELSE 'HIGH' END")


@query("bin_features", "SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, " + ", ".join(
    f"{bin_sql(k, 'lineitem')} AS {k}" for k in BIN_COLS) + " FROM lineitem")
def bin_features(spark, sf):
    items = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *BIN_COLS)
    return tidy(clean.tertile_bins(items, list(BIN_COLS)))


# --- splits ------------------------------------------------------------------
RANKED = """ranked AS (SELECT o_orderkey, o_orderpriority,
  row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5(o_orderkey::varchar), o_orderkey) AS rn,
  count(*) OVER (PARTITION BY o_orderpriority) AS nc FROM orders)"""


def order_labels(spark, sf):
    return load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")


@query("split_stratified", f"""WITH {RANKED} SELECT o_orderkey, o_orderpriority,
CASE WHEN rn <= greatest(1, round_even(nc * 0.2::double, 0)) THEN 'test' ELSE 'train' END AS split FROM ranked""")
def split_stratified(spark, sf):
    return split.stratified(order_labels(spark, sf), "o_orderkey", "o_orderpriority")


THREE = f"""{RANKED}, q AS (SELECT *, greatest(1, round_even(nc * 0.1::double, 0)) AS nt FROM ranked),
v AS (SELECT *, greatest(1, round_even((nc - nt) * (0.1::double / (1 - 0.1::double)), 0)) AS nv FROM q),
parts AS (SELECT o_orderkey, o_orderpriority, CASE WHEN rn <= nt THEN 'test' WHEN rn <= nt + nv THEN 'val' ELSE 'train' END AS split FROM v)"""


@query("split_three_way", f"WITH {THREE} SELECT * FROM parts")
def split_three_way(spark, sf):
    return split.three_way(order_labels(spark, sf), "o_orderkey", "o_orderpriority")


@query("union_train_val", f"WITH {THREE} SELECT o_orderkey, o_orderpriority FROM parts WHERE split IN ('train', 'val')")
def union_train_val(spark, sf):
    parts = split_three_way(spark, sf)
    train, val = (parts.filter(F.col("split") == k).drop("split") for k in ("train", "val"))
    return train.unionByName(val)


@query("split_random", """WITH r AS (SELECT vec_id, row_number() OVER (ORDER BY md5(vec_id::varchar), vec_id) AS rn,
  count(*) OVER () AS n FROM embeddings),
t AS (SELECT *, round_even(n * 0.2::double, 0) AS nt FROM r), v AS (SELECT *, round_even((n - nt) * 0.2::double, 0) AS nv FROM t)
SELECT vec_id, CASE WHEN rn <= nt THEN 'test' WHEN rn <= nt + nv THEN 'val' ELSE 'train' END AS split FROM v""")
def split_random(spark, sf):
    return split.random_split(load(spark, sf, "embeddings").select("vec_id"), "vec_id", 0.2, 0.2)


@query("kfold_assign", f"WITH {RANKED} SELECT o_orderkey, o_orderpriority, ((rn - 1) % 5)::bigint AS fold FROM ranked")
def kfold_assign(spark, sf):
    return tidy(split.k_folds(order_labels(spark, sf), "o_orderkey", "o_orderpriority"))


@query("bootstrap_sample")
def bootstrap_sample(spark, sf):
    """Draws per class and how many different rows they hit; as many draws as rows in all."""
    drawn = split.bootstrap(order_labels(spark, sf), "o_orderkey")
    return drawn.groupBy("o_orderpriority").agg(F.sum("copies").alias("n"), F.count("*").alias("n_rows"))


@query("bootstrap_size", "SELECT count(*) AS n_draws, true AS some_repeat, true AS none_foreign FROM orders")
def bootstrap_size(spark, sf):
    """What holds for any seed: as many draws as rows, some row more than once, and only rows of the table."""
    orders = order_labels(spark, sf)
    drawn = split.bootstrap(orders, "o_orderkey")
    foreign = drawn.join(orders, "o_orderkey", "left_anti").count()
    return drawn.agg(F.sum("copies").alias("n_draws"), (F.max("copies") > 1).alias("some_repeat"), F.lit(foreign == 0).alias("none_foreign"))


@query("distinct_values", """SELECT 'l_returnflag' AS feature, l_returnflag AS value FROM lineitem GROUP BY 2
UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem GROUP BY 2""")
def distinct_values(spark, sf):
    items = load(spark, sf, "lineitem").select("l_returnflag", "l_linestatus")
    return items.unpivot([], ["l_returnflag", "l_linestatus"], "feature", "value").distinct()


# --- tokenisers ----------------------------------------------------------------
def tokens_sql(array: str, extra: str = "") -> str:
    return (f"SELECT doc_id, len({array})::bigint AS n, array_to_string({array}, '|') AS tokens FROM "
            f"(SELECT doc_id, text, {FLAT} AS flat FROM documents){extra}")


def tokens(spark, sf, array):
    return tidy(text_docs(spark, sf).withColumn("flat", tx.flatten_lines(F.col("text"))).select(
        "doc_id", array.alias("a")).select("doc_id", F.size("a").alias("n"), F.array_join("a", "|").alias("tokens")))


@query("tokenize_words", tokens_sql(f"regexp_extract_all(text, '{tx.WORD}')"))
def tokenize_words(spark, sf):
    return tokens(spark, sf, tx.word_tokens(F.col("text")))


@query("tokenize_alpha", tokens_sql(alpha_sql("flat")))
def tokenize_alpha(spark, sf):
    return tokens(spark, sf, tx.alpha_tokens(F.col("flat")))


@query("split_sentences", tokens_sql(sentences_sql("text")))
def split_sentences(spark, sf):
    return tokens(spark, sf, tx.sentences(F.col("text")))


@query("split_sentences_term", tokens_sql(sentences_term_sql("flat")))
def split_sentences_term(spark, sf):
    return tokens(spark, sf, tx.sentences_terminated(F.col("flat")))


@query("split_clauses", tokens_sql(f"regexp_split_to_array(text, '{tx.CLAUSE_END}')"))
def split_clauses(spark, sf):
    return tokens(spark, sf, tx.clauses(F.col("text")))


@query("ngrams", f"""WITH w AS (SELECT doc_id, list_transform(regexp_extract_all(text, '{tx.WORD}'), lambda x: lower(x)) AS a FROM documents),
g AS (SELECT doc_id, list_transform(range(1, len(a)), lambda i: a[i] || ' ' || a[i+1]) AS b2,
  list_transform(range(1, len(a) - 1), lambda i: a[i] || ' ' || a[i+1] || ' ' || a[i+2]) AS b3 FROM w)
SELECT doc_id, array_to_string(b2, '|') AS bigrams, array_to_string(b3, '|') AS trigrams FROM g""")
def ngrams(spark, sf):
    words = F.transform(tx.word_tokens(F.col("text")), F.lower)
    return text_docs(spark, sf).select("doc_id", words.alias("a")).select(
        "doc_id", F.array_join(tx.ordered_ngrams(F.col("a"), 2), "|").alias("bigrams"),
        F.array_join(tx.ordered_ngrams(F.col("a"), 3), "|").alias("trigrams"))


@query("eda_lengths", f"""SELECT doc_id, length(text)::bigint AS chars,
len(list_filter(regexp_split_to_array(text, '{tx.SPACE}+'), lambda x: x <> ''))::bigint AS words FROM documents""")
def eda_lengths(spark, sf):
    return tidy(text_docs(spark, sf).select(
        "doc_id", F.length("text").alias("chars"), F.size(tx.blank_tokens(F.col("text"))).alias("words")))
