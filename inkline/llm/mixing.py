"""Mixing sources to target weights by hierarchical budgets.

A leaf is a (domain, language, source). A token budget runs down the tree: a
node's children share its budget by weight, none gets more than its own leaves
can supply in ``epochs`` passes, and what a child can't use goes to its
siblings. Since a node's ceiling is its whole subtree, a shortage leaves a family,
towards the next ancestor's other children, only when the family is used up.

A leaf's budget is filled by whole passes over it and then by a prefix of the
next one, in an order that depends on the seed, the pass and the doc_id. The
prefix ends before the first document that would exceed the budget. Rows fall
into buckets of that order; only the bucket in which the prefix ends is
sorted, so a leaf may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut

LEVELS = ("domain", "lang", "source")
BUCKET_ROWS = 20_000
RANGE = 1 << 32
WORDS = r"[^\x20\x09-\x0D]+"
BIG = "decimal(38,0)"


def level_keys(docs: DataFrame, level: int) -> list[str]:
    return [f"_k{i}" for i in range(level + 1)]


def weight_of(keys: list[str], weights: Mapping[str, int]) -> Column:
    """The weight listed for a node's path, 1 where none is listed."""
    mine = {k: v for k, v in weights.items() if k.count("/") == len(keys) - 1}
    if any(int(v) != v or v < 0 for v in mine.values()):
        raise ValueError("weights are whole numbers of 0 or more")
    path = F.concat_ws("/", *keys)
    if not mine:
        return F.lit(1).cast("long")
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in mine.items() for x in kv]), path).cast("long"), F.lit(1).cast("long"))


def pour(children: DataFrame, parents: list[str], name: list[str]) -> DataFrame:
    """Adds each child's ``budget`` of its parent's ``_parent``: by weight ``_w``, at most ``_cap``.

    Ordered by ceiling per weight, the children that reach their ceiling come
    first. Quotients are rounded down, so a few tokens of a budget may stay unused.
    """
    order = W.partitionBy(*parents).orderBy((F.col("_cap") / F.col("_w").cast("double")).asc_nulls_first(), *name)
    family = W.partitionBy(*parents)
    live = children.filter("_w > 0")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    behind = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    full = ((F.col("_parent") - F.coalesce(F.sum("_cap").over(before), F.lit(0))).cast(BIG) * F.col("_w")
            >= F.col("_cap").cast(BIG) * F.sum("_w").over(behind))
    told = live.withColumn("_full", full)
    rest = F.col("_parent") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("_cap"))).over(family), F.lit(0))
    open_weight = F.sum(F.when(~F.col("_full"), F.col("_w"))).over(family)
    share = F.floor((rest.cast(BIG) * F.col("_w")) / open_weight)
    given = told.withColumn("budget", F.when(F.col("_full"), F.col("_cap")).otherwise(share).cast("long"))
    none = children.filter("_w <= 0").withColumn("_full", F.lit(False)).withColumn("budget", F.lit(0).cast("long"))
    return given.unionByName(none).drop("_full")


def leaf_budgets(leaves: DataFrame, budget: int | None, share: float, epochs: int, weights: Mapping[str, int]) -> DataFrame:
    """(keys, n_docs, supply, budget) per leaf. Without ``budget`` it is ``share`` of all tokens, in whole thousandths."""
    depth = len(LEVELS)
    total = F.lit(budget).cast("long") if budget is not None else F.floor(F.col("_all") * round(share * 1000) / 1000).cast("long")
    top = leaves.agg(F.sum("supply").alias("_all")).select(total.alias("_parent"), F.lit(0).alias("_root"))
    current, parents = top, ["_root"]
    for level in range(depth):
        keys = [f"_k{i}" for i in range(level + 1)]
        sized = (leaves.withColumn("_root", F.lit(0)).groupBy("_root", *keys)
                 .agg((F.sum("supply") * epochs).alias("_cap"), F.sum("n_docs").alias("n_docs"), F.sum("supply").alias("supply"))
                 .withColumn("_w", weight_of(keys, weights)))
        family = sized.join(current, parents)
        poured = pour(family, parents, keys)
        parents = ["_root", *keys]
        current = poured.select(*parents, F.col("budget").alias("_parent"))
    return poured.select(*keys, "n_docs", "supply", "budget")


def name_of(doc_id: Column, text: Column) -> Column:
    """The id as text; rows without one are told apart by their text, so that many of them spread over the places of a pass."""
    return F.coalesce(doc_id.cast("string"), F.concat(F.lit("null "), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))


def place_of(seed: int, epoch: Column, name: Column) -> Column:
    """The document's place in a pass, as text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), name).cast("binary"))


def bucket_of(place: Column, buckets: Column) -> Column:
    return F.shiftright(F.conv(F.substring(place, 1, 8), 16, 10).cast("long") * buckets, 32)


def plan(docs: DataFrame, domain: Column, budget: int | None = None, share: float = 0.5, epochs: int = 2, seed: int = 17,
         weights: Mapping[str, int] | None = None) -> DataFrame:
    """(_k0, _k1, _k2, budget, supply, _passes, _buckets, _stop, _last) per leaf: whole passes and where the prefix ends."""
    read = docs.select(domain.alias("_d"), "lang", "source", name_of(F.col("doc_id"), F.col("text")).alias("_name"), F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORDS)).cast("long").alias("tokens"))
    meta = cut(read.select(*[F.coalesce(F.col(c).cast("string"), F.lit("null")).alias(f"_k{i}") for i, c in enumerate(("_d", "lang", "source"))], "_name", "tokens"))
    keys = [f"_k{i}" for i in range(3)]
    leaves = cut(meta.groupBy(*keys).agg(F.count("*").alias("n_docs"), F.sum("tokens").alias("supply")))
    budgets = leaf_budgets(leaves, budget, share, epochs, weights or {})
    whole = F.when(F.col("supply") > 0, F.least(F.lit(epochs).cast("long"), F.floor(F.col("budget") / F.col("supply").cast(BIG)).cast("long"))).otherwise(F.lit(0).cast("long"))
    told = cut(budgets.withColumn("_passes", whole)
               .withColumn("_rest", F.when(F.col("_passes") < epochs, F.col("budget") - F.col("_passes") * F.col("supply")).otherwise(F.lit(0)))
               .withColumn("_buckets", F.ceil(F.col("n_docs") / BUCKET_ROWS).cast("long")))
    placed = meta.join(told, keys).withColumn("_place", place_of(seed, F.col("_passes"), F.col("_name"))).withColumn("_b", bucket_of(F.col("_place"), F.col("_buckets")))
    totals = cut(placed.groupBy(*keys, "_b").agg(F.sum("tokens").alias("_sum"), F.first("_rest").alias("_rest")))
    run = totals.withColumn("_upto", F.sum("_sum").over(W.partitionBy(*keys).orderBy("_b")))
    over = cut(run.filter("_upto > _rest").groupBy(*keys).agg(F.min(F.struct("_b", (F.col("_upto") - F.col("_sum")).alias("_before"))).alias("_x"))
               .select(*keys, F.col("_x._b").alias("_stop"), F.col("_x._before").alias("_before")))
    inside = (placed.select(*keys, "_b", "_place", "tokens", "_rest").join(over.withColumnRenamed("_stop", "_b"), [*keys, "_b"])
              .withColumn("_sofar", F.sum("tokens").over(W.partitionBy(*keys, "_b").orderBy("_place"))))
    last = inside.filter("_before + _sofar <= _rest").groupBy(*keys).agg(F.max("_place").alias("_last"))
    return cut(told.join(over, keys, "left").join(last, keys, "left").select(*keys, "budget", "supply", "_passes", "_buckets", "_stop", "_last"))


def mix(docs: DataFrame, domain: Column, epochs: int = 2, seed: int = 17, **settings) -> DataFrame:
    """All columns of ``docs`` and domain, n_tokens, copies: how often the mixture holds the row.

    A null domain, language or source is a value of its own, written
    "null"; rows without doc_id are placed by their text. Null and empty texts have no tokens; they ride along where their
    place is within the prefix. Rows that repeat a doc_id in a leaf, or a text
    without one, are taken together or not at all. A node of weight 0 gets nothing. The plan, one row
    per leaf, meets the rows by an ordinary join that the optimiser sizes.
    """
    told = plan(docs, domain, epochs=epochs, seed=seed, **settings)
    rows = docs.withColumns({"domain": domain, "n_tokens": F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORDS)).cast("long")})
    leaf = told.select(*[F.col(c).alias(f"_m{c}") for c in told.columns])
    match = F.lit(True)
    for i, c in enumerate(LEVELS):
        match = match & (F.coalesce(rows[c].cast("string"), F.lit("null")) == leaf[f"_m_k{i}"])
    met = rows.join(leaf, match)
    place = place_of(seed, F.col("_m_passes"), name_of(F.col("doc_id"), F.col("text")))
    bucket = bucket_of(place, F.col("_m_buckets"))
    # without a stop every bucket fits: either nothing is left to fill or the leaf ends first
    within = F.when(F.col("_m_passes") >= epochs, F.lit(False)).when(F.col("_m_stop").isNull(), F.lit(True)).otherwise(
        (bucket < F.col("_m_stop")) | ((bucket == F.col("_m_stop")) & F.coalesce(place <= F.col("_m_last"), F.lit(False))))
    copies = (F.col("_m_passes") + within.cast("long")).alias("copies")
    return met.select(*[c for c in rows.columns if c != "copies"], copies)


def domain_of_source(source: Column) -> Column:
    """Three made-up domains of the test sources."""
    head = F.substring(F.md5(source.cast("string").cast("binary")), 1, 1)
    return F.when(head < "6", "web").when(head < "b", "books").otherwise("code")


WEIGHTS = {"web": 5, "books": 3, "code": 2, "web/en": 4, "books/en": 2, "code/en": 3, "web/de": 2, "web/en/src0": 2, "books/en/src1": 3}
SHARE, EPOCHS, SEED = 0.6, 2, 17


def _weight_sql(level: int, path: str) -> str:
    mine = {k: v for k, v in WEIGHTS.items() if k.count("/") == level}
    return "CASE " + path + " ".join(f" WHEN '{k}' THEN {v}" for k, v in mine.items()) + " ELSE 1 END" if mine else "1"


def _pour_sql(level: int) -> str:
    keys = [f"k{i}" for i in range(level + 1)]
    parent = keys[:-1]
    by = f"PARTITION BY {', '.join(parent)}" if parent else ""
    order = f"ORDER BY cap / CAST(w AS DOUBLE), {', '.join(keys)}"
    up = f"p{level - 1}" if level else "(SELECT floor(sum(supply) * 600 / 1000)::BIGINT budget FROM leaf)"
    join = f"JOIN {up} u ON {' AND '.join(f's.{k} = u.{k}' for k in parent)}" if parent else f", {up} u"
    return f"""
a{level} AS (SELECT s.*, u.budget parent FROM (SELECT {', '.join(keys)}, CAST(sum(supply) * {EPOCHS} AS BIGINT) cap,
    {_weight_sql(level, " || '/' || ".join(keys))} w FROM leaf GROUP BY {', '.join(keys)}) s {join}),
b{level} AS (SELECT *, CAST(parent - coalesce(sum(cap) OVER ({by} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS HUGEINT) * w
    >= CAST(cap AS HUGEINT) * sum(w) OVER ({by} {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) filled FROM a{level}),
p{level} AS (SELECT *, CAST(CASE WHEN filled THEN cap ELSE (CAST(parent - coalesce(sum(cap) FILTER (WHERE filled) OVER ({by}), 0) AS HUGEINT) * w)
    // CAST(sum(w) FILTER (WHERE NOT filled) OVER ({by}) AS HUGEINT) END AS BIGINT) budget FROM b{level}),"""


ORACLE = f"""
WITH doc AS (SELECT doc_id, coalesce(doc_id::VARCHAR, 'null ' || md5(coalesce(text, ''))) AS name, coalesce(lang, 'null') k1, coalesce(source, 'null') k2,
    CASE WHEN substr(md5(source), 1, 1) < '6' THEN 'web' WHEN substr(md5(source), 1, 1) < 'b' THEN 'books' ELSE 'code' END k0, lang, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) n_tokens FROM documents),
leaf AS (SELECT k0, k1, k2, CAST(sum(n_tokens) AS BIGINT) supply FROM doc GROUP BY ALL),{"".join(_pour_sql(i) for i in range(3))}
q AS (SELECT p2.k0, p2.k1, p2.k2, p2.budget, supply, CASE WHEN supply > 0 THEN least({EPOCHS}, p2.budget // supply) ELSE 0 END passes
    FROM p2 JOIN leaf USING (k0, k1, k2)),
r AS (SELECT doc.*, budget, passes, CASE WHEN passes < {EPOCHS} THEN budget - passes * supply ELSE -1 END rest,
    md5('{SEED}:' || passes || ':' || name) place FROM doc JOIN q USING (k0, k1, k2)),
s AS (SELECT *, sum(n_tokens) OVER (PARTITION BY k0, k1, k2 ORDER BY place) sofar FROM r)
SELECT doc_id, k0 AS domain, lang, source, n_tokens, CAST(passes + CASE WHEN sofar <= rest THEN 1 ELSE 0 END AS BIGINT) copies FROM s
"""
