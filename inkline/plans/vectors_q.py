"""Neighbours, clustering and boosting steps over ``embeddings`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boost, cluster, encode, neighbours, split
from ..sources.tables import load
from .registry import query, tidy
from .scores_q import scored, with_scores
from .sqltext import big, r


def vectors(spark, sf):
    return load(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"), "label")


PARTS = """e AS (SELECT vec_id, embedding::double[] AS v, label, row_number() OVER (ORDER BY md5(vec_id::varchar), vec_id) AS rn,
  count(*) OVER () AS n FROM embeddings),
te AS (SELECT * FROM e WHERE rn <= round_even(n * 0.2::double, 0)), tr AS (SELECT * FROM e WHERE rn > round_even(n * 0.2::double, 0))"""


SCALED = """st AS (SELECT i, avg(x) AS m, stddev_pop(x) AS s FROM (SELECT unnest(v) AS x, unnest(range(len(v))) AS i FROM tr) GROUP BY i),
sm AS (SELECT list(m ORDER BY i) AS m, list(CASE WHEN s > 0 THEN s ELSE 1 END ORDER BY i) AS s FROM st),
tes AS (SELECT vec_id, label, list_transform(list_zip(v, m, s), lambda z: (z[1] - z[2]) / z[3]) AS u FROM te, sm),
trs AS (SELECT vec_id, label, list_transform(list_zip(v, m, s), lambda z: (z[1] - z[2]) / z[3]) AS u FROM tr, sm)"""


@query("knn_classify", f"""WITH {PARTS}, {SCALED}, d AS (SELECT te.vec_id, tr.label, row_number() OVER (PARTITION BY te.vec_id
  ORDER BY list_distance(te.u, tr.u), tr.vec_id) AS k FROM tes te, trs tr),
vt AS (SELECT vec_id, label, count(*) AS c FROM d WHERE k <= 3 GROUP BY ALL),
p AS (SELECT vec_id, label, row_number() OVER (PARTITION BY vec_id ORDER BY c DESC, label) AS k FROM vt)
SELECT p.vec_id, te.label::bigint AS label, p.label::bigint AS pred FROM p JOIN te USING (vec_id) WHERE k = 1""")
def knn_classify(spark, sf):
    parts = split.random_split(vectors(spark, sf), "vec_id", 0.2)
    fitted = encode.fit_vector(parts.filter("split = 'train'"), "v")
    test, train = (encode.scale_vector(parts.filter(F.col("split") == k), "v", fitted).drop("split") for k in ("test", "train"))
    train = train.withColumnRenamed("vec_id", "train_id")
    pred = neighbours.classify(test, train, "vec_id", "train_id", "v", "label", 3)
    return tidy(test.select("vec_id", "label").join(pred, "vec_id"))


def first_centres(spark, sf, k=3):
    rows = vectors(spark, sf).orderBy("vec_id").limit(k).collect()  # k rows
    return [list(row["v"]) for row in rows]


CENTRES = "c AS (SELECT vec_id AS c, embedding::double[] AS cv FROM embeddings ORDER BY vec_id LIMIT 3), cn AS (SELECT row_number() OVER (ORDER BY c) - 1 AS k, cv FROM c)"
ASSIGN = f"""{CENTRES}, x AS (SELECT vec_id, embedding::double[] AS v FROM embeddings),
a AS (SELECT vec_id, v, k, d FROM (SELECT vec_id, v, k, d, row_number() OVER (PARTITION BY vec_id ORDER BY d, k) AS rn FROM (
  SELECT vec_id, v, k, list_sum(list_transform(list_zip(v, cv), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM x, cn)) WHERE rn = 1)"""


@query("kmeans_lloyd_step", f"""WITH {ASSIGN}, l AS (SELECT k, d, unnest(range(0, 64)) AS dim, unnest(v) AS x FROM a)
SELECT k::bigint AS cluster, dim::bigint AS dim, {r('avg(x)')} AS centre, count(*) AS n, {r('sum(d)', 5)} AS cost FROM l GROUP BY k, dim""")
def kmeans_lloyd_step(spark, sf):
    step = cluster.lloyd_step(vectors(spark, sf), "v", first_centres(spark, sf))
    return tidy(step.withColumn("cost", F.round("cost", 5)))


@query("silhouette_exact", f"""WITH x AS (SELECT vec_id, embedding::double[] AS v, label FROM embeddings),
p AS (SELECT a.vec_id, a.label AS own, b.label AS c, sum(list_distance(a.v, b.v)) AS s, count(*) AS n FROM x a, x b GROUP BY ALL),
ab AS (SELECT vec_id, max(CASE WHEN own = c AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN own <> c THEN s / n END) AS b,
  max(CASE WHEN own = c THEN n END) AS size FROM p GROUP BY vec_id)
SELECT {r('avg(CASE WHEN size > 1 THEN (b - a) / greatest(a, b) ELSE 0 END)')} AS silhouette, count(*) AS n FROM ab""")
def silhouette_exact(spark, sf):
    return tidy(cluster.silhouette_exact(vectors(spark, sf), "vec_id", "v", "label"))


BOOST = """bw AS (SELECT id, label, pred, 1.0::double / (SELECT count(*) FROM sc) AS w FROM sc),
er AS (SELECT sum(CASE WHEN label <> pred THEN w ELSE 0 END) / sum(w) AS e FROM bw), al AS (SELECT e, ln((1 - e) / e) AS alpha FROM er)"""


@query("adaboost_round", with_scores(f"""SELECT {r('any_value(e)')} AS error, {r('any_value(alpha)')} AS alpha,
{r('sum(CASE WHEN label <> pred THEN w * exp(alpha) END) / sum(CASE WHEN label <> pred THEN w * exp(alpha) ELSE w END)')} AS wrong_share,
{r('max(CASE WHEN label <> pred THEN w * exp(alpha) END) / sum(CASE WHEN label <> pred THEN w * exp(alpha) ELSE w END) * count(*)')} AS wrong_weight FROM bw, al""", BOOST))
def adaboost_round(spark, sf):
    """One SAMME round around the first score's predictions, uniform start weights."""
    s = scored(spark, sf)
    n = s.count()
    data = s.withColumn("w", F.lit(1.0 / n))
    row = boost.round_summary(data, "label", "pred", "w").first()
    total = boost.boosted_total(data, "label", "pred", "w", row["alpha"])
    new = boost.reweigh(data, "label", "pred", "w", row["alpha"], total)
    wrong = F.when(F.col("label") != F.col("pred"), F.col("w"))
    return tidy(new.agg(F.lit(row["error"]).alias("error"), F.lit(row["alpha"]).alias("alpha"), F.sum(wrong).alias("wrong_share"),
                        (F.max(wrong) * F.count("*")).alias("wrong_weight")))
