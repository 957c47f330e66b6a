"""Vector and evaluation jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from heronlake.functions.vectors import cosine, dot, norm, to_dense, to_sparse
from heronlake.operators import metrics
from heronlake.operators.vectors import similar_to, vector_of
from heronlake.registry import job
from heronlake.sources.tables import vectors

QUERY_ID = 0
V = "v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v, label FROM embeddings)"
Q = f"q AS (SELECT v AS qv FROM v WHERE id = {QUERY_ID})"


@job("vector_cosine", f"""WITH {V}, {Q} SELECT id, round(list_dot_product(v, qv), 6) AS dot,
    round(sqrt(list_dot_product(v, v)), 6) AS norm,
    round(list_dot_product(v, qv) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(qv, qv))), 6) AS cosine
    FROM v, q""")
def vector_cosine(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    query = vector_of(rows, QUERY_ID)
    return rows.select("id", F.round(dot(F.col("v"), query), 6).alias("dot"),
                       F.round(norm(F.col("v")), 6).alias("norm"),
                       F.round(cosine(F.col("v"), query), 6).alias("cosine"))


@job("embedding_neighbors", f"""WITH {V}, {Q}, s AS (SELECT id,
      list_dot_product(v, qv) / (sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(qv, qv))) AS similarity
      FROM v, q WHERE id <> {QUERY_ID})
    SELECT id, round(similarity, 6) AS similarity FROM s ORDER BY s.similarity DESC, id LIMIT 10""")
def embedding_neighbors(spark, sf_dir):
    top = similar_to(vectors(spark, sf_dir), QUERY_ID, 10)
    return top.select("id", F.round("similarity", 6).alias("similarity"))


@job("matrix_shape", f"WITH {V} SELECT count(*) AS num_rows, max(len(v)) AS num_cols FROM v")
def matrix_shape(spark, sf_dir):
    return vectors(spark, sf_dir).agg(F.count(F.lit(1)).alias("num_rows"),
                                      F.max(F.size("v")).cast("long").alias("num_cols"))


@job("vector_dense_sparse", f"""WITH {V}, r AS (SELECT id, list_transform(v, lambda x: trunc(x * 2)) AS v FROM v)
    SELECT id, len(v) AS size, array_to_string(list_filter(range(0, len(v)), lambda i: v[i + 1] <> 0), ',') AS indices,
    list_sum(v) AS total, true AS same FROM r""")
def vector_dense_sparse(spark, sf_dir):
    """Dense to sparse and back."""
    coarse = vectors(spark, sf_dir).select("id", F.transform(
        "v", lambda x: F.when(x < 0, F.ceil(x * 2)).otherwise(F.floor(x * 2)).cast("double")).alias("v"))
    rows = coarse.withColumn("s", to_sparse(F.col("v")))
    return rows.select(
        "id", F.col("s.size").cast("long").alias("size"), F.array_join(F.col("s.indices").cast("array<string>"), ",").alias("indices"),
        F.aggregate("v", F.lit(0.0), lambda s, x: s + x).alias("total"),
        (to_dense(F.col("s")) == F.col("v")).alias("same"))


PRED = f"p AS (SELECT id, v[1] AS score, v[2] AS other, CASE WHEN v[1] > 0 THEN 1 ELSE 0 END AS prediction, label % 2 AS label FROM v)"


def predictions(spark, sf_dir):
    return vectors(spark, sf_dir).select(
        "id", F.get("v", F.lit(0)).alias("score"), F.get("v", F.lit(1)).alias("other"),
        F.when(F.get("v", F.lit(0)) > 0, 1).otherwise(0).alias("prediction"), (F.col("label") % 2).alias("label"))


@job("metric_accuracy", f"WITH {V}, {PRED} SELECT round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM p")
def metric_accuracy(spark, sf_dir):
    return metrics.accuracy(predictions(spark, sf_dir)).select(F.round("accuracy", 6).alias("accuracy"))


@job("metric_auc", f"""WITH {V}, {PRED}, r AS (SELECT label, rank() OVER (ORDER BY score) AS lo,
      count(*) OVER (PARTITION BY score) AS same FROM p),
    u AS (SELECT sum(lo + (same - 1) / 2.0) FILTER (label = 1) AS ranks, count(*) FILTER (label = 1) AS np,
      count(*) FILTER (label = 0) AS nn FROM r)
    SELECT round((ranks - np * (np + 1) / 2.0) / (np * nn), 6) AS auc FROM u""")
def metric_auc(spark, sf_dir):
    return metrics.auc(predictions(spark, sf_dir)).select(F.round("auc", 6).alias("auc"))


@job("metric_regression", f"""WITH {V}, {PRED} SELECT round(avg((other - score) ** 2), 6) AS mse,
    round(sqrt(avg((other - score) ** 2)), 6) AS rmse,
    round(1 - avg((other - score) ** 2) / var_pop(score), 6) AS r2 FROM p""")
def metric_regression(spark, sf_dir):
    m = metrics.regression_metrics(predictions(spark, sf_dir), "other", "score")
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])
