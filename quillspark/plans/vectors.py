"""Vector queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..operators import vectors
from ..session import table


def rows(spark, d):
    return table(spark, d, "embeddings")


def label_centroids(spark, d):
    c = vectors.centroids(rows(spark, d), "label", "embedding")
    return c.select("label", F.round(vectors.norm(F.col("centroid")), 4).alias("norm"), F.round(F.get("centroid", F.lit(0)), 5).alias("first"))


def nearest_prototypes(spark, d):
    r = rows(spark, d)
    n = vectors.nearest(r, "vec_id", "embedding", vectors.centroids(r, "label", "embedding"), "label", "centroid")
    return n.select("vec_id", "nearest", F.round("score", 4).alias("score"))


def prototype_confusion(spark, d):
    return nearest_prototypes(spark, d).join(rows(spark, d).select("vec_id", "label"), "vec_id").groupBy("label", "nearest").agg(F.count("*").alias("n"))


def similar_vectors(spark, d):
    t = vectors.top_k(rows(spark, d), "vec_id", "embedding", F.col("vec_id") % 100 == 0, vocab.TOP_K)
    return t.select("query_id", "vec_id", F.round("score", 4).alias("score"), "rank")


QUERIES = {f.__name__: f for f in (label_centroids, nearest_prototypes, prototype_confusion, similar_vectors)}

CENT = """e AS (SELECT vec_id, label, embedding::double[] AS v FROM embeddings), x AS (SELECT label, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM e),
c AS (SELECT label, list(m ORDER BY i) AS c FROM (SELECT label, i, avg(x) AS m FROM x GROUP BY ALL) GROUP BY label)"""
NEAR = f"""{CENT}, s AS (SELECT vec_id, e.label AS own, c.label, list_cosine_similarity(v, c) AS score FROM e, c),
n AS (SELECT vec_id, own, label AS nearest, score FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label) AS k FROM s) WHERE k = 1)"""
SQL = {
    "label_centroids": f"WITH {CENT} SELECT label, round(sqrt(list_inner_product(c, c)), 4) AS norm, round(c[1], 5) AS first FROM c",
    "nearest_prototypes": f"WITH {NEAR} SELECT vec_id, nearest, round(score, 4) AS score FROM n",
    "prototype_confusion": f"WITH {NEAR} SELECT own AS label, nearest, count(*) AS n FROM n GROUP BY ALL",
    "similar_vectors": f"""WITH e AS (SELECT vec_id, embedding::double[] AS v FROM embeddings), s AS (SELECT q.vec_id AS query_id, e.vec_id, list_cosine_similarity(q.v, e.v) AS score FROM e q, e WHERE q.vec_id % 100 = 0 AND q.vec_id <> e.vec_id)
        SELECT query_id, vec_id, round(score, 4) AS score, k AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS k FROM s) WHERE k <= {vocab.TOP_K}""",
}
