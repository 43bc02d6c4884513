"""Vectors: cosine, prototypes, nearest prototype and exact top-k of a query set against all rows, in blocks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..arrow import arrow_stage, partition_stage

BLOCK = 512
TINY = 1e-9


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine; 0 where a side is null or has no length."""
    n = norm(a) * norm(b)
    return F.when(a.isNull() | b.isNull() | (n <= TINY), 0.0).otherwise(dot(a, b) / n)


def centroids(df: DataFrame, label: str, vector: str) -> DataFrame:
    """(<label>, centroid): means per dimension; partial sums precede the shuffle."""
    e = df.where(F.col(vector).isNotNull()).select(label, F.posexplode(vector).alias("i", "x"))
    m = e.groupBy(label, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return m.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centroid"))


def nearest(df: DataFrame, id_col: str, vector: str, protos: DataFrame, label: str, proto: str) -> DataFrame:
    """(<id>, nearest, score): the prototype of greatest cosine, the smallest label on ties. Prototypes are few by
    definition (one per label) and come as one array row, so no row meets another by a join of rows."""
    table = protos.agg(F.collect_list(F.struct(F.col(label).alias("l"), F.col(proto).alias("v"))).alias("ps"))
    scored = df.select(id_col, vector).crossJoin(table).select(id_col, F.transform("ps", lambda p: F.struct(cosine(F.col(vector), p["v"]).alias("score"), (-p["l"]).alias("minus"))).alias("s"))
    best = F.array_max("s")
    return scored.select(id_col, (-best["minus"]).alias("nearest"), best["score"].alias("score"))


def scores(df: DataFrame, id_col: str, vector: str, protos: DataFrame, label: str, proto: str) -> DataFrame:
    """(<id>, s): every prototype's label and cosine, best first, the smaller label on ties. One prototype per label."""
    table = protos.agg(F.collect_list(F.struct(F.col(label).alias("l"), F.col(proto).alias("v"))).alias("ps"))
    scored = df.select(id_col, vector).crossJoin(table)
    s = F.transform("ps", lambda p: F.struct((-cosine(F.col(vector), p["v"])).alias("minus"), p["l"].alias("label")))
    return scored.select(id_col, F.transform(F.array_sort(s), lambda x: F.struct(x["label"].alias("label"), (-x["minus"]).alias("score"))).alias("s"))


def top_k(df: DataFrame, id_col: str, vector: str, is_query: Column, k: int, threshold: float = -1.0) -> DataFrame:
    """(query_id, <id>, score, rank): exact cosine top-k of every query row against all rows but itself, ties by id.

    Both sides are packed into blocks of BLOCK vectors; each pair of blocks is one matrix product that gives back k rows
    a query, and the partial lists are merged. Every row meets every query; nothing is sampled or capped."""
    def packed(feed):
        ids, rows = [], []
        for batch in feed:
            for i, v in zip(batch["i"], batch["v"]):
                if v is not None and len(v):
                    ids.append(i)
                    rows.append(v)
                    if len(ids) == BLOCK:
                        yield ids, np.asarray(rows, dtype=np.float64).tobytes()
                        ids, rows = [], []
        if ids:
            yield ids, np.asarray(rows, dtype=np.float64).tobytes()

    kind = df.schema[id_col].dataType.simpleString()
    cols = lambda d: d.select(F.col(id_col).alias("i"), F.col(vector).alias("v"))
    schema = f"ids array<{kind}>, data binary"
    queries = partition_stage(cols(df.where(is_query)), schema, packed).select(F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    rows = partition_stage(cols(df), schema, packed)

    def unit(blob, n):
        m = np.frombuffer(blob, dtype=np.float64).reshape(n, -1)
        length = np.sqrt((m * m).sum(axis=1, keepdims=True))
        return m / np.maximum(length, TINY)

    def scored(batch):
        for qi, qd, ri, rd in zip(batch["q_ids"], batch["q_data"], batch["ids"], batch["data"]):
            s = unit(qd, len(qi)) @ unit(rd, len(ri)).T
            ids = np.asarray(ri)
            for a, q in enumerate(qi):
                order = np.lexsort((ids, -s[a]))
                left = k
                for b in order:
                    if ids[b] != q:
                        if s[a, b] < threshold:
                            break
                        yield q, ids[b].item(), float(s[a, b])
                        left -= 1
                        if not left:
                            break

    pairs = arrow_stage(queries.crossJoin(rows), f"query_id {kind}, `{id_col}` {kind}, score double", scored)
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.col(id_col))
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
