"""Problem 7: near copies by SetSketch.

A record is the set of its word n-grams. Records with equal sets are one class. Every class has a SetSketch: each of m
registers holds the truncated, exponentially spaced minimum floor(1 - log_b x) of exponential variables x of the set's
elements, so sketches merge by their maximum and equal registers are as likely as the sets are alike. Bands of r
registers give candidate pairs of classes; for each, the likeness is estimated jointly from the counts of larger, equal
and smaller registers by maximum likelihood, and candidates within reach of the threshold are verified on the sets.

r and the number of bands follow from the threshold so that a pair at the threshold is missed with a probability of
MISS at most; no bucket, partner list or class is capped.

Defined results: records with a null or blank text are left out; a null title counts as empty; a record of one word has
that word as its only element; equal records are alike with likeness 1; repeated ids count once per row's text.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread, written
from ..arrow import arrow_stage
from .lookalike import Rewriter
from .words import words

MISS = 2e-5
BASE, RATE, TOP = 1.001, 20.0, 65534
CHUNK = 2048


def band_plan(threshold: float) -> tuple[int, int]:
    """(registers per band, bands)"""
    r = max(1, round(math.log(0.13) / math.log(threshold)))
    return r, math.ceil(math.log(MISS) / math.log1p(-(threshold**r)))


class Hasher:
    """64-bit hashes of word n-grams, built from cached hashes of words."""

    def __init__(self, n: int) -> None:
        self.n, self.cache = n, {}

    def word(self, w: str) -> int:
        h = self.cache.get(w)
        if h is None:
            if len(self.cache) > 300_000:
                self.cache.clear()
            h = self.cache[w] = int.from_bytes(hashlib.blake2b(w.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return h

    def grams(self, ws: list[str]) -> np.ndarray:
        h = np.fromiter((self.word(w) for w in ws), dtype=np.uint64, count=len(ws))
        n = min(self.n, len(ws))
        if not n:
            return h
        g = np.zeros(len(h) - n + 1, dtype=np.uint64)
        for k in range(n):
            g = mix(g * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k])
        return np.unique(g)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def seeds(m: int) -> np.ndarray:
    return mix(np.arange(1, m + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sketch(grams: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """SetSketch registers. The smallest exponential variable of a register belongs to the largest uniform hash."""
    best = np.zeros(len(seed), dtype=np.uint64)
    for at in range(0, len(grams), CHUNK):
        part = grams[at : at + CHUNK, None]
        h = (part ^ seed) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        np.maximum(best, h.max(axis=0), out=best)
    u = (best >> np.uint64(11)).astype(np.float64) / 2.0**53
    x = -np.log(np.maximum(u, 1e-300)) / RATE
    k = np.floor(1 - np.log(np.maximum(x, 1e-300)) / math.log(BASE))
    return np.clip(k, 0, TOP + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def joint_likeness(a: np.ndarray, b: np.ndarray, na: int, nb: int) -> float:
    """Maximum-likelihood Jaccard likeness from the register order of two sketches of sets of known size."""
    up, down = int((a > b).sum()), int((a < b).sum())
    same = len(a) - up - down
    u, v = na / (na + nb), nb / (na + nb)
    q = (BASE - 1) / BASE
    ln = math.log(BASE)
    p = lambda x: -math.log1p(-min(max(x, 1e-12), 1) * q) / ln
    lo, hi = 0.0, min(u / v, v / u)

    def likelihood(j: float) -> float:
        pu, pd = p(u - v * j), p(v - u * j)
        return up * math.log(pu) + down * math.log(pd) + same * math.log(max(1 - pu - pd, 1e-12))

    g = (math.sqrt(5) - 1) / 2
    x1, x2 = hi - g * (hi - lo), lo + g * (hi - lo)
    f1, f2 = likelihood(x1), likelihood(x2)
    for _ in range(24):
        if f1 < f2:
            lo, x1, f1 = x1, x2, f2
            x2 = lo + g * (hi - lo)
            f2 = likelihood(x2)
        else:
            hi, x2, f2 = x2, x1, f1
            x1 = hi - g * (hi - lo)
            f1 = likelihood(x1)
    return (lo + hi) / 2


def record_sets(df: DataFrame, id_col: str, fields: list[str], body: str, mapping: dict[str, str], n: int) -> DataFrame:
    """(id, class, grams): the n-gram set of each record whose body is not blank, and its class."""
    rw = Rewriter(mapping)
    hasher = Hasher(n)

    def sets(batch):
        for i, rid in enumerate(batch[id_col]):
            text = batch[body][i]
            if rid is None or not text or not text.strip():
                continue
            ws: list[str] = []
            for f in fields:
                if t := batch[f][i]:
                    ws += words(rw(t).lower())
            g = hasher.grams(ws).tobytes()
            yield rid, int.from_bytes(hashlib.blake2b(g, digest_size=8).digest(), "little", signed=True), g

    cols = list(dict.fromkeys([id_col, *fields, body]))
    return arrow_stage(spread(df.select(*cols)), f"id {df.schema[id_col].dataType.simpleString()}, class long, grams binary", sets)


def class_pairs(classes: DataFrame, threshold: float) -> DataFrame:
    """(class_a, class_b, likeness) of the different classes whose likeness reaches the threshold; classes: (class, grams)."""
    r, bands = band_plan(threshold)
    m = r * bands
    seed = seeds(m)

    def sketched(batch):
        for c, g in zip(batch["class"], batch["grams"]):
            yield c, g, sketch(np.frombuffer(g, dtype=np.uint64), seed).tobytes()

    kept = written(arrow_stage(classes, "class long, grams binary, regs binary", sketched), "sketches")

    def banded(batch):
        where = mix(np.arange(1, bands + 1, dtype=np.uint64))
        for c, regs in zip(batch["class"], batch["regs"]):
            rows = np.frombuffer(regs, dtype=np.uint16).reshape(bands, r).astype(np.uint64)
            h = where.copy()
            for k in range(r):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, k] + np.uint64(1))
            for b in h.astype(np.int64).tolist():
                yield b, c

    buckets = arrow_stage(kept.select("class", "regs"), "bucket long, class long", banded)
    a, b = buckets.withColumnRenamed("class", "class_a"), buckets.withColumnRenamed("class", "class_b")
    pairs = a.join(b, "bucket").where("class_a < class_b").select("class_a", "class_b").distinct()
    left = kept.select(F.col("class").alias("class_a"), F.col("grams").alias("ga"), F.col("regs").alias("ra"))
    right = kept.select(F.col("class").alias("class_b"), F.col("grams").alias("gb"), F.col("regs").alias("rb"))
    slack = 5 * math.sqrt(threshold * (1 - threshold) / m)

    def verified(batch):
        for ca, cb, ga, gb, ra, rb in zip(*(batch[c] for c in ("class_a", "class_b", "ga", "gb", "ra", "rb"))):
            x, y = np.frombuffer(ga, dtype=np.uint64), np.frombuffer(gb, dtype=np.uint64)
            if min(len(x), len(y)) < threshold * max(len(x), len(y)) - 1e-9:
                continue
            est = joint_likeness(np.frombuffer(ra, dtype=np.uint16), np.frombuffer(rb, dtype=np.uint16), len(x), len(y))
            if est < threshold - slack:
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            like = both / (len(x) + len(y) - both)
            if like >= threshold - 1e-12:
                yield ca, cb, like

    joined = pairs.join(left, "class_a").join(right, "class_b").select("class_a", "class_b", "ga", "gb", "ra", "rb")
    return arrow_stage(joined, "class_a long, class_b long, likeness double", verified)


def near_copies(df: DataFrame, id_col: str, fields: list[str], body: str, mapping: dict[str, str], n: int = 5, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(membership, links): (id, class) of every record, and (class_a, class_b, likeness) between classes."""
    sets = written(record_sets(df, id_col, fields, body, mapping, n), "sets")
    return sets.select("id", "class"), class_pairs(sets.select("class", "grams").dropDuplicates(["class"]), threshold)


def record_pairs(membership: DataFrame, links: DataFrame, id_col: str) -> DataFrame:
    """All pairs of records, the smaller id first: those of linked classes and those within a class."""
    a = membership.select(F.col("id").alias("x"), F.col("class").alias("class_a"))
    b = membership.select(F.col("id").alias("y"), F.col("class").alias("class_b"))
    many = membership.groupBy("class").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select(F.col("class").alias("class_a"))
    within = a.join(many, "class_a", "left_semi").join(b.withColumnRenamed("class_b", "class_a"), "class_a").where("x < y").select("x", "y")
    across = links.select("class_a", "class_b").join(a, "class_a").join(b, "class_b").where("x <> y").select("x", "y")
    return within.unionByName(across).select(F.least("x", "y").alias(f"{id_col}_a"), F.greatest("x", "y").alias(f"{id_col}_b")).distinct()
