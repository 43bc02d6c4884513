"""Attempts, checkpoints and calls: redelivery, latest state, resume sets, gaps and completion classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab


def once(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the first by order; rows without a key are kept. min_by pre-aggregates, so a hot key is no hot task."""
    whole = F.struct(*df.columns)
    keyed = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(whole, F.struct(*order)).alias("r")).select("r.*")
    return keyed.unionByName(df.where(F.col(key).isNull()))


def latest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by order."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_r")).select("_r.*")


def resume(targets: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return targets.join(done.select(key).distinct(), key, "left_anti")


def retry(targets: DataFrame, failed: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return targets.join(failed.select(key).distinct(), key, "left_semi").join(done.select(key).distinct(), key, "left_anti")


def completion_class(finish: Column, succeeded: Column) -> Column:
    """completed, max_tokens, safety, malformed_or_unknown or provider_error; never inferred from a broken text."""
    f = F.upper(finish)
    return (
        F.when(~succeeded, "provider_error").when(f.isNull(), "malformed_or_unknown").when(f == "STOP", "completed")
        .when(f == "MAX_TOKENS", "max_tokens").when(f.isin("SAFETY", "RECITATION", "BLOCKLIST", "PROHIBITED_CONTENT", "SPII"), "safety")
        .otherwise("malformed_or_unknown")
    )


def parse_class(text: Column) -> Column:
    """empty, failed, non_object or object: what a response is as JSON."""
    v = F.try_parse_json(text)
    return F.when(text.isNull() | (F.trim(text) == ""), "empty").when(v.isNull(), "failed").when(F.schema_of_variant(v).startswith("OBJECT"), "object").otherwise("non_object")


def safe_message(c: Column) -> Column:
    hit = F.lit(False)
    for m in vocab.SECRET_MARKERS:
        hit = hit | F.lower(c).contains(m)
    return F.when(hit, "[redacted]").otherwise(F.substring(c, 1, vocab.MESSAGE_CAP))


def token_tier(n: Column) -> Column:
    """Output token budget of a request for n paths; null for none and above the last tier."""
    out = F.when(n < 1, None)
    for top, budget in vocab.TOKEN_TIERS:
        out = out.when(n <= top, budget)
    return out


def sessions(df: DataFrame, key: str, at: str, gap: str) -> DataFrame:
    """Session windows by a gap, aggregated per key: session_window pre-aggregates, so a hot key is spread."""
    return df.groupBy(key, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("started"), F.col("w.end").alias("ended"), "n")


def attempts_numbered(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return df.withColumn("attempt", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
