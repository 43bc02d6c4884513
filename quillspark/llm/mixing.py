"""Problem 9: a mix of sources with target shares of the tokens.

Within each source the texts are ordered by exponential keys -ln(u)/w (Efraimidis-Spirakis: the first k are a weighted
sample without replacement), u from a hash of id and seed, w the quality weight. A source's budget is its share of the
total; complete epochs, every text once, come first, then the texts in key order whose running token sum fits the rest.

Running sums are taken in two steps, over buckets of keys and within a bucket, so a hot source is spread over BUCKETS
tasks. Equal texts under other ids or sources are one text, the row of the smallest id among the sources with a target,
so none is used more than max_repeats times.

Defined results: null and blank texts and texts of sources without a target are left out; a target source without texts
contributes nothing and its share is spread over the others; null weights count as the least weight; budgets that
exceed max_repeats times a source's tokens are cut to that and the shares reached are reported.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written
from .tokens import BpeCounter, count_tokens, folded

BUCKETS = 1024
LEAST_WEIGHT = 0.01


def quality_weight(text: str = "text") -> F.Column:
    """Share of letters and marks in the visible text, the quality weight used where the caller gives none."""
    visible = F.length(F.regexp_replace(F.col(text), r"\s", ""))
    letters = F.length(F.regexp_replace(F.col(text), r"[^\p{L}\p{M}]", ""))
    return F.when(visible > 0, letters / visible)


def mix(docs: DataFrame, targets: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weight: F.Column | None = None, total_tokens: int | None = None, seed: int = 42, counter=None) -> tuple[DataFrame, DataFrame]:
    """(mix, shares): (<id>, source, n_tokens, copies), and per source the target and actual shares; texts_of_other_sources
    are those it holds too but that count as another target source's, which has them under a smaller id.

    Without total_tokens, the total is the largest for which every source that has texts reaches its share."""
    w = quality_weight(text_col) if weight is None else weight
    texts = docs.where(F.trim(F.col(text_col)) != "").select(
        F.col(id_col).alias("id"), folded(source_col).alias("source"), w.cast("double").alias("w"), F.col(text_col).alias("text"), F.md5(text_col).alias("text_key")
    )
    texts = texts.where("text rlike '\\\\S'")
    counted = count_tokens(texts, "text", ["id", "source", "w", "text_key"], {"n_tokens": counter or BpeCounter()})
    t = targets.select(folded("source").alias("source"), "target_share", "max_repeats").where("target_share > 0 and source is not null")
    t = t.groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    wanted = counted.join(t.select("source"), "source", "left_semi")  # before the choice: a text is kept if any target source holds it
    first = F.min_by(F.struct("id", "source", "w", "n_tokens"), F.struct("id", "source"))
    one = wanted.groupBy("text_key").agg(first.alias("r"), F.collect_set("source").alias("held")).select("r.*", F.array_remove("held", F.col("r.source")).alias("others"))
    u = (F.shiftrightunsigned(F.xxhash64(F.col("id").cast("string"), F.lit(seed)), 11) + 0.5) / float(1 << 53)
    keyed = one.select(
        "id", "source", "n_tokens", "others", (-F.log(u) / F.greatest(F.coalesce("w", F.lit(LEAST_WEIGHT)), F.lit(LEAST_WEIGHT))).alias("key")
    )
    keyed = written(keyed.withColumn("bucket", F.floor(F.col("key") / (1 + F.col("key")) * BUCKETS)), "mix")
    sums = keyed.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # BUCKETS rows a source
    offsets = sums.select("source", "bucket", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("offset"))
    have = sums.groupBy("source").agg(F.sum("tokens").alias("have"), F.sum("n").alias("texts"))
    plan = t.join(have, "source", "left").withColumns({"have": F.coalesce("have", F.lit(0)), "texts": F.coalesce("texts", F.lit(0))})
    everything = Window.partitionBy()  # one row per target source
    plan = plan.withColumn("share", F.when(F.col("have") > 0, F.col("target_share")) / F.sum(F.when(F.col("have") > 0, F.col("target_share"))).over(everything))
    cap = F.col("have") * F.col("max_repeats")
    total = F.lit(total_tokens) if total_tokens is not None else F.min(F.when(F.col("have") > 0, cap / F.col("share"))).over(everything)
    plan = plan.withColumn("budget", F.coalesce(F.least(F.floor(F.col("share") * total + 1e-6), cap), F.lit(0)))
    plan = plan.withColumn("epochs", F.when(F.col("have") > 0, F.floor(F.col("budget") / F.greatest("have", F.lit(1)))).otherwise(0))
    plan = plan.withColumn("rest", F.col("budget") - F.col("epochs") * F.col("have"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, -1)
    run = keyed.join(offsets, ["source", "bucket"]).withColumn("before", F.col("offset") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    picked = run.join(plan.select("source", "epochs", "rest"), "source").withColumn(
        "copies", (F.col("epochs") + (F.col("before") + F.col("n_tokens") / 2 <= F.col("rest")).cast("int")).cast("int")
    )
    chosen = picked.where("copies > 0").select(F.col("id").alias(id_col), "source", "n_tokens", "copies")
    used = chosen.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.max("copies").alias("most_copies"))
    given = keyed.select(F.explode("others").alias("source")).groupBy("source").agg(F.count("*").alias("given"))
    shares = plan.join(used, "source", "left").join(given, "source", "left").select(
        "source", "target_share", "max_repeats", "texts", F.col("have").alias("tokens_available"), F.coalesce("tokens", F.lit(0)).alias("tokens_used"),
        F.coalesce("most_copies", F.lit(0)).alias("most_copies"), F.coalesce("given", F.lit(0)).alias("texts_of_other_sources"),
        F.coalesce(F.col("tokens") / F.sum("tokens").over(everything), F.lit(0.0)).alias("actual_share"),
    )
    return chosen, shares
