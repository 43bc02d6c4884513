"""Queries of the problems tagged llm. None has SQL: their tests compare with brute force, round trips and held-out rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from . import bitext, encodings, languages, leaks, lookalike, mixing, neardup, sentences, tokens


def language_names(spark: SparkSession, d: str) -> list[str]:
    rows = table(spark, d, "release_manifest").select(F.trim("language").alias("l")).where("l <> ''").distinct().collect()
    return sorted({r.l for r in rows} | {"English"})


def p1_stretches(spark: SparkSession, d: str) -> DataFrame:
    poems = table(spark, d, "source_records")
    names = language_names(spark, d)
    models = languages.fit_languages([(poems, "original_poem", "language"), (poems, "translated_poem", "'English'")], names)
    bounds = sentences.fit_boundaries([(poems, "original_poem")])
    models = languages.calibrated(models, languages.labelled_sample(poems, "original_poem", "language", names, bounds))
    return languages.language_stretches(poems.where("trim(original_poem) <> ''"), "poem_id", "original_poem", models, bounds, ["language"])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return languages.label_cases(p1_stretches(spark, d), "poem_id", "language_in", language_names(spark, d))


COUNTERS = {"n_tokens": tokens.BpeCounter, "n_longest_match": tokens.TrieCounter}
SLICE = ["source", "language", "text_domain"]


def p2_token_counts(spark: SparkSession, d: str) -> DataFrame:
    """(table_name, id, slice keys, both counts), one row per text that is not null."""
    docs = table(spark, d, "documents").select(
        F.lit("documents").alias("table_name"), F.col("doc_id").cast("string").alias("id"),
        tokens.folded("source").alias("source"), tokens.folded("lang", region=True).alias("language"), tokens.folded("text_domain").alias("text_domain"), "text"
    )
    poems = table(spark, d, "source_records").select(
        F.lit("source_records").alias("table_name"), F.col("poem_id").alias("id"),
        F.lit("source_records").alias("source"), tokens.folded("language").alias("language"), F.lit("poem").alias("text_domain"), F.col("original_poem").alias("text")
    )
    return tokens.count_tokens(docs.unionByName(poems), "text", ["table_name", "id", *SLICE], {k: c() for k, c in COUNTERS.items()})


def p2_token_budget(spark: SparkSession, d: str) -> DataFrame:
    return tokens.token_budget(p2_token_counts(spark, d), SLICE, list(COUNTERS))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    poems = table(spark, d, "source_records")
    bounds = sentences.fit_boundaries([(poems, "original_poem"), (poems, "translated_poem")])
    return sentences.sentences(poems, "poem_id", "original_poem", bounds)


def p5_aligned(spark: SparkSession, d: str, unlinked: bool) -> DataFrame:
    poems = table(spark, d, "source_records")
    bounds = sentences.fit_boundaries([(poems, "original_poem"), (poems, "translated_poem")])
    lexicon = bitext.fit_lexicon(poems, "original_poem", "translated_poem", table(spark, d, "glossary"))
    return bitext.aligned_sentences(poems, "poem_id", "original_poem", "translated_poem", lexicon, bounds, unlinked)


def p5_links(spark: SparkSession, d: str) -> DataFrame:
    return p5_aligned(spark, d, True)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_aligned(spark, d, False).select("poem_id", "src_start", "tgt_start")


def p6_forms(spark: SparkSession, d: str) -> DataFrame:
    poems = table(spark, d, "source_records").select("poem_id", "poem_title", "original_poem")
    forms = lookalike.fit_representatives([(poems, ["original_poem", "poem_title"])])
    return lookalike.normal_form(poems, ["poem_title", "original_poem"], forms)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    poems = table(spark, d, "source_records")
    forms = lookalike.fit_representatives([(poems, ["original_poem", "poem_title"])])
    return lookalike.look_alike_pairs(poems, "poem_id", ["original_poem", "poem_title"], forms)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    poems = table(spark, d, "source_records")
    forms = lookalike.fit_representatives([(poems, ["original_poem", "poem_title"])])
    members, links = neardup.near_copies(poems, "poem_id", ["poem_title", "original_poem"], "original_poem", forms, n=2, threshold=0.6)
    return neardup.record_pairs(members, links, "poem_id")


def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    docs, items = table(spark, d, "documents"), table(spark, d, "eval_items")
    forms = lookalike.fit_representatives([(docs, ["text"]), (items, ["text"])])
    return leaks.leaks(docs, "doc_id", "text", items, "item_id", "text", forms)


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_leaks(spark, d).select("doc_id", "item_id")


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p10_repaired(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return encodings.repaired(docs, "doc_id", "text", encodings.fit_channel([(docs, "text")]))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return p10_repaired(spark, d).select("doc_id").distinct()


QUERIES = {
    "p1_found": p1_found, "p1_stretches": p1_stretches, "p2_token_budget": p2_token_budget, "p2_token_counts": p2_token_counts, "p4_found": p4_found,
    "p5_found": p5_found, "p5_links": p5_links, "p6_found": p6_found, "p6_forms": p6_forms, "p7_found": p7_found,
    "p8_found": p8_found, "p8_leaks": p8_leaks, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found,
    "p10_repaired": p10_repaired,
}
SQL: dict[str, str] = {}
