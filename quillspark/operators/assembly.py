"""Assembly: invalid paths from all rules, presence counts, term gates, section merges, prompts and target sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import term_present
from . import annotation, corpus, ledger
from .segments import rendering, stanza_texts

SECTIONS = ("overview", "entities", "figurative", "loss")


def invalid_paths(bridge: DataFrame, grounding: DataFrame) -> DataFrame:
    """(<id>, field_path, rule): every path some rule objects to, once, with the rule of the first family that does:
    contradictions, completeness, grounding errors."""
    fam = lambda df, k: df.select("result_id", "field_path", "rule", k.alias("family"))
    errors = grounding.where("severity = 'error'").select("result_id", F.concat_ws(".", "object_path", "field").alias("field_path"), F.col("code").alias("rule"))
    own = annotation.violations(annotation.every_object(bridge), [*annotation.contradiction_rules(), *annotation.completeness_rules()])
    every = fam(own, F.when(F.col("rule") == "faithful_with_loss_note", 1).otherwise(2)).unionByName(fam(errors, F.lit(3)))
    return every.groupBy("result_id", "field_path").agg(F.min_by("rule", F.struct("family", "rule")).alias("rule"))


def presence(objs: DataFrame, fields: list[str]) -> DataFrame:
    """(kind, field, populated, empty, missing) over objects; one scan."""
    rows = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("v")) for f in fields))
    x = objs.select("kind", F.inline(rows))
    empty = F.trim("v").isin("", "[]")
    return x.groupBy("kind", "field").agg(F.count_if(F.col("v").isNotNull() & ~empty).alias("populated"), F.count_if(F.coalesce(empty, F.lit(False))).alias("empty"), F.count_if(F.col("v").isNull()).alias("missing"))


def unknown_keys(bridge: DataFrame) -> DataFrame:
    """(<id>, object_path, key): members of objects that their kind does not know."""
    known = {k: [f.split(" ")[0].strip("`") for f in v.split(", ")] for k, v in annotation.FIELDS.items()}
    keys = F.coalesce(F.json_object_keys("fields"), F.array().cast("array<string>"))
    allowed = F.lit(None).cast("array<string>")
    for k, names in known.items():
        allowed = F.when(F.col("kind") == k, F.array(*map(F.lit, names + ["metaphor_mapping", "stanzas", "cultural_entities", "metaphor_spans", "translation_loss"]))).otherwise(allowed)
    return bridge.select("result_id", "object_path", F.explode(F.array_except(keys, allowed)).alias("key"))


def term_gate(objs: DataFrame, poems: DataFrame, results: DataFrame) -> DataFrame:
    """(<id>, object_path, term, present): does each term of an annotation occur in its poem."""
    text = results.select("result_id", "poem_id").join(poems.select("poem_id", "original_poem"), "poem_id").select("result_id", "original_poem")
    t = objs.select("result_id", "object_path", F.coalesce("term", "source_term").alias("term")).where("trim(term) <> ''")
    return t.join(text, "result_id").select("result_id", "object_path", "term", term_present(F.col("term"), F.col("original_poem")).alias("present"))


def merged_sections(calls: DataFrame) -> DataFrame:
    """(poem_id, one state per section, complete): the latest answer of each section. max_by pre-aggregates, so the poem
    that holds a tenth of the rows is no hot task."""
    kind = F.when(ledger.parse_class(F.col("text")) != "object", "unreadable").when(F.col("finish_reason") == "STOP", "complete").otherwise("cut")
    last = calls.where(F.col("section_name").isin(*SECTIONS)).groupBy("poem_id", "section_name").agg(F.max_by(kind, F.struct("requested_at", "received_at", "response_id")).alias("state"))
    wide = last.groupBy("poem_id").pivot("section_name", list(SECTIONS)).agg(F.first("state"))
    done = F.lit(True)
    for s in SECTIONS:
        done = done & (F.coalesce(F.col(s), F.lit("absent")) == "complete")
    return wide.select("poem_id", *(F.coalesce(s, F.lit("absent")).alias(s) for s in SECTIONS), done.alias("complete"))


def token_estimate(c: Column) -> Column:
    """Characters over four, half to even, in whole numbers."""
    n = F.char_length(c)
    q, r = F.floor(n / 4), n % 4
    return (q + F.when(r == 3, 1).when(r == 2, q % 2).otherwise(0)).cast("int")


def answer_budget(stanzas: Column) -> Column:
    return F.least(F.lit(2048), F.lit(1536) + 300 * F.greatest(stanzas - 1, F.lit(0)))


def prompts(poems: DataFrame) -> DataFrame:
    """(poem_id, prompt_sha256, n_tokens, answer_tokens): prompts of title, numbered source and translation."""
    text = F.concat_ws("\n\n", F.concat(F.lit("Title: "), F.coalesce("poem_title", F.lit("-"))), rendering(F.col("original_poem")), rendering(F.col("translated_poem"), "T"))
    p = poems.select("poem_id", text.alias("prompt"), F.greatest(F.coalesce(F.size(stanza_texts(F.coalesce("original_poem", F.lit("")))), F.lit(0)), F.lit(0)).alias("stanzas"))
    return p.select("poem_id", F.sha2(F.encode("prompt", "UTF-8"), 256).alias("prompt_sha256"), token_estimate(F.col("prompt")).alias("n_tokens"), answer_budget(F.col("stanzas")).alias("answer_tokens"))


def targets(records: DataFrame, assigned: DataFrame | None = None, poem_id: str | None = None, language: str | None = None, excluded: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Records to work on: an assignment wins over an id, an id over a language, a language over all; then exclusions,
    then a limit in id order."""
    if assigned is not None:
        out = records.join(assigned.select("poem_id").distinct(), "poem_id", "left_semi")
    elif poem_id is not None:
        if language is None:
            raise ValueError("a poem id needs its language")
        out = records.where((F.col("poem_id") == poem_id) & (F.col("language") == language))
    else:
        out = records if language is None else records.where(F.col("language") == language)
    if excluded is not None:
        out = out.join(excluded.select("poem_id").distinct(), "poem_id", "left_anti")
    return out if limit is None else out.orderBy("poem_id").limit(limit)


def chat_fault(model: Column, messages: Column, temperature: Column, top_p: Column, max_tokens: Column) -> Column:
    """The first fault of a chat request; null for a valid one. messages: array<struct<role, content>>."""
    roles = F.transform(messages, lambda m: m["role"])
    known = F.forall(messages, lambda m: m["role"].isin("system", "user", "assistant"))
    said = F.forall(messages, lambda m: F.coalesce(F.trim(m["content"]), F.lit("")) != "")
    return (
        F.when(F.coalesce(F.trim(model), F.lit("")) == "", "model").when(messages.isNull() | (F.size(messages) == 0), "no_messages").when(~F.coalesce(known, F.lit(False)), "role")
        .when(~said, "blank_content").when(~F.array_contains(roles, "user"), "no_user_turn").when(~temperature.between(0, 2), "temperature").when(~top_p.between(0, 1), "top_p").when(max_tokens < 1, "max_tokens")
    )


def running_share(df: DataFrame, key: str, value: str) -> DataFrame:
    """(<key>, total, rank, running share) of totals per key, largest first, then by key. A total that many keys share is
    split into blocks of keys."""
    t = df.groupBy(key).agg(F.sum(F.coalesce(value, F.lit(0))).alias("total"))
    text = F.col(key).cast("string")
    t = t.withColumns({"_a": -F.floor(F.log2(F.greatest(F.col("total"), F.lit(1)).cast("double"))), "_minus": -F.col("total"), "_s": F.substring(text, 1, corpus.SUPER), "_b": F.substring(text, 1, corpus.BLOCK)})
    x = corpus.running(t, ["_a"], ["_minus", "_s", "_b"], [key], {"run": "total"}, "rank")
    every = t.agg(F.sum("total").alias("all"))  # one row
    return x.crossJoin(every).select(key, "total", "rank", F.round(F.col("run") / F.col("all"), 6).alias("running_share"))
