"""Paths, semantic units, packing and splitting of repair work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab

# Fields by who may fill them.
NULLABLE = ("cultural_specificity_level", "visualization_difficulty")
HUMAN = ("line_ref", "source_span_original", "translation_status")
MODEL = (
    "gloss", "visual_features", "acceptable_visual_variants", "negative_confusions", "theme", "expression_type", "literal_meaning", "vehicle",
    "tenor", "metaphor_mapping", "literalization_risk", "visualization_strategy", "translation_loss", "source_span_translation", "visual_priority",
)
GRAMMAR = r"^[A-Za-z_][A-Za-z0-9_]*(\[[0-9]+\])*(\.[A-Za-z_][A-Za-z0-9_]*(\[[0-9]+\])*)*$"


def plain_path(c: Column) -> Column:
    """A path in the one notation key[n].key: pointers, dotted positions, roots and wrappers are rewritten."""
    p = F.regexp_replace(F.regexp_replace(F.replace(F.trim(c), F.lit("/"), F.lit(".")), r"^\$", ""), r"^\.", "")
    return F.regexp_replace(F.regexp_replace(p, r"\.([0-9]+)", "[$1]"), r"^annotation(\.|$)", "")


def path_error(c: Column) -> Column:
    """Why a path is no patch path; null where it is one."""
    return (
        F.when(c.isNull() | (c == ""), "empty_path").when(c.rlike(r"\[-[0-9]+\]"), "negative_index").when(c.rlike(r"\[[0-9]*[^0-9\]][0-9]*\]|\[\]"), "bad_index")
        .when(~c.rlike(GRAMMAR), "bad_syntax")
    )


def leaf(c: Column) -> Column:
    return F.regexp_extract(c, r"([^.\[\]]*)(\[[0-9]*\])*$", 1)


def path_class(c: Column) -> Column:
    f = leaf(c)
    return F.when(f.isin(*NULLABLE), "intentionally_nullable").when(f.isin(*HUMAN), "human_review_required").when(f.isin(*MODEL), "model_backfill_allowed").otherwise("not_applicable")


def unit(c: Column) -> Column:
    """struct<rank, a, b>: the semantic unit of a path, in canonical order: entities, expressions, losses, the poem."""
    n = lambda pattern, g: F.regexp_extract(c, pattern, g).try_cast("int")
    e, m, t = r"^cultural_entities\[([0-9]+)\]", r"^stanzas\[([0-9]+)\]\.metaphor_spans\[([0-9]+)\]", r"^stanzas\[([0-9]+)\]"
    zero = F.lit(0)
    u = lambda rank, a, b: F.struct(F.lit(rank).alias("rank"), a.alias("a"), b.alias("b"))
    return F.when(c.rlike(e), u(0, n(e, 1), zero)).when(c.rlike(m), u(1, n(m, 1), n(m, 2))).when(c.rlike(t), u(2, n(t, 1), zero)).otherwise(u(3, zero, zero))


def units(paths: DataFrame, key: str, path: str) -> DataFrame:
    """(<key>, units): per key its units in canonical order, each with its sorted distinct paths."""
    g = paths.select(key, F.col(path).alias("p"), unit(F.col(path)).alias("u")).distinct().groupBy(key, "u").agg(F.array_sort(F.collect_set("p")).alias("paths"))
    return g.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("u", "paths"))).alias("units"))


def batch_numbers(us: Column, max_paths: int, max_units: int) -> Column:
    """Greedy packing in order: the batch number, from 1, of each unit. A unit is never split; one above the cap is alone."""
    start = F.struct(F.lit(0).alias("batch"), F.lit(0).alias("paths"), F.lit(0).alias("units"), F.array().cast("array<int>").alias("out"))

    def step(acc, u):
        n = F.size(u["paths"])
        full = (acc["units"] == 0) | (acc["paths"] + n > max_paths) | (acc["units"] + 1 > max_units)
        b = acc["batch"] + full.cast("int")
        return F.struct(b.alias("batch"), F.when(full, n).otherwise(acc["paths"] + n).alias("paths"), F.when(full, F.lit(1)).otherwise(acc["units"] + 1).alias("units"), F.concat(acc["out"], F.array(b)).alias("out"))

    return F.aggregate(us, start, step, lambda acc: acc["out"])


def batches(packed_units: DataFrame, key: str, max_paths: int = vocab.MAX_PATHS, max_units: int = vocab.MAX_UNITS) -> DataFrame:
    """(<key>, batch_no, batch_id, n_units, n_paths, paths, over_cap)"""
    z = packed_units.select(key, F.inline(F.zip_with("units", batch_numbers(F.col("units"), max_paths, max_units), lambda u, b: F.struct(b.alias("batch_no"), u["u"].alias("u"), u["paths"].alias("ps")))))
    g = z.groupBy(key, "batch_no").agg(F.count("*").alias("n_units"), F.array_sort(F.flatten(F.collect_list("ps"))).alias("paths"))
    return g.select(key, "batch_no", F.format_string("%s_batch_%02d", F.col(key).cast("string"), "batch_no").alias("batch_id"), "n_units", F.size("paths").alias("n_paths"), "paths",
                    (F.size("paths") > max_paths).alias("over_cap"))


def reliability(n: Column) -> Column:
    return F.when(n <= 1, "single_request_safe").when(n == 2, "single_request_high_risk").otherwise("batching_required")


def split_parts(packed_units: DataFrame, key: str, preferred: int = vocab.PREFERRED_PARTS, cap: int = vocab.PART_PATHS) -> DataFrame:
    """(<key>, part_index, n_parts, reason, n_units, paths): balanced contiguous parts; as many as preferred unless there
    are fewer units or the cap needs more. A key with a unit above the cap cannot be split: it gives one row with reason
    unit_over_cap, all its paths, no part_index and 0 parts."""
    over = F.exists("units", lambda u: F.size(u["paths"]) > cap)
    need = F.array_max(batch_numbers(F.col("units"), cap, 1 << 30))
    n = F.size("units")
    p = packed_units.withColumns({"need": need, "over": over})
    p = p.withColumn("n_parts", F.when(F.col("over"), 1).when(n < preferred, n).when(F.col("need") > preferred, F.col("need")).otherwise(F.lit(preferred)))
    p = p.withColumn("reason", F.when(F.col("over"), "unit_over_cap").when(n < preferred, "fewer_units").when(F.col("need") > preferred, "cap_needs_more"))
    base, extra = F.floor(n / F.col("n_parts")), n % F.col("n_parts")
    big = extra * (base + 1)
    part = lambda i: F.when(i < big, F.floor(i / (base + 1))).otherwise(extra + F.floor((i - big) / base)).cast("int")
    z = p.select(key, "over", "n_parts", "reason", F.inline(F.transform("units", lambda u, i: F.struct((part(i) + 1).alias("part_index"), u["paths"].alias("ps")))))
    z = z.withColumns({"part_index": F.when(~F.col("over"), F.col("part_index")), "n_parts": F.when(F.col("over"), 0).otherwise(F.col("n_parts"))})
    return z.groupBy(key, "part_index", "n_parts", "reason").agg(F.count("*").alias("n_units"), F.array_sort(F.flatten(F.collect_list("ps"))).alias("paths"))


def uncovered(asked: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """(<key>, path, n): asked paths that are not in exactly one part, those of keys that could not be split included,
    and paths of parts that were not asked."""
    used = parts.where("part_index IS NOT NULL").select(key, F.explode("paths").alias("path")).groupBy(key, "path").agg(F.count("*").alias("n"))
    asked = asked.select(key, "path", F.lit(True).alias("asked")).distinct()
    return asked.join(used, [key, "path"], "full").where("n IS NULL OR n <> 1 OR asked IS NULL").select(key, "path", "n")
