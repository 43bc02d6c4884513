"""Patches and repairs of annotations as rows: what is asked, what is answered, what may be applied.

A patch is a row (<id>, path, value). Objects come as typed columns (operators.annotation), so the value at a path is a
column of the object that holds it, found by one equi-join, and every check is an expression; a document's patches are
applied if all of them may be.

Defined results: a null or empty path is an error; a repeated path makes all its rows an error; a patch of a field that
holds something else than nothing, an empty text or an empty list is refused; null values are refused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab
from . import annotation, planning

# Closed vocabularies by field.
CLOSED = {
    "recitation_style": vocab.RECITATION_STYLES, "emotion": vocab.EMOTIONS, "tone": vocab.TONES, "translation_quality": vocab.TRANSLATION_QUALITIES,
    "category": vocab.ENTITY_CATEGORIES, "visual_priority": vocab.VISUAL_PRIORITIES, "cultural_specificity_level": vocab.CULTURAL_SPECIFICITY,
    "translation_status": vocab.TRANSLATION_STATUSES, "expression_type": vocab.EXPRESSION_TYPES, "visualization_difficulty": vocab.VISUALIZATION_DIFFICULTY, "severity": vocab.LOSS_SEVERITY,
}
SCALARS = {kind: [f.split(" ")[0].strip("`") for f in fields.split(", ") if f.endswith(" STRING")] for kind, fields in annotation.FIELDS.items()}
LEAVES = sorted({n for names in SCALARS.values() for n in names})


def fields(bridge: DataFrame, id_col: str = "result_id") -> DataFrame:
    """(<id>, object_path, kind, field, value): every scalar field of every object that holds something."""
    values = lambda kind: F.array(*(F.struct(F.lit(n).alias("field"), F.col(n).alias("value")) for n in SCALARS[kind]))
    every = F.lit(None)
    for kind in SCALARS:
        every = F.when(F.col("kind") == kind, values(kind)).otherwise(every)
    rows = annotation.every_object(bridge, id_col).select(id_col, "object_path", "kind", F.inline(every))
    return rows.where("value IS NOT NULL")


def field_path(object_path: Column, field: Column) -> Column:
    return F.when(object_path == "$", field).otherwise(F.concat(object_path, F.lit("."), field))


def holder(path: Column) -> Column:
    """The object a path of a scalar field is in: the path without its last step."""
    return F.when(path.contains("."), F.regexp_replace(path, r"\.[^.]*$", "")).otherwise(F.lit("$"))


def differing(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """(<keys>, before, after): keys whose values differ or that only one side has. Full outer join, null-safe."""
    a, b = before.select(*keys, F.col("value").alias("before")), after.select(*keys, F.col("value").alias("after"))
    return a.join(b, keys, "full").where("NOT (before <=> after)")


def path_match(asked: DataFrame, given: DataFrame, key: str) -> DataFrame:
    """(<key>, n_asked, n_given, missing, extra, disjoint, equal): two path sets per key, joined as sets of rows."""
    a, b = (d.select(key, "path").distinct().withColumn(n, F.lit(True)) for d, n in ((asked, "a"), (given, "b")))
    j = a.join(b, [key, "path"], "full")
    lack = lambda has, other: F.array_join(F.array_sort(F.collect_set(F.when(F.col(has).isNotNull() & F.col(other).isNull(), F.col("path")))), ";")
    g = j.groupBy(key).agg(F.count("a").alias("n_asked"), F.count("b").alias("n_given"), lack("a", "b").alias("missing"), lack("b", "a").alias("extra"), F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("both"))
    return g.select(key, "n_asked", "n_given", "missing", "extra", (F.col("both") == 0).alias("disjoint"), ((F.col("missing") == "") & (F.col("extra") == "")).alias("equal"))


def verdicts(patches: DataFrame, bridge: DataFrame, id_col: str = "result_id") -> DataFrame:
    """patches (<id>, issue_id, path, value) with verdict and applied. verdict, the first that holds: the error of the path,
    repeated, unknown_field, no_object, no_value, already_filled, outside_vocabulary, or ok."""
    p = F.col("path")
    asked = patches.withColumns({"leaf": planning.leaf(p), "object_path": holder(p), "n": F.count("*").over(Window.partitionBy(id_col, "path"))})
    known = F.lit(None)
    held = F.lit(None).cast("string")
    for kind, names in SCALARS.items():
        known = F.when(F.col("kind") == kind, F.col("leaf").isin(*names)).otherwise(known)
    for n in LEAVES:
        held = F.when(F.col("leaf") == n, F.col(f"o.{n}")).otherwise(held)
    objs = bridge.select(id_col, "object_path", "kind", F.from_json("fields", annotation.ALL_FIELDS).alias("o"))
    j = asked.join(objs, [id_col, "object_path"], "left")
    closed = F.lit(False)
    for n, allowed in CLOSED.items():
        closed = closed | ((F.col("leaf") == n) & ~F.col("value").isin(*allowed))
    verdict = (
        F.when(planning.path_error(p).isNotNull(), planning.path_error(p)).when(F.col("n") > 1, "repeated").when(~F.col("leaf").isin(*LEAVES), "unknown_field").when(F.col("kind").isNull(), "no_object")
        .when(~known, "unknown_field").when(F.col("value").isNull(), "no_value").when((F.coalesce(held, F.lit("")) != "") & (held != F.col("value")), "already_filled").when(closed, "outside_vocabulary").otherwise("ok")
    )
    v = j.select(id_col, "issue_id", "path", "value", verdict.alias("verdict"))
    whole = v.groupBy(id_col).agg(F.bool_and(F.col("verdict") == "ok").alias("applied"))  # a document's patches are applied together
    return v.join(whole, id_col)


def patched_fields(rows: DataFrame, verdict_rows: DataFrame, id_col: str = "result_id") -> DataFrame:
    """fields() after the patches that are applied."""
    new = verdict_rows.where("applied").select(id_col, holder(F.col("path")).alias("object_path"), planning.leaf(F.col("path")).alias("field"), F.col("value").alias("new"))
    j = rows.drop("kind").join(new, [id_col, "object_path", "field"], "full")
    return j.select(id_col, "object_path", "field", F.coalesce("new", "value").alias("value"))


def repaired(asked: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """(<key>, path, old, answer, value, unresolved) of every asked path (<key>, path, old).

    answers: (<key>, members MAP<STRING, STRING>, open ARRAY<STRING>), one row a key: what was answered by path, null
    for a null answer, and the paths left open. Left open wins over absent, absent over null, null over a value; answers
    to paths nobody asked for change nothing."""
    j = asked.join(answers, key, "left")
    there = F.coalesce(F.map_contains_key("members", F.col("path")), F.lit(False))
    left = F.coalesce(F.array_contains("open", F.col("path")), F.lit(False))
    got = F.element_at("members", F.col("path"))
    answer = F.when(left, "left_open").when(~there, "absent").when(got.isNull(), "null").otherwise("value")
    kept = left | ~there
    return j.select(key, "path", "old", answer.alias("answer"), F.when(kept, F.col("old")).otherwise(got).alias("value"), kept.alias("unresolved"))


def answer_rows(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(<key>, members, open) of the answers that are JSON objects, fenced or not."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(text), r"^```[A-Za-z]*\s*", ""), r"\s*```$", "")
    t = texts.select(key, bare.alias("t")).where(F.schema_of_variant(F.try_parse_json("t")).startswith("OBJECT"))
    items = F.from_json(F.get_json_object("t", "$.unresolved_items"), "array<struct<field_path string>>")
    return t.select(key, F.from_json("t", "map<string,string>").alias("members"), F.transform(items, lambda x: x["field_path"]).alias("open"))
