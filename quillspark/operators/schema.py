"""Types of delivered members: strict checks, canonical spellings, clamped indexes, and the first failing gate.

Members are read as JSON values, so a text where a list belongs or a 1 where a boolean belongs is seen as what it is; a
cast would accept it.

Defined results: absent and null members are no faults; enumerations compare trimmed and case folded and come back in
their canonical spelling; a stanza index that is no number, or a poem without stanzas, has no clamped index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import annotation, patches

LISTS = {kind: [f.split(" ")[0].strip("`") for f in fields.split(", ") if "ARRAY" in f] for kind, fields in annotation.FIELDS.items()}
# Members whose JSON type is not text.
INTEGERS = {"stanza": ["index"], "cultural_entity": ["stanza_index"]}
BOOLEANS = {"cultural_entity": ["preserved"]}


def wanted_types() -> dict[str, dict[str, str]]:
    out = {}
    for kind in annotation.FIELDS:
        other = {n: "integer" for n in INTEGERS.get(kind, [])} | {n: "boolean" for n in BOOLEANS.get(kind, [])}
        out[kind] = {n: "text" for n in patches.SCALARS[kind] if n not in other} | other | {n: "list" for n in LISTS[kind]}
    return out


def json_type(v: Column) -> Column:
    """text, list, object, boolean, integer or number; null for null and absent."""
    t = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | (t == "VOID"), None).when(t == "STRING", "text").when(t.startswith("ARRAY"), "list").when(t.startswith("OBJECT"), "object").when(t == "BOOLEAN", "boolean").when(t == "BIGINT", "integer").otherwise("number")
    )


def typed_members(bridge: DataFrame, id_col: str = "result_id") -> DataFrame:
    """(<id>, object_path, field, wanted, found) of every member a kind of object may have."""
    checks = None
    for kind, names in wanted_types().items():
        one = F.array(*(F.struct(F.lit(n).alias("field"), F.lit(t).alias("wanted"), json_type(F.variant_get("v", f"$.{n}", "variant")).alias("found")) for n, t in names.items()))
        checks = F.when(F.col("kind") == kind, one) if checks is None else checks.when(F.col("kind") == kind, one)
    rows = bridge.select(id_col, "object_path", "kind", F.parse_json("fields").alias("v"))
    return rows.select(id_col, "object_path", F.inline(checks))


def type_faults(bridge: DataFrame, id_col: str = "result_id") -> DataFrame:
    """Members of another type than their field's."""
    return typed_members(bridge, id_col).where("found <> wanted")


def member_types(bridge: DataFrame) -> DataFrame:
    return typed_members(bridge).groupBy("field", "wanted", "found").agg(F.count("*").alias("n"))


def canonical_values(fields: DataFrame, id_col: str = "result_id") -> DataFrame:
    """(<id>, object_path, field, value, canonical, fault): members of closed vocabularies in their canonical spelling."""
    canonical, closed = F.lit(None).cast("string"), F.lit(False)
    folded = F.lower(F.trim("value"))
    for name, allowed in patches.CLOSED.items():
        spelt = F.lit(None).cast("string")
        for a in allowed:
            spelt = F.when(folded == a.lower(), a).otherwise(spelt)
        canonical = F.when(F.col("field") == name, spelt).otherwise(canonical)
        closed = closed | (F.col("field") == name)
    c = fields.where(closed).select(id_col, "object_path", "field", "value", canonical.alias("canonical"))
    return c.withColumn("fault", F.when(F.col("canonical").isNull(), "not_in_vocabulary").when(F.col("canonical") != F.col("value"), "spelling"))


def clamped_indexes(bridge: DataFrame, id_col: str = "result_id") -> DataFrame:
    """(<id>, object_path, stanza_index, clamped): the index of an entity's stanza, brought into 1..number of stanzas."""
    n = bridge.groupBy(id_col).agg(F.count_if(F.col("kind") == "stanza").alias("n"))  # partial counts before the shuffle
    e = annotation.objects(bridge, "cultural_entity", id_col).join(n, id_col)
    k = F.expr("try_cast(stanza_index AS int)")
    return e.select(id_col, "object_path", "stanza_index", F.when(F.col("n") > 0, F.greatest(F.lit(1), F.least(k, F.col("n").cast("int")))).alias("clamped")).withColumn("clamped", F.when(k.isNotNull(), F.col("clamped")))


GATES = ("schema", "completeness", "vocabulary", "grounding", "romanization")


def gate_run(results: DataFrame, faults: dict[str, DataFrame], statuses: DataFrame, id_col: str = "result_id") -> DataFrame:
    """(<id>, n_<gate> ..., first_failure): the gates run on the annotations. faults holds the fault rows of each gate;
    completeness and grounding count only where the schema holds, an unreadable annotation fails the schema."""
    every = None
    for gate, df in faults.items():
        one = df.groupBy(id_col).agg(F.count("*").alias("n")).withColumn("gate", F.lit(gate))
        every = one if every is None else every.unionByName(one)
    wide = every.groupBy(id_col).pivot("gate", list(GATES)).agg(F.sum("n"))
    x = results.select(id_col).join(statuses, id_col).join(wide, id_col, "left")
    n = {g: F.coalesce(F.col(g), F.lit(0)) for g in GATES}
    n["schema"] = n["schema"] + (F.col("status") != "read").cast("long")
    x = x.select(id_col, *(v.alias(f"n_{g}") for g, v in n.items()))
    for g in ("completeness", "grounding"):
        x = x.withColumn(f"n_{g}", F.when(F.col("n_schema") == 0, F.col(f"n_{g}")).otherwise(0))
    first = F.lit("pass")
    for g in reversed(GATES):
        first = F.when(F.col(f"n_{g}") > 0, g).otherwise(first)
    return x.withColumn("first_failure", first)


def assembled(poems: DataFrame, bridge: DataFrame, results: DataFrame, n_stanzas: Column, id_col: str = "result_id") -> DataFrame:
    """(<id>, stanza_index, in_overview, emotion, n_spans, n_losses): the sections put together over the stanzas 1..n of the
    poem. The overview drives; what a section lacks gets its default, what lies beyond n is left out."""
    st = annotation.objects(bridge, "stanza", id_col).withColumn("k", F.expr("try_cast(index AS int)"))
    first = st.where("k IS NOT NULL").groupBy(id_col, "k").agg(F.min_by(F.struct("object_path", "emotion"), "ordinal").alias("s"))
    kids = bridge.where("kind IN ('metaphor_span', 'translation_loss')").groupBy(id_col, F.col("parent_path").alias("object_path")).agg(
        F.count_if(F.col("kind") == "metaphor_span").alias("spans"), F.count_if(F.col("kind") == "translation_loss").alias("losses"))
    wanted = results.select(id_col, "poem_id").join(poems.select("poem_id", n_stanzas.alias("n")), "poem_id").where("n > 0").select(id_col, F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k"))
    readable = bridge.where("object_path = '$'").select(id_col)
    j = wanted.join(readable, id_col, "left_semi").join(first, [id_col, "k"], "left").withColumn("object_path", F.col("s.object_path")).join(kids, [id_col, "object_path"], "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return j.select(id_col, F.col("k").alias("stanza_index"), F.col("s").isNotNull().alias("in_overview"), F.col("s.emotion").alias("emotion"), zero("spans").alias("n_spans"), zero("losses").alias("n_losses"))
