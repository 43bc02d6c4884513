"""Rules over annotations.

The Merkle reader (operators.nested) gives one row per object; here its fields become typed columns, and every rule
family is one projection that builds the array of its violations, so a rule costs an expression and not a scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import vocab
from ..functions.text import has_word, is_blank, line_ref_status, numbered_lines, strip, words_found
from ..session import written

FIELDS = {
    "annotation": "recitation_style STRING, emotional_arc STRING, theme STRING",
    "stanza": "index STRING, emotion STRING, tone STRING, translation_quality STRING, loss_note STRING",
    "cultural_entity": "term STRING, romanization STRING, category STRING, stanza_index STRING, preserved STRING, translation_note STRING, gloss STRING, "
    "line_ref STRING, source_span_original STRING, source_span_translation STRING, visual_features ARRAY<STRING>, visual_priority STRING, "
    "acceptable_visual_variants ARRAY<STRING>, negative_confusions ARRAY<STRING>, translation_status STRING, cultural_specificity_level STRING",
    "metaphor_span": "source_term STRING, abstract_meaning STRING, source_span_original STRING, source_span_translation STRING, expression_type STRING, "
    "literal_meaning STRING, vehicle STRING, tenor STRING, line_ref STRING, literalization_risk STRING, visualization_strategy STRING, "
    "acceptable_visual_variants ARRAY<STRING>, visualization_difficulty STRING",
    "metaphor_mapping": "vehicle_concept STRING, tenor_concept STRING, transferred_attributes ARRAY<STRING>",
    "translation_loss": "what_was_lost STRING, `where` STRING, severity STRING",
}
ALL_FIELDS = ", ".join(dict.fromkeys(f.strip() for kind in FIELDS.values() for f in kind.split(", ")))


def objects(bridge: DataFrame, kind: str, id_col: str = "result_id") -> DataFrame:
    """(<id>, parent_path, object_path, ordinal, one column per field) of the objects of a kind."""
    rows = bridge.where(F.col("kind") == kind)
    return rows.select(id_col, "parent_path", "object_path", "ordinal", F.from_json("fields", FIELDS[kind]).alias("o")).select(id_col, "parent_path", "object_path", "ordinal", "o.*")


def every_object(bridge: DataFrame, id_col: str = "result_id") -> DataFrame:
    """All objects at once, under the union of the kinds' fields: rules of several kinds then share one scan."""
    keep = [id_col, "parent_path", "object_path", "kind", "ordinal", "n_children"]
    return bridge.select(*keep, F.from_json("fields", ALL_FIELDS).alias("o")).select(*keep, "o.*")


def of(kind: str, rules: list[Column]) -> list[Column]:
    return [F.when(F.col("kind") == kind, r) for r in rules]


def violation(test: Column, field: str, rule: str) -> Column:
    path = F.when(F.col("object_path") == "$", F.lit(field)).otherwise(F.concat("object_path", F.lit("." + field)))
    return F.when(test, F.struct(path.alias("field_path"), F.lit(rule).alias("rule")))


def violations(df: DataFrame, rules: list[Column], id_col: str = "result_id") -> DataFrame:
    """(<id>, field_path, rule): one pass, all rules."""
    return df.select(id_col, F.inline(F.array_compact(F.array(*rules))))


def blank(name: str) -> Column:
    return is_blank(F.col(name))


def completeness_rules() -> list[Column]:
    entity = of("cultural_entity", [
        violation(F.col("term").rlike(r"[^\x{0}-\x{7f}]") & F.col("term").rlike(r"[\p{L}&&[^\x{0}-\x{7f}]]") & blank("romanization"), "romanization", "romanization_of_non_ascii_term"),
        violation(F.col("cultural_specificity_level").isNull(), "cultural_specificity_level", "specificity_required"),
        violation(F.col("translation_status").isNull(), "translation_status", "status_required"),
        violation(F.col("line_ref").isNull(), "line_ref", "line_ref_required"),
        violation(F.col("source_span_original").isNull(), "source_span_original", "span_required"),
        violation(F.col("translation_status").isin(*vocab.NOTE_REQUIRED_STATUSES) & blank("translation_note"), "translation_note", "note_required_for_status"),
        violation(F.col("visual_priority").isNotNull() & (F.col("visual_priority") != "non_visual") & (F.coalesce(F.size("visual_features"), F.lit(0)) < 1), "visual_features", "features_required_unless_non_visual"),
    ])
    expression = of("metaphor_span", [
        violation(blank("vehicle"), "vehicle", "vehicle_required"),
        violation(blank("tenor"), "tenor", "tenor_required"),
        violation((F.coalesce(F.col("expression_type"), F.lit("")) != "wordplay") & F.col("visualization_difficulty").isNull(), "visualization_difficulty", "difficulty_required"),
        violation(F.col("line_ref").isNull(), "line_ref", "line_ref_required"),
        violation(F.col("source_span_original").isNull(), "source_span_original", "span_required"),
    ])
    stanza = of("stanza", [violation((F.coalesce(F.col("translation_quality"), F.lit("")) != "faithful") & blank("loss_note"), "loss_note", "loss_note_required_when_not_faithful")])
    return [*entity, *expression, *stanza]


def completeness(bridge: DataFrame) -> DataFrame:
    """Missing fields of entities, expressions and stanzas. A mapping is never required."""
    return violations(every_object(bridge), completeness_rules())


def outside(name: str, allowed: tuple[str, ...], fold: bool = False) -> Column:
    c = F.lower(F.trim(F.col(name))) if fold else F.col(name)
    return F.col(name).isNotNull() & ~c.isin(*((a.lower() for a in allowed) if fold else allowed))


def vocabulary_errors(bridge: DataFrame) -> DataFrame:
    """Values outside the four case-sensitive vocabularies and, folded, outside the enumerations of the schema."""
    v = lambda name, allowed, fold=False: violation(outside(name, allowed, fold), name, "outside_vocabulary")
    rules = [
        *of("annotation", [v("recitation_style", vocab.RECITATION_STYLES, True)]),
        *of("stanza", [v("emotion", vocab.EMOTIONS, True), v("tone", vocab.TONES, True), v("translation_quality", vocab.TRANSLATION_QUALITIES, True)]),
        *of("cultural_entity", [v("category", vocab.ENTITY_CATEGORIES, True), v("visual_priority", vocab.VISUAL_PRIORITIES, True),
                                v("cultural_specificity_level", vocab.CULTURAL_SPECIFICITY), v("translation_status", vocab.TRANSLATION_STATUSES)]),
        *of("metaphor_span", [v("expression_type", vocab.EXPRESSION_TYPES, True), v("visualization_difficulty", vocab.VISUALIZATION_DIFFICULTY)]),
        *of("translation_loss", [v("severity", vocab.LOSS_SEVERITY)]),
    ]
    return violations(every_object(bridge), rules)


def contradiction_rules() -> list[Column]:
    bad = (F.col("translation_quality") == "faithful") & (F.coalesce(F.col("loss_note"), F.lit("")) != "")
    return of("stanza", [violation(bad, "loss_note", "faithful_with_loss_note"), violation(bad, "translation_quality", "faithful_with_loss_note")])


def contradictions(bridge: DataFrame) -> DataFrame:
    """A faithful stanza with a loss note: both fields, for every stanza."""
    return violations(every_object(bridge), contradiction_rules())


def index_mismatches(bridge: DataFrame) -> DataFrame:
    """Stanzas whose index is not their position from 1; entities whose stanza index is outside the stanzas."""
    st = objects(bridge, "stanza")
    n = st.groupBy("result_id").agg(F.count("*").alias("n_stanzas"))
    a = violations(st, [violation(F.coalesce(F.expr("try_cast(index AS int)"), F.lit(-1)) != F.col("ordinal") + 1, "index", "index_is_position")])
    e = objects(bridge, "cultural_entity").join(n, "result_id", "left").withColumn("k", F.expr("try_cast(stanza_index AS int)"))
    bad = F.col("k").isNull() | (F.col("k") < 1) | (F.col("k") > F.coalesce("n_stanzas", F.lit(0)))
    return a.unionByName(violations(e, [violation(bad, "stanza_index", "stanza_index_in_range")]))


def romanization_conflicts(bridge: DataFrame) -> DataFrame:
    """(<id>, term, first_romanization, romanization, object_path) of entities that romanise a term unlike its first entity."""
    e = objects(bridge, "cultural_entity").where("term <> ''")
    first = F.first_value("romanization").over(Window.partitionBy("result_id", "term").orderBy("ordinal"))
    return e.withColumn("first_romanization", first).where("NOT (first_romanization <=> romanization)").select("result_id", "term", "first_romanization", "romanization", "object_path")


def quality_flags(bridge: DataFrame) -> DataFrame:
    """Advisory: a tenor that restates the type, or names a sensitive topic."""
    tenor, kind = F.lower(strip(F.col("tenor"))), F.lower(strip(F.col("expression_type")))
    topic = F.lit(False)
    for m in vocab.STEREOTYPE_TENORS:
        topic = topic | tenor.contains(m)
    return violations(objects(bridge, "metaphor_span"), [violation((tenor == kind) & (tenor != ""), "tenor", "tenor_restates_type"), violation(topic, "tenor", "sensitive_tenor")])


def free_texts(bridge: DataFrame) -> DataFrame:
    """(<id>, field_path, text): every free-text field that is not empty."""
    wanted = {
        "cultural_entity": ("translation_note", "gloss"),
        "metaphor_span": ("literal_meaning", "vehicle", "tenor", "visualization_strategy", "abstract_meaning"),
        "translation_loss": ("what_was_lost",),
    }
    fields = F.array(*(
        F.when(F.col("kind") == kind, F.struct(F.concat("object_path", F.lit("." + n)).alias("field_path"), F.col(n).alias("text"))) for kind, names in wanted.items() for n in names
    ))
    return every_object(bridge).select("result_id", F.inline(F.filter(fields, lambda x: F.coalesce(x["text"], F.lit("")) != "")))


def marker_findings(bridge: DataFrame, results: DataFrame, poems: DataFrame) -> DataFrame:
    """(<id>, field_path, category, marker): marker words of an annotation that its poem and translation do not hold."""
    text = F.lower(F.concat_ws(" ", "original_poem", "translated_poem"))
    families = {
        "specificity": vocab.SPECIFICITY_MARKERS, "cultural": vocab.CULTURAL_MARKERS, "social": vocab.SOCIAL_MARKERS,
        "religious": vocab.RELIGIOUS_MARKERS, "gender": vocab.GENDER_MARKERS,
    }

    def family(category: str, markers: tuple[str, ...]) -> Column:
        return F.transform(words_found(F.lower("text"), markers), lambda m: F.struct(F.lit(category).alias("category"), m.alias("marker")))

    found = F.flatten(F.array(*(family(c, ms) for c, ms in families.items())))
    hits = free_texts(bridge).select("result_id", "field_path", F.inline(found))
    source = results.select("result_id", "poem_id").join(poems.select("poem_id", text.alias("source")), "poem_id")
    held = F.rlike(F.col("source"), F.concat(F.lit("(^|[^a-z])"), F.col("marker"), F.lit("([^a-z]|$)")))
    return hits.join(source, "result_id").where(~held).select("result_id", "field_path", "category", "marker")


def risk_findings(bridge: DataFrame) -> DataFrame:
    """(<id>, field_path, rule): advisory checks that need the annotation alone."""
    objs = written(every_object(bridge), "objects")
    evidence = F.lower(F.concat_ws(" ", F.coalesce("translation_note", F.lit("")), F.coalesce("gloss", F.lit(""))))
    has_evidence = F.lit(False)
    for w in vocab.EVIDENCE_MARKERS:
        has_evidence = has_evidence | has_word(evidence, w)
    sensitive = F.lit(False)
    for w in vocab.TENOR_MARKERS:
        sensitive = sensitive | has_word(F.lower("tenor"), w)
    variants = F.transform(F.filter("acceptable_visual_variants", lambda v: v.isNotNull()), lambda v: F.lower(strip(v)))
    single = violations(objs, [
        *of("cultural_entity", [
            violation(F.col("category").isin(*vocab.EVIDENCE_CATEGORIES) & ~has_evidence, "category", "category_without_evidence"),
            violation(F.size(F.array_distinct(variants)) < F.size(variants), "acceptable_visual_variants", "repeated_variants"),
            violation(F.col("preserved").isNull(), "preserved", "unresolved"),
            violation(F.col("translation_status") == "UNCERTAIN", "translation_status", "uncertain"),
        ]),
        *of("metaphor_span", [
            violation(F.coalesce(sensitive, F.lit(False)), "tenor", "tenor_too_specific"),
            violation((F.col("expression_type") == "metaphor") & (F.col("n_children") == 0), "metaphor_mapping", "metaphor_without_mapping"),
        ]),
        *of("translation_loss", [violation((F.col("severity") == "high") & F.col("where").isNull(), "where", "high_loss_without_place")]),
    ])
    here = F.lit("$").alias("field_path")
    repeats = objs.where("kind = 'cultural_entity' AND term <> ''").groupBy("result_id", "term").agg(F.count("*").alias("n"), F.count_distinct(F.struct("category", F.coalesce(strip(F.col("translation_note")), F.lit("")))).alias("k"))
    both = F.array_compact(F.array(F.when(F.col("n") > 1, F.lit("repeated_term")), F.when(F.col("k") > 1, F.lit("term_read_differently"))))
    dense = objs.groupBy("result_id").agg(F.count_if(F.col("kind") == "stanza").alias("s"), F.count_if(F.col("kind") == "cultural_entity").alias("e")).where("e > 2 * greatest(s, 1)")
    many = objs.where("kind = 'metaphor_span'").groupBy("result_id", "parent_path").agg(F.count("*").alias("n")).where("n > 3")
    return (
        single.unionByName(repeats.select("result_id", here, F.explode(both).alias("rule")))
        .unionByName(dense.select("result_id", here, F.lit("too_many_entities").alias("rule")))
        .unionByName(many.select("result_id", F.col("parent_path").alias("field_path"), F.lit("too_many_expressions").alias("rule")))
    )


def text_anomalies(poems: DataFrame) -> DataFrame:
    """(poem_id, field, anomaly): empty texts, Latin words in another script, runs of one character."""
    def of(name: str) -> Column:
        c = F.col(name)
        mixed = c.rlike(r"[\p{L}&&[^\x{0}-\x{2af}]]") & c.rlike("[A-Za-z]{2,}")
        return F.array(
            F.when(is_blank(c), F.struct(F.lit(name).alias("field"), F.lit("empty").alias("anomaly"))),
            F.when(~is_blank(c) & mixed, F.struct(F.lit(name).alias("field"), F.lit("latin_words_in_other_script").alias("anomaly"))),
            F.when(~is_blank(c) & c.rlike(r"(?s)(.)\1{5,}"), F.struct(F.lit(name).alias("field"), F.lit("repeated_character").alias("anomaly"))),
        )

    return poems.select("poem_id", F.inline(F.array_compact(F.concat(of("original_poem"), of("translated_poem")))))


def loss_places(bridge: DataFrame, results: DataFrame, poems: DataFrame) -> DataFrame:
    """(<id>, object_path, where, status) of every loss item: is its place a line of the poem."""
    n = results.select("result_id", "poem_id").join(poems.select("poem_id", F.size(numbered_lines(F.coalesce("original_poem", F.lit("")))).alias("n_lines")), "poem_id")
    return objects(bridge, "translation_loss").join(n, "result_id").select("result_id", "object_path", "where", line_ref_status(F.col("where"), F.col("n_lines")).alias("status"))
