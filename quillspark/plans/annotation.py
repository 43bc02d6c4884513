"""Rules over annotations as queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..functions.text import WS
from ..operators import annotation as rules
from ..operators import nested
from ..session import table
from .annotation_sql import ANNOTATIONS, text
from .segments import SRC, stripped


def bridge(spark, d):
    return nested.occurrences(table(spark, d, "validation_results"), "result_id", "normalized_annotation")


def completeness_violations(spark, d):
    return rules.completeness(bridge(spark, d))


def vocabulary_errors(spark, d):
    return rules.vocabulary_errors(bridge(spark, d))


def loss_note_contradictions(spark, d):
    return rules.contradictions(bridge(spark, d))


def index_mismatches(spark, d):
    return rules.index_mismatches(bridge(spark, d))


def romanization_conflicts(spark, d):
    return rules.romanization_conflicts(bridge(spark, d))


def quality_flags(spark, d):
    return rules.quality_flags(bridge(spark, d))


def free_texts(spark, d):
    return rules.free_texts(bridge(spark, d))


def marker_findings(spark, d):
    return rules.marker_findings(bridge(spark, d), table(spark, d, "validation_results"), table(spark, d, "source_records"))


def risk_findings(spark, d):
    return rules.risk_findings(bridge(spark, d))


def risk_summary(spark, d):
    return risk_findings(spark, d).groupBy("rule").agg(F.count("*").alias("n"), F.count_distinct("result_id").alias("n_results"))


def text_anomalies(spark, d):
    return rules.text_anomalies(table(spark, d, "source_records"))


def loss_places(spark, d):
    return rules.loss_places(bridge(spark, d), table(spark, d, "validation_results"), table(spark, d, "source_records"))


def faithful_fraction(spark, d):
    st = rules.objects(bridge(spark, d), "stanza")
    return st.groupBy("result_id").agg(F.count("*").alias("n_stanzas"), F.round(F.avg((F.col("translation_quality") == "faithful").cast("double")), 6).alias("faithful_fraction"))


def category_density(spark, d):
    e = rules.objects(bridge(spark, d), "cultural_entity")
    return e.groupBy("category", "translation_status").agg(F.count("*").alias("n"), F.count("line_ref").alias("n_with_line"), F.count_distinct("term").alias("n_terms"))


QUERIES = {f.__name__: f for f in (
    completeness_violations, vocabulary_errors, loss_note_contradictions, index_mismatches, romanization_conflicts, quality_flags,
    free_texts, marker_findings, risk_findings, risk_summary, text_anomalies, loss_places, faithful_fraction, category_density,
)}


def f(name: str, short: str | None = None) -> str:
    return text("o", name, short)


def blank(x: str) -> str:
    return f"({x} IS NULL OR regexp_full_match({x}, '{WS}*'))"


def rule(source: str, test: str, field: str, name: str) -> str:
    path = f"'{field}'" if source == "ann" else f"object_path || '.{field}'"
    return f"SELECT result_id, {path} AS field_path, '{name}' AS rule FROM {source} WHERE {test}"


def inlist(values, fold: bool = False) -> str:
    return "(" + ", ".join("'" + (v.lower() if fold else v) + "'" for v in values) + ")"


def out_of(source: str, name: str, values, fold: bool, short: str | None = None) -> str:
    x = f(name, short)
    return rule(source, f"{x} IS NOT NULL AND {'lower(trim(' + x + '))' if fold else x} NOT IN {inlist(values, fold)}", name, "outside_vocabulary")


def union(parts: list[str]) -> str:
    return f"WITH {ANNOTATIONS} " + " UNION ALL ".join(parts)


def any_word(x: str, words) -> str:
    return "regexp_matches(" + x + ", '(^|[^a-z])(" + "|".join(words) + ")([^a-z]|$)')"


REQ = [
    rule("ce", f"regexp_matches({f('term', 'tm')}, '[^\\x00-\\x7f]') AND regexp_matches(regexp_replace({f('term', 'tm')}, '[\\x00-\\x7f]', '', 'g'), '\\pL') AND {blank(f('romanization', 'rm'))}", "romanization", "romanization_of_non_ascii_term"),
    rule("ce", f"{f('cultural_specificity_level')} IS NULL", "cultural_specificity_level", "specificity_required"),
    rule("ce", f"{f('translation_status')} IS NULL", "translation_status", "status_required"),
    rule("ce", f"{f('line_ref')} IS NULL", "line_ref", "line_ref_required"),
    rule("ce", f"{f('source_span_original')} IS NULL", "source_span_original", "span_required"),
    rule("ce", f"{f('translation_status')} IN {inlist(vocab.NOTE_REQUIRED_STATUSES)} AND {blank(f('translation_note', 'tn'))}", "translation_note", "note_required_for_status"),
    rule("ce", f"{f('visual_priority')} <> 'non_visual' AND coalesce(json_array_length(CASE WHEN json_type(o->'visual_features') = 'ARRAY' THEN o->'visual_features' END), 0) < 1", "visual_features", "features_required_unless_non_visual"),
    rule("ms", blank(f("vehicle")), "vehicle", "vehicle_required"),
    rule("ms", blank(f("tenor")), "tenor", "tenor_required"),
    rule("ms", f"coalesce({f('expression_type')}, '') <> 'wordplay' AND {f('visualization_difficulty')} IS NULL", "visualization_difficulty", "difficulty_required"),
    rule("ms", f"{f('line_ref')} IS NULL", "line_ref", "line_ref_required"),
    rule("ms", f"{f('source_span_original')} IS NULL", "source_span_original", "span_required"),
    rule("st", f"coalesce({f('translation_quality', 'tq')}, '') <> 'faithful' AND {blank(f('loss_note', 'ln'))}", "loss_note", "loss_note_required_when_not_faithful"),
]
VOC = [
    out_of("ann", "recitation_style", vocab.RECITATION_STYLES, True, "rs"), out_of("st", "emotion", vocab.EMOTIONS, True, "em"),
    out_of("st", "tone", vocab.TONES, True, "to"), out_of("st", "translation_quality", vocab.TRANSLATION_QUALITIES, True, "tq"),
    out_of("ce", "category", vocab.ENTITY_CATEGORIES, True, "ct"), out_of("ce", "visual_priority", vocab.VISUAL_PRIORITIES, True),
    out_of("ce", "cultural_specificity_level", vocab.CULTURAL_SPECIFICITY, False), out_of("ce", "translation_status", vocab.TRANSLATION_STATUSES, False),
    out_of("ms", "expression_type", vocab.EXPRESSION_TYPES, True), out_of("ms", "visualization_difficulty", vocab.VISUALIZATION_DIFFICULTY, False),
    out_of("tl", "severity", vocab.LOSS_SEVERITY, False),
]
BAD = f"{f('translation_quality', 'tq')} = 'faithful' AND coalesce({f('loss_note', 'ln')}, '') <> ''"
FREE = " UNION ALL ".join(
    f"SELECT result_id, object_path || '.{n}' AS field_path, {f(n, s)} AS text FROM {t} WHERE coalesce({f(n, s)}, '') <> ''"
    for t, n, s in (("ce", "translation_note", "tn"), ("ce", "gloss", None), ("ms", "literal_meaning", None), ("ms", "vehicle", None), ("ms", "tenor", None),
                    ("ms", "visualization_strategy", None), ("ms", "abstract_meaning", "am"), ("tl", "what_was_lost", None))
)
FAMILIES = {"specificity": vocab.SPECIFICITY_MARKERS, "cultural": vocab.CULTURAL_MARKERS, "social": vocab.SOCIAL_MARKERS, "religious": vocab.RELIGIOUS_MARKERS, "gender": vocab.GENDER_MARKERS}
MARKERS = ", ".join(f"('{c}', '{w}')" for c, ws in FAMILIES.items() for w in ws)
VARIANTS = f"list_transform(list_filter(CAST(CASE WHEN json_type(o->'acceptable_visual_variants') = 'ARRAY' THEN o->'acceptable_visual_variants' END AS VARCHAR[]), lambda v: v IS NOT NULL), lambda v: lower({stripped('v')}))"
EVIDENCE = f"lower(coalesce({f('translation_note', 'tn')}, '') || ' ' || coalesce({f('gloss')}, ''))"
TERMS = f"SELECT result_id, {f('term', 'tm')} AS term, count(*) AS n, count(DISTINCT coalesce({f('category', 'ct')}, '?') || '|' || coalesce({stripped(f('translation_note', 'tn'))}, '')) AS k FROM ce WHERE {f('term', 'tm')} <> '' GROUP BY ALL"
RISK = [
    rule("ce", f"{f('category', 'ct')} IN {inlist(vocab.EVIDENCE_CATEGORIES)} AND NOT {any_word(EVIDENCE, vocab.EVIDENCE_MARKERS)}", "category", "category_without_evidence"),
    rule("ce", f"len(list_distinct({VARIANTS})) < len({VARIANTS})", "acceptable_visual_variants", "repeated_variants"),
    rule("ce", f"{f('preserved', 'pr')} IS NULL", "preserved", "unresolved"),
    rule("ce", f"{f('translation_status')} = 'UNCERTAIN'", "translation_status", "uncertain"),
    rule("ms", any_word(f"lower({f('tenor')})", vocab.TENOR_MARKERS), "tenor", "tenor_too_specific"),
    rule("ms", f"{f('expression_type')} = 'metaphor' AND coalesce(json_type(o->'metaphor_mapping'), '') <> 'OBJECT'", "metaphor_mapping", "metaphor_without_mapping"),
    rule("tl", f"{f('severity')} = 'high' AND {f('where')} IS NULL", "where", "high_loss_without_place"),
    f"SELECT result_id, '$', 'repeated_term' FROM ({TERMS}) WHERE n > 1",
    f"SELECT result_id, '$', 'term_read_differently' FROM ({TERMS}) WHERE k > 1",
    "SELECT a.result_id, '$', 'too_many_entities' FROM ann a WHERE (SELECT count(*) FROM ce WHERE ce.result_id = a.result_id) > 2 * greatest((SELECT count(*) FROM st WHERE st.result_id = a.result_id), 1)",
    "SELECT result_id, parent_path, 'too_many_expressions' FROM ms GROUP BY result_id, parent_path HAVING count(*) > 3",
]
MISMATCH = f"""sn AS (SELECT result_id, count(*) AS n FROM st GROUP BY ALL),
ix AS (SELECT result_id, object_path || '.index' AS field_path, 'index_is_position' AS rule FROM st WHERE coalesce(try_cast({f('index', 'i')} AS int), -1) <> ordinal + 1
    UNION ALL SELECT ce.result_id, object_path || '.stanza_index', 'stanza_index_in_range' FROM ce LEFT JOIN sn USING (result_id)
    WHERE try_cast({f('stanza_index', 'si')} AS int) IS NULL OR try_cast({f('stanza_index', 'si')} AS int) NOT BETWEEN 1 AND coalesce(n, 0))"""
TENOR, KIND = f"lower({stripped(f('tenor'))})", f"lower({stripped(f('expression_type'))})"

SQL = {
    "completeness_violations": union(REQ),
    "vocabulary_errors": union(VOC),
    "loss_note_contradictions": union([rule("st", BAD, "loss_note", "faithful_with_loss_note"), rule("st", BAD, "translation_quality", "faithful_with_loss_note")]),
    "index_mismatches": f"WITH {ANNOTATIONS}, {MISMATCH} SELECT * FROM ix",
    "romanization_conflicts": f"""WITH {ANNOTATIONS}, r AS (SELECT result_id, {f('term', 'tm')} AS term, {f('romanization', 'rm')} AS romanization, object_path,
        first_value({f('romanization', 'rm')}) OVER (PARTITION BY result_id, {f('term', 'tm')} ORDER BY ordinal) AS first_romanization FROM ce WHERE {f('term', 'tm')} <> '')
        SELECT result_id, term, first_romanization, romanization, object_path FROM r WHERE romanization IS DISTINCT FROM first_romanization""",
    "quality_flags": union([rule("ms", f"{TENOR} = {KIND} AND {TENOR} <> ''", "tenor", "tenor_restates_type"),
                            rule("ms", "(" + " OR ".join(f"contains({TENOR}, '{m}')" for m in vocab.STEREOTYPE_TENORS) + ")", "tenor", "sensitive_tenor")]),
    "free_texts": f"WITH {ANNOTATIONS} {FREE}",
    "marker_findings": f"""WITH {ANNOTATIONS}, ft AS ({FREE}), mk(category, marker) AS (VALUES {MARKERS}),
        src AS (SELECT result_id, lower(concat_ws(' ', original_poem, translated_poem)) AS source FROM validation_results JOIN source_records USING (poem_id))
        SELECT result_id, field_path, category, marker FROM ft JOIN mk ON regexp_matches(lower(text), '(^|[^a-z])' || marker || '([^a-z]|$)') JOIN src USING (result_id)
        WHERE NOT regexp_matches(source, '(^|[^a-z])' || marker || '([^a-z]|$)')""",
    "risk_findings": f"WITH {ANNOTATIONS} SELECT * FROM (" + " UNION ALL ".join(RISK) + ") t(result_id, field_path, rule)",
    "risk_summary": f"WITH {ANNOTATIONS} SELECT rule, count(*) AS n, count(DISTINCT result_id) AS n_results FROM (" + " UNION ALL ".join(RISK) + ") t(result_id, field_path, rule) GROUP BY rule",
    "text_anomalies": " UNION ALL ".join(
        f"SELECT poem_id, '{c}' AS field, 'empty' AS anomaly FROM source_records WHERE {blank(c)} UNION ALL "
        f"SELECT poem_id, '{c}', 'latin_words_in_other_script' FROM source_records WHERE NOT {blank(c)} AND regexp_matches(regexp_replace({c}, '[\\x{{0}}-\\x{{2af}}]', '', 'g'), '\\pL') AND regexp_matches({c}, '[A-Za-z]{{2,}}') UNION ALL "
        f"SELECT poem_id, '{c}', 'repeated_character' FROM source_records WHERE NOT {blank(c)} AND len(list_filter(generate_series(1, length({c}) - 5), lambda i: {c}[i:i+5] = repeat({c}[i], 6))) > 0"
        for c in ("original_poem", "translated_poem")
    ),
    "loss_places": f"""WITH {ANNOTATIONS}, {SRC}, n AS (SELECT poem_id, max(line_number) AS n FROM li GROUP BY ALL),
        w AS (SELECT result_id, tl.poem_id, object_path, {f('where')} AS "where", {stripped(f('where'))} AS r FROM tl JOIN source_records USING (poem_id)),
        p AS (SELECT *, regexp_full_match(r, 'L[1-9][0-9]{{0,8}}(-L[1-9][0-9]{{0,8}})?') AS ok, try_cast(regexp_extract(r, '^L([0-9]+)', 1) AS int) AS s,
            coalesce(try_cast(regexp_extract(r, '-L([0-9]+)$', 1) AS int), try_cast(regexp_extract(r, '^L([0-9]+)', 1) AS int)) AS e FROM w)
        SELECT result_id, object_path, "where", CASE WHEN "where" IS NULL THEN 'absent' WHEN NOT ok OR s > e THEN 'malformed' WHEN e > coalesce(n, 0) THEN 'out_of_range' ELSE 'valid' END AS status
        FROM p LEFT JOIN n USING (poem_id)""",
    "faithful_fraction": f"WITH {ANNOTATIONS} SELECT result_id, count(*) AS n_stanzas, round(avg(CASE WHEN {f('translation_quality', 'tq')} = 'faithful' THEN 1.0 WHEN {f('translation_quality', 'tq')} IS NOT NULL THEN 0.0 END), 6) AS faithful_fraction FROM st GROUP BY ALL",
    "category_density": f"WITH {ANNOTATIONS} SELECT {f('category', 'ct')} AS category, {f('translation_status')} AS translation_status, count(*) AS n, count({f('line_ref')}) AS n_with_line, count(DISTINCT {f('term', 'tm')}) AS n_terms FROM ce GROUP BY ALL",
}
