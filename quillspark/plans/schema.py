"""Schema, gate and assembly queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import annotation, nested, patches, schema
from ..operators.segments import stanza_texts
from ..session import table, written
from . import annotation as rules
from .annotation_sql import ANNOTATIONS, pick
from .grounding import BASE, issue_sql, grounding_issues
from .patches import ALL_FIELDS, PLACE, TABLES, bridge, object_fields, results
from .segments import SRC


def type_faults(spark, d):
    return schema.type_faults(bridge(spark, d))


def member_types(spark, d):
    """How often each member comes as which type."""
    return schema.member_types(bridge(spark, d))


def canonical_values(spark, d):
    return schema.canonical_values(object_fields(spark, d))


def clamped_indexes(spark, d):
    return schema.clamped_indexes(bridge(spark, d))


def schema_verdicts(spark, d):
    """The first schema fault of each annotation that has any, by path."""
    b = bridge(spark, d)
    f = type_faults(spark, d).select("result_id", patches.field_path(F.col("object_path"), F.col("field")).alias("path"), F.lit("type").alias("fault"))
    more = annotation.index_mismatches(b).unionByName(annotation.contradictions(b)).select("result_id", F.col("field_path").alias("path"), F.col("rule").alias("fault"))
    g = f.unionByName(more).groupBy("result_id").agg(F.count("*").alias("n_faults"), F.min(F.struct("path", "fault")).alias("m"))
    return g.select("result_id", "n_faults", "m.path", "m.fault")


def gate_run(spark, d):
    b = written(bridge(spark, d), "bridge")  # read by every gate, parsed once
    bad = lambda df: df.select("result_id")
    faults = {
        "schema": bad(schema.type_faults(b)).unionByName(bad(annotation.index_mismatches(b))).unionByName(bad(annotation.contradictions(b))),
        "completeness": bad(annotation.completeness(b)), "vocabulary": bad(annotation.vocabulary_errors(b)),
        "grounding": bad(grounding_issues(spark, d).where("severity = 'error'")), "romanization": bad(annotation.romanization_conflicts(b)),
    }
    return schema.gate_run(results(spark, d), faults, nested.statuses(results(spark, d), "result_id", "normalized_annotation"))


def gate_run_summary(spark, d):
    return gate_run(spark, d).groupBy("first_failure").agg(F.count("*").alias("n"), F.sum("n_grounding").alias("grounding_errors"))


def assembled_stanzas(spark, d):
    p = table(spark, d, "source_records")
    return schema.assembled(p, bridge(spark, d), results(spark, d), F.coalesce(F.size(stanza_texts(F.col("original_poem"))), F.lit(0)))


QUERIES = {f.__name__: f for f in (type_faults, member_types, canonical_values, clamped_indexes, schema_verdicts, gate_run, gate_run_summary, assembled_stanzas)}

NAMES = {"VARCHAR": "text", "ARRAY": "list", "OBJECT": "object", "BOOLEAN": "boolean", "UBIGINT": "integer", "BIGINT": "integer", "DOUBLE": "number"}
TYPE = lambda v: "CASE json_type(" + v + ") " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in NAMES.items()) + " END"


def checks():
    for t, kind in TABLES.items():
        short = {full: k for k, full in nested.COMPACT[kind].items()}
        for n, want in schema.wanted_types()[kind].items():
            v = pick("o", n, short.get(n))
            yield f"SELECT result_id, {PLACE(t)} AS object_path, '{n}' AS field, '{want}' AS wanted, {TYPE(v)} AS found FROM {t}"


EVERY = " UNION ALL ".join(checks())
TYPES = f"ty AS (SELECT * FROM ({EVERY}) WHERE found <> wanted)"
SPELT = "CASE field " + " ".join(f"WHEN '{n}' THEN CASE lower(trim(value, ' ')) " + " ".join(f"WHEN '{a.lower()}' THEN '{a}'" for a in vs) + " END" for n, vs in patches.CLOSED.items()) + " END"
CONTRA = "cn AS (" + " UNION ALL ".join(rules.rule("st", rules.BAD, f, "faithful_with_loss_note") for f in ("loss_note", "translation_quality")) + ")"
CLAMP = rules.f("stanza_index", "si")
GATE = f"""{BASE}, {TYPES}, {rules.MISMATCH}, {CONTRA}, rc AS (SELECT result_id FROM (SELECT result_id, {rules.f('romanization', 'rm')} AS r, first_value({rules.f('romanization', 'rm')}) OVER (PARTITION BY result_id, {rules.f('term', 'tm')} ORDER BY ordinal) AS f FROM ce WHERE {rules.f('term', 'tm')} <> '') WHERE r IS DISTINCT FROM f),
fx AS (SELECT result_id, 'schema' AS gate FROM ty UNION ALL SELECT result_id, 'schema' FROM ix UNION ALL SELECT result_id, 'schema' FROM cn UNION ALL SELECT result_id, 'completeness' FROM ({' UNION ALL '.join(rules.REQ)})
    UNION ALL SELECT result_id, 'vocabulary' FROM ({' UNION ALL '.join(rules.VOC)}) UNION ALL SELECT result_id, 'grounding' FROM ({issue_sql(False)}) WHERE severity = 'error' UNION ALL SELECT result_id, 'romanization' FROM rc),
g0 AS (SELECT r.result_id, count(*) FILTER (WHERE gate = 'schema') + CASE WHEN any_value(ann.result_id) IS NULL THEN 1 ELSE 0 END AS n_schema, count(*) FILTER (WHERE gate = 'completeness') AS c, count(*) FILTER (WHERE gate = 'vocabulary') AS n_vocabulary, count(*) FILTER (WHERE gate = 'grounding') AS g, count(*) FILTER (WHERE gate = 'romanization') AS n_romanization
    FROM validation_results r LEFT JOIN ann USING (result_id) LEFT JOIN fx USING (result_id) GROUP BY r.result_id),
g1 AS (SELECT result_id, n_schema, CASE WHEN n_schema = 0 THEN c ELSE 0 END AS n_completeness, n_vocabulary, CASE WHEN n_schema = 0 THEN g ELSE 0 END AS n_grounding, n_romanization FROM g0),
gr AS (SELECT *, CASE WHEN n_schema > 0 THEN 'schema' WHEN n_completeness > 0 THEN 'completeness' WHEN n_vocabulary > 0 THEN 'vocabulary' WHEN n_grounding > 0 THEN 'grounding' WHEN n_romanization > 0 THEN 'romanization' ELSE 'pass' END AS first_failure FROM g1)"""
SQL = {
    "type_faults": f"WITH {ANNOTATIONS}, {TYPES} SELECT * FROM ty",
    "member_types": f"WITH {ANNOTATIONS} SELECT field, wanted, found, count(*) AS n FROM ({EVERY}) GROUP BY ALL",
    "canonical_values": f"WITH {ALL_FIELDS}, c AS (SELECT result_id, object_path, field, value, {SPELT} AS canonical FROM fl WHERE field IN ({', '.join(repr(n) for n in patches.CLOSED)})) SELECT *, CASE WHEN canonical IS NULL THEN 'not_in_vocabulary' WHEN canonical <> value THEN 'spelling' END AS fault FROM c",
    "clamped_indexes": f"""WITH {ANNOTATIONS}, n AS (SELECT result_id, count(*) AS n FROM st GROUP BY ALL) SELECT ce.result_id, object_path, {CLAMP} AS stanza_index,
        CASE WHEN n > 0 AND try_cast({CLAMP} AS int) IS NOT NULL THEN greatest(1, least(try_cast({CLAMP} AS int), n)) END AS clamped FROM ce LEFT JOIN n USING (result_id)""",
    "schema_verdicts": f"""WITH {ANNOTATIONS}, {TYPES}, {rules.MISMATCH}, {CONTRA}, a AS (SELECT result_id, CASE WHEN object_path = '$' THEN field ELSE object_path || '.' || field END AS path, 'type' AS fault FROM ty
        UNION ALL SELECT result_id, field_path, rule FROM ix UNION ALL SELECT result_id, field_path, rule FROM cn), k AS (SELECT *, count(*) OVER (PARTITION BY result_id) AS n_faults, row_number() OVER (PARTITION BY result_id ORDER BY path, fault) AS k FROM a)
        SELECT result_id, n_faults, path, fault FROM k WHERE k = 1""",
    "gate_run": f"{GATE} SELECT * FROM gr",
    "gate_run_summary": f"{GATE} SELECT first_failure, count(*) AS n, sum(n_grounding) AS grounding_errors FROM gr GROUP BY ALL",
    "assembled_stanzas": f"""WITH {ANNOTATIONS}, {SRC}, ns AS (SELECT poem_id, max(stanza_index) AS n FROM li GROUP BY ALL), w AS (SELECT result_id, unnest(generate_series(1, n::bigint)) AS k FROM ann JOIN ns USING (poem_id)),
        s AS (SELECT result_id, k, object_path, emotion FROM (SELECT result_id, try_cast({rules.f('index', 'i')} AS int) AS k, object_path, {rules.f('emotion', 'em')} AS emotion, row_number() OVER (PARTITION BY result_id, try_cast({rules.f('index', 'i')} AS int) ORDER BY ordinal) AS r FROM st) WHERE r = 1 AND k IS NOT NULL),
        sp AS (SELECT result_id, parent_path AS object_path, count(*) AS n FROM ms GROUP BY ALL), ls AS (SELECT result_id, parent_path AS object_path, count(*) AS n FROM tl GROUP BY ALL)
        SELECT w.result_id, w.k AS stanza_index, s.k IS NOT NULL AS in_overview, emotion, coalesce(sp.n, 0) AS n_spans, coalesce(ls.n, 0) AS n_losses FROM w LEFT JOIN s ON s.result_id = w.result_id AND s.k = w.k
        LEFT JOIN sp ON sp.result_id = s.result_id AND sp.object_path = s.object_path LEFT JOIN ls ON ls.result_id = s.result_id AND ls.object_path = s.object_path""",
}
