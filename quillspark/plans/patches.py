"""Patch and repair queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ledger, nested, patches, planning
from ..session import table
from .annotation_sql import ANNOTATIONS, text
from .planning import PATHS, issue_paths

TABLES = {"ann": "annotation", "st": "stanza", "ce": "cultural_entity", "ms": "metaphor_span", "tl": "translation_loss", "mm": "metaphor_mapping"}


def results(spark, d):
    return table(spark, d, "validation_results")


def bridge(spark, d):
    return nested.occurrences(results(spark, d), "result_id", "normalized_annotation")


def object_fields(spark, d):
    return patches.fields(bridge(spark, d))


def attempt_changes(spark, d):
    """Fields in which two attempts at one poem differ."""
    v = results(spark, d).select("result_id", "poem_id", "attempt_no")
    f = object_fields(spark, d).join(v, "result_id")
    ends = v.groupBy("poem_id").agg(F.min("attempt_no").alias("a"), F.max("attempt_no").alias("b")).where("a < b")
    f = f.join(ends, "poem_id")
    keys = ["poem_id", "object_path", "field"]
    return patches.differing(f.where("attempt_no = a"), f.where("attempt_no = b"), keys)


def unasked_changes(spark, d):
    """Continuity: fields that the second attempt changed although no issue of the first was about them."""
    asked = issue_paths(spark, d).join(results(spark, d).select("result_id", "poem_id", "attempt_no"), "result_id")
    first = results(spark, d).groupBy("poem_id").agg(F.min("attempt_no").alias("attempt_no"))
    asked = asked.join(first, ["poem_id", "attempt_no"], "left_semi").select("poem_id", "path").distinct()
    c = attempt_changes(spark, d).withColumn("path", patches.field_path(F.col("object_path"), F.col("field")))
    return c.join(asked, ["poem_id", "path"], "left_anti").groupBy("poem_id").agg(F.count("*").alias("n_fields"), F.min("path").alias("first_path"))


def issue_fields(spark, d):
    """The value of the scalar field each issue names, where there is one."""
    p = issue_paths(spark, d).select("result_id", "issue_id", "path", patches.holder(F.col("path")).alias("object_path"), planning.leaf(F.col("path")).alias("field"))
    return p.where("path NOT LIKE '%]'").join(object_fields(spark, d), ["result_id", "object_path", "field"]).select("issue_id", "result_id", "path", "value")


def wanted_patches(spark, d):
    """One patch per issue that names allowed values: the first of them."""
    a = table(spark, d, "invalid_path_issues").where("size(allowed_values) > 0").select("issue_id", F.get("allowed_values", F.lit(0)).alias("value"))
    return issue_paths(spark, d).select("result_id", "issue_id", "path").join(a, "issue_id")


def patch_verdicts(spark, d):
    return patches.verdicts(wanted_patches(spark, d), bridge(spark, d))


def patched_documents(spark, d):
    """Documents whose patches are all applied, with their fields that hold something before and after."""
    v, f = patch_verdicts(spark, d), object_fields(spark, d)
    done = v.where("applied").select("result_id").distinct()
    n = lambda x, c: x.join(done, "result_id", "left_semi").groupBy("result_id").agg(F.count("*").alias(c))
    return done.join(n(f, "n_before"), "result_id", "left").join(n(patches.patched_fields(f, v), "n_after"), "result_id")


def path_match(spark, d):
    """Paths the issues name against those the completeness rules object to, per result."""
    given = results(spark, d).select("result_id", F.inline("completeness_violations")).select("result_id", planning.plain_path(F.col("field_path")).alias("path"))
    return patches.path_match(issue_paths(spark, d), given, "result_id")


def repair_applied(spark, d):
    """The issue paths of each result under the last repair answer of its poem."""
    poem = results(spark, d).select("result_id", "poem_id")
    last = ledger.latest(table(spark, d, "provider_calls").where("section_name = 'repair' AND response_id IS NOT NULL").select("poem_id", "requested_at", "received_at", "response_id", "text"), ["poem_id"], ["requested_at", "received_at", "response_id", "text"])
    old = issue_fields(spark, d).select("issue_id", F.col("value").alias("old"))
    asked = issue_paths(spark, d).join(old, "issue_id", "left").groupBy("result_id", "path").agg(F.max("old").alias("old")).join(poem, "result_id")
    r = patches.repaired(asked, patches.answer_rows(last, "poem_id", "text"), "poem_id")
    return asked.select("result_id", "poem_id", "path").join(r.distinct(), ["poem_id", "path"]).select("result_id", "path", "answer", "unresolved").distinct()


def related_context(spark, d):
    """Term and source span of the entity or expression each issue is about: what a repair prompt shows beside a path."""
    about = nested.issue_objects(table(spark, d, "invalid_path_issues"), "result_id", "issue_id", "field_path")
    f = object_fields(spark, d).where("kind IN ('cultural_entity', 'metaphor_span')")
    o = f.groupBy("result_id", "object_path").agg(F.max(F.when(F.col("field").isin("term", "source_term"), F.col("value"))).alias("term"), F.max(F.when(F.col("field") == "source_span_original", F.col("value"))).alias("span"))
    return about.join(o, ["result_id", "object_path"]).select("issue_id", "object_path", "term", "span")


QUERIES = {f.__name__: f for f in (object_fields, attempt_changes, unasked_changes, issue_fields, patch_verdicts, patched_documents, path_match, repair_applied, related_context)}


def picks(table_name: str):
    kind = TABLES[table_name]
    short = {full: k for k, full in nested.COMPACT[kind].items()}
    for n in patches.SCALARS[kind]:
        yield n, text("o", n, short.get(n))


PLACE = lambda t: "'$'" if t == "ann" else "object_path"
ALL_FIELDS = f"{ANNOTATIONS}, fl AS (" + " UNION ALL ".join(
    f"SELECT result_id, poem_id, {PLACE(t)} AS object_path, '{kind}' AS kind, '{n}' AS field, {v} AS value FROM {t} WHERE {v} IS NOT NULL" for t, kind in TABLES.items() for n, v in picks(t)
) + ")"
FPATH = "CASE WHEN object_path = '$' THEN field ELSE object_path || '.' || field END"
ENDS = "en AS (SELECT poem_id, min(attempt_no) AS a, max(attempt_no) AS b FROM validation_results GROUP BY ALL HAVING min(attempt_no) < max(attempt_no))"
CHANGES = f"""{ALL_FIELDS}, {ENDS}, fa AS (SELECT fl.*, attempt_no, a, b FROM fl JOIN validation_results USING (result_id, poem_id) JOIN en USING (poem_id)),
ch AS (SELECT poem_id, object_path, field, x.value AS before, y.value AS after FROM (SELECT * FROM fa WHERE attempt_no = a) x FULL JOIN (SELECT * FROM fa WHERE attempt_no = b) y USING (poem_id, object_path, field) WHERE x.value IS DISTINCT FROM y.value)"""
HOLD = r"CASE WHEN contains(path, '.') THEN regexp_replace(path, '\.[^.]*$', '') ELSE '$' END"
LEAF = r"regexp_extract(path, '([^.\[\]]*)(\[[0-9]*\])*$', 1)"
ISSUE = f"isf AS (SELECT issue_id, ip.result_id, path, value FROM (SELECT *, {HOLD} AS hold, {LEAF} AS leaf FROM ip WHERE path NOT LIKE '%]') ip JOIN fl ON fl.result_id = ip.result_id AND fl.object_path = hold AND fl.field = leaf)"
IN = lambda vs: "(" + ", ".join(f"'{v}'" for v in vs) + ")"
KINDS = "ob AS (" + " UNION ALL ".join(f"SELECT result_id, {PLACE(t)} AS object_path, '{k}' AS kind FROM {t}" for t, k in TABLES.items()) + ")"
KNOWN = " OR ".join(f"(kind = '{k}' AND leaf IN {IN(ns)})" for k, ns in patches.SCALARS.items())
OUTSIDE = " OR ".join(f"(leaf = '{n}' AND v.value NOT IN {IN(vs)})" for n, vs in patches.CLOSED.items())
VERDICT = f"""{PATHS}, {ALL_FIELDS}, {KINDS}, wp AS (SELECT ip.result_id, issue_id, path, allowed_values[1] AS value, {HOLD} AS hold, {LEAF} AS leaf, count(*) OVER (PARTITION BY ip.result_id, path) AS n FROM ip JOIN invalid_path_issues i USING (issue_id) WHERE len(allowed_values) > 0),
vd AS (SELECT v.result_id, v.issue_id, v.path, v.value, CASE WHEN path = '' THEN 'empty_path' WHEN regexp_matches(path, '\\[-[0-9]+\\]') THEN 'negative_index' WHEN regexp_matches(path, '\\[[0-9]*[^0-9\\]][0-9]*\\]|\\[\\]') THEN 'bad_index'
    WHEN NOT regexp_matches(path, '{planning.GRAMMAR}') THEN 'bad_syntax' WHEN n > 1 THEN 'repeated' WHEN leaf NOT IN {IN(patches.LEAVES)} THEN 'unknown_field' WHEN kind IS NULL THEN 'no_object' WHEN NOT ({KNOWN}) THEN 'unknown_field' WHEN v.value IS NULL THEN 'no_value'
    WHEN coalesce(f.value, '') <> '' AND f.value <> v.value THEN 'already_filled' WHEN {OUTSIDE} THEN 'outside_vocabulary' ELSE 'ok' END AS verdict
    FROM wp v LEFT JOIN ob ON ob.result_id = v.result_id AND ob.object_path = hold LEFT JOIN (SELECT result_id, object_path, field, value FROM fl) f ON f.result_id = v.result_id AND f.object_path = hold AND f.field = leaf),
ap AS (SELECT result_id, bool_and(verdict = 'ok') AS applied FROM vd GROUP BY ALL)"""
SQL = {
    "object_fields": f"WITH {ALL_FIELDS} SELECT result_id, object_path, kind, field, value FROM fl",
    "attempt_changes": f"WITH {CHANGES} SELECT * FROM ch",
    "unasked_changes": f"""WITH {PATHS}, {CHANGES}, q AS (SELECT DISTINCT v.poem_id, path FROM ip JOIN validation_results v USING (result_id) JOIN (SELECT poem_id, min(attempt_no) AS attempt_no FROM validation_results GROUP BY ALL) f USING (poem_id, attempt_no)),
        c AS (SELECT poem_id, {FPATH} AS path FROM ch) SELECT poem_id, count(*) AS n_fields, min(path) AS first_path FROM c WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.poem_id = c.poem_id AND q.path = c.path) GROUP BY poem_id""",
    "issue_fields": f"WITH {PATHS}, {ALL_FIELDS}, {ISSUE} SELECT * FROM isf",
    "patch_verdicts": f"WITH {VERDICT} SELECT vd.*, applied FROM vd JOIN ap USING (result_id)",
    "patched_documents": f"""WITH {VERDICT}, b AS (SELECT result_id, count(*) AS n FROM fl GROUP BY ALL), nw AS (SELECT result_id, count(*) AS n FROM vd WHERE NOT EXISTS (SELECT 1 FROM fl WHERE fl.result_id = vd.result_id AND {FPATH} = vd.path) GROUP BY ALL)
        SELECT ap.result_id, b.n AS n_before, coalesce(b.n, 0) + coalesce(nw.n, 0) AS n_after FROM ap LEFT JOIN b USING (result_id) LEFT JOIN nw USING (result_id) WHERE applied""",
    "path_match": rf"""WITH {PATHS}, g AS (SELECT DISTINCT result_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(trim(v.field_path, ' '), '/', '.'), '^\$', ''), '^\.', ''), '\.([0-9]+)', '[\1]', 'g'), '^annotation(\.|$)', '') AS path FROM (SELECT result_id, unnest(completeness_violations) AS v FROM validation_results)),
        j AS (SELECT coalesce(a.result_id, g.result_id) AS result_id, coalesce(a.path, g.path) AS path, a.path IS NOT NULL AS a, g.path IS NOT NULL AS b FROM (SELECT DISTINCT result_id, path FROM ip) a FULL JOIN g ON a.result_id = g.result_id AND a.path = g.path),
        s AS (SELECT result_id, count_if(a) AS n_asked, count_if(b) AS n_given, coalesce(string_agg(path, ';' ORDER BY path) FILTER (WHERE a AND NOT b), '') AS missing, coalesce(string_agg(path, ';' ORDER BY path) FILTER (WHERE b AND NOT a), '') AS extra, count_if(a AND b) AS shared FROM j GROUP BY ALL)
        SELECT result_id, n_asked, n_given, missing, extra, shared = 0 AS disjoint, missing = '' AND extra = '' AS equal FROM s""",
    "repair_applied": f"""WITH {PATHS}, l AS (SELECT poem_id, regexp_replace(regexp_replace(trim(text, ' '), '^```[A-Za-z]*\\s*', ''), '\\s*```$', '') AS t FROM (SELECT *, row_number() OVER (PARTITION BY poem_id ORDER BY requested_at DESC, received_at DESC NULLS LAST, response_id DESC, text DESC NULLS LAST) AS k
        FROM provider_calls WHERE section_name = 'repair' AND response_id IS NOT NULL) WHERE k = 1), o AS (SELECT poem_id, t::JSON AS j FROM l WHERE json_valid(t) AND json_type(CASE WHEN json_valid(t) THEN t END) = 'OBJECT'),
        q AS (SELECT DISTINCT result_id, poem_id, path FROM ip JOIN validation_results USING (result_id)),
        r AS (SELECT result_id, path, CASE WHEN list_contains(json_extract_string(j, '$.unresolved_items[*].field_path'), path) THEN 'left_open' WHEN j IS NULL OR NOT list_contains(json_keys(j), path) THEN 'absent'
            WHEN json_type(json_extract(j, '$."' || path || '"')) = 'NULL' THEN 'null' ELSE 'value' END AS answer FROM q LEFT JOIN o USING (poem_id))
        SELECT result_id, path, answer, answer IN ('left_open', 'absent') AS unresolved FROM r""",
    "related_context": f"""WITH {ALL_FIELDS}, o AS (SELECT result_id, object_path, max(value) FILTER (WHERE field IN ('term', 'source_term')) AS term, max(value) FILTER (WHERE field = 'source_span_original') AS span FROM fl WHERE kind IN ('cultural_entity', 'metaphor_span') GROUP BY ALL),
        i1 AS (SELECT result_id, issue_id, regexp_replace(regexp_replace(replace(trim(field_path), '/', '.'), '^\\$', ''), '^\\.', '') AS p FROM invalid_path_issues WHERE trim(field_path) <> ''),
        i2 AS (SELECT result_id, issue_id, regexp_replace(regexp_replace(p, '\\.([0-9]+)', '[\\1]', 'g'), '^annotation(\\.|$)', '') AS p FROM i1),
        i3 AS (SELECT result_id, issue_id, CASE WHEN regexp_matches(p, '^stanzas\\[[0-9]+\\]\\.metaphor_spans\\[[0-9]+\\]\\.metaphor_mapping') THEN NULL WHEN regexp_matches(p, '^stanzas\\[[0-9]+\\]\\.metaphor_spans\\[[0-9]+\\]') THEN regexp_extract(p, '^stanzas\\[[0-9]+\\]\\.metaphor_spans\\[[0-9]+\\]')
            WHEN regexp_matches(p, '^cultural_entities\\[[0-9]+\\]') THEN regexp_extract(p, '^cultural_entities\\[[0-9]+\\]') END AS object_path FROM i2) SELECT issue_id, object_path, term, span FROM i3 JOIN o USING (result_id, object_path)""",
}
