"""Grounding queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import grounding
from ..session import table
from .annotation_sql import ANNOTATIONS, text
from .segments import SRC, TGT, stripped


def found(spark, d):
    return grounding.grounded(table(spark, d, "validation_results"), table(spark, d, "source_records"))


def span_matches(spark, d):
    m = found(spark, d).where("near_status IS NOT NULL")
    return m.select(
        "result_id", "object_path", "line_ref", "ref_status", F.col("near_status").alias("status"), F.col("near_n").alias("occurrence_count"), F.array_join("near_refs", ",").alias("line_refs"),
        F.col("far_status").alias("whole_status"), F.array_join("far_refs", ",").alias("whole_refs"),
    )


def grounding_issues(spark, d):
    return grounding.issues(found(spark, d))


def strict_grounding_issues(spark, d):
    return grounding.issues(found(spark, d), strict=True)


def grounding_severity(spark, d):
    return grounding_issues(spark, d).groupBy("severity", "code").agg(F.count("*").alias("n"), F.count("corrected_line_ref").alias("n_correctable"))


QUERIES = {f.__name__: f for f in (span_matches, grounding_issues, strict_grounding_issues, grounding_severity)}


def over(t: str, s: str) -> str:
    """Overlapping occurrences of s in t."""
    return f"CASE WHEN contains({t}, {s}) THEN len(list_filter(generate_series(1, length({t}) - length({s}) + 1), lambda i: substring({t}, i, length({s})) = {s})) ELSE 0 END"


F_ = lambda n, s=None: text("o", n, s)
BASE = f"""WITH {ANNOTATIONS}, {SRC}, {TGT},
nl AS (SELECT poem_id, max(line_number) AS n FROM li GROUP BY ALL),
ob0 AS (SELECT result_id, poem_id, object_path, {F_('line_ref')} AS line_ref, {F_('source_span_original')} AS span, {F_('source_span_translation')} AS tspan, {F_('preserved', 'pr')} AS preserved, {F_('translation_status')} AS tstatus FROM ce
    UNION ALL SELECT result_id, poem_id, object_path, {F_('line_ref')}, {F_('source_span_original')}, {F_('source_span_translation')}, NULL, NULL FROM ms),
ob1 AS (SELECT ob0.*, coalesce(n, 0) AS n, {stripped('line_ref')} AS r FROM ob0 JOIN source_records USING (poem_id) LEFT JOIN nl USING (poem_id)),
ob2 AS (SELECT *, try_cast(regexp_extract(r, '^L([0-9]+)', 1) AS int) AS a, coalesce(try_cast(regexp_extract(r, '-L([0-9]+)$', 1) AS int), try_cast(regexp_extract(r, '^L([0-9]+)', 1) AS int)) AS b,
    regexp_full_match(r, 'L[1-9][0-9]{{0,8}}(-L[1-9][0-9]{{0,8}})?') AS ok FROM ob1),
ob AS (SELECT result_id, poem_id, object_path, line_ref, span, tspan, preserved, tstatus, a, b, CASE WHEN line_ref IS NULL THEN 'absent' WHEN NOT ok OR a > b THEN 'malformed' WHEN b > n THEN 'out_of_range' ELSE 'valid' END AS ref_status FROM ob2),
hit AS (SELECT result_id, object_path, line_number, ref_status <> 'valid' OR line_number BETWEEN a AND b AS near, {over('line_text', 'span')} AS c, {over('nfc_normalize(line_text)', 'nfc_normalize(span)')} AS k
    FROM ob JOIN li USING (poem_id) WHERE span <> ''),
sc AS (SELECT result_id, object_path, sum(c) FILTER (WHERE near) AS c, sum(k) FILTER (WHERE near) AS k, sum(c) AS wc, sum(k) AS wk,
    string_agg('L' || line_number, ',' ORDER BY line_number) FILTER (WHERE near AND c > 0) AS cr, string_agg('L' || line_number, ',' ORDER BY line_number) FILTER (WHERE near AND k > 0) AS kr,
    string_agg('L' || line_number, ',' ORDER BY line_number) FILTER (WHERE c > 0) AS wcr, string_agg('L' || line_number, ',' ORDER BY line_number) FILTER (WHERE k > 0) AS wkr,
    count_if(c > 0) AS wcn, count_if(k > 0) AS wkn FROM hit GROUP BY ALL),
sm0 AS (SELECT ob.*, CASE WHEN coalesce(c, 0) = 1 THEN 'exact' WHEN c > 1 THEN 'ambiguous' WHEN k = 1 THEN 'nfc_equivalent' WHEN k > 1 THEN 'ambiguous' ELSE 'not_found' END AS status,
    CASE WHEN c > 0 THEN c ELSE coalesce(k, 0) END AS occurrence_count, coalesce(CASE WHEN c > 0 THEN cr ELSE kr END, '') AS line_refs,
    CASE WHEN coalesce(wc, 0) = 1 THEN 'exact' WHEN wc > 1 THEN 'ambiguous' WHEN wk = 1 THEN 'nfc_equivalent' WHEN wk > 1 THEN 'ambiguous' ELSE 'not_found' END AS ws,
    coalesce(CASE WHEN wc > 0 THEN wcr ELSE wkr END, '') AS wr, CASE WHEN wc > 0 THEN wcn ELSE coalesce(wkn, 0) END AS wn FROM ob LEFT JOIN sc USING (result_id, object_path) WHERE span <> ''),
sm AS (SELECT *, CASE WHEN status = 'not_found' AND ref_status = 'valid' THEN ws END AS whole_status, CASE WHEN status = 'not_found' AND ref_status = 'valid' THEN wr END AS whole_refs FROM sm0),
th AS (SELECT result_id, object_path, sum({over('line_text', 'tspan')}) AS c, sum({over('nfc_normalize(line_text)', 'nfc_normalize(tspan)')}) AS k FROM ob JOIN ti USING (poem_id) WHERE tspan <> '' GROUP BY ALL),
tm AS (SELECT ob.result_id, ob.object_path, CASE WHEN c = 1 THEN 'exact' WHEN c > 1 THEN 'ambiguous' WHEN k = 1 THEN 'nfc_equivalent' WHEN k > 1 THEN 'ambiguous' ELSE 'not_found' END AS status FROM ob LEFT JOIN th USING (result_id, object_path) WHERE tspan <> '')"""


def issue_sql(strict: bool) -> str:
    late = f"'{'error' if strict else 'review'}'"
    more = "".join(f" UNION ALL SELECT result_id, object_path, '{f}', 'required_field_missing', 'error', NULL FROM ob WHERE coalesce({c}, '') = ''" for f, c in (("source_span_original", "span"), ("line_ref", "line_ref"))) if strict else ""
    return f"""SELECT result_id, object_path, 'line_ref' AS field, 'line_ref_invalid' AS code, 'error' AS severity, NULL::varchar AS corrected_line_ref FROM ob WHERE ref_status IN ('malformed', 'out_of_range')
    UNION ALL SELECT result_id, object_path, 'line_ref', 'line_ref_span_mismatch', 'error', CASE WHEN whole_status IN ('exact', 'nfc_equivalent') AND wn = 1 THEN whole_refs END FROM sm WHERE status = 'not_found' AND whole_status <> 'not_found'
    UNION ALL SELECT result_id, object_path, 'source_span_original', 'span_not_found', 'error', NULL FROM sm WHERE status = 'not_found' AND coalesce(whole_status, 'not_found') = 'not_found'
    UNION ALL SELECT result_id, object_path, 'source_span_original', 'span_ambiguous', 'review', NULL FROM sm WHERE status = 'ambiguous'
    UNION ALL SELECT result_id, object_path, 'source_span_translation', 'translation_span_not_found', 'error', NULL FROM tm WHERE status = 'not_found'
    UNION ALL SELECT result_id, object_path, 'source_span_translation', 'translation_span_ambiguous', 'review', NULL FROM tm WHERE status = 'ambiguous'
    UNION ALL SELECT o.result_id, o.object_path, 'source_span_translation', 'translation_evidence_missing', {late}, NULL FROM ob o LEFT JOIN tm ON tm.result_id = o.result_id AND tm.object_path = o.object_path AND tm.status <> 'not_found'
        WHERE (preserved = 'true' OR lower({stripped('tstatus')}) = 'preserved') AND coalesce(lower({stripped('tstatus')}), '') NOT IN ('lost', 'omitted', 'not_translated', 'untranslated') AND tm.result_id IS NULL{more}"""


SQL = {
    "span_matches": f"{BASE} SELECT result_id, object_path, line_ref, ref_status, status, occurrence_count, line_refs, whole_status, whole_refs FROM sm",
    "grounding_issues": f"{BASE} {issue_sql(False)}",
    "strict_grounding_issues": f"{BASE} {issue_sql(True)}",
    "grounding_severity": f"{BASE} SELECT severity, code, count(*) AS n, count(corrected_line_ref) AS n_correctable FROM ({issue_sql(False)}) GROUP BY ALL",
}
