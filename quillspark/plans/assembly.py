"""Assembly queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..functions.text import WS
from ..operators import annotation, assembly, grounding, ledger, nested, planning
from ..session import table
from .annotation import REQ, f
from .annotation_sql import ANNOTATIONS
from .corpus import CKPT
from .grounding import BASE, issue_sql
from .planning import PATHS
from .segments import SRC, TGT, stripped

SPAN_FIELDS = ["vehicle", "tenor", "literal_meaning", "visualization_difficulty", "line_ref", "source_span_original"]


def bridge(spark, d):
    return nested.occurrences(table(spark, d, "validation_results"), "result_id", "normalized_annotation")


def derived_invalid_paths(spark, d):
    r, p = table(spark, d, "validation_results"), table(spark, d, "source_records")
    b = bridge(spark, d)
    return assembly.invalid_paths(b, grounding.issues(grounding.grounded(r, p)))


def field_presence(spark, d):
    o = annotation.every_object(bridge(spark, d)).where("kind IN ('metaphor_span', 'cultural_entity')")
    return assembly.presence(o, SPAN_FIELDS + ["gloss", "romanization", "translation_note"])


def unknown_keys(spark, d):
    return assembly.unknown_keys(bridge(spark, d))


def term_gate(spark, d):
    o = annotation.every_object(bridge(spark, d)).where("kind IN ('metaphor_span', 'cultural_entity')")
    return assembly.term_gate(o, table(spark, d, "source_records"), table(spark, d, "validation_results"))


def glossary_coverage(spark, d):
    """Distinct entity terms per language and category of their glossary entry (a dimension join)."""
    lang = table(spark, d, "validation_results").select("result_id", "poem_id").join(table(spark, d, "source_records").select("poem_id", F.lower(F.trim("language")).alias("language")), "poem_id")
    e = annotation.objects(bridge(spark, d), "cultural_entity").where("term IS NOT NULL").join(lang, "result_id").select("language", "term").distinct()
    g = table(spark, d, "glossary").groupBy(F.lower("language").alias("language"), "term").agg(F.min("gloss").alias("gloss"))
    return e.join(g, ["language", "term"], "left").groupBy("language").agg(F.count("*").alias("n_terms"), F.count("gloss").alias("n_known"))


def merged_sections(spark, d):
    return assembly.merged_sections(table(spark, d, "provider_calls"))


def prompt_plan(spark, d):
    return assembly.prompts(table(spark, d, "source_records"))


def field_breakdown(spark, d):
    p = table(spark, d, "invalid_path_issues").where("trim(field_path) <> ''").select("result_id", planning.plain_path(F.col("field_path")).alias("path"))
    size = p.groupBy("result_id").agg(F.count_distinct("path").alias("n"))
    k = F.when(F.col("n") <= vocab.SMALL_PLAN, "small").when(F.col("n") <= vocab.MEDIUM_PLAN, "medium").otherwise("large")
    return p.join(size, "result_id").groupBy(planning.leaf(F.col("path")).alias("leaf"), k.alias("size_class")).agg(F.count("*").alias("n_paths"), F.count_distinct("result_id").alias("n_results"))


def relevant_stanzas(spark, d):
    """Stanzas the issues of a result touch; the first one where they name none."""
    p = table(spark, d, "invalid_path_issues").where("trim(field_path) <> ''").select("result_id", planning.plain_path(F.col("field_path")).alias("path"))
    n = F.regexp_extract("path", r"^stanzas\[([0-9]+)\]", 1).try_cast("int")
    g = p.groupBy("result_id").agg(F.array_sort(F.collect_set(n)).alias("s"))
    return g.select("result_id", F.array_join(F.when(F.size("s") > 0, F.col("s")).otherwise(F.array(F.lit(0))).cast("array<string>"), ",").alias("stanzas"))


def safe_messages(spark, d):
    m = ledger.safe_message(F.col("message"))
    return table(spark, d, "failures").groupBy("classification", m.alias("message")).agg(F.count("*").alias("n"), F.min("failed_at").alias("first_at"))


def poem_states(spark, d):
    """One row per poem: calls, failures, last checkpoint and last validation."""
    calls = table(spark, d, "provider_calls").groupBy("poem_id").agg(F.count_distinct("response_id").alias("n_responses"))
    fails = table(spark, d, "failures").distinct().groupBy("poem_id").agg(F.count("*").alias("n_failures"), F.max("failed_at").alias("last_failure"))
    done = ledger.latest(table(spark, d, "checkpoints"), ["poem_id"], ["recorded_at", "completed_at", "candidate_sha256", "repair_count"]).select("poem_id", "completed_at", "stop_gate_result")
    val = ledger.latest(table(spark, d, "validation_results").select("poem_id", "attempt_no", "result_id", "grounding_valid"), ["poem_id"], ["attempt_no", "result_id"]).select("poem_id", "attempt_no", "grounding_valid")
    x = table(spark, d, "source_records").select("poem_id").join(calls, "poem_id", "left").join(fails, "poem_id", "left").join(done, "poem_id", "left").join(val, "poem_id", "left")
    state = F.when(F.col("completed_at").isNotNull() & (F.coalesce("last_failure", "completed_at") <= F.col("completed_at")), "completed").when(F.col("completed_at").isNotNull(), "completed_then_failed").when(F.col("n_failures") > 0, "failed").otherwise("open")
    return x.select("poem_id", F.coalesce("n_responses", F.lit(0)).alias("n_responses"), F.coalesce("n_failures", F.lit(0)).alias("n_failures"), "attempt_no", "grounding_valid", "stop_gate_result", state.alias("state"))


def token_running_share(spark, d):
    return assembly.running_share(table(spark, d, "provider_calls"), "poem_id", "total_token_count")


QUERIES = {g.__name__: g for g in (
    derived_invalid_paths, field_presence, unknown_keys, term_gate, glossary_coverage, merged_sections, prompt_plan, field_breakdown, relevant_stanzas,
    safe_messages, poem_states, token_running_share,
)}

LEAF = r"regexp_extract(path, '([^.\[\]]*)(\[[0-9]*\])*$', 1)"
BAD = f"{f('translation_quality', 'tq')} = 'faithful' AND coalesce({f('loss_note', 'ln')}, '') <> ''"
VAL = lambda t, n, s=None: f"SELECT '{'metaphor_span' if t == 'ms' else 'cultural_entity'}' AS kind, '{n}' AS field, {f(n, s)} AS v FROM {t}"
FIELDS = [(n, None) for n in SPAN_FIELDS] + [("gloss", None), ("romanization", "rm"), ("translation_note", "tn")]
KNOWN = {t: [x.split(" ")[0].strip("`") for x in annotation.FIELDS[k].split(", ")] for t, k in (("ann", "annotation"), ("st", "stanza"), ("ce", "cultural_entity"), ("ms", "metaphor_span"), ("tl", "translation_loss"), ("mm", "metaphor_mapping"))}
LISTS = ["metaphor_mapping", "stanzas", "cultural_entities", "metaphor_spans", "translation_loss"]
PK = lambda x: stripped(f"regexp_replace(lower({x}), '{WS}+', ' ', 'g')")


def unknown(t: str, kind: str) -> str:
    path = "'$'" if t == "ann" else "object_path"
    short = nested.COMPACT[kind]
    allowed = ", ".join(f"'{k}'" for k in KNOWN[t] + LISTS + list(short))
    return f"SELECT result_id, object_path, key FROM (SELECT result_id, {path} AS object_path, unnest(json_keys(o)) AS key FROM {t}) WHERE key NOT IN ({allowed})"


SQL = {
    "derived_invalid_paths": f"""{BASE}, ev AS (SELECT result_id, object_path || '.loss_note' AS field_path, 'faithful_with_loss_note' AS rule, 1 AS family FROM st WHERE {BAD}
        UNION ALL SELECT result_id, object_path || '.translation_quality', 'faithful_with_loss_note', 1 FROM st WHERE {BAD}
        UNION ALL SELECT *, 2 FROM ({' UNION ALL '.join(REQ)}) UNION ALL SELECT result_id, object_path || '.' || field, code, 3 FROM ({issue_sql(False)}) WHERE severity = 'error')
        SELECT result_id, field_path, rule FROM (SELECT *, row_number() OVER (PARTITION BY result_id, field_path ORDER BY family, rule) AS k FROM ev) WHERE k = 1""",
    "field_presence": f"WITH {ANNOTATIONS}, v AS (" + " UNION ALL ".join(VAL(t, n, s if t == "ce" else None) for t in ("ms", "ce") for n, s in FIELDS) + """)
        SELECT kind, field, count_if(v IS NOT NULL AND trim(v, ' ') NOT IN ('', '[]')) AS populated, count_if(v IS NOT NULL AND trim(v, ' ') IN ('', '[]')) AS empty, count_if(v IS NULL) AS missing FROM v GROUP BY ALL""",
    "unknown_keys": f"WITH {ANNOTATIONS} " + " UNION ALL ".join(unknown(t, k) for t, k in (("ann", "annotation"), ("st", "stanza"), ("ce", "cultural_entity"), ("ms", "metaphor_span"), ("tl", "translation_loss"), ("mm", "metaphor_mapping"))),
    "term_gate": f"""WITH {ANNOTATIONS}, t AS (SELECT result_id, poem_id, object_path, {f('term', 'tm')} AS term FROM ce UNION ALL SELECT result_id, poem_id, object_path, {f('source_term', 'src')} FROM ms),
        k AS (SELECT result_id, object_path, term, {PK('term')} AS a, {stripped("regexp_replace(" + PK('term') + ", '[(][\\x00-\\x7f]*[)]$', '')")} AS b, {PK('original_poem')} AS x FROM t JOIN source_records USING (poem_id) WHERE trim(term, ' ') <> '')
        SELECT result_id, object_path, term, coalesce((a <> '' AND (contains(x, a) OR contains(replace(x, ' ', ''), replace(a, ' ', '')))) OR (b <> '' AND (contains(x, b) OR contains(replace(x, ' ', ''), replace(b, ' ', '')))), false) AS present FROM k""",
    "glossary_coverage": f"""WITH {ANNOTATIONS}, e AS (SELECT DISTINCT lower(trim(language, ' ')) AS language, {f('term', 'tm')} AS term FROM ce JOIN source_records USING (poem_id) WHERE {f('term', 'tm')} IS NOT NULL),
        g AS (SELECT lower(language) AS language, term, min(gloss) AS gloss FROM glossary GROUP BY ALL) SELECT e.language, count(*) AS n_terms, count(gloss) AS n_known FROM e LEFT JOIN g ON e.language = g.language AND e.term = g.term GROUP BY e.language""",
    "merged_sections": """WITH s AS (SELECT poem_id, section_name, CASE WHEN text IS NULL OR trim(text, ' ') = '' OR NOT json_valid(text) THEN 'unreadable' WHEN json_type(CASE WHEN json_valid(text) THEN text END) <> 'OBJECT' THEN 'unreadable' WHEN finish_reason = 'STOP' THEN 'complete' ELSE 'cut' END AS state,
        row_number() OVER (PARTITION BY poem_id, section_name ORDER BY requested_at DESC NULLS LAST, received_at DESC NULLS LAST, response_id DESC NULLS LAST) AS k FROM provider_calls WHERE section_name IN ('overview', 'entities', 'figurative', 'loss')),
        w AS (SELECT poem_id, coalesce(max(state) FILTER (WHERE section_name = 'overview'), 'absent') AS overview, coalesce(max(state) FILTER (WHERE section_name = 'entities'), 'absent') AS entities,
        coalesce(max(state) FILTER (WHERE section_name = 'figurative'), 'absent') AS figurative, coalesce(max(state) FILTER (WHERE section_name = 'loss'), 'absent') AS loss FROM s WHERE k = 1 GROUP BY poem_id)
        SELECT *, overview = 'complete' AND entities = 'complete' AND figurative = 'complete' AND loss = 'complete' AS complete FROM w""",
    "prompt_plan": f"""WITH {SRC}, {TGT}, a AS (SELECT poem_id, string_agg('L' || line_number || ': ' || line_text, chr(10) ORDER BY line_number) AS x, max(stanza_index) AS s FROM li GROUP BY poem_id),
        b AS (SELECT poem_id, string_agg('T' || line_number || ': ' || line_text, chr(10) ORDER BY line_number) AS x FROM ti GROUP BY poem_id),
        p AS (SELECT p.poem_id, 'Title: ' || coalesce(poem_title, '-') || chr(10) || chr(10) || CASE WHEN original_poem IS NULL THEN '(no lines)' ELSE coalesce(a.x, '(no lines)') END || chr(10) || chr(10) || coalesce(b.x, '(no lines)') AS t, coalesce(a.s, 0) AS s
            FROM source_records p LEFT JOIN a USING (poem_id) LEFT JOIN b USING (poem_id))
        SELECT poem_id, sha256(t) AS prompt_sha256, length(t) // 4 + CASE length(t) % 4 WHEN 3 THEN 1 WHEN 2 THEN (length(t) // 4) % 2 ELSE 0 END AS n_tokens, least(2048, 1536 + 300 * greatest(s - 1, 0)) AS answer_tokens FROM p""",
    "field_breakdown": f"""WITH {PATHS}, s AS (SELECT result_id, count(DISTINCT path) AS n FROM ip GROUP BY ALL)
        SELECT {LEAF} AS leaf, CASE WHEN n <= 20 THEN 'small' WHEN n <= 79 THEN 'medium' ELSE 'large' END AS size_class, count(*) AS n_paths, count(DISTINCT result_id) AS n_results FROM ip JOIN s USING (result_id) GROUP BY ALL""",
    "relevant_stanzas": rf"""WITH {PATHS}, s AS (SELECT result_id, list_sort(list(DISTINCT try_cast(regexp_extract(path, '^stanzas\[([0-9]+)\]', 1) AS int)) FILTER (WHERE regexp_matches(path, '^stanzas\[[0-9]+\]'))) AS s FROM ip GROUP BY result_id)
        SELECT result_id, CASE WHEN len(s) > 0 THEN array_to_string(s, ',') ELSE '0' END AS stanzas FROM s""",
    "safe_messages": """SELECT classification, CASE WHEN regexp_matches(lower(message), 'begin private key|service_account|refresh_token|authorization:|bearer ') THEN '[redacted]' ELSE substring(message, 1, 500) END AS message, count(*) AS n, min(failed_at) AS first_at FROM failures GROUP BY ALL""",
    "poem_states": f"""WITH c AS (SELECT poem_id, count(DISTINCT response_id) AS n_responses FROM provider_calls GROUP BY ALL), x AS (SELECT poem_id, count(*) AS n_failures, max(failed_at) AS last_failure FROM (SELECT DISTINCT * FROM failures) GROUP BY ALL),
        k AS ({CKPT}), v AS (SELECT poem_id, attempt_no, grounding_valid FROM (SELECT *, row_number() OVER (PARTITION BY poem_id ORDER BY attempt_no DESC, result_id DESC) AS k FROM validation_results) WHERE k = 1)
        SELECT p.poem_id, coalesce(n_responses, 0) AS n_responses, coalesce(n_failures, 0) AS n_failures, attempt_no, grounding_valid, stop_gate_result,
        CASE WHEN completed_at IS NOT NULL AND coalesce(last_failure, completed_at) <= completed_at THEN 'completed' WHEN completed_at IS NOT NULL THEN 'completed_then_failed' WHEN n_failures > 0 THEN 'failed' ELSE 'open' END AS state
        FROM source_records p LEFT JOIN c USING (poem_id) LEFT JOIN x USING (poem_id) LEFT JOIN k USING (poem_id) LEFT JOIN v USING (poem_id)""",
    "token_running_share": """WITH t AS (SELECT poem_id, sum(coalesce(total_token_count, 0)) AS total FROM provider_calls GROUP BY ALL) SELECT poem_id, total, row_number() OVER (ORDER BY total DESC, poem_id) AS rank,
        round(sum(total) OVER (ORDER BY total DESC, poem_id ROWS UNBOUNDED PRECEDING) / sum(total) OVER (), 6) AS running_share FROM t""",
}
