"""Corpus and ledger queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import WS
from ..operators import corpus, ledger
from ..session import table
from .segments import stripped


def t(name):
    return lambda spark, d: table(spark, d, name)


poems, assigned, done, failed, calls, manifest, results = map(t, ("source_records", "assignments", "checkpoints", "failures", "provider_calls", "release_manifest", "validation_results"))
CALL_ORDER = ["requested_at", "received_at", "poem_id", "section_name"]


def routed_records(spark, d):
    r = corpus.route(poems(spark, d), "language", manifest(spark, d).select("language"), ["poem_title", "original_poem", "translated_poem"])
    return r.select("poem_id", "route")


def route_counts(spark, d):
    return routed_records(spark, d).groupBy("route").agg(F.count("*").alias("n"))


def canonical_ids(spark, d):
    r = corpus.route(poems(spark, d), "language", manifest(spark, d).select("language"), ["poem_title", "original_poem", "translated_poem"]).where("route = 'canonical'")
    n = corpus.exact_numbers(r.select("poem_id"), [], "poem_id", "n")
    return n.select("poem_id", F.format_string("C_%07d", F.col("n").cast("long")).alias("canonical_id"))


def language_inventory(spark, d):
    return corpus.inventory(poems(spark, d), corpus.folded(F.col("language")), "poem_id", "original_poem", "translated_poem")


def inventory_zero_filled(spark, d):
    m = manifest(spark, d).select(F.lower("language").alias("language")).distinct()
    return m.join(language_inventory(spark, d), "language", "left").select("language", F.coalesce("n_records", F.lit(0)).alias("n_records"), F.coalesce("source_chars", F.lit(0)).alias("source_chars"))


def inventory_rollup(spark, d):
    p = poems(spark, d).join(assigned(spark, d).groupBy("poem_id").agg(F.min("assignee").alias("assignee")), "poem_id", "left")
    return p.rollup(corpus.folded(F.col("language")).alias("language"), "assignee").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


def duplicate_titles(spark, d):
    return corpus.duplicates(poems(spark, d).where("poem_title IS NOT NULL"), [corpus.folded(F.col("language")).alias("language"), F.col("poem_title")], "poem_id")


def duplicate_texts(spark, d):
    return corpus.duplicates(poems(spark, d).where("trim(original_poem) <> ''"), [F.md5("original_poem").alias("text_md5")], "poem_id")


def record_hashes(spark, d):
    return corpus.text_hashes(poems(spark, d), "poem_id", ["original_poem", "translated_poem"])


def hash_mismatches(spark, d):
    h = corpus.text_hashes(poems(spark, d), "poem_id", ["original_poem", "translated_poem"])
    c = done(spark, d).select("poem_id", "source_hash", "translation_hash").distinct()
    j = c.join(h, "poem_id")
    return j.where("source_hash <> original_poem_sha256 OR translation_hash <> translated_poem_sha256").select(
        "poem_id", (F.col("source_hash") == F.col("original_poem_sha256")).alias("source_same"), (F.col("translation_hash") == F.col("translated_poem_sha256")).alias("translation_same"))


def dealt_records(spark, d):
    open_ = ledger.resume(poems(spark, d).select("poem_id", "language"), done(spark, d), "poem_id")
    return corpus.deal(open_, F.coalesce(corpus.folded(F.col("language")), F.lit("")), "poem_id", 3).select("poem_id", "worker")


def deal_sizes(spark, d):
    return dealt_records(spark, d).groupBy("worker").agg(F.count("*").alias("n"))


def double_assignments(spark, d):
    return assigned(spark, d).groupBy("poem_id").agg(F.count("*").alias("n"), F.min("assignee").alias("first_assignee"), F.count_distinct("assignee").alias("n_assignees")).where("n > 1")


def assignment_load(spark, d):
    a = assigned(spark, d).groupBy("assignee").agg(F.count("*").alias("n_rows"), F.count_distinct("poem_id").alias("n_poems"))
    total = a.agg(F.sum("n_rows").alias("total"))
    return a.crossJoin(total).select("assignee", "n_rows", "n_poems", F.round(F.col("n_rows") / F.col("total"), 6).alias("share"))


def unassigned_records(spark, d):
    return poems(spark, d).join(assigned(spark, d), "poem_id", "left_anti").select("poem_id")


def outputs_without_source(spark, d):
    return done(spark, d).select("poem_id").distinct().join(poems(spark, d), "poem_id", "left_anti")


def language_disagreements(spark, d):
    a = assigned(spark, d).select("poem_id", F.col("language").alias("assigned_language")).distinct()
    j = poems(spark, d).select("poem_id", "language").join(a, "poem_id")
    return j.where(~corpus.folded(F.col("language")).eqNullSafe(corpus.folded(F.col("assigned_language"))))


def resume_targets(spark, d):
    return ledger.resume(assigned(spark, d).select("poem_id", "assignee"), done(spark, d), "poem_id")


def retry_targets(spark, d):
    return ledger.retry(assigned(spark, d).select("poem_id", "assignee"), failed(spark, d), done(spark, d), "poem_id")


def latest_checkpoints(spark, d):
    c = ledger.latest(done(spark, d), ["poem_id"], ["recorded_at", "completed_at", "candidate_sha256", "repair_count"])
    return c.select("poem_id", "recorded_at", "completed_at", "section_attempts", "repair_count", "stop_gate_result")


def late_checkpoints(spark, d):
    c = done(spark, d).distinct()
    days = F.floor(F.expr("timestampdiff(SECOND, completed_at, recorded_at)") / 86400)
    return c.groupBy(days.alias("days_late")).agg(F.count("*").alias("n"), F.count_if(F.col("model").isNull()).alias("n_without_model"))


def failure_classes(spark, d):
    f = failed(spark, d).distinct().join(done(spark, d).select("poem_id").distinct().withColumn("completed", F.lit(True)), "poem_id", "left")
    return f.groupBy("classification").agg(F.count("*").alias("n"), F.count_distinct("poem_id").alias("n_poems"), F.count("completed").alias("n_completed_too"), F.count_if(F.col("message").isNull()).alias("n_silent"))


def latest_validations(spark, d):
    v = ledger.latest(results(spark, d).select("poem_id", "result_id", "attempt_no", "schema_valid", "candidate_complete"), ["poem_id"], ["attempt_no", "result_id"])
    return v


def gate_classes(spark, d):
    c = lambda n: F.coalesce(F.col(n), F.lit(False))
    first = (
        F.when(~c("schema_valid"), "schema").when(~c("candidate_complete"), "completeness").when(~c("controlled_vocab_valid"), "vocabulary")
        .when(~c("grounding_valid"), "grounding").when(~c("romanization_consistent"), "romanization").otherwise("pass")
    )
    return results(spark, d).groupBy(first.alias("first_failure"), "attempt_no").agg(F.count("*").alias("n"))


def violation_counts(spark, d):
    v = results(spark, d).select("result_id", F.inline("completeness_violations"))
    return v.groupBy("rule", F.regexp_extract("field_path", r"([a-z_]+)(\[[0-9]+\])?$", 1).alias("leaf")).agg(F.count("*").alias("n"), F.count_distinct("result_id").alias("n_results"))


def grounding_issue_counts(spark, d):
    g = results(spark, d).select("result_id", F.inline("grounding_issues"))
    return g.groupBy("code").agg(F.count("*").alias("n"), F.count("corrected_line_ref").alias("n_correctable"))


def once(spark, d, *cols):
    """Calls without redeliveries. Only what the order and the caller need is read and shuffled, not the answers' text."""
    need = list(dict.fromkeys(["response_id", *CALL_ORDER, *cols]))
    return ledger.once(calls(spark, d).select(*need), "response_id", CALL_ORDER).select(*cols)


def unique_calls(spark, d):
    return once(spark, d, "poem_id", "section_name", "response_id", "finish_reason", "requested_at", "received_at", "total_token_count")


def completion_classes(spark, d):
    c = once(spark, d, "section_name", "response_id", "finish_reason", "candidates_token_count", "total_token_count")
    k = ledger.completion_class(F.col("finish_reason"), F.col("response_id").isNotNull())
    return c.groupBy("section_name", k.alias("completion")).agg(F.count("*").alias("n"), F.sum("candidates_token_count").alias("output_tokens"), F.count_if(F.col("total_token_count").isNull()).alias("n_uncounted"))


def response_parse_classes(spark, d):
    return calls(spark, d).groupBy("finish_reason", ledger.parse_class(F.col("text")).alias("parsed")).agg(F.count("*").alias("n"))


def token_utilisation(spark, d):
    c = once(spark, d, "section_name", "prompt_token_count", "candidates_token_count", "total_token_count", "cached_content_token_count")
    return c.groupBy("section_name").agg(
        F.round(F.avg(F.col("candidates_token_count") / 8192), 6).alias("mean_use"), F.max("candidates_token_count").alias("most"),
        F.round(F.sum(F.coalesce("cached_content_token_count", F.lit(0))) / F.sum("prompt_token_count"), 6).alias("cached_share"),
        F.count_if(F.col("prompt_token_count") + F.col("candidates_token_count") != F.col("total_token_count")).alias("n_inconsistent"),
    )


def call_latency(spark, d):
    s = F.expr("timestampdiff(MICROSECOND, requested_at, received_at)") / 1e6
    return calls(spark, d).where("received_at IS NOT NULL").groupBy("section_name").agg(F.count("*").alias("n"), F.round(F.avg(s), 4).alias("mean_s"), F.round(F.max(s), 4).alias("max_s"), F.round(F.expr("percentile(timestampdiff(MICROSECOND, requested_at, received_at) / 1e6, 0.5)"), 4).alias("median_s"))


def calls_per_poem(spark, d):
    """Poems by load: one poem holds about a tenth of the rows, so counts are pre-aggregated before the shuffle."""
    c = once(spark, d, "poem_id", "section_name", "total_token_count", "requested_at", "received_at")
    return c.groupBy("poem_id").agg(F.count("*").alias("n_calls"), F.count_distinct("section_name").alias("n_sections"), F.sum("total_token_count").alias("tokens"), F.min("requested_at").alias("first_call"), F.max("received_at").alias("last_answer"))


def hourly_calls(spark, d):
    return calls(spark, d).groupBy(F.date_trunc("hour", "requested_at").alias("hour")).agg(F.count("*").alias("n"), F.sum("total_token_count").alias("tokens"))


def call_checkpoint_asof(spark, d):
    """Each checkpoint with its poem's last answer at or before it (as-of join by max over the matches). The calls are the
    left side of an inner join, where a hot poem can be split, and are summed up to one row a checkpoint before checkpoints
    without calls come back in."""
    c = once(spark, d, "poem_id", "received_at").where("received_at IS NOT NULL")
    k = latest_checkpoints(spark, d).select("poem_id", "completed_at")
    j = c.join(k, "poem_id").groupBy("poem_id").agg(
        F.max(F.when(F.col("received_at") <= F.col("completed_at"), F.col("received_at"))).alias("last_answer"), F.count_if(F.col("received_at") > F.col("completed_at")).alias("n_later"))
    return k.join(j, "poem_id", "left").select("poem_id", "completed_at", "last_answer", F.coalesce("n_later", F.lit(0)).alias("n_later"))


QUERIES = {f.__name__: f for f in (
    routed_records, route_counts, canonical_ids, language_inventory, inventory_zero_filled, inventory_rollup, duplicate_titles, duplicate_texts,
    record_hashes, hash_mismatches, dealt_records, deal_sizes, double_assignments, assignment_load, unassigned_records, outputs_without_source,
    language_disagreements, resume_targets, retry_targets, latest_checkpoints, late_checkpoints, failure_classes, latest_validations, gate_classes,
    violation_counts, grounding_issue_counts, unique_calls, completion_classes, response_parse_classes, token_utilisation, call_latency,
    calls_per_poem, hourly_calls, call_checkpoint_asof,
)}

LANG = f"lower({stripped('language')})"
EMPTY = lambda c: f"({c} IS NULL OR regexp_full_match({c}, '{WS}*'))"
ROUTE = f"""SELECT p.*, CASE WHEN {EMPTY('poem_title')} AND {EMPTY('original_poem')} AND {EMPTY('translated_poem')} THEN 'blank'
    WHEN {EMPTY('p.language')} THEN 'trailing' WHEN m.l IS NULL THEN 'anomalous' ELSE 'canonical' END AS route
    FROM source_records p LEFT JOIN (SELECT DISTINCT {LANG} AS l FROM release_manifest) m ON m.l = lower({stripped('p.language')})"""
INV = f"""SELECT {LANG} AS language, count(*) AS n_records, count(DISTINCT poem_id) AS n_ids, count_if({EMPTY('original_poem')}) AS n_empty_source,
    count_if({EMPTY('translated_poem')}) AS n_missing_translation, sum(length(regexp_replace(coalesce(original_poem, ''), '\\r\\n?', chr(10), 'g'))) AS source_chars
    FROM source_records GROUP BY ALL"""
HASH = """SELECT poem_id, sha256(coalesce(original_poem, '')) AS original_poem_sha256, sha256(coalesce(translated_poem, '')) AS translated_poem_sha256,
    sha256(coalesce(original_poem, '') || chr(0) || coalesce(translated_poem, '')) AS record_sha256 FROM source_records"""
DEAL = f"""SELECT poem_id, ((row_number() OVER (ORDER BY coalesce({LANG}, ''), poem_id) - 1) % 3)::int AS worker
    FROM source_records WHERE poem_id NOT IN (SELECT poem_id FROM checkpoints)"""
ONCE = """(SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY response_id ORDER BY requested_at, received_at, poem_id, section_name) AS k
    FROM provider_calls WHERE response_id IS NOT NULL) WHERE k = 1 UNION ALL SELECT * FROM provider_calls WHERE response_id IS NULL)"""
CLASS = """CASE WHEN response_id IS NULL THEN 'provider_error' WHEN finish_reason IS NULL THEN 'malformed_or_unknown' WHEN upper(finish_reason) = 'STOP' THEN 'completed'
    WHEN upper(finish_reason) = 'MAX_TOKENS' THEN 'max_tokens' WHEN upper(finish_reason) IN ('SAFETY', 'RECITATION', 'BLOCKLIST', 'PROHIBITED_CONTENT', 'SPII') THEN 'safety'
    ELSE 'malformed_or_unknown' END"""
CKPT = """SELECT poem_id, recorded_at, completed_at, section_attempts, repair_count, stop_gate_result FROM (SELECT *, row_number() OVER
    (PARTITION BY poem_id ORDER BY recorded_at DESC, completed_at DESC, candidate_sha256 DESC, repair_count DESC) AS k FROM checkpoints) WHERE k = 1"""
SQL = {
    "routed_records": f"SELECT poem_id, route FROM ({ROUTE})",
    "route_counts": f"SELECT route, count(*) AS n FROM ({ROUTE}) GROUP BY route",
    "canonical_ids": f"SELECT poem_id, 'C_' || lpad((row_number() OVER (ORDER BY poem_id))::varchar, 7, '0') AS canonical_id FROM ({ROUTE}) WHERE route = 'canonical'",
    "language_inventory": INV,
    "inventory_zero_filled": f"SELECT m.language, coalesce(n_records, 0) AS n_records, coalesce(source_chars, 0) AS source_chars FROM (SELECT DISTINCT lower(language) AS language FROM release_manifest) m LEFT JOIN ({INV}) i USING (language)",
    "inventory_rollup": f"""SELECT language, assignee, count(*) AS n, grouping_id(language, assignee) AS level FROM (SELECT {LANG.replace('language', 'p.language')} AS language, assignee FROM source_records p
        LEFT JOIN (SELECT poem_id, min(assignee) AS assignee FROM assignments GROUP BY ALL) a USING (poem_id)) GROUP BY ROLLUP (language, assignee)""",
    "duplicate_titles": f"SELECT {LANG} AS language, poem_title, count(*) AS n, min(poem_id) AS first_id, max(poem_id) AS last_id FROM source_records WHERE poem_title IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1",
    "duplicate_texts": "SELECT md5(original_poem) AS text_md5, count(*) AS n, min(poem_id) AS first_id, max(poem_id) AS last_id FROM source_records WHERE trim(original_poem, ' ') <> '' GROUP BY 1 HAVING count(*) > 1",
    "record_hashes": HASH,
    "hash_mismatches": f"""SELECT poem_id, source_hash = original_poem_sha256 AS source_same, translation_hash = translated_poem_sha256 AS translation_same
        FROM (SELECT DISTINCT poem_id, source_hash, translation_hash FROM checkpoints) c JOIN ({HASH}) h USING (poem_id) WHERE source_hash <> original_poem_sha256 OR translation_hash <> translated_poem_sha256""",
    "dealt_records": DEAL,
    "deal_sizes": f"SELECT worker, count(*) AS n FROM ({DEAL}) GROUP BY worker",
    "double_assignments": "SELECT poem_id, count(*) AS n, min(assignee) AS first_assignee, count(DISTINCT assignee) AS n_assignees FROM assignments GROUP BY poem_id HAVING count(*) > 1",
    "assignment_load": "SELECT assignee, count(*) AS n_rows, count(DISTINCT poem_id) AS n_poems, round(count(*) / (SELECT count(*) FROM assignments), 6) AS share FROM assignments GROUP BY assignee",
    "unassigned_records": "SELECT poem_id FROM source_records p WHERE NOT EXISTS (SELECT 1 FROM assignments a WHERE a.poem_id = p.poem_id)",
    "outputs_without_source": "SELECT DISTINCT poem_id FROM checkpoints c WHERE NOT EXISTS (SELECT 1 FROM source_records p WHERE p.poem_id = c.poem_id)",
    "language_disagreements": f"SELECT p.poem_id, p.language, assigned_language FROM source_records p JOIN (SELECT DISTINCT poem_id, language AS assigned_language FROM assignments) a USING (poem_id) WHERE lower({stripped('p.language')}) IS DISTINCT FROM lower({stripped('assigned_language')})",
    "resume_targets": "SELECT poem_id, assignee FROM assignments a WHERE NOT EXISTS (SELECT 1 FROM checkpoints c WHERE c.poem_id = a.poem_id)",
    "retry_targets": "SELECT poem_id, assignee FROM assignments a WHERE EXISTS (SELECT 1 FROM failures f WHERE f.poem_id = a.poem_id) AND NOT EXISTS (SELECT 1 FROM checkpoints c WHERE c.poem_id = a.poem_id)",
    "latest_checkpoints": CKPT,
    "late_checkpoints": "SELECT floor((epoch_us(recorded_at) - epoch_us(completed_at)) // 1000000 / 86400) AS days_late, count(*) AS n, count_if(model IS NULL) AS n_without_model FROM (SELECT DISTINCT * FROM checkpoints) GROUP BY ALL",
    "failure_classes": """SELECT classification, count(*) AS n, count(DISTINCT f.poem_id) AS n_poems, count(c.poem_id) AS n_completed_too, count_if(message IS NULL) AS n_silent
        FROM (SELECT DISTINCT * FROM failures) f LEFT JOIN (SELECT DISTINCT poem_id FROM checkpoints) c USING (poem_id) GROUP BY classification""",
    "latest_validations": "SELECT poem_id, result_id, attempt_no, schema_valid, candidate_complete FROM (SELECT *, row_number() OVER (PARTITION BY poem_id ORDER BY attempt_no DESC, result_id DESC) AS k FROM validation_results) WHERE k = 1",
    "gate_classes": """SELECT CASE WHEN NOT coalesce(schema_valid, false) THEN 'schema' WHEN NOT coalesce(candidate_complete, false) THEN 'completeness' WHEN NOT coalesce(controlled_vocab_valid, false) THEN 'vocabulary'
        WHEN NOT coalesce(grounding_valid, false) THEN 'grounding' WHEN NOT coalesce(romanization_consistent, false) THEN 'romanization' ELSE 'pass' END AS first_failure, attempt_no, count(*) AS n FROM validation_results GROUP BY ALL""",
    "violation_counts": """SELECT v.rule AS rule, regexp_extract(v.field_path, '([a-z_]+)(\\[[0-9]+\\])?$', 1) AS leaf, count(*) AS n, count(DISTINCT result_id) AS n_results FROM (SELECT result_id, unnest(completeness_violations) AS v FROM validation_results) GROUP BY ALL""",
    "grounding_issue_counts": "SELECT g.code AS code, count(*) AS n, count(g.corrected_line_ref) AS n_correctable FROM (SELECT unnest(grounding_issues) AS g FROM validation_results) GROUP BY ALL",
    "unique_calls": f"SELECT poem_id, section_name, response_id, finish_reason, requested_at, received_at, total_token_count FROM {ONCE}",
    "completion_classes": f"SELECT section_name, {CLASS} AS completion, count(*) AS n, sum(candidates_token_count) AS output_tokens, count_if(total_token_count IS NULL) AS n_uncounted FROM {ONCE} GROUP BY ALL",
    "response_parse_classes": """SELECT finish_reason, CASE WHEN text IS NULL OR trim(text, ' ') = '' THEN 'empty' WHEN NOT json_valid(text) THEN 'failed' WHEN json_type(CASE WHEN json_valid(text) THEN text END) = 'OBJECT' THEN 'object' ELSE 'non_object' END AS parsed, count(*) AS n FROM provider_calls GROUP BY ALL""",
    "token_utilisation": f"""SELECT section_name, round(avg(candidates_token_count / 8192), 6) AS mean_use, max(candidates_token_count) AS most,
        round(sum(coalesce(cached_content_token_count, 0)) / sum(prompt_token_count), 6) AS cached_share, count_if(prompt_token_count + candidates_token_count <> total_token_count) AS n_inconsistent FROM {ONCE} GROUP BY ALL""",
    "call_latency": """SELECT section_name, count(*) AS n, round(avg(s), 4) AS mean_s, round(max(s), 4) AS max_s, round(median(s), 4) AS median_s
        FROM (SELECT section_name, (epoch_us(received_at) - epoch_us(requested_at)) / 1e6 AS s FROM provider_calls WHERE received_at IS NOT NULL) GROUP BY ALL""",
    "calls_per_poem": f"SELECT poem_id, count(*) AS n_calls, count(DISTINCT section_name) AS n_sections, sum(total_token_count) AS tokens, min(requested_at) AS first_call, max(received_at) AS last_answer FROM {ONCE} GROUP BY poem_id",
    "hourly_calls": "SELECT date_trunc('hour', requested_at) AS hour, count(*) AS n, sum(total_token_count) AS tokens FROM provider_calls GROUP BY ALL",
    "call_checkpoint_asof": f"""SELECT k.poem_id, k.completed_at, max(c.received_at) FILTER (WHERE c.received_at <= k.completed_at) AS last_answer, count_if(c.received_at > k.completed_at) AS n_later
        FROM ({CKPT}) k LEFT JOIN (SELECT poem_id, received_at FROM {ONCE} WHERE received_at IS NOT NULL) c USING (poem_id) GROUP BY ALL""",
}
