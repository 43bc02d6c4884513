"""Progress, prompt and context queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import corpus, planning, progress, vectors
from ..session import table
from . import planning as plans
from .grounding import BASE, grounding_issues, issue_sql
from .patches import ALL_FIELDS, issue_fields, object_fields, results
from .planning import CLASS, PATHS, issue_paths, pack_sql, packed, split_sql
from .vectors import CENT

RUNS = ["requested_at", "received_at", "response_id"]


def repair_runs(spark, d):
    c = table(spark, d, "provider_calls").where("section_name = 'repair' AND requested_at IS NOT NULL").select("poem_id", "response_id", "finish_reason", "requested_at", "received_at").distinct()
    return c.withColumn("status", F.when(F.col("finish_reason") == "STOP", "success").otherwise("failed"))


def batch_runs(spark, d):
    """(poem_id, batch_no, status): runs are dealt to the poem's three batches by the hour they were asked for in."""
    return repair_runs(spark, d).withColumn("batch_no", F.hour("requested_at") % 3 + 1)


def latest_run_states(spark, d):
    r = progress.latest_runs(batch_runs(spark, d), ["poem_id", "batch_no"], RUNS)
    return r.select("poem_id", "batch_no", "status", "complete", "n_runs")


def batch_progress(spark, d):
    r = latest_run_states(spark, d)
    b = r.select("poem_id").distinct().select("poem_id", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("batch_no"))
    return progress.progress(b, r, "poem_id")


def next_attempts(spark, d):
    return progress.next_attempts(results(spark, d), "poem_id", "attempt_no")


def starting_copies(spark, d):
    p = planning.split_parts(packed(spark, d), "result_id", cap=plans.TIGHT_PART).where("part_index IS NOT NULL")
    c = results(spark, d).select("result_id", "poem_id").join(progress.latest_attempts(results(spark, d)).where("candidate > 1"), "poem_id", "left").select("result_id", "candidate")
    return progress.starting_copies(p.join(c, "result_id"), "result_id")


def effective_paths(spark, d):
    i = issue_paths(spark, d)
    return progress.effective_paths(i, i.where(planning.path_class(F.col("path")) == "human_review_required"), "result_id")


def overlay_faults(spark, d):
    """Splits made at the tight cap, held against a tighter one."""
    return progress.overlay_faults(planning.split_parts(packed(spark, d), "result_id", cap=plans.TIGHT_PART), "result_id", plans.TIGHT_PART - 1)


def overage_reasons(spark, d):
    b = planning.batches(packed(spark, d), "result_id", plans.TIGHT_PATHS, plans.TIGHT_UNITS)
    why = F.when(~F.col("over_cap"), None).when(F.col("n_units") == 1, "single_unit_over_cap").otherwise("units_over_cap")
    return b.groupBy(why.alias("reason")).agg(F.count("*").alias("n"), F.max("n_paths").alias("most_paths"))


def whole_array_paths(spark, d):
    """Paths that name a whole list: their repair must say whether detection is complete."""
    return issue_paths(spark, d).where(F.col("path").rlike("(cultural_entities|metaphor_spans)$")).select("issue_id", "path")


def represented_paths(spark, d):
    """One row: are all asked paths in exactly one batch."""
    a = issue_paths(spark, d).select("result_id", "path").distinct()
    b = planning.batches(packed(spark, d), "result_id").select("result_id", F.explode("paths").alias("path"))
    g = a.withColumn("a", F.lit(1)).join(b.withColumn("b", F.lit(1)), ["result_id", "path"], "full")
    return g.agg(F.count("a").alias("n_asked"), F.count("b").alias("n_batched"), F.coalesce(F.bool_and(F.col("a").isNotNull() & F.col("b").isNotNull()), F.lit(True)).alias("all_represented"))


def patch_prompts(spark, d):
    """The request for each batch: its paths and what they hold now, in order, with hash and size."""
    old = issue_fields(spark, d).groupBy("result_id", "path").agg(F.max("value").alias("old"))
    p = issue_paths(spark, d).select("result_id", "path").distinct().join(old, ["result_id", "path"], "left")
    line = F.concat(F.lit("- "), "path", F.lit(": "), F.coalesce("old", F.lit("(empty)")))
    g = p.groupBy("result_id").agg(F.count("*").alias("n_paths"), F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("body"))
    text = F.concat(F.lit("Fill these fields and no others:\n"), F.col("body"), F.lit("\nList under unresolved_items what cannot be filled."))
    return g.select("result_id", "n_paths", F.char_length(text).alias("n_chars"), F.sha2(F.encode(text, "UTF-8"), 256).alias("prompt_sha256"))


def guidance_texts(spark, d):
    """Terms of the glossary per language and category as one block of text, cut to nothing."""
    g = table(spark, d, "glossary").where("term IS NOT NULL AND gloss IS NOT NULL")
    b = g.groupBy("language", F.coalesce("category", F.lit("general")).alias("category")).agg(F.count("*").alias("n_terms"), F.array_join(F.array_sort(F.collect_list(F.concat("term", F.lit(" = "), "gloss"))), "\n").alias("block"))
    return b.select("language", "category", "n_terms", F.sha2(F.encode("block", "UTF-8"), 256).alias("block_sha256"))


def blocked_terms(spark, d):
    """Entities left when those whose term is in their language's categorised glossary are taken out, per language."""
    lang = results(spark, d).select("result_id", "poem_id").join(table(spark, d, "source_records").select("poem_id", corpus.folded(F.col("language")).alias("language")), "poem_id")
    e = object_fields(spark, d).where("kind = 'cultural_entity' AND field = 'term'").join(lang, "result_id").select("result_id", "object_path", "language", corpus.folded(F.col("value")).alias("term"))
    stop = table(spark, d, "glossary").where("category IS NOT NULL").select(corpus.folded(F.col("language")).alias("language"), corpus.folded(F.col("term")).alias("term")).distinct()
    return e.join(stop, ["language", "term"], "left_anti").groupBy("language").agg(F.count("*").alias("n_entities"), F.count_distinct("term").alias("n_terms"))


def id_sets(spark, d):
    """Ids assigned, completed and failed as sets: how many in each pair of sets, and only in one."""
    a, c, f = (table(spark, d, t).select("poem_id").distinct() for t in ("assignments", "checkpoints", "failures"))
    n = lambda name, x: x.agg(F.count("*").alias("n"), F.min("poem_id").alias("first_id")).select(F.lit(name).alias("ids"), "n", "first_id")
    return n("assigned_and_completed", a.intersect(c)).unionByName(n("assigned_not_completed", a.exceptAll(c))).unionByName(n("completed_not_assigned", c.exceptAll(a))).unionByName(n("completed_and_failed", c.intersect(f))).unionByName(n("any", a.union(c).union(f).distinct()))


def first_duplicates(spark, d):
    """The ten smallest ids that are assigned more than once (a report)."""
    g = table(spark, d, "assignments").groupBy("poem_id").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_set("assignee")), ",").alias("assignees")).where("n > 1")
    return g.orderBy("poem_id").limit(10)


def latin_words(spark, d):
    """The first five words in Latin letters of poems in another script."""
    c = F.col("original_poem")
    p = table(spark, d, "source_records").where(c.rlike(r"[\p{L}&&[^\x{0}-\x{2af}]]") & c.rlike("[A-Za-z]{2,}"))
    return p.select("poem_id", F.array_join(F.slice(F.regexp_extract_all("original_poem", F.lit("[A-Za-z]{2,}"), F.lit(0)), 1, 5), " ").alias("words"))


def token_metadata(spark, d):
    """Tokens of a call from the first member that is there: the total, else the sum of its parts."""
    t = F.coalesce("total_token_count", F.col("prompt_token_count") + F.col("candidates_token_count"), "prompt_token_count", "candidates_token_count")
    kind = F.when(F.col("total_token_count").isNotNull(), "total").when(t.isNull(), "none").otherwise("parts")
    return table(spark, d, "provider_calls").groupBy("section_name", kind.alias("known_by")).agg(F.count("*").alias("n"), F.sum(t).alias("tokens"))


def vector_context(spark, d):
    """The two nearest prototypes of each vector, the lead of the first, and whether it disagrees with its own label."""
    r = table(spark, d, "embeddings")
    s = vectors.scores(r, "vec_id", "embedding", vectors.centroids(r, "label", "embedding"), "label", "centroid").join(r.select("vec_id", "label"), "vec_id")
    lead = F.col("s")[0]["score"] - F.col("s")[1]["score"]
    return s.select("vec_id", F.col("s")[0]["label"].alias("nearest"), F.col("s")[1]["label"].alias("second"), F.round(lead, 3).alias("lead"), (F.col("s")[0]["label"] != F.col("label")).alias("review"))


def review_items(spark, d):
    return vector_context(spark, d).groupBy("nearest", "review").agg(F.count("*").alias("n"))


def first_ungrounded(spark, d):
    """The first path of each result whose span is not in its poem."""
    g = grounding_issues(spark, d).where("code = 'span_not_found'").select("result_id", F.concat_ws(".", "object_path", "field").alias("path"))
    return g.groupBy("result_id").agg(F.min("path").alias("first_path"), F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (
    latest_run_states, batch_progress, next_attempts, starting_copies, effective_paths, overlay_faults, overage_reasons, whole_array_paths, represented_paths, patch_prompts, guidance_texts,
    blocked_terms, id_sets, first_duplicates, latin_words, token_metadata, vector_context, review_items, first_ungrounded,
)}

FOLD = lambda c: f"lower(trim({c}))"
RUN_SQL = """rr AS (SELECT DISTINCT poem_id, response_id, finish_reason, requested_at, received_at FROM provider_calls WHERE section_name = 'repair' AND requested_at IS NOT NULL),
rb AS (SELECT poem_id, (hour(requested_at) % 3 + 1)::int AS batch_no, CASE WHEN finish_reason = 'STOP' THEN 'success' ELSE 'failed' END AS status, row_number() OVER (PARTITION BY poem_id, hour(requested_at) % 3 ORDER BY requested_at DESC, received_at DESC NULLS LAST, response_id DESC NULLS LAST) AS k,
    count(*) OVER (PARTITION BY poem_id, hour(requested_at) % 3) AS n_runs FROM rr), lr AS (SELECT poem_id, batch_no, status, status = 'success' AS complete, n_runs FROM rb WHERE k = 1)"""
BATCHES = f"{pack_sql(40, 25)}, bt AS (SELECT result_id, batch_no, unnest(ps) AS path FROM rec JOIN un USING (result_id, k))"
CONTEXT = f"""{CENT}, s AS (SELECT vec_id, e.label AS own, c.label, list_cosine_similarity(v, c) AS score FROM e, c), k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, label) AS k FROM s),
vc AS (SELECT a.vec_id, a.label AS nearest, b.label AS second, round(a.score - b.score, 3) AS lead, a.label <> a.own AS review FROM k a JOIN k b ON a.vec_id = b.vec_id AND a.k = 1 AND b.k = 2)"""


def sets_sql() -> str:
    side = {n: f"SELECT DISTINCT poem_id FROM {t}" for n, t in (("a", "assignments"), ("c", "checkpoints"), ("f", "failures"))}
    ops = (("assigned_and_completed", "a", "INTERSECT", "c"), ("assigned_not_completed", "a", "EXCEPT", "c"), ("completed_not_assigned", "c", "EXCEPT", "a"), ("completed_and_failed", "c", "INTERSECT", "f"))
    parts = [f"SELECT '{n}' AS ids, count(*) AS n, min(poem_id) AS first_id FROM ({side[x]} {op} {side[y]})" for n, x, op, y in ops]
    return " UNION ALL ".join([*parts, f"SELECT 'any', count(*), min(poem_id) FROM ({side['a']} UNION {side['c']} UNION {side['f']})"])


SQL = {
    "latest_run_states": f"WITH {RUN_SQL} SELECT * FROM lr",
    "batch_progress": f"""WITH {RUN_SQL}, b AS (SELECT DISTINCT poem_id, k AS batch_no FROM lr, generate_series(1, 3) t(k)), j AS (SELECT b.poem_id, b.batch_no, coalesce(complete, false) AS complete FROM b LEFT JOIN lr ON lr.poem_id = b.poem_id AND lr.batch_no = b.batch_no),
        g AS (SELECT poem_id, count(*) AS n_batches, count(*) FILTER (WHERE complete) AS n_complete, min(batch_no) FILTER (WHERE NOT complete) AS next_batch, max(batch_no) AS last FROM j GROUP BY poem_id)
        SELECT poem_id, n_batches, n_complete, next_batch, coalesce(last - next_batch, 0) AS n_blocked, next_batch IS NULL AS fully_done FROM g""",
    "next_attempts": "SELECT poem_id, max(coalesce(attempt_no, 0)) + 1 AS next_attempt, count(*) AS n_attempts FROM validation_results GROUP BY poem_id",
    "starting_copies": f"""WITH RECURSIVE {split_sql(plans.TIGHT_PART)}, c AS (SELECT poem_id, max(attempt_no) AS a FROM validation_results GROUP BY ALL HAVING max(attempt_no) > 1), p AS (SELECT sp.*, a FROM sp JOIN validation_results USING (result_id) LEFT JOIN c USING (poem_id) WHERE part_index IS NOT NULL)
        SELECT result_id, part_index, CASE WHEN part_index > 1 THEN 'part ' || (part_index - 1)::int WHEN a IS NOT NULL THEN 'attempt ' || a ELSE 'initial' END AS start,
        coalesce((SELECT string_agg(path, ';' ORDER BY path) FROM (SELECT unnest(q.paths) AS path FROM p q WHERE q.result_id = p.result_id AND q.part_index < p.part_index)), '') AS paths_before FROM p""",
    "effective_paths": f"""WITH {PATHS}, c AS (SELECT DISTINCT result_id, path, {CLASS} = 'human_review_required' AS o FROM ip)
        SELECT result_id, coalesce(string_agg(path, ';' ORDER BY path) FILTER (WHERE NOT o), '') AS applied, coalesce(string_agg(path, ';' ORDER BY path) FILTER (WHERE o), '') AS deferred FROM c GROUP BY result_id""",
    "overlay_faults": f"""WITH RECURSIVE {split_sql(plans.TIGHT_PART)}, g AS (SELECT result_id, min(part_index) AS lo, max(len(paths)) AS big FROM sp GROUP BY ALL)
        SELECT result_id, 'not_split' AS rule FROM g WHERE lo IS NULL UNION ALL SELECT result_id, 'part_over_cap' FROM g WHERE lo IS NOT NULL AND big > {plans.TIGHT_PART - 1}""",
    "overage_reasons": f"""WITH RECURSIVE {pack_sql(plans.TIGHT_PATHS, plans.TIGHT_UNITS)}, g AS (SELECT result_id, batch_no, count(*) AS u, sum(n) AS p FROM rec JOIN un USING (result_id, k) GROUP BY ALL)
        SELECT CASE WHEN p <= {plans.TIGHT_PATHS} THEN NULL WHEN u = 1 THEN 'single_unit_over_cap' ELSE 'units_over_cap' END AS reason, count(*) AS n, max(p) AS most_paths FROM g GROUP BY ALL""",
    "whole_array_paths": f"WITH {PATHS} SELECT issue_id, path FROM ip WHERE regexp_matches(path, '(cultural_entities|metaphor_spans)$')",
    "represented_paths": f"""WITH RECURSIVE {BATCHES}, a AS (SELECT DISTINCT result_id, path FROM ip) SELECT count(a.path) AS n_asked, count(bt.path) AS n_batched, bool_and(a.path IS NOT NULL AND bt.path IS NOT NULL) AS all_represented
        FROM a FULL JOIN bt ON a.result_id = bt.result_id AND a.path = bt.path""",
    "patch_prompts": f"""WITH {PATHS}, {ALL_FIELDS}, o AS (SELECT DISTINCT ip.result_id, path, value AS old FROM (SELECT *, CASE WHEN contains(path, '.') THEN regexp_replace(path, '\\.[^.]*$', '') ELSE '$' END AS hold, regexp_extract(path, '([^.\\[\\]]*)(\\[[0-9]*\\])*$', 1) AS leaf FROM ip WHERE path NOT LIKE '%]') ip
        JOIN fl ON fl.result_id = ip.result_id AND fl.object_path = hold AND fl.field = leaf), q AS (SELECT DISTINCT result_id, path FROM ip), l AS (SELECT result_id, '- ' || path || ': ' || coalesce(old, '(empty)') AS line FROM q LEFT JOIN o USING (result_id, path)),
        t AS (SELECT result_id, count(*) AS n_paths, 'Fill these fields and no others:' || chr(10) || string_agg(line, chr(10) ORDER BY line) || chr(10) || 'List under unresolved_items what cannot be filled.' AS t FROM l GROUP BY result_id)
        SELECT result_id, n_paths, length(t) AS n_chars, sha256(t) AS prompt_sha256 FROM t""",
    "guidance_texts": "SELECT language, coalesce(category, 'general') AS category, count(*) AS n_terms, sha256(string_agg(term || ' = ' || gloss, chr(10) ORDER BY term || ' = ' || gloss)) AS block_sha256 FROM glossary WHERE term IS NOT NULL AND gloss IS NOT NULL GROUP BY ALL",
    "blocked_terms": f"""WITH {ALL_FIELDS}, e AS (SELECT {FOLD('language')} AS language, {FOLD('value')} AS term FROM fl JOIN source_records USING (poem_id) WHERE kind = 'cultural_entity' AND field = 'term')
        SELECT language, count(*) AS n_entities, count(DISTINCT term) AS n_terms FROM e WHERE NOT EXISTS (SELECT 1 FROM glossary g WHERE category IS NOT NULL AND {FOLD('g.language')} = e.language AND {FOLD('g.term')} = e.term) GROUP BY language""",
    "id_sets": sets_sql(),
    "first_duplicates": "SELECT poem_id, count(*) AS n, string_agg(DISTINCT assignee, ',' ORDER BY assignee) AS assignees FROM assignments GROUP BY poem_id HAVING count(*) > 1 ORDER BY poem_id LIMIT 10",
    "latin_words": r"SELECT poem_id, array_to_string(regexp_extract_all(original_poem, '[A-Za-z]{2,}')[1:5], ' ') AS words FROM source_records WHERE regexp_matches(regexp_replace(original_poem, '[\x{0}-\x{2af}]', '', 'g'), '\pL') AND regexp_matches(original_poem, '[A-Za-z]{2,}')",
    "token_metadata": """SELECT section_name, CASE WHEN total_token_count IS NOT NULL THEN 'total' WHEN coalesce(prompt_token_count, candidates_token_count) IS NULL THEN 'none' ELSE 'parts' END AS known_by, count(*) AS n,
        sum(coalesce(total_token_count, prompt_token_count + candidates_token_count, prompt_token_count, candidates_token_count)) AS tokens FROM provider_calls GROUP BY ALL""",
    "vector_context": f"WITH {CONTEXT} SELECT * FROM vc",
    "review_items": f"WITH {CONTEXT} SELECT nearest, review, count(*) AS n FROM vc GROUP BY ALL",
    "first_ungrounded": f"{BASE} SELECT result_id, min(object_path || '.' || field) AS first_path, count(*) AS n FROM ({issue_sql(False)}) WHERE code = 'span_not_found' GROUP BY result_id",
}
