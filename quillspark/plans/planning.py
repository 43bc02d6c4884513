"""Repair planning queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import vocab
from ..operators import ledger, planning
from ..session import table

TIGHT_PATHS, TIGHT_UNITS, TIGHT_PART = 4, 3, 3  # caps at which the issues of one result need several batches, beside the real ones
# Phrases of validation reasons, and the category of the first that is in a reason (or, where a path is
# named, whose path fits too).
RULE_PHRASES = (
    ("must be empty when translation_quality is faithful", None, "faithful_loss_note"),
    ("deterministically re-derived", ".line_ref", "line_ref_mismatch"),
    ("span", None, "grounding"), ("not found", None, "grounding"), ("ambiguous", None, "grounding"),
    ("completeness", None, "completeness"), ("missing", None, "completeness"),
)


def issue_paths(spark, d):
    i = table(spark, d, "invalid_path_issues").where("trim(field_path) <> ''")
    return i.select("result_id", "issue_id", "validation_reason", planning.plain_path(F.col("field_path")).alias("path"))


def path_classes(spark, d):
    p = F.col("path")
    return issue_paths(spark, d).select("issue_id", "path", planning.leaf(p).alias("leaf"), planning.path_class(p).alias("path_class"), planning.path_error(p).alias("error"))


def backfill_plans(spark, d):
    p = issue_paths(spark, d).withColumn("c", planning.path_class(F.col("path")))
    pick = lambda c: F.array_join(F.array_sort(F.collect_set(F.when(F.col("c") == c, F.col("path")))), ";")
    return p.groupBy("result_id").agg(pick("model_backfill_allowed").alias("requested"), pick("human_review_required").alias("human_only"), pick("intentionally_nullable").alias("nullable"),
                                      F.count_distinct("path").alias("n_paths"))


def repair_rules(spark, d):
    """Paths per category; a path of several issues takes that of its first. A grounding path is one whatever the reason."""
    r, p = F.lower(F.coalesce("validation_reason", F.lit(""))), F.col("path")
    hits = F.array_compact(F.array(*(F.when(r.contains(phrase) & (F.lit(True) if end is None else p.endswith(end)), F.struct(F.lit(n).alias("n"), F.lit(name).alias("name"))) for n, (phrase, end, name) in enumerate(RULE_PHRASES)), F.when(p.contains("grounding"), F.struct(F.lit(2).alias("n"), F.lit("grounding").alias("name")))))
    rule = F.coalesce(F.array_min(hits)["name"], F.lit("other_schema"))
    one = issue_paths(spark, d).withColumn("rule", rule).groupBy("result_id", "path").agg(F.min_by("rule", "issue_id").alias("rule"), F.min("issue_id").alias("first_issue"))
    return one.groupBy("result_id", "rule").agg(F.count("*").alias("n_paths"), F.min("first_issue").alias("first_issue"))


def packed(spark, d):
    return planning.units(issue_paths(spark, d), "result_id", "path")


def batched(spark, d, max_paths, max_units):
    b = planning.batches(packed(spark, d), "result_id", max_paths, max_units)
    return b.select("result_id", "batch_no", "batch_id", "n_units", "n_paths", F.array_join("paths", ";").alias("paths"), "over_cap")


def repair_batches(spark, d):
    return batched(spark, d, vocab.MAX_PATHS, vocab.MAX_UNITS)


def tight_batches(spark, d):
    return batched(spark, d, TIGHT_PATHS, TIGHT_UNITS)


def batch_plans(spark, d):
    b = planning.batches(packed(spark, d), "result_id")
    return b.groupBy("result_id").agg(F.count("*").alias("n_batches"), F.sum("n_paths").alias("n_paths")).select(
        "result_id", "n_batches", "n_paths", planning.reliability(F.col("n_batches")).alias("reliability"), ledger.token_tier(F.col("n_paths")).alias("token_budget"))


def overlay(spark, d, cap):
    p = planning.split_parts(packed(spark, d), "result_id", cap=cap)
    return p.select("result_id", "part_index", "n_parts", "reason", "n_units", F.array_join("paths", ";").alias("paths"))


def split_overlay(spark, d):
    """Every result at the production cap: its parts, or one row with reason unit_over_cap."""
    return overlay(spark, d, vocab.PART_PATHS)


def tight_split(spark, d):
    return overlay(spark, d, TIGHT_PART)


def coverage_faults(spark, d):
    """Paths of all results that are not in exactly one part, at the production cap."""
    return planning.uncovered(issue_paths(spark, d), planning.split_parts(packed(spark, d), "result_id"), "result_id")


def tight_coverage(spark, d):
    return planning.uncovered(issue_paths(spark, d), planning.split_parts(packed(spark, d), "result_id", cap=TIGHT_PART), "result_id")


QUERIES = {f.__name__: f for f in (path_classes, backfill_plans, repair_rules, repair_batches, tight_batches, batch_plans, split_overlay, tight_split, coverage_faults, tight_coverage)}

PATHS = r"""ip0 AS (SELECT result_id, issue_id, validation_reason, regexp_replace(regexp_replace(replace(trim(field_path, ' '), '/', '.'), '^\$', ''), '^\.', '') AS p FROM invalid_path_issues WHERE trim(field_path, ' ') <> ''),
ip AS (SELECT result_id, issue_id, validation_reason, regexp_replace(regexp_replace(p, '\.([0-9]+)', '[\1]', 'g'), '^annotation(\.|$)', '') AS path FROM ip0)"""
LEAF = r"regexp_extract(path, '([^.\[\]]*)(\[[0-9]*\])*$', 1)"
IN = lambda vs: "(" + ", ".join(f"'{v}'" for v in vs) + ")"
CLASS = f"CASE WHEN {LEAF} IN {IN(planning.NULLABLE)} THEN 'intentionally_nullable' WHEN {LEAF} IN {IN(planning.HUMAN)} THEN 'human_review_required' WHEN {LEAF} IN {IN(planning.MODEL)} THEN 'model_backfill_allowed' ELSE 'not_applicable' END"
UNITS = PATHS + r""",
un0 AS (SELECT DISTINCT result_id, path, CASE WHEN regexp_matches(path, '^cultural_entities\[[0-9]+\]') THEN 0 WHEN regexp_matches(path, '^stanzas\[[0-9]+\]\.metaphor_spans\[[0-9]+\]') THEN 1 WHEN regexp_matches(path, '^stanzas\[[0-9]+\]') THEN 2 ELSE 3 END AS rank,
    coalesce(try_cast(regexp_extract(path, '^[a-z_]+\[([0-9]+)\]', 1) AS int), 0) AS a, coalesce(try_cast(regexp_extract(path, '^stanzas\[[0-9]+\]\.metaphor_spans\[([0-9]+)\]', 1) AS int), 0) AS b FROM ip),
un AS (SELECT result_id, rank, a, b, count(*) AS n, list(path ORDER BY path) AS ps, row_number() OVER (PARTITION BY result_id ORDER BY rank, a, b) AS k FROM un0 GROUP BY result_id, rank, a, b)"""


def pack_sql(paths: int, units: int) -> str:
    return f"""{UNITS}, rec AS (SELECT result_id, k, n AS np, 1 AS nu, 1 AS batch_no FROM un WHERE k = 1 UNION ALL
    SELECT u.result_id, u.k, CASE WHEN r.np + u.n > {paths} OR r.nu + 1 > {units} THEN u.n ELSE r.np + u.n END, CASE WHEN r.np + u.n > {paths} OR r.nu + 1 > {units} THEN 1 ELSE r.nu + 1 END,
    r.batch_no + CASE WHEN r.np + u.n > {paths} OR r.nu + 1 > {units} THEN 1 ELSE 0 END FROM rec r JOIN un u ON u.result_id = r.result_id AND u.k = r.k + 1)"""


def split_sql(cap: int) -> str:
    return f"""{pack_sql(cap, 1 << 30)}, over AS (SELECT DISTINCT result_id FROM un WHERE n > {cap}), nd AS (SELECT result_id, max(batch_no) AS need, count(*) AS n FROM rec GROUP BY ALL),
ok AS (SELECT result_id, n, CASE WHEN n < 3 THEN n WHEN need > 3 THEN need ELSE 3 END AS n_parts, CASE WHEN n < 3 THEN 'fewer_units' WHEN need > 3 THEN 'cap_needs_more' END AS reason
    FROM nd WHERE result_id NOT IN (SELECT result_id FROM over)),
pt AS (SELECT result_id, n_parts, reason, ps, CASE WHEN k - 1 < (ok.n % n_parts) * (ok.n // n_parts + 1) THEN (k - 1) // (ok.n // n_parts + 1) ELSE ok.n % n_parts + (k - 1 - (ok.n % n_parts) * (ok.n // n_parts + 1)) // (ok.n // n_parts) END + 1 AS part_index
    FROM un JOIN ok USING (result_id)),
sp AS (SELECT result_id, part_index, n_parts, reason, count(*) AS n_units, list_sort(flatten(list(ps))) AS paths FROM pt GROUP BY result_id, part_index, n_parts, reason
    UNION ALL SELECT result_id, NULL, 0, 'unit_over_cap', count(*), list_sort(flatten(list(ps))) FROM un JOIN over USING (result_id) GROUP BY result_id)"""


def overlay_sql(cap: int) -> str:
    return f"WITH RECURSIVE {split_sql(cap)} SELECT result_id, part_index, n_parts, reason, n_units, array_to_string(paths, ';') AS paths FROM sp"


def coverage_sql(cap: int) -> str:
    return f"""WITH RECURSIVE {split_sql(cap)}, used AS (SELECT result_id, path, count(*) AS n FROM (SELECT result_id, unnest(paths) AS path FROM sp WHERE part_index IS NOT NULL) GROUP BY ALL),
        asked AS (SELECT DISTINCT result_id, path FROM ip) SELECT coalesce(a.result_id, u.result_id) AS result_id, coalesce(a.path, u.path) AS path, n FROM asked a FULL JOIN used u ON a.result_id = u.result_id AND a.path = u.path WHERE n IS NULL OR n <> 1"""


def batch_sql(paths: int, units: int) -> str:
    return f"""WITH RECURSIVE {pack_sql(paths, units)}, g AS (SELECT result_id, batch_no, count(*) AS n_units, list_sort(flatten(list(ps))) AS ps FROM rec JOIN un USING (result_id, k) GROUP BY ALL)
        SELECT result_id, batch_no, result_id || '_batch_' || lpad(batch_no::varchar, 2, '0') AS batch_id, n_units, len(ps) AS n_paths, array_to_string(ps, ';') AS paths, len(ps) > {paths} AS over_cap FROM g"""


R = "lower(coalesce(validation_reason, ''))"
SQL = {
    "path_classes": rf"""WITH {PATHS} SELECT issue_id, path, {LEAF} AS leaf, {CLASS} AS path_class, CASE WHEN path = '' THEN 'empty_path' WHEN regexp_matches(path, '\[-[0-9]+\]') THEN 'negative_index'
        WHEN regexp_matches(path, '\[[0-9]*[^0-9\]][0-9]*\]|\[\]') THEN 'bad_index' WHEN NOT regexp_matches(path, '{planning.GRAMMAR}') THEN 'bad_syntax' END AS error FROM ip""",
    "backfill_plans": f"""WITH {PATHS}, c AS (SELECT DISTINCT result_id, path, {CLASS} AS c FROM ip) SELECT result_id, coalesce(string_agg(path, ';' ORDER BY path) FILTER (WHERE c = 'model_backfill_allowed'), '') AS requested,
        coalesce(string_agg(path, ';' ORDER BY path) FILTER (WHERE c = 'human_review_required'), '') AS human_only, coalesce(string_agg(path, ';' ORDER BY path) FILTER (WHERE c = 'intentionally_nullable'), '') AS nullable, count(*) AS n_paths FROM c GROUP BY result_id""",
    "repair_rules": f"""WITH {PATHS}, r AS (SELECT result_id, path, issue_id, CASE WHEN contains({R}, 'must be empty when translation_quality is faithful') THEN 'faithful_loss_note' WHEN path LIKE '%.line_ref' AND contains({R}, 'deterministically re-derived') THEN 'line_ref_mismatch'
        WHEN contains(path, 'grounding') OR contains({R}, 'span') OR contains({R}, 'not found') OR contains({R}, 'ambiguous') THEN 'grounding' WHEN contains({R}, 'completeness') OR contains({R}, 'missing') THEN 'completeness' ELSE 'other_schema' END AS rule FROM ip),
        o AS (SELECT result_id, path, arg_min(rule, issue_id) AS rule, min(issue_id) AS first_issue FROM r GROUP BY ALL) SELECT result_id, rule, count(*) AS n_paths, min(first_issue) AS first_issue FROM o GROUP BY ALL""",
    "repair_batches": batch_sql(vocab.MAX_PATHS, vocab.MAX_UNITS), "tight_batches": batch_sql(TIGHT_PATHS, TIGHT_UNITS),
    "batch_plans": f"""WITH RECURSIVE {pack_sql(40, 25)}, g AS (SELECT result_id, max(batch_no) AS n_batches FROM rec GROUP BY ALL), p AS (SELECT result_id, sum(n) AS n_paths FROM un GROUP BY ALL)
        SELECT result_id, n_batches, n_paths, CASE WHEN n_batches <= 1 THEN 'single_request_safe' WHEN n_batches = 2 THEN 'single_request_high_risk' ELSE 'batching_required' END AS reliability,
        CASE WHEN n_paths BETWEEN 1 AND 20 THEN 4096 WHEN n_paths BETWEEN 21 AND 30 THEN 8192 WHEN n_paths BETWEEN 31 AND 40 THEN 24576 END AS token_budget FROM g JOIN p USING (result_id)""",
    "split_overlay": overlay_sql(vocab.PART_PATHS), "tight_split": overlay_sql(TIGHT_PART), "coverage_faults": coverage_sql(vocab.PART_PATHS), "tight_coverage": coverage_sql(TIGHT_PART),
}
