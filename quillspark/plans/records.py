"""JSON path, repair and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import json_paths
from ..operators import nested, planning
from ..session import table
from ..streaming import calls


def repaired_annotations(spark, d):
    r = json_paths.closed(table(spark, d, "validation_results"), ["result_id"], "normalized_annotation")
    return r.groupBy("state").agg(F.count("*").alias("n"), F.sum(F.char_length("repaired")).alias("chars"))


def issue_values(spark, d):
    """The value each issue's path names, in the annotation's full form whatever shape it was delivered in."""
    i = table(spark, d, "invalid_path_issues").where("field_path IS NOT NULL").select("result_id", "issue_id", planning.plain_path(F.col("field_path")).alias("path"))
    v = table(spark, d, "validation_results").select("result_id", "normalized_annotation")
    return json_paths.values_at(i.join(v, "result_id"), ["result_id", "issue_id", "path"], "normalized_annotation", "path", nested.read_annotation, nested.full_path)


def attempt_differences(spark, d):
    """Leaves in which two attempts at one poem differ: full outer join by path of the leaves of their full forms."""
    v = table(spark, d, "validation_results").select("poem_id", "attempt_no", "normalized_annotation")
    leaves = json_paths.leaf_rows(v, ["poem_id", "attempt_no"], "normalized_annotation", nested.read_annotation)
    both = leaves.groupBy("poem_id").agg(F.min("attempt_no").alias("a"), F.max("attempt_no").alias("b")).where("a < b")
    a = leaves.join(both, "poem_id").where("attempt_no = a").select("poem_id", "path", F.col("value").alias("before"))
    b = leaves.join(both, "poem_id").where("attempt_no = b").select("poem_id", "path", F.col("value").alias("after"))
    return a.join(b, ["poem_id", "path"], "full").where("NOT (before <=> after)")


def response_members(spark, d):
    """Members of the provider's answers that are JSON objects."""
    c = table(spark, d, "provider_calls").where("response_id IS NOT NULL").select("response_id", "section_name", F.try_parse_json("text").alias("v"))
    keys = c.where(F.schema_of_variant("v").startswith("OBJECT")).select("response_id", "section_name", F.explode(F.json_object_keys(F.to_json("v"))).alias("member"))
    return keys.groupBy("section_name", "member").agg(F.count("*").alias("n"), F.count_distinct("response_id").alias("n_responses"))


def streamed_unique_calls(spark, d):
    s = calls.unique(calls.call_stream(spark, f"{d}/provider_calls.parquet"))
    r = calls.drain(s, "unique")
    return r.groupBy("section_name").agg(F.count("*").alias("n"), F.count("response_id").alias("n_ids"))


QUERIES = {f.__name__: f for f in (repaired_annotations, issue_values, attempt_differences, response_members, streamed_unique_calls)}
SQL = {
    "response_members": """WITH m AS (SELECT response_id, section_name, unnest(json_keys(text::JSON)) AS member FROM (SELECT * FROM provider_calls WHERE response_id IS NOT NULL AND json_valid(text)) WHERE json_type(text::JSON) = 'OBJECT')
        SELECT section_name, member, count(*) AS n, count(DISTINCT response_id) AS n_responses FROM m GROUP BY ALL""",
    "streamed_unique_calls": """SELECT section_name, count(*) AS n, count(response_id) AS n_ids FROM (SELECT DISTINCT response_id, section_name, CASE WHEN response_id IS NULL THEN poem_id || '|' || section_name || '|' || requested_at END FROM provider_calls) GROUP BY ALL""",
}
