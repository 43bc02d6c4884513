"""Queries over nested annotations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import nested
from ..session import table
from .annotation_sql import OBJECTS, PATHS


def results(spark: SparkSession, d: str) -> tuple[DataFrame, str, str]:
    return table(spark, d, "validation_results"), "result_id", "normalized_annotation"


def p3_bridge(spark: SparkSession, d: str) -> DataFrame:
    return nested.bridge(*results(spark, d))


def p3_objects(spark: SparkSession, d: str) -> DataFrame:
    return nested.distinct_objects(*results(spark, d))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    about = nested.issue_objects(table(spark, d, "invalid_path_issues"), "result_id", "issue_id", "field_path")
    return nested.objects_with_issues(p3_bridge(spark, d), about, "result_id", "issue_id")


def bridge_places(spark: SparkSession, d: str) -> DataFrame:
    """The bridge without its hashes."""
    return p3_bridge(spark, d).drop("object_hash")


def annotation_status(spark: SparkSession, d: str) -> DataFrame:
    return nested.statuses(*results(spark, d))


QUERIES = {"p3_found": p3_found, "p3_bridge": p3_bridge, "p3_objects": p3_objects, "bridge_places": bridge_places, "annotation_status": annotation_status}
KIDS = "SELECT result_id, parent_path AS object_path, count(*) AS n FROM pl GROUP BY ALL"
SQL = {
    "p3_found": f"WITH {OBJECTS}, {PATHS} SELECT obj.result_id, parent_path, object_path, coalesce(issue_id, 0) AS issue_id FROM obj LEFT JOIN i3 USING (result_id, object_path)",
    "bridge_places": f"""WITH {OBJECTS}, pl AS (SELECT result_id, '' AS parent_path, '$' AS object_path, 'annotation' AS kind, 0 AS ordinal FROM ann
        UNION ALL SELECT result_id, parent_path, object_path, 'stanza', ordinal FROM st UNION ALL SELECT result_id, parent_path, object_path, 'cultural_entity', ordinal FROM ce
        UNION ALL SELECT result_id, parent_path, object_path, 'metaphor_span', ordinal FROM ms UNION ALL SELECT result_id, parent_path, object_path, 'translation_loss', ordinal FROM tl
        UNION ALL SELECT result_id, parent_path, object_path, 'metaphor_mapping', ordinal FROM mm), kids AS ({KIDS})
        SELECT pl.*, coalesce(n, 0) AS n_children FROM pl LEFT JOIN kids USING (result_id, object_path)""",
    "annotation_status": f"""WITH {OBJECTS} SELECT r.result_id, CASE WHEN normalized_annotation IS NULL THEN 'null' WHEN trim(normalized_annotation, ' ') = '' THEN 'blank'
        WHEN ann.result_id IS NULL THEN 'unreadable' ELSE 'read' END AS status FROM validation_results r LEFT JOIN ann USING (result_id)""",
}
