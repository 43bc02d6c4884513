"""Rules that find nothing in the test data, on tables with planted faults, in Spark and DuckDB alike."""

import json

import pytest
from oracle import differences, duck

from quillspark.plans import registry

OK = {"recitation_style": "lament", "emotional_arc": "a", "theme": "t", "stanzas": [{"index": 1, "emotion": "grief", "tone": "prayer", "translation_quality": "faithful", "loss_note": ""}, {"index": 2, "emotion": "fear"}], "cultural_entities": [{"term": "x", "stanza_index": 2}]}
SPAN = {"source_term": "a", "vehicle": "v"}
ANNOTATIONS = [
    OK,
    OK | {"stanzas": [{"index": 2}, {"index": 2}, {"index": "x"}, None, {"index": 5}]},
    OK | {"cultural_entities": [{"term": "x", "stanza_index": 3}, {"term": "x", "stanza_index": 0}, {"term": "y"}, {"term": "z", "stanza_index": "q", "preserved": "true"}]},
    OK | {"stanzas": [{"index": 1, "metaphor_spans": [SPAN | {"tenor": " Metaphor ", "expression_type": "metaphor"}, SPAN | {"tenor": "the oppression of rain", "expression_type": "simile"}, SPAN | {"tenor": "", "expression_type": ""}]}]},
    OK | {"mood": 1, "stanzas": [{"index": 1, "colour": "red", "metaphor_spans": [SPAN | {"shade": None, "metaphor_mapping": {"odd": 1}}], "translation_loss": [{"what_was_lost": "x", "why": "y"}]}]},
    OK | {"theme": ["a", "b"], "stanzas": [{"index": 1.5, "emotion": 7}, {"index": 2, "tone": {"a": 1}}], "cultural_entities": [{"term": True, "visual_features": "river", "preserved": 1, "stanza_index": 1}]},
]
ISSUES = [(1, 1, "cultural_entities[0].term"), *((10 + k, 2, f"cultural_entities[0].f{k}") for k in range(21)), (40, 2, "stanzas[0].tone"), *((50 + k, 3, f"stanzas[{k}].tone") for k in range(4))]
NAMES = ["index_mismatches", "quality_flags", "unknown_keys", "unassigned_records", "outputs_without_source", "coverage_faults", "tight_coverage", "type_faults", "member_types", "schema_verdicts", "clamped_indexes", "split_overlay", "overlay_faults", "annotation_status"]


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("planted")
    save = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{d}/{name}.parquet")
    save([(i, f"p{i}", 1, json.dumps(a)) for i, a in enumerate(ANNOTATIONS)] + [(90, "p90", 1, "{"), (91, "p91", 1, None), (92, "p92", 1, " ")], "result_id long, poem_id string, attempt_no int, normalized_annotation string", "validation_results")
    save([(i, r, p, None, None) for i, r, p in ISSUES], "issue_id long, result_id long, field_path string, validation_reason string, allowed_values array<string>", "invalid_path_issues")
    save([(f"p{i}",) for i in range(6)] + [("lonely",)], "poem_id string", "source_records")
    save([(f"p{i}",) for i in range(6)] + [("p1",)], "poem_id string", "assignments")
    save([("p0",), ("stray",), ("stray",)], "poem_id string", "checkpoints")
    return str(d)


@pytest.mark.parametrize("name", NAMES)
def test_planted_faults_are_found(spark, planted, name):
    df = registry.queries()[name](spark, planted)
    only_spark, only_sql = differences(df, registry.oracle_sql()[name], duck(planted))
    assert not only_spark and not only_sql and df.count() > 0
