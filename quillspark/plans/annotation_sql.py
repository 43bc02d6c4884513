"""SQL for DuckDB that reads the delivered annotations: fences, JSON in strings, wrappers, compact keys, lone objects."""

from __future__ import annotations


def pick(obj: str, full: str, short: str | None = None) -> str:
    """A member by its full key or, where that is absent, its compact one, as JSON."""
    return f"coalesce({obj}->'{full}', {obj}->'{short}')" if short else f"({obj}->'{full}')"


def text(obj: str, full: str, short: str | None = None) -> str:
    """As pick, as text; JSON null is NULL."""
    return f"coalesce({obj}->>'{full}', CASE WHEN ({obj}->'{full}') IS NULL THEN {obj}->>'{short}' END)" if short else f"({obj}->>'{full}')"


def elements(value: str) -> str:
    return f"CASE json_type({value}) WHEN 'ARRAY' THEN CAST({value} AS JSON[]) WHEN 'OBJECT' THEN [{value}] ELSE [] END"


def exploded(name: str, source: str, keep: str, value: str, path: str) -> str:
    return f"""{name}0 AS (SELECT {keep}, {elements(value)} AS xs FROM {source}),
{name} AS (SELECT * EXCLUDE (xs, k), k AS ordinal, {path} AS object_path FROM (SELECT * EXCLUDE (xs), unnest(xs) AS o, generate_subscripts(xs, 1) - 1 AS k, xs FROM {name}0) WHERE json_type(o) = 'OBJECT')"""


ANNOTATIONS = f"""
a0 AS (SELECT result_id, poem_id, regexp_replace(regexp_replace(trim(normalized_annotation, ' ' || chr(10) || chr(13) || chr(9)), '^```[A-Za-z]*\\s*', ''), '\\s*```$', '') AS t FROM validation_results),
a1 AS (SELECT result_id, poem_id, CASE WHEN json_valid(t) THEN t::JSON END AS j FROM a0),
a2 AS (SELECT result_id, poem_id, CASE WHEN json_type(j) = 'VARCHAR' THEN CASE WHEN json_valid(j->>'$') THEN (j->>'$')::JSON END ELSE j END AS j FROM a1),
ann AS (SELECT result_id, poem_id, o FROM (SELECT result_id, poem_id, CASE WHEN json_type(j->'annotation') = 'OBJECT' THEN j->'annotation' ELSE j END AS o FROM a2) WHERE json_type(o) = 'OBJECT'),
{exploded('st', 'ann', "result_id, poem_id, '$' AS parent_path", pick('o', 'stanzas', 'st'), "'stanzas[' || k || ']'")},
{exploded('ce', 'ann', "result_id, poem_id, '$' AS parent_path", pick('o', 'cultural_entities', 'ce'), "'cultural_entities[' || k || ']'")},
{exploded('ms', 'st', "result_id, poem_id, object_path AS parent_path", pick('o', 'metaphor_spans', 'ms'), "parent_path || '.metaphor_spans[' || k || ']'")},
{exploded('tl', 'st', "result_id, poem_id, object_path AS parent_path", pick('o', 'translation_loss'), "parent_path || '.translation_loss[' || k || ']'")},
mm AS (SELECT result_id, poem_id, object_path AS parent_path, object_path || '.metaphor_mapping' AS object_path, 0 AS ordinal, o->'metaphor_mapping' AS o FROM ms WHERE json_type(o->'metaphor_mapping') = 'OBJECT')"""

OBJECTS = f"""{ANNOTATIONS},
obj AS (SELECT result_id, '' AS parent_path, '$' AS object_path FROM ann UNION ALL SELECT result_id, parent_path, object_path FROM st
    UNION ALL SELECT result_id, parent_path, object_path FROM ce UNION ALL SELECT result_id, parent_path, object_path FROM ms
    UNION ALL SELECT result_id, parent_path, object_path FROM tl UNION ALL SELECT result_id, parent_path, object_path FROM mm)"""

PATHS = r"""
i1 AS (SELECT result_id, issue_id, regexp_replace(regexp_replace(replace(trim(field_path), '/', '.'), '^\$', ''), '^\.', '') AS p FROM invalid_path_issues WHERE trim(field_path) <> ''),
i2 AS (SELECT result_id, issue_id, regexp_replace(regexp_replace(p, '\.([0-9]+)', '[\1]', 'g'), '^annotation(\.|$)', '') AS p FROM i1),
i3 AS (SELECT result_id, issue_id, CASE
    WHEN regexp_matches(p, '^stanzas\[[0-9]+\]\.metaphor_spans\[[0-9]+\]\.metaphor_mapping') THEN regexp_extract(p, '^stanzas\[[0-9]+\]\.metaphor_spans\[[0-9]+\]\.metaphor_mapping')
    WHEN regexp_matches(p, '^stanzas\[[0-9]+\]\.(metaphor_spans|translation_loss)\[[0-9]+\]') THEN regexp_extract(p, '^stanzas\[[0-9]+\]\.(metaphor_spans|translation_loss)\[[0-9]+\]')
    WHEN regexp_matches(p, '^(stanzas|cultural_entities)\[[0-9]+\]') THEN regexp_extract(p, '^(stanzas|cultural_entities)\[[0-9]+\]')
    ELSE '$' END AS object_path FROM i2)"""
