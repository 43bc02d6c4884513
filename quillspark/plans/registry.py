"""All queries of the core with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from . import annotation, assembly, corpus, grounding, nested, patches, planning, progress, records, schema, segments, vectors

MODULES = (nested, segments, annotation, corpus, grounding, planning, patches, schema, progress, vectors, records, assembly)


def queries() -> dict[str, Callable]:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
