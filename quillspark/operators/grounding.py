"""Grounding issues of annotation objects: places, source spans, translated spans and evidence of preservation."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import arrow_stage
from ..functions.text import strip
from ..session import spread
from . import nested, spans

KEYS = ["result_id", "object_path"]
FIELDS = ("line_ref", "source_span_original", "source_span_translation", "preserved", "translation_status")
MATCH = "{0}_status string, {0}_refs array<string>, {0}_n int"


def as_text(v: object) -> str | None:
    return v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False, separators=(",", ":"))


def grounded(results: DataFrame, poems: DataFrame) -> DataFrame:
    """One row per entity and expression of every annotation: its fields, ref_status and the matches of the source span in
    its place (near_*), of spans lost there in all lines (far_*), and of the translated span (told_*).

    An annotation meets its poem once, as a row; it is parsed, its lines are numbered and all its spans are searched in
    one Arrow stage. Without a poem there are no rows."""
    rows = results.select("result_id", "poem_id", "normalized_annotation").join(poems.select("poem_id", "original_poem", "translated_poem"), "poem_id")
    nothing = (None, None, None)

    def run(batch):
        for rid, text, original, translated in zip(*(batch[c] for c in ("result_id", "normalized_annotation", "original_poem", "translated_poem"))):
            tree = nested.parse_annotation(text)
            if tree is None:
                continue
            lines, told_lines = spans.lines_of(original), spans.lines_of(translated)
            for path, kind, obj in nested.objects_of(tree):
                if kind not in ("cultural_entity", "metaphor_span"):
                    continue
                ref, span, told, preserved, status = (as_text(obj.get(f)) for f in FIELDS)
                if kind != "cultural_entity":
                    preserved = status = None
                state = spans.ref_status(ref, len(lines))
                near = spans.ground(span, spans.scope(lines, spans.line_range(ref)) if state == "valid" else lines) if span else nothing
                far = spans.ground(span, lines) if near[0] == "not_found" and state == "valid" else nothing
                yield rid, path, ref, span, told, preserved, status, state, *near, *far, *(spans.ground(told, told_lines) if told else nothing)

    key = results.schema["result_id"].dataType.simpleString()
    schema = f"result_id {key}, object_path string, " + ", ".join(f"{f} string" for f in FIELDS) + ", ref_status string, " + ", ".join(MATCH.format(m) for m in ("near", "far", "told"))
    return arrow_stage(spread(rows), schema, run)


def issues(found: DataFrame, strict: bool = False) -> DataFrame:
    """(<keys>, field, code, severity, corrected_line_ref): one projection, all codes."""
    def issue(test, field, code, severity, fixed=None):
        fix = F.lit(None).cast("string") if fixed is None else fixed
        return F.when(test, F.struct(F.lit(field).alias("field"), F.lit(code).alias("code"), F.lit(severity).alias("severity"), fix.alias("corrected_line_ref")))

    gone = F.col("near_status") == "not_found"
    elsewhere = F.coalesce(F.col("far_status").isin("exact", "nfc_equivalent", "ambiguous"), F.lit(False))
    fixed = F.when(F.col("far_status").isin("exact", "nfc_equivalent") & (F.size("far_refs") == 1), F.get("far_refs", F.lit(0)))
    status = F.lower(strip(F.coalesce("translation_status", F.lit(""))))
    kept = (F.coalesce(F.col("preserved") == "true", F.lit(False)) | (status == "preserved")) & ~status.isin("lost", "omitted", "not_translated", "untranslated")
    proven = F.coalesce(F.col("told_status") != "not_found", F.lit(False))
    all_ = [
        issue(F.col("ref_status").isin("malformed", "out_of_range"), "line_ref", "line_ref_invalid", "error"),
        issue(gone & elsewhere, "line_ref", "line_ref_span_mismatch", "error", fixed),
        issue(gone & ~elsewhere, "source_span_original", "span_not_found", "error"),
        issue(F.col("near_status") == "ambiguous", "source_span_original", "span_ambiguous", "review"),
        issue(F.col("told_status") == "not_found", "source_span_translation", "translation_span_not_found", "error"),
        issue(F.col("told_status") == "ambiguous", "source_span_translation", "translation_span_ambiguous", "review"),
        issue(kept & ~proven, "source_span_translation", "translation_evidence_missing", "error" if strict else "review"),
    ]
    if strict:
        all_ += [issue(F.coalesce(f, F.lit("")) == "", f, "required_field_missing", "error") for f in ("source_span_original", "line_ref")]
    return found.select(*KEYS, F.inline(F.array_compact(F.array(*all_))))
