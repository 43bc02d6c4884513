"""Exact grounding of quoted spans in numbered lines.

A span is searched exactly: within single lines, in windows of stripped lines, then in the raw lines joined. Only what
none of these finds is searched again in canonical composition. Nothing is fuzzy. Each search is a plain substring
search on the texts of one row, so a row goes through one Arrow stage and nothing is joined or shuffled for it.

Defined results: a null or empty span and a malformed line reference are invalid input; a null reference means all lines;
a reference beyond the last line has no lines; occurrences may overlap and are each counted.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..arrow import arrow_stage
from ..functions.text import numbered_lines

REF = re.compile(r"L([1-9][0-9]{0,8})(?:-L([1-9][0-9]{0,8}))?\Z")
Lines = list[tuple[int, str]]  # numbers and raw texts


def lines_of(text: str | None) -> Lines:
    """Lines that are not blank, numbered from 1."""
    kept = (l for l in (text or "").replace("\r\n", "\n").replace("\r", "\n").split("\n") if l.strip())
    return list(enumerate(kept, 1))


def line_range(ref: str | None) -> tuple[int, int] | None:
    m = REF.match(ref.strip()) if ref is not None else None
    if not m:
        return None
    a = int(m.group(1))
    b = int(m.group(2) or a)
    return (a, b) if a <= b else None


def ref_status(ref: str | None, n_lines: int) -> str:
    r = line_range(ref)
    return "absent" if ref is None else "malformed" if r is None else "out_of_range" if r[1] > n_lines else "valid"


def scope(lines: Lines, r: tuple[int, int]) -> Lines:
    return lines[r[0] - 1 : r[1]]


def places(text: str, span: str) -> list[int]:
    """Starts of all occurrences of a span, overlapping ones too."""
    out, at = [], text.find(span)
    while at >= 0:
        out.append(at)
        at = text.find(span, at + 1)
    return out


def ref(a: int, b: int) -> str:
    return f"L{a}" if a == b else f"L{a}-L{b}"


def in_lines(span: str, lines: Lines) -> tuple[int, list[str]]:
    hits = [(k, n) for k, l in lines if (n := len(places(l, span)))]
    return sum(n for _, n in hits), [ref(k, k) for k, _ in hits]


def in_windows(span: str, lines: Lines) -> tuple[int, list[str]]:
    """In windows of as many stripped lines as the span has."""
    k = span.count("\n") + 1
    bare = [l.strip() for _, l in lines]
    hits = [(i, n) for i in range(len(lines) - k + 1) if (n := len(places("\n".join(bare[i : i + k]), span)))]
    return sum(n for _, n in hits), [ref(lines[i][0], lines[i + k - 1][0]) for i, _ in hits]


def in_raw(span: str, lines: Lines) -> tuple[int, list[str]]:
    """In the raw lines joined by line feeds; an occurrence that starts or ends on a joint has no lines and is dropped."""
    joints, at = [], 0
    for _, l in lines:
        at += len(l) + 1
        joints.append(at - 1)
    on = set(joints)
    good = [p for p in places("\n".join(l for _, l in lines), span) if p not in on and p + len(span) - 1 not in on]
    line = lambda p: lines[bisect_right(joints, p)][0]
    return len(good), [ref(line(p), line(p + len(span) - 1)) for p in good]


def search(span: str, lines: Lines) -> tuple[int, list[str]]:
    """The first of the three searches that finds anything."""
    if "\n" not in span:
        return in_lines(span, lines)
    n, refs = in_windows(span, lines)
    return (n, refs) if n else in_raw(span, lines)


def ground(span: str | None, lines: Lines) -> tuple[str, list[str] | None, int | None]:
    """(status, line references, occurrences); status: exact, ambiguous, nfc_equivalent, not_found or invalid_input."""
    if not span:
        return "invalid_input", None, None
    n, refs = search(span, lines)
    if not n and not span.isascii():
        n, refs = search(unicodedata.normalize("NFC", span), [(k, unicodedata.normalize("NFC", l)) for k, l in lines])
        if n == 1:
            return "nfc_equivalent", refs, n
    return "not_found" if not n else "exact" if n == 1 else "ambiguous", refs, n


def ground_column(df: DataFrame, keep: list[str], span: str, text: str, line_ref: str, out: str) -> DataFrame:
    """The kept columns with <out>_status, <out>_refs and <out>_n of each row's span in the lines its reference names."""
    def run(batch):
        for i, (s, t, r) in enumerate(zip(batch["_span"], batch["_text"], batch["_ref"])):
            lines, place = lines_of(t), line_range(r)
            bad = r is not None and place is None
            yield (*(batch[k][i] for k in keep), *(("invalid_input", None, None) if bad else ground(s, scope(lines, place) if place else lines)))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema) + f", {out}_status string, {out}_refs array<string>, {out}_n int"
    return arrow_stage(df.select(*keep, F.col(span).alias("_span"), F.col(text).alias("_text"), F.col(line_ref).alias("_ref")), schema, run)


def number_lines(c: Column) -> Column:
    return F.transform(numbered_lines(F.coalesce(c, F.lit(""))), lambda x: F.struct(x["line_number"].alias("line_number"), x["text"].alias("text")))
