"""Text expressions shared by the operators: white space, line endings, counting, markers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the white space of Unicode, in a class that Java and RE2 read alike.
WS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def unix_lines(c: Column) -> Column:
    """Line endings as LF; nothing is stripped."""
    return F.regexp_replace(c, "\r\n?", "\n")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def raw_lines(c: Column) -> Column:
    return F.split(unix_lines(c), "\n")


def numbered_lines(c: Column) -> Column:
    """array<struct<position, line_number, text>> of the lines that are not blank; numbers run from 1, positions from 0."""
    every = F.transform(raw_lines(c), lambda l, i: F.struct(i.alias("position"), l.alias("text")))
    kept = F.filter(every, lambda x: strip(x["text"]) != "")
    return F.transform(kept, lambda x, i: F.struct(x["position"].alias("position"), (i + 1).alias("line_number"), x["text"].alias("text")))


def stanza_starts(lines: Column) -> Column:
    """Positions at which a stanza starts: the first numbered line and each behind a blank one."""
    pos = F.transform(lines, lambda x: x["position"])
    return F.filter(pos, lambda p, i: (i == 0) | (F.get(pos, i - 1) < p - 1))


def has_word(text: Column, word: str) -> Column:
    """word in lowered text, not within other ASCII letters."""
    return text.rlike(rf"(^|[^a-z]){word}([^a-z]|$)")


def words_found(text: Column, words: tuple[str, ...]) -> Column:
    return F.array_compact(F.array(*(F.when(has_word(text, w), F.lit(w)) for w in words)))


def presence_key(c: Column) -> Column:
    """Lower case, white space runs as one space, outer space gone."""
    return strip(F.regexp_replace(F.lower(c), f"{WS}+", " "))


def term_present(term: Column, text: Column) -> Column:
    """The term, or the term without a trailing gloss in brackets, occurs in the text, with or without spaces."""
    t, x = presence_key(term), presence_key(text)
    bare = strip(F.regexp_replace(t, r"\([\x00-\x7f]*\)$", ""))
    flat = lambda c: F.replace(c, F.lit(" "), F.lit(""))
    hit = lambda a: (a != "") & (x.contains(a) | flat(x).contains(flat(a)))
    return F.coalesce(hit(t) | hit(bare), F.lit(False))


def parse_line_ref(ref: Column) -> Column:
    """struct<start, end> of L<n> or L<n>-L<m>; null where malformed, reversed or with leading zeros."""
    r = strip(ref)
    shape = r.rlike(r"^L[1-9][0-9]{0,8}(-L[1-9][0-9]{0,8})?$")
    start = F.regexp_extract(r, r"^L([0-9]+)", 1).try_cast("int")
    end = F.coalesce(F.regexp_extract(r, r"-L([0-9]+)$", 1).try_cast("int"), start)
    return F.when(shape & (start <= end), F.struct(start.alias("start"), end.alias("end")))


def line_ref_status(ref: Column, n_lines: Column) -> Column:
    p = parse_line_ref(ref)
    return F.when(ref.isNull(), "absent").when(p.isNull(), "malformed").when(p["end"] > n_lines, "out_of_range").otherwise("valid")
