"""Problem 6: one consistent form for text that looks the same.

Look-alike classes are the components of a union-find over strings and code points. Its edges are

* a code point and its canonical decomposition, marks in canonical order; for Hangul both follow from a formula,
* a full-width, half-width, no-break or presentation form and its plain form, a space of another width and the space,
* an invisible code point and the empty string,
* the cross-script look-alikes listed below, also under every combining mark.

Every class has one plain member, which all its members reach by decomposing them and replacing each code point by its
class's plain one. The representative of a class is its most frequent member in the corpus (ties: the shorter, then the
smaller string, the empty string first). A text is brought to plain members first; an Aho-Corasick automaton then
rewrites these, left to right and longest first, to the representatives. The plain form of a representative is the
member it stands for, so rewriting is idempotent by construction and needs no second pass.

Defined results: a null stays null, an empty text stays empty, rewriting is idempotent, and ties never depend on row order.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections import Counter
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread
from ..arrow import arrow_stage, partition_stage

# Letters of other scripts that are drawn like a Latin letter, and Arabic letters drawn alike.
CYRILLIC_AS_LATIN = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P",
    "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ѵ": "V", "Ү": "Y", "Ԛ": "Q", "Ԝ": "W", "Ԍ": "G", "Ӏ": "I",
    "а": "a", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѵ": "v",
    "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ӏ": "l",
}
GREEK_AS_LATIN = {
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J", "ο": "o", "ν": "v", "ρ": "p", "ϲ": "c", "ϳ": "j", "ι": "ı",
}
ARMENIAN_AS_LATIN = {"Տ": "S", "Լ": "L", "Օ": "O", "Ս": "U", "օ": "o", "ս": "u", "հ": "h", "ո": "n", "ց": "g", "զ": "q", "յ": "j"}
CHEROKEE_AS_LATIN = {
    "Ꭺ": "A", "Ᏼ": "B", "Ꮯ": "C", "Ꭰ": "D", "Ꭼ": "E", "Ꮐ": "G", "Ꮋ": "H", "Ꭻ": "J", "Ꮶ": "K", "Ꮮ": "L", "Ꮇ": "M",
    "Ꮲ": "P", "Ꭱ": "R", "Ꮪ": "S", "Ꭲ": "T", "Ꮩ": "V", "Ꮃ": "W", "Ꮓ": "Z",
}
LATIN_ALIKE = {"ɑ": "a", "ɡ": "g", "ı": "i"}
ARABIC_ALIKE = {"ي": "ی", "ى": "ی", "ك": "ک"}
LOOK_ALIKE = CYRILLIC_AS_LATIN | GREEK_AS_LATIN | ARMENIAN_AS_LATIN | CHEROKEE_AS_LATIN | LATIN_ALIKE | ARABIC_ALIKE
INVISIBLE = (
    "­", "͏", "؜", "᠎", "​", "‎", "‏", "‪", "‫", "‬", "‭",
    "‮", "⁠", "⁡", "⁢", "⁣", "⁤", "⁦", "⁧", "⁨", "⁩", "﻿",
)
SAME_LOOK_TAGS = {"<wide>", "<narrow>", "<noBreak>", "<isolated>", "<initial>", "<medial>", "<final>", "<font>"}


def _points(hexes: str) -> str:
    return "".join(chr(int(x, 16)) for x in hexes.split())


@lru_cache(maxsize=1)
def unicode_edges() -> tuple[dict[str, str], dict[str, str]]:
    """(code point -> canonical decomposition, code point -> plain form), from the Unicode database. Hangul is left to
    the formula of canonical decomposition."""
    canon, plain = {}, {}
    for o in range(0x80, 0x30000):
        if 0xAC00 <= o <= 0xD7A3:
            continue
        ch = chr(o)
        d = unicodedata.decomposition(ch)
        if d.startswith("<"):
            tag, _, rest = d.partition(" ")
            if tag in SAME_LOOK_TAGS:
                plain[ch] = _points(rest)
        elif d:
            canon[ch] = unicodedata.normalize("NFD", ch)
        if ch not in plain and unicodedata.category(ch) == "Zs":
            plain[ch] = " "
    return canon, plain


@lru_cache(maxsize=1)
def steps() -> dict[str, str]:
    """Code point -> the string one edge nearer to the plain member of its class. No chain of steps comes back."""
    return {ch: p for ch, p in unicode_edges()[1].items() if p != ch} | LOOK_ALIKE | {c: "" for c in INVISIBLE}


@lru_cache(maxsize=1 << 16)
def plain_char(ch: str) -> str:
    d = unicodedata.normalize("NFD", ch)
    if d != ch:
        return "".join(map(plain_char, d))
    near = steps().get(ch)
    return ch if near is None else "".join(map(plain_char, near))


def plain_member(text: str) -> str:
    """The plain member of a string's class, marks in canonical order."""
    return unicodedata.normalize("NFD", "".join(map(plain_char, text)))


class UnionFind:
    """Disjoint sets of strings; the root of a set is arbitrary, classes() gives the sets themselves."""

    def __init__(self) -> None:
        self.up: dict[str, str] = {}

    def find(self, x: str) -> str:
        root = x
        while self.up.setdefault(root, root) != root:
            root = self.up[root]
        while self.up[x] != root:
            self.up[x], x = root, self.up[x]
        return root

    def union(self, a: str, b: str) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def classes(self) -> list[set[str]]:
        out: dict[str, set[str]] = {}
        for x in list(self.up):
            out.setdefault(self.find(x), set()).add(x)
        return [c for c in out.values() if len(c) > 1]


def look_alike_classes(members: set[str]) -> list[set[str]]:
    """Classes of the strings and code points that look the same, each with its plain member."""
    sets = UnionFind()
    for m in members:
        sets.union(m, plain_member(m))
    return sets.classes()


def representatives(counts: dict[str, int]) -> dict[str, str]:
    """Member -> representative for every class member that is not its own. counts: of code points and of strings; the
    counts of Hangul syllables and of their decompositions are one pair for the whole block, under HANGUL."""
    members = set(counts) - set(HANGUL)
    canon = unicode_edges()[0]
    members |= {ch for ch in canon if plain_member(ch) in members}
    out = {}
    for cls in look_alike_classes(members):
        best = "" if "" in cls else min(cls, key=lambda x: (-counts.get(x, 0), len(x), x))
        out |= {m: best for m in cls if m != best and m}
    if counts.get(HANGUL[1], 0) > counts.get(HANGUL[0], 0):
        out[HANGUL[0]] = HANGUL[1]
    return out


HANGUL = ("hangul:syllable", "hangul:jamo")
JAMO = re.compile("[\u1100-\u11ff]+")
SYLLABLE = re.compile("[\uac00-\ud7a3]")


class Rewriter:
    """Texts by plain members, then greedy, leftmost-longest rewriting of these to representatives."""

    def __init__(self, mapping: dict[str, str]) -> None:
        self.mapping = mapping
        self.pairs = {m: r for m, r in mapping.items() if m == plain_member(m) and m not in HANGUL}
        self.single = {m: r for m, r in self.pairs.items() if len(m) == 1}
        self.strings = {m: r for m, r in self.pairs.items() if len(m) > 1}
        self.composed = HANGUL[0] not in mapping
        first = {m[0] for m in self.strings}
        self.ascii_stays = not any(m.isascii() for m in self.single)
        self.table = _PlainTable()
        self.last = str.maketrans(self.single) if self.single else None
        self.auto = None
        if self.strings:
            self.auto = ahocorasick.Automaton()
            for m, r in self.pairs.items():
                self.auto.add_word(m, (len(m), r))
            self.auto.make_automaton()
            second = {m[1] for m in self.strings}
            self.near = re.compile("[" + "".join(map(re.escape, sorted(first))) + "][" + "".join(map(re.escape, sorted(second))) + "]")

    def __reduce__(self):
        return Rewriter, (self.mapping,)

    def __call__(self, text: str | None) -> str | None:
        if not text or text.isascii() and self.ascii_stays:
            return text
        text = unicodedata.normalize("NFD", text).translate(self.table)
        if not unicodedata.is_normalized("NFD", text):  # what was between two marks is gone
            text = unicodedata.normalize("NFD", text)
        if self.auto is not None and self.near.search(text):
            out, at = [], 0
            for end, (n, r) in self.auto.iter_long(text):
                out.append(text[at : end - n + 1])
                out.append(r)
                at = end + 1
            out.append(text[at:])
            text = "".join(out)
        elif self.last:
            text = text.translate(self.last)
        return JAMO.sub(lambda m: unicodedata.normalize("NFC", m.group()), text) if self.composed and JAMO.search(text) else text


class _PlainTable(dict):
    """Plain members by code point, filled as code points are met."""

    def __missing__(self, o: int):
        p = plain_char(chr(o))
        self[o] = o if p == chr(o) else p
        return self[o]


@lru_cache(maxsize=1)
def _composites() -> dict[str, list[str]]:
    """Mark -> the canonical decompositions with it behind their first letter."""
    out: dict[str, set[str]] = {}
    for d in unicode_edges()[0].values():
        if len(d) > 1:
            out.setdefault(d[1], set()).add(d)
    return {m: sorted(ds) for m, ds in out.items()}


def count_members(texts: list[str]) -> Counter:
    """Code points, and canonical decompositions as strings, in texts; Hangul by the block."""
    joined = "\n".join(t for t in texts if t)
    n = Counter(joined)
    if joined.isascii():
        return n
    present = set(n)
    for mark in present & _composites().keys():
        for d in _composites()[mark]:
            if d[0] in present and (hits := joined.count(d)):
                n[d] = hits
    for name, pattern, inside in ((HANGUL[0], SYLLABLE, "\uac00\ud7a3"), (HANGUL[1], JAMO, "\u1100\u11ff")):
        if any(inside[0] <= c <= inside[1] for c in present):
            n[name] = len(pattern.findall(joined))
            for c in [c for c in n if len(c) == 1 and inside[0] <= c <= inside[1]]:
                del n[c]
    return n


def fit_representatives(tables: list[tuple[DataFrame, list[str]]]) -> dict[str, str]:
    """Representatives from the counts over all texts of the given columns. What reaches the driver is bounded by
    the alphabet: code points and canonical decompositions that occur."""
    total: Counter = Counter()
    for df, cols in tables:
        def counted(feed):
            n: Counter = Counter()
            for batch in feed:
                for texts in batch.values():
                    n.update(count_members(texts))
            return n.items()

        part = partition_stage(df.select(*cols), "member string, n long", counted)
        for r in part.groupBy("member").agg(F.sum("n").alias("n")).collect():
            total[r.member] += r.n
    return representatives(total)


def normal_form(df: DataFrame, cols: list[str], mapping: dict[str, str], suffix: str = "_form") -> DataFrame:
    """df with <col><suffix> for each column of cols: its consistent form (null for null)."""
    rw = Rewriter(mapping)
    keep = df.schema
    schema = type(keep)(list(keep.fields))
    for c in cols:
        schema = schema.add(c + suffix, "string")
    names = df.columns

    def form(batch):
        forms = [[rw(t) for t in batch[c]] for c in cols]
        return zip(*(batch[n] for n in names), *forms)

    return arrow_stage(df, schema, form)


def look_alike_pairs(df: DataFrame, id_col: str, cols: list[str], mapping: dict[str, str]) -> DataFrame:
    """Pairs (field_name, <id>_a, <id>_b), the smaller id first, whose values share a form but not their characters.

    The values of a form that has several are paired as values, each once, and only then are the records of each value
    put beside them: records that are merely equal never meet, and every joined row is a row of the result or its mirror."""
    rw = Rewriter(mapping)

    def keyed(batch):
        for i, rid in enumerate(batch[id_col]):
            for c in cols:
                t = batch[c][i]
                if t and rid is not None and t.strip():
                    form = rw(t).replace("\r\n", "\n")
                    if form.strip():
                        yield c, rid, *(hashlib.md5(x.encode("utf-8", "surrogatepass")).digest() for x in (form, t))

    id_type = df.schema[id_col].dataType.simpleString()
    long = arrow_stage(spread(df.select(id_col, *cols)), f"field_name string, id {id_type}, form binary, raw binary", keyed)
    values = long.groupBy("field_name", "form", "raw").agg(F.lit(1).alias("one")).drop("one")
    mixed = values.groupBy("field_name", "form").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).where("lo <> hi").select("field_name", "form")
    few = values.join(mixed, ["field_name", "form"], "left_semi")
    pairs = few.withColumnRenamed("raw", "raw_a").join(few.withColumnRenamed("raw", "raw_b"), ["field_name", "form"]).where("raw_a <> raw_b").drop("form")
    side = lambda k: long.select("field_name", F.col("raw").alias(f"raw_{k}"), F.col("id").alias(k))
    return (
        pairs.join(side("a"), ["field_name", "raw_a"]).join(side("b"), ["field_name", "raw_b"]).where("a < b")
        .select("field_name", F.col("a").alias(f"{id_col}_a"), F.col("b").alias(f"{id_col}_b")).distinct()
    )
