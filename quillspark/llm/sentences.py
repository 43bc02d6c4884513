"""Problem 4: sentences of texts in many scripts.

Candidate boundaries are all runs of end marks outside quotation marks and brackets, inside one stanza (a block of lines
without a blank one). Each is classified by a maximum-entropy model (logistic regression) over features of its mark, of
the tokens on both sides (length, case, script, digits, whether the one before is a listed abbreviation or is common
before points and never ends a stanza) and of the space between them. It is trained on reliable boundaries. Reliable
ends are the marks at the end of a stanza and points behind a token that ends stanzas elsewhere; reliable non-ends are
points behind a token that is common and never ends one, points between digits, and ellipses. The texts are dealt into
two halves: what a token does elsewhere is taken from the other half for the label and from the own one for the feature,
so that no label is a function of its features.

Defined results: a null or blank text has no sentence; a stanza without any ending has one sentence per line; offsets
count code points, the end is exclusive; marks, closing quotes and a verse number between marks belong to the sentence
before them; text without a letter or digit behind the last mark is part of the sentence before it; the end of a stanza
is always one of a sentence.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread, written
from ..arrow import arrow_stage, partition_stage

# Abbreviations that stand before a name or a number, as written before their point.
ABBREVIATIONS = (
    "Dr Prof St Mr Mrs Ms Sr Jr No Vol Rev Sri Smt Pt Fr Mt etc vs viz "
    "डॉ प्रो पं श्री प्रा कै सौ चि स्व कु "
    "ড ডা মো শ্রী শ্ৰী অধ্যা অধ্যাপক প্রো "
    "ਡਾ ਪ੍ਰੋ ਸ ਸ਼੍ਰੀ ગો ડૉ પ્રો શ્રી ડો "
    "ଡା ଡଃ ପ୍ରା ଶ୍ରୀ ପ୍ରୋ "
    "திரு பேரா டாக் முனை "
    "డా ప్రొ శ్రీ ಡಾ ಪ್ರೊ ಶ್ರೀ ഡോ പ്രൊഫ ശ്രീ "
    "ڈاکٹر ڈاک پروف ص ڊاڪ ڊاڪٽر "
    "ᱰᱟ ᱥᱨᱤ ᱯᱨᱚ ꯗꯥ ꯁ꯭ꯔꯤ ꯄ꯭ꯔꯣ"
).split()
# Opening and closing quotation marks and brackets; the signs typed for a danda.
PAIRS = {"“": "”", "„": "”", "‘": "’", "«": "»", "「": "」", "『": "』", "(": ")", "[": "]", "{": "}", "（": "）", "【": "】"}
TYPED_DANDA = "|"
DANDAS = "।॥|꯫᱾᱿۔"

INVISIBLE = "­​⁠﻿"
HASHED = 8192
FIT_ROWS = 20_000  # bound of the labelled sample the classifier is fitted on: the most frequent feature rows
SEEN = 20  # a token this often before a point and never at a stanza's end is taken for an abbreviation
HALF_SEEN = 8  # the same within one half of the texts, for labels and features of the fit


@lru_cache(maxsize=1)
def patterns() -> tuple[re.Pattern, re.Pattern, re.Pattern]:
    """(run of end marks with a verse number, visible character, letter or digit)"""
    marks = {chr(o) for o in range(0x20, 0x10000) if regex.match(r"\p{Sentence_Terminal}", chr(o))} | set(DANDAS)
    m = "[" + "".join(re.escape(c) for c in sorted(marks)) + "]"
    hard = "[" + "".join(re.escape(c) for c in sorted(marks - {"."})) + "]"
    run = re.compile(rf"{m}+(?:\s*{hard}\s*\d+\s*{hard}+|(?<={hard})\s*\d+\s*{hard}+)?(?:\s*{hard}+)*")
    gone = "".join(re.escape(c) for c in INVISIBLE)
    return run, re.compile(rf"[^\s{gone}]"), re.compile(r"[^\W_]")


def stanza_spans(text: str) -> list[list[tuple[int, int]]]:
    """Stanzas as lists of line spans; a line's span leaves out its break."""
    visible = patterns()[1]
    out: list[list[tuple[int, int]]] = []
    open_, at = False, 0
    for line in text.split("\n"):
        end = at + len(line)
        if visible.search(text, at, end):
            if not open_:
                out.append([])
            out[-1].append((at, end))
            open_ = True
        else:
            open_ = False
        at = end + 1
    return out


QUOTE_HINT = re.compile("[\"'“„‘«「『(\\[{（【]")


def protected(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Spans inside quotation marks and brackets. An opening sign without its closing one protects nothing."""
    out, at = [], start
    while m := QUOTE_HINT.search(text, at, end):
        o, ch = m.start(), m.group()
        at = o + 1
        if ch == "'" or ch == "‘":
            if o > start and text[o - 1].isalnum() or unicodedata.category(text[o - 1 : o] or " ")[0] == "M":
                continue
        if ch in "\"'":
            c = text.find(ch, at, end)
            if ch == "'":  # an apostrophe inside a word closes nothing
                while c >= 0 and c + 1 < end and text[c + 1].isalnum():
                    c = text.find(ch, c + 1, end)
        else:
            close, depth, c = PAIRS[ch], 1, at
            while c < end:
                if text[c] == close and not (close == "’" and c + 1 < end and text[c + 1].isalpha()):
                    depth -= 1
                    if not depth:
                        break
                elif text[c] == ch:
                    depth += 1
                c += 1
            c = c if c < end else -1
        if c >= 0:
            out.append((o, c + 1))
            at = c + 1
    return out


@lru_cache(maxsize=65536)
def token_shape(token: str) -> tuple[int, str, str]:
    """(letters without marks, script of the last letter, case class of the first)"""
    letters = [c for c in token if unicodedata.category(c)[0] == "L"]
    script = unicodedata.name(letters[-1], "?").split(" ")[0] if letters else "-"
    case = "-" if not letters else "u" if letters[0].isupper() else "l" if letters[0].islower() else "n"
    return len(letters), script, case


BREAKS = re.compile(r"[\s.!?।॥|۔؟꯫᱾\"'“”‘’()\[\]{}…]")


def token_before(text: str, start: int, at: int) -> str:
    """The whole token that ends at a place."""
    white = max(text.rfind(" ", start, at), text.rfind("\n", start, at), start - 1)
    return BREAKS.split(text[white + 1 : at])[-1].strip(INVISIBLE)


def what_follows(text: str, at: int, end: int) -> str:
    """Class of the next visible character (u, l, n: letters; d: digit; p: other), 1 before an initial, and the gap."""
    m = patterns()[1].search(text, at, end)
    if not m:
        return ""
    k = m.start()
    c = text[k]
    kind = "d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "n" if c.isalpha() else "p"
    point = text.find(".", k, k + 6)
    initial = "1" if point > k and text[k:point].strip() == text[k:point] and token_shape(text[k:point])[0] == 1 else "0"
    gap = text[at:k]
    return kind + initial + ("\n" if "\n" in gap else " " if gap else "x")


ELLIPSIS, BETWEEN_DIGITS = "..", "0.0"


def candidates(text: str, start: int, end: int):
    """(mark start, run end, mark, token before, what follows, at the stanza's end) of every run of end marks of one
    stanza outside quotes and brackets. mark is the first sign of the run that is no point, or '.', '..' for an
    ellipsis, '0.0' for a point between digits; the token is given for single points."""
    run, visible, solid = patterns()
    found = list(run.finditer(text, start, end))
    if not found:
        return
    inside = protected(text, start, end)
    k = 0
    final = found[-1].start() if not solid.search(text, found[-1].end(), end) else -1
    for m in found:
        a, b = m.span()
        while k < len(inside) and inside[k][1] <= a:
            k += 1
        if k < len(inside) and inside[k][0] < a < inside[k][1]:
            continue
        marks = m.group()
        last = a >= final >= 0 or not solid.search(text, b, end)
        if hard := marks.strip(".").strip():
            yield a, b, hard[0], "", "" if last else what_follows(text, b, end), last
        elif marks.count(".") > 1:
            yield a, b, ELLIPSIS, "", "" if last else what_follows(text, b, end), last
        elif text[a - 1 : a].isdigit() and text[b : b + 1].isdigit():
            yield a, b, BETWEEN_DIGITS, "", "d0x", last
        elif (token := token_before(text, start, a)) or last:
            yield a, b, ".", token, "" if last else what_follows(text, b, end), last


class BoundaryModel:
    """Logistic regression over hashed and real features of a candidate."""

    def __init__(self, weights: np.ndarray, never: frozenset[str]) -> None:
        self.weights, self.never, self.known = weights, never, {}

    def __reduce__(self):
        return BoundaryModel, (self.weights, self.never)

    def ends(self, mark: str, token: str, follow: str) -> bool:
        key = (mark, token, follow)
        if key not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            x = features(mark, token, follow, token in self.never)
            self.known[key] = bool(sum(self.weights[i] * v for i, v in x) > 0)
        return self.known[key]


ABBREVIATION_SET = frozenset(ABBREVIATIONS)
REAL = 8
BIAS, HARD, SINGLE, BARE, LENGTH, LISTED, NEVER, DIGIT = range(HASHED, HASHED + REAL)


def _slot(s: str) -> int:
    h = 2166136261
    for b in s.encode():
        h = (h ^ b) * 16777619 & 0xFFFFFFFF
    return h % HASHED


def features(mark: str, token: str, follow: str, never: bool) -> list[tuple[int, float]]:
    """follow is empty where nothing is known of it, its last character where the gap is not."""
    out = [(BIAS, 1.0), (_slot("m" + mark), 1.0)]
    if follow:
        out += [(_slot("f" + follow[0]), 1.0), (_slot("i" + follow[1]), 1.0)]
        if len(follow) > 2:
            out.append((_slot("g" + follow[2]), 1.0))
    if mark != ".":
        return out + ([(HARD, 1.0)] if mark not in (ELLIPSIS, BETWEEN_DIGITS) else [])
    n, script, case = token_shape(token)
    return out + [
        (SINGLE, float(n <= 1)), (BARE, float(n == len(token) == 1)), (LENGTH, min(n, 8) / 8), (LISTED, float(token in ABBREVIATION_SET)),
        (NEVER, float(never)), (DIGIT, float(token[-1:].isdigit())), (_slot("t" + token), 1.0), (_slot("s" + script), 1.0), (_slot("c" + case), 1.0),
    ]


def fit_boundaries(tables: list[tuple[DataFrame, str]]) -> BoundaryModel:
    """Fit the classifier. Counts of (mark, token, what follows, at the stanza's end) cover all texts; the driver gets the
    FIT_ROWS most frequent of them to fit on, and from all of them the tokens that are common before points and never end
    a stanza. A stanza's last mark is given the first sign of the next stanza as what follows it."""

    def counted(feed):
        n: Counter = Counter()
        for batch in feed:
            for text in next(iter(batch.values())):
                if not text:
                    continue
                half = zlib.crc32(text.encode("utf-8", "surrogatepass")) & 1
                stanzas = [(lines[0][0], lines[-1][1]) for lines in stanza_spans(text)]
                for k, (s, e) in enumerate(stanzas):
                    for _, b, mark, token, follow, last in candidates(text, s, e):
                        if last:
                            follow = what_follows(text, b, stanzas[k + 1][1])[:2] if k + 1 < len(stanzas) else ""
                        n[(mark, token, follow, last, half)] += 1
            if len(n) > 200_000:
                yield from ((*k, v) for k, v in n.items())
                n.clear()
        yield from ((*k, v) for k, v in n.items())

    parts = None
    for df, col in tables:
        p = partition_stage(df.select(col), "mark string, token string, follow string, final boolean, half int, n long", counted)
        parts = p if parts is None else parts.unionByName(p)
    counts = written(parts.groupBy("mark", "token", "follow", "final", "half").agg(F.sum("n").alias("n")), "points")
    rows = counts.orderBy(F.desc("n"), "mark", "token", "follow", "final", "half").limit(FIT_ROWS).collect()
    inner = lambda h: F.sum(F.when(~F.col("final") & (F.lit(True) if h is None else F.col("half") == h), F.col("n")).otherwise(0))
    ended = lambda h: F.bool_or(F.col("final") & (F.col("half") == h))
    by_token = counts.where("mark = '.' and token <> ''").groupBy("token").agg(
        inner(None).alias("i"), inner(0).alias("i0"), inner(1).alias("i1"), ended(0).alias("e0"), ended(1).alias("e1"))
    known = by_token.where(f"(i >= {SEEN} and not (e0 or e1)) or (i0 >= {HALF_SEEN} and not e0) or (i1 >= {HALF_SEEN} and not e1)").collect()
    never = frozenset(r.token for r in known if r.i >= SEEN and not (r.e0 or r.e1))
    half_never = [{r.token for r in known if r[f"i{h}"] >= HALF_SEEN and not r[f"e{h}"]} for h in (0, 1)]
    half_ends = [{r.token for r in rows if r.final and r.half == h and r.mark == "."} for h in (0, 1)]
    seen: Counter = Counter()
    for r in rows:
        other = 1 - r.half
        if r.mark in (ELLIPSIS, BETWEEN_DIGITS):
            y = None if r.final else 0.0
        elif r.final:
            y = 1.0
        elif r.mark != ".":
            y = None  # nothing is known of a mark inside a stanza
        else:
            y = 0.0 if r.token in half_never[other] else 1.0 if r.token in half_ends[other] else None
        if y is not None:
            seen[(tuple(features(r.mark, r.token, r.follow, r.token in half_never[r.half])), y)] += 1 + np.log(r.n)
    return BoundaryModel(_logistic([x for x, _ in seen], np.array([y for _, y in seen]), np.array(list(seen.values()))), never)


def _logistic(xs: list, ys: np.ndarray, ws: np.ndarray, rounds: int = 300, l2: float = 1e-3) -> np.ndarray:
    """Maximum-entropy weights by full-batch gradient steps with momentum, over distinct feature rows with their weights;
    the fit starts from those of a prior, which stand where there are no rows."""
    w = np.zeros(HASHED + REAL)
    w[BIAS], w[HARD], w[BARE], w[LISTED], w[NEVER], w[_slot("m" + ELLIPSIS)], w[_slot("m" + BETWEEN_DIGITS)] = 2.0, 4.0, -6.0, -6.0, -4.0, -8.0, -8.0
    if not xs or ys.min() == ys.max():
        return w
    used = np.array(sorted({j for f in xs for j, _ in f}))
    place = {j: k for k, j in enumerate(used.tolist())}
    row = np.array([i for i, f in enumerate(xs) for _ in f])
    col = np.array([place[j] for f in xs for j, _ in f])
    val = np.array([v for f in xs for _, v in f])
    v, step = w[used], np.zeros(len(used))
    ws = ws / ws.sum()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(row, val * v[col], len(xs)), -30, 30)))
        g = np.bincount(col, val * ((p - ys) * ws)[row], len(used)) + l2 * 0.01 * v
        step = 0.9 * step - 2.0 * g
        v = v + step
    w[used] = v
    return w


def sentence_spans(text: str | None, model: BoundaryModel) -> list[tuple[int, int]]:
    if not text:
        return []
    visible, solid = patterns()[1:]
    out = []
    for lines in stanza_spans(text):
        s, e = lines[0][0], lines[-1][1]
        cuts = [b for _, b, mark, token, follow, last in candidates(text, s, e) if last or model.ends(mark, token, follow)]
        if not cuts:
            pieces = lines
        else:
            if cuts[-1] != e:
                cuts.append(e)
            pieces = list(zip([s, *cuts[:-1]], cuts))
        spans: list[tuple[int, int]] = []
        for a, b in pieces:
            m = visible.search(text, a, b)
            if not m:
                continue
            a = m.start()
            while not visible.match(text[b - 1]):
                b -= 1
            if spans and not solid.search(text, a, b):
                spans[-1] = (spans[-1][0], b)
            else:
                spans.append((a, b))
        out += spans
    return out


def sentences(df: DataFrame, id_col: str, text_col: str, model: BoundaryModel) -> DataFrame:
    """(<id>, char_start, char_end), one row per sentence of every text."""

    def split(batch):
        for rid, text in zip(batch[id_col], batch[text_col]):
            for a, b in sentence_spans(text, model):
                yield rid, a, b

    kind = df.schema[id_col].dataType.simpleString()
    return arrow_stage(spread(df.select(id_col, text_col)), f"{id_col} {kind}, char_start long, char_end long", split)
