"""Problem 10: text that was decoded in a wrong encoding.

Noisy channel: the text that was meant is drawn from the corpus, by the frequencies of its words with signs beyond ASCII
and, for other words, of its characters; the channel encodes a span as UTF-8 or in a single-byte encoding and decodes it
in another one, up to twice, and may lose bytes, which then stand as U+FFFD.

Every span of letters and characters that can be images of bytes above 0x7F is a byte lattice: a character may be kept,
or several be read as the bytes of one, byte by byte, a lost byte being a wildcard for every byte it may have been. A
Viterbi search runs through it under the word frequencies: its states are the encoding (entering one costs CHANNEL nats)
and the place within a word, which is a prefix of words of the corpus, or an unknown word, scored by its characters.
Wildcards take whatever characters fit the bytes that are left, so nothing is enumerated or cut off. Misreadings between
single-byte encodings are decided by the frequencies of whole words. Copies of a damaged text do not make it more likely:
frequencies count equal texts once, and single-byte misreadings are compared both ways.

Defined results: null and blank texts are undamaged; a text with U+FFFD is damaged even where nothing can be restored;
accents, rare signs and other scripts alone are no damage; ties keep the text as it is.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import arrow_stage, partition_stage
from ..session import spread, written
from .words import words

# Encodings in which bytes are wrongly read, and in which they may have been meant.
READ_AS = ("cp1252", "latin-1", "cp437", "cp1251", "mac_roman", "cp850", "koi8-r", "cp866", "cp1250", "iso8859-15")
MEANT = ("cp1252", "mac_roman", "cp437", "cp1251", "koi8-r")
LOST = "�"
CHANNEL = 7.0  # nats for entering a wrong encoding
WORD_RATIO = 15.0  # times a restored word must be more frequent than the word read
LEAST_WORDS = 4
WORD_SHARE = 5e-6  # words beyond ASCII with less than this share of them are unknown words, so at most 200,000 reach the driver
SHORTEST = 2  # letters of a word the search knows; shorter ones are scored by their characters


@lru_cache(maxsize=1)
def byte_tables() -> dict[str, dict[str, int]]:
    """encoding -> character -> byte above 0x7F; cp1252 reads its five undefined bytes as C1 controls."""
    out = {}
    for enc in READ_AS:
        t = {}
        for b in range(0x80, 0x100):
            try:
                t[bytes([b]).decode(enc)] = b
            except UnicodeDecodeError:
                t[chr(b)] = b
        out[enc] = t
    return out


@lru_cache(maxsize=1)
def image_span() -> re.Pattern:
    """Letters of ASCII and images of bytes in a row, one image at least."""
    chars = {c for t in byte_tables().values() for c in t} | {LOST}
    inner = "".join(re.escape(c) for c in sorted(chars))
    return re.compile(f"[A-Za-z]*[{inner}][A-Za-z{inner}]*")


@lru_cache(maxsize=1)
def lead_pair() -> re.Pattern:
    """A lead byte of UTF-8 and a byte that continues it, both read in one encoding, or a lost byte."""
    ways = []
    for t in byte_tables().values():
        lead = "".join(re.escape(c) for c, b in sorted(t.items()) if 0xC2 <= b <= 0xF4)
        more = "".join(re.escape(c) for c, b in sorted(t.items()) if b < 0xC0)
        ways.append(f"[{lead}][{more}]")
    return re.compile("|".join([LOST, *ways]))


@lru_cache(maxsize=1)
def odd_token() -> re.Pattern:
    """Words with a letter or sign beyond ASCII that may stand for a byte."""
    chars = {c for t in byte_tables().values() for c in t if ord(c) > 0x7F} | {LOST}
    inner = "".join(re.escape(c) for c in sorted(chars) if c not in "“”‘’…—–«»„‚¿¡\xa0")
    return re.compile(f"[A-Za-z{inner}]*[{inner}][A-Za-z{inner}]*")


@lru_cache(maxsize=100_000)
def one_script(w: str) -> bool:
    """Two or more Latin letters and nothing else: what a single-byte encoding of the West was meant for."""
    return len(w) >= 2 and all(c.isalpha() and unicodedata.name(c, "").startswith("LATIN") for c in w)


@lru_cache(maxsize=1 << 16)
def in_word(c: str) -> bool:
    k = unicodedata.category(c)
    return k[0] in "LM" or k == "Nd"


INSIDE = "\0"  # the place within an unknown word


class Channel:
    """Log-frequencies of characters and of words beyond ASCII. chars and words count rows, once_chars and once_words
    distinct texts; word_total is that of all words beyond ASCII by distinct texts."""

    def __init__(self, chars: dict[str, int], words: dict[str, int], once_chars: dict[str, int], once_words: dict[str, int], word_total: int) -> None:
        self.chars, self.words, self.once_chars, self.once_words, self.word_total = chars, words, once_chars, once_words, word_total
        self.total = sum(once_chars.values()) + 1
        self.floor = math.log(0.05 / (sum(chars.values()) + 1))
        self.memo: dict[str, tuple[str, frozenset]] = {}
        self.tokens: dict[str, tuple[str, str]] = {}
        self.fits: dict[tuple, list[str]] = {}
        self.alphabet = [(c.encode(), c) for c, n in sorted(chars.items()) if n >= LEAST_WORDS and not c.isascii() and c != LOST and not 0xD800 <= ord(c) < 0xE000]
        self.listed = sorted(w for w in once_words if len(w) >= SHORTEST and all(map(in_word, w)) and not lead_pair().search(w))
        self.lasting = {w: math.log(once_words[w] / max(word_total, 1)) for w in self.listed}
        self.heads: dict[str, bool] = {}

    def __reduce__(self):
        return Channel, (self.chars, self.words, self.once_chars, self.once_words, self.word_total)

    def logp(self, c: str) -> float:
        n = self.once_chars.get(c, 0)
        return math.log(n / self.total) if n else self.floor

    def starts_word(self, prefix: str) -> bool:
        got = self.heads.get(prefix)
        if got is None:
            if len(self.heads) > 500_000:
                self.heads.clear()
            i = bisect_left(self.listed, prefix)
            got = self.heads[prefix] = i < len(self.listed) and self.listed[i].startswith(prefix)
        return got

    def next_letters(self, prefix: str):
        """Characters beyond ASCII with which a word of the corpus goes on."""
        i, n = bisect_left(self.listed, prefix), len(prefix)
        while i < len(self.listed) and self.listed[i].startswith(prefix):
            if len(self.listed[i]) == n:
                i += 1
                continue
            c = self.listed[i][n]
            if not c.isascii():
                yield c
            i = bisect_left(self.listed, prefix + chr(ord(c) + 1)) if ord(c) < 0x10FFFF else len(self.listed)

    # --- UTF-8 read in a single-byte encoding -------------------------------------------------------------------
    def sequence(self, run: str, at: int, enc: str, least: int = LEAST_WORDS) -> tuple[int, list[str]] | None:
        """(characters read, characters that may be meant): the UTF-8 sequence that starts at a place of a span read in
        enc. Lost bytes may be any byte of a sequence that the encoding cannot show."""
        table = byte_tables()[enc]
        lead = table.get(run[at])
        if lead is None or not 0xC2 <= lead <= 0xF4:
            return None
        size = 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        if at + size > len(run):
            return None
        read: list[int | None] = [lead]
        for c in run[at + 1 : at + size]:
            b = None if c == LOST else table.get(c, 0)
            if b is not None and not 0x80 <= b < 0xC0:
                return None
            read.append(b)
        if None not in read:
            try:
                c = bytes(read).decode("utf-8")
            except UnicodeDecodeError:
                return None
            return (size, [c]) if self.chars.get(c, 0) >= least else None
        lost = losable(enc)
        key = (lost, *read)
        if key not in self.fits:
            self.fits[key] = [c for raw, c in self.alphabet if len(raw) == size and all(x == y or y is None and x in lost for x, y in zip(raw, read))]
        return (size, self.fits[key]) if self.fits[key] else None

    def moved(self, value: float, place: str, c: str):
        """(value, place) after one more character, in each way to read it as a word."""
        if in_word(c):
            if place != INSIDE and self.starts_word(place + c):
                yield value, place + c
            if place in ("", INSIDE):
                yield value + self.logp(c), INSIDE
        elif place in ("", INSIDE):
            yield value + self.logp(c), ""
        elif place in self.lasting:
            yield value + self.lasting[place] + self.logp(c), ""

    def viterbi(self, run: str) -> tuple[str, frozenset]:
        """(text meant, encodings wrongly read) of a span."""
        got = self.memo.get(run)
        if got is None:
            if len(self.memo) > 50_000:
                self.memo.clear()
            got = self.memo[run] = self._viterbi(run)
        return got

    def _viterbi(self, run: str) -> tuple[str, frozenset]:
        n = len(run)
        arcs: list[list[tuple[str, int, list[str]]]] = [[] for _ in range(n)]
        for enc in READ_AS:
            table = byte_tables()[enc]
            for i, c in enumerate(run):
                if c in table and (found := self.sequence(run, i, enc)):
                    arcs[i].append((enc, *found))
        if not any(arcs) and LOST not in run:
            return run, frozenset()
        some = run.strip(LOST) != ""  # of a span that is lost as a whole nothing is known
        best: list[dict[tuple[str, str], tuple]] = [{} for _ in range(n + 1)]
        best[0][("", "")] = (0.0, None, "")

        def reach(at: int, state: tuple[str, str], value: float, frm: tuple, out: str) -> None:
            old = best[at].get(state)
            if old is None or value > old[0] + 1e-9:
                best[at][state] = (value, frm, out)

        for i, c in enumerate(run):
            here = best[i]
            top: dict[str, float] = {}
            for (_, place), (value, _, _) in here.items():
                top[place] = max(top.get(place, -math.inf), value)
            lost = 0
            while some and i + lost < n and run[i + lost] == LOST:
                lost += 1
            for (enc, place), (value, _, _) in list(here.items()):
                if value < top[place] - CHANNEL - 1e-9:
                    continue  # coming from the best state of this place and entering the encoding anew is better
                frm = (i, (enc, place))
                if c == LOST:
                    if place in ("", INSIDE):
                        reach(i + 1, ("", ""), value - 16.0, frm, c)
                    elif place in self.lasting:
                        reach(i + 1, ("", ""), value + self.lasting[place] - 16.0, frm, c)
                    if place != INSIDE and lost and (place or i + lost < n):  # no word is read from lost bytes alone
                        for x in self.next_letters(place):
                            for size in {1, len(x.encode())}:
                                if size <= lost:
                                    reach(i + size, ("lost bytes", place + x), value - (0 if enc == "lost bytes" else CHANNEL), frm, x)
                else:
                    for v, p in self.moved(value, place, c):
                        reach(i + 1, (enc if c.isascii() else "", p), v, frm, c)
                for how, size, chars in arcs[i]:
                    paid = value - (0 if how == enc else CHANNEL)
                    for x in chars:
                        for v, p in self.moved(paid, place, x):
                            reach(i + size, (how, p), v, frm, x)
        ended = {s: v[0] + (0 if s[1] in ("", INSIDE) else self.lasting[s[1]]) for s, v in best[n].items() if s[1] in ("", INSIDE) or s[1] in self.lasting}
        kept = "".join(run)
        at, state = n, max(ended, key=ended.get)
        parts, used, left = [], set(), []
        while at > 0:
            _, (at, before), out = best[at][state]
            parts.append(out)
            if state[0] and not out.isascii():
                used.add(state[0])
            elif not state[0]:
                left.append(out)
            state = before
        # A span that was misread was misread as a whole: no letter that stands for a byte may be left over, but for
        # Latin ones, which accents give.
        tables = [byte_tables()[e] for e in used if e in READ_AS]
        if any(c.isalpha() and not c.isascii() and any(c in t for t in tables) and not unicodedata.name(c, "").startswith("LATIN") for c in left):
            return kept, frozenset()
        if not used:
            return kept, frozenset()
        text = "".join(reversed(parts))
        again, more = self.viterbi(text) if text != run and lead_pair().search(text) else (text, frozenset())
        return again, frozenset(used) | more

    def twice(self, run: str) -> tuple[str, frozenset]:
        """Text that was misread twice: the inner reading is rare itself, so both steps are tried as one."""
        for enc in ("cp1252", "latin-1"):
            table = byte_tables()[enc]
            if not all(c in table or c == LOST or c.isascii() for c in run):
                continue
            inner, i, ok = [], 0, False
            while i < len(run):
                got = self.sequence(run, i, enc, 0)
                if got:
                    inner.append(max(got[1], key=self.logp))
                    i += got[0]
                    ok = True
                else:
                    inner.append(run[i])
                    i += 1
            if ok:
                mid = "".join(inner)
                text, used = self.viterbi(mid)
                if used:
                    gain = sum(map(self.logp, text)) - 2 * CHANNEL - sum(-16.0 if c == LOST else self.logp(c) for c in run)
                    if gain > 0:
                        return text, used | {enc}
        return run, frozenset()

    # --- words --------------------------------------------------------------------------------------------------
    def word(self, token: str) -> tuple[str, str]:
        """(word meant, encoding wrongly read or '')."""
        got = self.tokens.get(token)
        if got is None:
            if len(self.tokens) > 100_000:
                self.tokens.clear()
            got = self.tokens[token] = self._word(token)
        return got

    def seen(self, word: str, counts: dict[str, int]) -> int:
        return max(counts.get(word, 0), counts.get(word.lower(), 0))

    def likelier(self, word: str, read: str) -> bool:
        """Whether a word is so much more frequent than the word read, by rows or by distinct texts."""
        return any(self.seen(word, n) >= LEAST_WORDS and self.seen(word, n) > WORD_RATIO * (self.seen(read, n) + 0.2) for n in (self.words, self.once_words))

    def _word(self, token: str) -> tuple[str, str]:
        best, how = None, ""
        for enc in READ_AS:
            try:
                raw = token.encode(enc)
            except UnicodeEncodeError:
                continue
            for meant in MEANT:
                if meant == enc:
                    continue
                try:
                    w = raw.decode(meant)
                except UnicodeDecodeError:
                    continue
                n = self.seen(w, self.words)
                if w != token and one_script(w) and self.likelier(w, token) and (best is None or n > best[1]):
                    best, how = (w, n), enc
        return (best[0], how) if best else (token, "")

    def repair(self, text: str) -> tuple[str, set[str]]:
        """(restored text, encodings wrongly read); U+FFFD that stays is reported as 'lost'."""
        if text.isascii():
            return text, set()
        used: set[str] = set()

        def run(m: re.Match) -> str:
            span = m.group()
            if not lead_pair().search(span):
                return span
            out, how = self.viterbi(span)
            if not how:
                out, how = self.twice(span)
            used.update(how)
            return out

        def token(m: re.Match) -> str:
            out, how = self.word(m.group())
            if how:
                used.add(how)
            return out

        text = image_span().sub(run, text)
        text = odd_token().sub(token, text)
        if LOST in text:
            used.add("lost")
        return text, used


@lru_cache(maxsize=16)
def losable(enc: str) -> frozenset[int]:
    """Bytes that are lost when read in an encoding: those it has no character for, or any, where it has one for each."""
    gone = set()
    for b in range(0x80, 0x100):
        try:
            bytes([b]).decode(enc)
        except UnicodeDecodeError:
            gone.add(b)
    return frozenset(gone or range(0x80, 0x100))


def fit_channel(tables: list[tuple[DataFrame, str]]) -> Channel:
    """Counts over all texts, by rows and by distinct texts. The driver gets characters (an alphabet) and the words beyond
    ASCII that occur LEAST_WORDS times or more and make up WORD_SHARE of all, 1 / WORD_SHARE at most."""

    def counted(feed):
        chars, found = (Counter(), Counter()), (Counter(), Counter())  # by distinct texts, by rows beyond one a text

        def rows(kind, counts):
            return ((kind, x, n, n + counts[1][x]) for x, n in counts[0].items())

        for batch in feed:
            for t, copies in zip(batch["text"], batch["copies"]):
                own = Counter(t)
                chars[0].update(own)
                odd = Counter()
                if not t.isascii():
                    if lead_pair().search(t):  # what may be damaged is no evidence of words
                        t = image_span().sub(lambda m: " " if lead_pair().search(m.group()) else m.group(), t)
                    odd.update(w for w in words(t) if not w.isascii())
                    odd.update(w for w in odd_token().findall(t) if not w.isalpha())
                    odd.update([""] * odd.total())
                found[0].update(odd)
                if copies > 1:
                    for total, one in ((chars[1], own), (found[1], odd)):
                        for x, n in one.items():
                            total[x] += n * (copies - 1)
            if len(found[0]) > 200_000:
                yield from rows("w", found)
                found[0].clear()
                found[1].clear()
        yield from rows("c", chars)
        yield from rows("w", found)

    texts = None
    for df, col in tables:
        t = df.select(F.col(col).alias("text")).where("text <> ''")
        texts = t if texts is None else texts.unionByName(t)
    distinct = texts.groupBy("text").agg(F.count("*").alias("copies"))
    parts = partition_stage(distinct, "kind string, item string, once long, n long", counted)
    counts = written(parts.groupBy("kind", "item").agg(F.sum("once").alias("once"), F.sum("n").alias("n")), "channel")
    total = next((r.once for r in counts.where("kind = 'w' and item = ''").collect()), 0)
    found = counts.where(f"kind = 'c' or item <> '' and n >= {LEAST_WORDS} and once >= {WORD_SHARE * total}").collect()
    of = lambda kind, least, k: {r.item: r[k] for r in found if r.kind == kind and r[k] >= least}
    return Channel(of("c", 0, "n"), of("w", LEAST_WORDS, "n"), of("c", 0, "once"), of("w", 1, "once"), total)


def repaired(df: DataFrame, id_col: str, text_col: str, channel: Channel) -> DataFrame:
    """(<id>, restored, encodings, restorable) of the damaged texts."""

    def scan(batch):
        for rid, text in zip(batch["_id"], batch["_text"]):
            if not text:
                continue
            out, used = channel.repair(text)
            if used:
                yield rid, out, sorted(used - {"lost"}), "lost" not in used

    kind = df.schema[id_col].dataType.simpleString()
    return arrow_stage(spread(df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))), f"`{id_col}` {kind}, restored string, encodings array<string>, restorable boolean", scan)
