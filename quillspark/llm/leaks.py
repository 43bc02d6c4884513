"""Problem 8: test passages inside a large corpus, by size-partitioned MinHash containment search.

A passage counts as leaked when a document holds `run` of its words in a row, which share run - SHINGLE + 1 of their
shingles with it, however long the document is. Documents are partitioned by size: up to SIZES[-1] words a document is
one domain of its size class, a longer one is cut into domains of that size that overlap by run - 1 words; items are cut
into queries of ITEM_WORDS words in the same way, so every run lies whole in a domain and in a query. In a class of at
most u shingles, a leak has a likeness of at least s = k / (u + q - k) with k shared shingles and q in the query; the class
has as many MinHash registers as it takes for a pair of likeness s to agree in none with a probability of MISS. Small
domains need few registers, large ones many. Registers hold 32-bit hashes: two shingles of one hash only add a candidate.
A shingle that comes again in a domain or a query counts as another one, so runs of repeated words share k shingles too.
Pairs that agree in a register are verified exactly, run by run, and the share of the item's shingles the document holds
is reported.

Defined results: null and blank texts and texts of fewer than `run` words leak nothing; repeated rows give one row;
copies of an item are each reported; the size class is that of the whole document, log2 of its words.
"""

from __future__ import annotations

import math
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import arrow_stage
from ..session import spread, written
from .lookalike import Rewriter
from .neardup import Hasher, mix, seeds
from .words import words

SHINGLE = 5  # words of a shingle
SIZES = (32, 48, 64, 96, 128, 192, 256)  # greatest words of a domain, by size class
ITEM_WORDS = 64  # words of a query
CELLS = 65_536  # hashes computed at once
BLOCK = 32_768  # words of short documents hashed at once
LOOKUPS = 128  # domains looked up at once
HITS = 500_000  # items of shared values put beside their domains at once
MISS = 1e-5  # probability to overlook the smallest leak
IN_MEMORY = 4_000_000  # register values of items up to which they are searched where documents are read; beyond it, joined


def cuts(n: int, size: int, run: int) -> list[tuple[int, int]]:
    """Spans of at most size words that cover n words so that every run of `run` words lies in one."""
    size = max(size, run)
    out, at = [], 0
    while True:
        out.append((at, min(at + size, n)))
        if at + size >= n:
            return out
        at += size - run + 1


def registers_of(size: int, run: int, shingle: int) -> int:
    """Registers of the class of domains of up to `size` words."""
    shared = run - shingle + 1
    least = shared / (max(size, run) + max(ITEM_WORDS, run) - 2 * (shingle - 1) - shared)
    return math.ceil(math.log(MISS) / math.log1p(-least)) if least < 1 else 1


def numbered(g: np.ndarray) -> np.ndarray:
    """Shingles as a set in which the second, third, ... of the same ones are elements of their own; in any order."""
    s = np.sort(g)
    same = s[1:] == s[:-1]
    if not same.any():
        return g
    at = np.arange(len(s))
    rank = (at - np.maximum.accumulate(np.where(np.concatenate(([True], ~same)), at, 0))).astype(np.uint64)
    return np.where(rank > 0, mix(s + rank * np.uint64(0x9E3779B97F4A7C15)), s)


class Known(dict):
    """What Hasher keeps; a word that is not there yet is hashed when it is asked for."""

    def __init__(self, word) -> None:
        self.word = word

    def __missing__(self, w: str) -> int:
        return self.word(w)


class Domains:
    """Cuts texts into domains and computes the register values of their size classes."""

    def __init__(self, run: int) -> None:
        self.run, self.shingle = run, min(SHINGLE, run)
        self.sizes = [s for s in SIZES if s >= run] or [run]
        self.counts = [registers_of(s, run, self.shingle) for s in self.sizes]
        self.seed = seeds(max(self.counts))
        self.number = mix(np.arange(1, max(self.counts) + 1, dtype=np.uint64))
        self.low_seed = self.seed.astype(np.uint32)
        self.hasher, self.room = Hasher(1), np.empty((2, max(CELLS, *self.counts)), dtype=np.uint32)  # kept: fresh memory costs more than the arithmetic
        self.hasher.cache = Known(self.hasher.word)

    def __reduce__(self):
        return Domains, (self.run,)

    def hashes(self, ws: list[str]) -> np.ndarray:
        return np.fromiter(map(self.hasher.cache.__getitem__, ws), dtype=np.uint64, count=len(ws))

    def shingles(self, h: np.ndarray) -> np.ndarray:
        n = self.shingle
        g = np.zeros(len(h) - n + 1, dtype=np.uint64)
        for k in range(n):
            g = mix(g * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - n + 1 + k])
        return g

    def spans(self, n: int) -> list[tuple[int, int, int]]:
        """(start, end, registers) of the domains of a text of n words."""
        return [(a, b, self.counts[next(i for i, s in enumerate(self.sizes) if s >= b - a)]) for a, b in cuts(n, self.sizes[-1], self.run)]

    def minima(self, g: np.ndarray, m: int) -> np.ndarray:
        """The first m registers of shingles."""
        low, seed, g = np.full(m, np.iinfo(np.uint32).max, dtype=np.uint32), self.low_seed[:m], numbered(g).astype(np.uint32)
        step = max(1, CELLS // m)
        for at in range(0, len(g), step):
            part = g[at : at + step, None]
            h, t = (room[: len(part) * m].reshape(len(part), m) for room in self.room)
            np.bitwise_xor(part, seed, out=h)
            np.multiply(h, np.uint32(0x85EBCA6B), out=h)
            np.right_shift(h, np.uint32(16), out=t)
            np.bitwise_xor(h, t, out=h)
            np.multiply(h, np.uint32(0xC2B2AE35), out=h)
            np.minimum(low, h.min(axis=0), out=low)
        return low

    def values(self, g: np.ndarray, m: int) -> np.ndarray:
        """The first m register values of shingles, each mixed with its register's number."""
        return mix(self.minima(g, m) ^ self.number[:m])

    def values_of(self, g: np.ndarray, spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Register values of the domains (start, end, registers) of a text with shingles g, and the domain of each."""
        low = np.concatenate([self.minima(g[a : b - self.shingle + 1], m) for a, b, m in spans])
        number = np.concatenate([self.number[:m] for _, _, m in spans])
        return mix(low ^ number), np.repeat(np.arange(len(spans)), [m for _, _, m in spans])


def runs(ws: list[str], run: int) -> set[str]:
    return {" ".join(ws[k : k + run]) for k in range(len(ws) - run + 1)}


class Items:
    """Items in memory: their register values, sorted, the queries that have each, and what verifies a candidate."""

    def __init__(self, texts: list[tuple[object, list[str]]], domains: Domains) -> None:
        self.ids, self.runs, self.shingles, values, owners = [], [], [], [], []
        for iid, ws in texts:
            h = domains.hashes(ws)
            for a, b in cuts(len(ws), ITEM_WORDS, domains.run):
                values.append(domains.values(domains.shingles(h[a:b]), len(domains.seed)))
                owners.append(np.full(len(values[-1]), len(self.ids)))
            self.ids.append(iid)
            self.runs.append(runs(ws, domains.run))
            self.shingles.append(np.unique(domains.shingles(h)))
        v, o = (np.concatenate(values), np.concatenate(owners)) if values else (np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64))
        order = np.argsort(v, kind="stable")
        self.values, self.owners = v[order], o[order]
        self.mask = np.uint64((1 << max(10, (16 * len(v)).bit_length())) - 1)
        self.maybe = np.zeros(int(self.mask) + 1, dtype=bool)  # most values that no item has are seen to be so at one look
        self.maybe[(v & self.mask).astype(np.int64)] = True

    def pairs(self, values: np.ndarray, domain: np.ndarray):
        """(domain, item) of the domains with these values, in their order, and the items that share one. A pair comes
        again where a domain has more than HITS."""
        hit = np.flatnonzero(self.maybe[(values & self.mask).astype(np.int64)])
        values, domain = values[hit], domain[hit]
        lo = np.searchsorted(self.values, values)
        n = np.searchsorted(self.values, values, side="right") - lo
        upto, at = np.cumsum(n), 0
        while at < len(n):
            end = max(at + 1, int(np.searchsorted(upto, upto[at] - n[at] + HITS, side="right")))
            some = n[at:end]
            owners = self.owners[np.arange(some.sum()) + np.repeat(lo[at:end] - np.cumsum(some) + some, some)]
            for x in np.unique(np.repeat(domain[at:end], some) * len(self.ids) + owners).tolist():
                yield divmod(x, len(self.ids))
            at = end

    def candidates(self, values: np.ndarray) -> set[int]:
        return {k for _, k in self.pairs(values, np.zeros(len(values), dtype=np.int64))}

    def shared(self, k: int, g: np.ndarray) -> int:
        """How many of the shingles g item k has."""
        have = self.shingles[k]
        return int(np.count_nonzero(have[np.minimum(np.searchsorted(have, g), len(have) - 1)] == g))

    def leaked(self, part: list[tuple[object, list[str]]], domains: Domains):
        """(id, item id, size class, containment) of documents (id, words) that are hashed together."""
        run, short = domains.run, domains.shingle - 1
        starts = [0, *accumulate(len(ws) for _, ws in part)]
        g = domains.shingles(domains.hashes([w for _, ws in part for w in ws]))
        spans = [(d, a, b, m) for d, (_, ws) in enumerate(part) for a, b, m in domains.spans(len(ws))]

        def rows(d: int, found: set[int]):
            rid, ws = part[d]
            for k in sorted(found):
                yield rid, self.ids[k], len(ws).bit_length() - 1, contained(self.shingles[k], g[starts[d] : starts[d] + len(ws) - short])

        doc, found = 0, set()
        for at in range(0, len(spans), LOOKUPS):
            some, last, have = spans[at : at + LOOKUPS], None, None
            for j, k in self.pairs(*domains.values_of(g, [(starts[d] + a, starts[d] + b, m) for d, a, b, m in some])):
                d, a, b, _ = some[j]
                if d != doc:
                    yield from rows(doc, found)
                    doc, found = d, set()
                if j != last:
                    last, have = j, None
                if k in found or have is None and self.shared(k, g[starts[d] + a : starts[d] + b - short]) < run - short:
                    continue  # a run shares run - short shingles
                have = have or runs(part[d][1][a:b], run)
                if not have.isdisjoint(self.runs[k]):
                    found.add(k)
        yield from rows(doc, found)


def word_lists(rw: Rewriter, run: int, ids: list, texts: list):
    for rid, text in zip(ids, texts):
        if rid is not None and text:
            ws = words(rw(text).lower())
            if len(ws) >= run:
                yield rid, ws


def blocks(lists):
    """(id, words) in lists of BLOCK words or little more."""
    out, n = [], 0
    for rid, ws in lists:
        out.append((rid, ws))
        n += len(ws)
        if n >= BLOCK:
            yield out
            out, n = [], 0
    if out:
        yield out


def contained(item: np.ndarray, doc: np.ndarray) -> float:
    return float(np.isin(item, doc).mean())


def leaks(docs: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, item_text: str, mapping: dict[str, str], run: int = 12) -> DataFrame:
    """(<doc_id>, <item_id>, size_class, containment): documents and the items of which they hold run words in a row."""
    rw, domains = Rewriter(mapping), Domains(run)
    dk, ik = docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    docs = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    items = items.select(F.col(item_id).alias("_id"), F.col(item_text).alias("_text"))
    schema = f"`{doc_id}` {dk}, `{item_id}` {ik}, size_class int, containment double"
    once = lambda df: df.groupBy(doc_id, item_id).agg(F.max("size_class").alias("size_class"), F.max("containment").alias("containment"))
    n = items.agg(F.sum(F.length("_text"))).first()[0] or 0  # a query has no less than one character a word
    if n / ITEM_WORDS * len(domains.seed) <= IN_MEMORY:
        known = Items(list(word_lists(rw, run, *zip(*[(r[0], r[1]) for r in items.dropDuplicates().collect()] or [((), ())]))) if n else [], domains)

        def search(batch):
            for part in blocks(word_lists(rw, run, batch["_id"], batch["_text"])):
                yield from known.leaked(part, domains)

        return once(arrow_stage(spread(docs), schema, search))

    def registers(batch, of):
        for rid, ws in word_lists(rw, run, batch["_id"], batch["_text"]):
            h = domains.hashes(ws)
            for a, b, m in of(len(ws)):
                for v in np.unique(domains.values(domains.shingles(h[a:b]), m)).view(np.int64).tolist():
                    yield v, rid

    left = arrow_stage(spread(docs), f"v long, d {dk}", lambda b: registers(b, domains.spans))
    right = arrow_stage(spread(items), f"v long, i {ik}", lambda b: registers(b, lambda n: [(x, y, len(domains.seed)) for x, y in cuts(n, ITEM_WORDS, run)]))
    near = written(left.join(right, "v").select("d", "i").distinct(), "leaks")
    pairs = near.join(docs.dropDuplicates().select(F.col("_id").alias("d"), F.col("_text").alias("dt")), "d").join(items.dropDuplicates().select(F.col("_id").alias("i"), F.col("_text").alias("it")), "i")

    def verify(batch):
        for d, i, dt, it in zip(*(batch[c] for c in ("d", "i", "dt", "it"))):
            x, y = words(rw(dt).lower()), words(rw(it).lower())
            if len(x) >= run and len(y) >= run and not runs(x, run).isdisjoint(runs(y, run)):
                yield d, i, len(x).bit_length() - 1, contained(np.unique(domains.shingles(domains.hashes(y))), domains.shingles(domains.hashes(x)))

    return once(arrow_stage(pairs.select("d", "i", "dt", "it"), schema, verify))
