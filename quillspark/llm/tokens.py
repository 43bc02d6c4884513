"""Problem 2: tokens per text under an existing tokenizer, and totals per slice.

Two exact counters, both linear in the text and memoised per piece of text:

* BpeCounter: byte-pair vocabularies. Pieces never cross from a visible character into white space, so the count of a
  text is the sum over its pieces (white space and the visible run behind it), each encoded once per worker.
* TrieCounter: longest-match subword vocabularies. A trie with failure links; each node keeps how many tokens are
  emitted when its failure link is taken, so a text is counted in one pass without backing up.

Defined results: a null text counts no token and is not counted as a text; an empty text counts 0 tokens; slices with a
null key are kept; labels compare trimmed and case folded, a region suffix of a language does not count.
"""

from __future__ import annotations

import base64
import re
from collections import OrderedDict
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import arrow_stage
from ..session import spread

VOCABULARIES = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_multi_50k.tiktoken"
CHUNK = re.compile(r"\s*\S+|\s+$")
PIECES_KEPT = 400_000
# Fixed value: the published pre-tokenizer of byte-level BPE vocabularies.
PRETOKENIZER = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=4)
def bpe(path: str):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PRETOKENIZER, mergeable_ranks=ranks(path), special_tokens={})


class BpeCounter:
    """Exact token counts of a byte-pair vocabulary."""

    def __init__(self, path: str = f"{VOCABULARIES}/{BYTE_BPE}") -> None:
        self.path, self.memo = path, {}

    def __reduce__(self):
        return BpeCounter, (self.path,)

    def __call__(self, text: str) -> int:
        total, memo = 0, self.memo
        for piece in CHUNK.findall(text):
            n = memo.get(piece)
            if n is None:
                if len(memo) > PIECES_KEPT:
                    memo.clear()
                n = len(bpe(self.path).encode_ordinary(piece))
                memo[piece] = n
            total += n
        return total


class Trie:
    """Longest-match vocabulary over bytes: transitions, failure links and emissions per node."""

    def __init__(self, vocabulary: set[bytes]) -> None:
        self.step: dict[int, int] = {}
        ends, parents = {0: False}, []
        for w in sorted(vocabulary):
            node = 0
            for b in w:
                key = node << 8 | b
                nxt = self.step.get(key)
                if nxt is None:
                    nxt = self.step[key] = len(parents) + 1
                    parents.append((node, b))
                node = nxt
            ends[node] = True
        size = len(parents) + 1
        self.fail = [-1] * size  # -1: nothing can be emitted here
        self.emit = [0] * size
        self.fail[0] = -1
        depth = [0] * size
        for v, (u, _) in enumerate(parents, 1):
            depth[v] = depth[u] + 1
        for v in sorted(range(1, size), key=depth.__getitem__):
            u, b = parents[v - 1]
            if ends.get(v):
                self.fail[v], self.emit[v] = 0, 1
                continue
            if u == 0:
                continue
            z, n = self.fail[u], self.emit[u]
            while z >= 0 and (z << 8 | b) not in self.step:
                n += self.emit[z]
                z = self.fail[z]
            if z >= 0:
                self.fail[v], self.emit[v] = self.step[z << 8 | b], n

    def count(self, data: bytes) -> int:
        """Tokens of data. Where no token fits, the text up to the next byte that starts one counts as one unknown token."""
        step, fail, emit = self.step, self.fail, self.emit
        node = total = 0
        unknown = False
        for b in data:
            while (nxt := step.get(node << 8 | b)) is None and node and fail[node] >= 0:
                total += emit[node]
                node = fail[node]
            if nxt is None:
                nxt = step.get(b) if node else None
                total += not unknown
                unknown = nxt is None
            elif node == 0:
                unknown = False
            node = nxt or 0
        while node:
            if fail[node] < 0:
                return total + 1
            total += emit[node]
            node = fail[node]
        return total


@lru_cache(maxsize=2)
def byte_trie(path: str) -> Trie:
    return Trie(set(ranks(path)))


class TrieCounter:
    """Exact longest-match counts, memoised per white-space piece (no vocabulary entry is matched across pieces)."""

    def __init__(self, path: str = f"{VOCABULARIES}/{BYTE_BPE}") -> None:
        self.path, self.memo = path, OrderedDict()

    def __reduce__(self):
        return TrieCounter, (self.path,)

    def __call__(self, text: str) -> int:
        total, memo = 0, self.memo
        for piece in CHUNK.findall(text):
            n = memo.get(piece)
            if n is None:
                if len(memo) > PIECES_KEPT:
                    memo.clear()
                n = memo[piece] = byte_trie(self.path).count(piece.encode("utf-8", "surrogatepass"))
            total += n
        return total


def count_tokens(df: DataFrame, text_col: str, keep: list[str], counters: dict[str, object]) -> DataFrame:
    """The kept columns and one count per counter, one row per row of df with a text. A kept column that is named like
    a counter is given back as <name>_in."""
    schema = df.select(*keep).schema
    out = ", ".join([f"`{f.name + '_in' if f.name in counters else f.name}` {f.dataType.simpleString()}" for f in schema] + [f"`{c}` long" for c in counters])
    fns = list(counters.values())

    def count(batch):
        for i, text in enumerate(batch["_text"]):
            if text is not None:
                yield (*(batch[k][i] for k in keep), *(f(text) for f in fns))

    return arrow_stage(spread(df.select(*keep, F.col(text_col).alias("_text"))), out, count)


def folded(col: str, region: bool = False) -> F.Column:
    c = F.lower(F.trim(F.col(col)))
    return F.regexp_replace(c, "[-_].*$", "") if region else c


def token_budget(counted: DataFrame, by: list[str], counters: list[str]) -> DataFrame:
    """Texts and totals per slice; partial sums precede the shuffle, so a hot slice is no hot task."""
    return counted.groupBy(*by).agg(F.count("*").alias("n_texts"), *(F.sum(c).alias(c) for c in counters))
