"""Problem 5: sentence alignment of rough translations.

A translation lexicon is learned from all records, equal pairs of texts counting once: for every source word, the share
of its pairs whose translation holds an English word, in excess of that word's share overall. Co-occurrences are counted
sparsely, as sums by (source word, English word). Candidates that tie are kept together; a word with more than BEST best
ones is left to the glossary. Sentence vectors are bags of English words: the words themselves on the English side, the
lexicon's translations on the source side, with numbers and the consonant skeletons of names on both.

Each record then solves entropic optimal transport between its sentences: masses are content words, costs fall with the
overlap of the vectors, and a null row and column take up omitted and added sentences at a fixed cost, so mass goes from
sentence to sentence only where that is cheaper than leaving out the one and adding the other. Sinkhorn scaling gives
the plan. A pair is linked when the plan carries SHARE of the lighter sentence's mass from one to the other, so merges
and splits come out as several links, omissions and additions as none or, where asked for, as rows with one side.

Defined results: a null or blank side gives no link; sentences without any content word are linked to nothing; equal
sentences share their mass and are all linked to the equal translations.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread, written
from ..arrow import arrow_stage, column_stage, partition_stage
from .lookalike import INVISIBLE, LOOK_ALIKE
from .neardup import Hasher
from .sentences import BoundaryModel, sentence_spans
from .words import words

EXCESS = 0.3  # least excess share of a translation
LEAST = 4  # words in fewer pairs of texts are names, not vocabulary
BEST = 4  # a word with more candidates than this that cannot be told apart has no translation
NEAR = 0.8  # translations kept beside the best one: those with this share of its excess
EPSILON, NULL_COST, ROUNDS = 0.02, 0.24, 60  # two null costs are the price of the least overlap that is a rendering
SHARE = 0.4  # least share of the lighter sentence's mass of a link

_PLAIN = {ord(a): b for a, b in LOOK_ALIKE.items()} | {ord(c): None for c in INVISIBLE}
CLUSTERS = (("ch", "c"), ("sh", "s"), ("kh", "k"), ("gh", "g"), ("th", "t"), ("dh", "d"), ("ph", "p"), ("bh", "b"), ("w", "v"), ("q", "k"))
# English function words; they say nothing about which sentence renders which.
FUNCTION_WORDS = frozenset(
    "a an the this that these those my our your his her its their no every each some any in on at of to for from by with "
    "without under over near beside beyond between after before like as and or but because when while if so than then "
    "is are was were be been being am do does did has have had will would shall should can could may might must not "
    "i we you he she it they me us him them who which what where there here still only also just too very".split()
)
OL_CHIKI_VOWELS = {"LA", "LAA", "LI", "LU", "LE", "LO"}


_OTHER = re.compile("[" + "".join(map(re.escape, [*LOOK_ALIKE, *INVISIBLE])) + "]")


def plain(text: str) -> str:
    if not text.isascii():
        if _OTHER.search(text):
            text = text.translate(_PLAIN)
        text = unicodedata.normalize("NFC", text)
    return text.lower()


def tokens(text: str) -> list[str]:
    return [w if w.isascii() or not w[0].isdigit() else digits(w) for w in words(plain(text))]


def digits(w: str) -> str:
    return "".join(str(unicodedata.digit(c, c)) for c in w)


@lru_cache(maxsize=4096)
def consonant(ch: str) -> str:
    """The consonant a letter stands for, read off its Unicode name; '' for vowels and marks."""
    name = unicodedata.name(ch, "")
    if " LETTER " not in name:
        return ""
    if ch.isascii() or name.startswith("LATIN"):
        base = unicodedata.normalize("NFD", ch)[0].lower()
        return "" if base in "aeiou" else base
    last = name.split(" LETTER ")[1].split(" ")[0]
    if name.startswith("OL CHIKI"):
        if last in OL_CHIKI_VOWELS:
            return ""
        last = last.lstrip("AEIOU")
    last = last.lower()
    if name.startswith("ARABIC"):
        last = {"tcheh": "c", "keheh": "k", "waw": "", "alef": "", "yeh": "y", "farsi": "y", "hah": "h", "khah": "k", "ghain": "g", "sheen": "s", "seen": "s", "jeem": "j", "zain": "z"}.get(last, last)
    if name.startswith("MEETEI"):
        last = {"chil": "c", "un": "", "i": "", "atiya": "", "lonsum": ""}.get(last, last)
    lead = re.match("[^aeiou]*", last).group()
    for a, b in CLUSTERS:
        lead = lead.replace(a, b)
    return re.sub(r"(.)\1", r"\1", lead)


@lru_cache(maxsize=100_000)
def skeleton(word: str) -> str:
    s = "".join(map(consonant, unicodedata.normalize("NFC", word)))
    for a, b in CLUSTERS:
        s = s.replace(a, b)
    return s.replace("y", "")


class Lexicon:
    """entries: source word -> its translations. known: sorted hashes of all words of the vocabulary, 8 bytes a word."""

    def __init__(self, entries: dict[str, dict[str, float]], known: np.ndarray, english: frozenset[str]) -> None:
        self.entries, self.known, self.english, self.hasher = entries, known, english, Hasher(1)
        self.sources: dict[str, dict[str, float] | None] = {}
        self.targets: dict[str, str | None] = {}

    def __reduce__(self):
        return Lexicon, (self.entries, self.known, self.english)

    def holds(self, w: str) -> bool:
        h = np.uint64(self.hasher.word(w))
        i = np.searchsorted(self.known, h)
        return bool(i < len(self.known) and self.known[i] == h)

    def _source(self, w: str) -> dict[str, float] | None:
        if w in FUNCTION_WORDS:
            return None
        if e := self.entries.get(w):
            return e
        if w.isdigit() or w in self.english:
            return {w: 1.0}
        return {"~" + s: 0.9} if not self.holds(w) and len(s := skeleton(w)) >= 2 else None

    def _target(self, w: str) -> str | None:
        if w in self.english or w.isdigit():
            return w
        return "~" + s if w not in FUNCTION_WORDS and not self.holds(w) and len(s := skeleton(w)) >= 2 else None

    def source(self, toks: list[str]) -> list[dict[str, float]]:
        return [e for w in toks if (e := memo(self.sources, w, self._source)) is not None]

    def target(self, toks: list[str]) -> Counter:
        return Counter(e for w in toks if (e := memo(self.targets, w, self._target)) is not None)


def memo(kept: dict, key: str, fn):
    """fn(key), remembered; forgets all when there are very many."""
    try:
        return kept[key]
    except KeyError:
        if len(kept) > 300_000:
            kept.clear()
        v = kept[key] = fn(key)
        return v


def word_hashes(ws) -> np.ndarray:
    return np.array([HASHER.word(w) for w in ws], dtype=np.uint64)


HASHER = Hasher(1)
PAIRS_KEPT = 3_000_000  # codes of co-occurrences summed at once


def fit_lexicon(df: DataFrame, src: str, tgt: str, glossary: DataFrame | None = None) -> Lexicon:
    """Counts cover the distinct pairs of texts of all records. Each text is read once, into the hashes of its words.
    The vocabulary, words in LEAST pairs or more, reaches the driver and the workers as sorted hashes and counts, and the
    lexicon as words; the co-occurrence counts stay rows, summed before and after the shuffle."""
    pairs = spread(df.where(f"trim({src}) <> '' and trim({tgt}) <> ''").select(F.col(src).alias("s"), F.col(tgt).alias("t")).distinct())

    def read(feed):
        n: Counter = Counter()
        for batch in feed:
            for s, t in zip(batch["s"], batch["t"]):
                a, b = set(tokens(s)), set(tokens(t))
                n.update(("s", w) for w in a)
                n.update(("t", w) for w in b)
                yield "p", None, None, 1, word_hashes(a).tobytes(), word_hashes(b).tobytes()
            if len(n) > 500_000:
                yield from ((side, w, HASHER.word(w) - (1 << 63), v, None, None) for (side, w), v in n.items())
                n.clear()
        yield from ((side, w, HASHER.word(w) - (1 << 63), v, None, None) for (side, w), v in n.items())

    rows = written(partition_stage(pairs, "kind string, word string, h long, n long, s binary, t binary", read), "pairs")
    total = rows.where("kind = 'p'").count()
    vocabulary = written(rows.where("kind <> 'p'").groupBy("kind", "word").agg(F.first("h").alias("h"), F.sum("n").alias("n")).where(F.col("n") >= LEAST), "vocabulary")
    listed = lambda kind, test: vocabulary.where(F.col("kind") == kind).where(test).select("h", "n").toArrow()

    def arrays(kind: str, test: str) -> tuple[np.ndarray, np.ndarray]:
        t = listed(kind, test)
        h = (t["h"].to_numpy().astype(np.int64).view(np.uint64)) ^ np.uint64(1 << 63)
        order = np.argsort(h)
        return h[order], t["n"].to_numpy()[order]

    digits_ = "word rlike '^[0-9]+$'"
    function = ", ".join(f"'{w}'" for w in sorted(FUNCTION_WORDS))
    sv, s_n = arrays("s", f"not {digits_}")
    tv, t_n = arrays("t", f"not {digits_} and length(word) > 1 and word not in ({function})")
    known = np.unique(np.concatenate([arrays("s", "true")[0], arrays("t", "true")[0]]))

    def places(blob: bytes, v: np.ndarray) -> np.ndarray:
        h = np.frombuffer(blob, dtype=np.uint64)
        at = np.minimum(np.searchsorted(v, h), len(v) - 1)
        return at[v[at] == h]

    def together(batches):
        held, size, codes, counts = [], 0, np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

        def summed():
            new, n = np.unique(np.concatenate(held), return_counts=True) if held else (codes[:0], counts[:0])
            every, back = np.unique(np.concatenate([codes, new]), return_inverse=True)
            return every, np.bincount(back, np.concatenate([counts, n]), len(every)).astype(np.int64)

        for batch in batches:
            for s, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                i, j = places(s, sv), places(t, tv)
                held.append((i[:, None] * len(tv) + j).ravel())
                size += len(held[-1])
                if size > PAIRS_KEPT:
                    codes, counts = summed()
                    held, size = [], 0
                    if len(codes) > PAIRS_KEPT:
                        yield codes // len(tv), codes % len(tv), counts
                        codes, counts = codes[:0], counts[:0]
        codes, counts = summed()
        for at in range(0, len(codes), 200_000):
            c = codes[at : at + 200_000]
            yield c // len(tv), c % len(tv), counts[at : at + 200_000]

    def telling(batches):
        for batch in batches:
            i, j, n = (batch.column(k).to_numpy() for k in range(3))
            share, base = n / s_n[i], t_n[j] / total
            excess = (share - base) / np.maximum(1 - base, 1e-6)
            keep = (excess >= EXCESS) & ((share - base) / np.sqrt(base * (1 - base) / s_n[i] + 1e-9) >= 3.5)
            flat = lambda h: (h ^ np.uint64(1 << 63)).view(np.int64)
            yield flat(sv[i[keep]]), flat(tv[j[keep]]), excess[keep]

    found: dict[str, dict[str, float]] = {}
    if len(sv) and len(tv):
        counted = column_stage(rows.where("kind = 'p'").select("s", "t"), "i long, j long, n long", together).groupBy("i", "j").agg(F.sum("n").alias("n"))
        few = column_stage(counted, "sh long, th long, w double", telling)
        word = lambda k: vocabulary.where(F.col("kind") == k).select(F.col("h").alias(f"{k}h"), F.col("word").alias(f"{k}w"))
        for r in few.join(word("s"), "sh").join(word("t"), "th").select("sw", "tw", "w").collect():
            found.setdefault(r.sw, {})[r.tw] = r.w
    entries = {f: es for f, ws in found.items() if (es := translations(ws))}
    if glossary is not None:
        for r in glossary.where("term is not null and gloss is not null").select("term", "gloss").collect():
            f, e = tokens(r.term), tokens(r.gloss)
            if len(f) == 1 and len(e) == 1 and f[0] not in entries:
                entries[f[0]] = {e[0]: 1.0}
    return Lexicon(entries, known, frozenset(e for es in entries.values() for e in es))


def translations(excess: dict[str, float]) -> dict[str, float]:
    """The best candidates and those nearly as good, by their share of the best; none where more than BEST are best."""
    top = max(excess.values())
    if sum(w >= top - 1e-9 for w in excess.values()) > BEST:
        return {}
    return {e: w / top for e, w in excess.items() if w >= NEAR * top}


WEIGHT = {"~": 0.9}  # of a name, known by its skeleton only


def overlap(src: list[list[dict[str, float]]], tgt: list[Counter]) -> np.ndarray:
    """Overlap of sentence vectors: matched weight over the lighter vector's. A source word is matched once in each
    target sentence, by its heaviest translation there, a target word as often as it occurs."""
    m = np.zeros((len(src), len(tgt)))
    where: dict[str, list[tuple[int, int]]] = {}
    for j, t in enumerate(tgt):
        for e, n in t.items():
            where.setdefault(e, []).append((j, n))
    for i, s in enumerate(src):
        got = [0.0] * len(tgt)
        sure: dict[str, int] = {}
        several = []
        for es in s:
            if len(es) == 1:
                e = next(iter(es))
                sure[e] = sure.get(e, 0) + 1
            else:
                several.append(es)
        weight = WEIGHT.get
        for e, k in sure.items():
            for j, n in where.get(e, ()):
                got[j] += (k if k < n else n) * weight(e[0], 1.0)
        for es in several:
            done = set()
            for e in sorted(es, key=lambda x: -es[x]):
                for j, n in where.get(e, ()):
                    if j not in done and n > sure.get(e, 0):
                        got[j] += es[e]
                        done.add(j)
        m[i] = got
    sizes = np.minimum(np.array([len(s) for s in src])[:, None], np.array([sum(t.values()) for t in tgt]))
    return np.minimum(m / np.maximum(sizes, 1), 1.0)


def transports(likes: list[np.ndarray], masses: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """Sinkhorn plans of many records at once. Row and column 0 are null and take any mass at NULL_COST; records are
    padded to common sizes with rows and columns of no mass."""
    out: list = [None] * len(likes)
    groups: dict[tuple[int, int], list[int]] = {}
    for i, like in enumerate(likes):
        groups.setdefault((-(-like.shape[0] // 4) * 4, -(-like.shape[1] // 4) * 4), []).append(i)
    for (n, m), members in groups.items():
        step = max(1, 200_000 // (n * m))
        for at in range(0, len(members), step):
            part = members[at : at + step]
            cost = np.full((len(part), n + 1, m + 1), 1e3)
            r, c = np.zeros((len(part), n + 1)), np.zeros((len(part), m + 1))
            for k, i in enumerate(part):
                (a, b), (x, y) = masses[i], likes[i].shape
                cost[k, 1 : x + 1, 1 : y + 1] = 1 - likes[i]
                cost[k, 0, 1 : y + 1] = cost[k, 1 : x + 1, 0] = NULL_COST
                cost[k, 0, 0] = 0
                r[k, 0], r[k, 1 : x + 1], c[k, 0], c[k, 1 : y + 1] = b.sum(), a, a.sum(), b
            kern = np.exp(-cost / EPSILON)
            v = (c > 0).astype(float)
            for _ in range(ROUNDS):
                u = r / np.maximum(np.matmul(kern, v[:, :, None])[:, :, 0], 1e-300)
                v = c / np.maximum(np.matmul(u[:, None, :], kern)[:, 0, :], 1e-300)
            plans = u[:, :, None] * kern * v[:, None, :]
            for k, i in enumerate(part):
                x, y = likes[i].shape
                out[i] = plans[k, 1 : x + 1, 1 : y + 1]
    return out


def sentence_tokens(text: str, spans: list[tuple[int, int]]) -> list[list[str]]:
    """Tokens of each sentence; the texts are brought to their plain form in one go."""
    parts = plain("\0".join(text[a:b] for a, b in spans)).split("\0")
    return [[w if w.isascii() or not w[0].isdigit() else digits(w) for w in words(p)] for p in parts]


def align_all(pairs: list[tuple[str, str]], lex: Lexicon, bounds: BoundaryModel, unlinked: bool = False) -> list[list[tuple]]:
    """For each pair of texts, (src start, src end, tgt start, tgt end, share) of the linked sentences. With unlinked, also
    every sentence in no link, the other side None, with the share of its mass that goes to null."""
    out: list[list] = [[] for _ in pairs]
    at, spans, likes, masses = [], [], [], []
    for i, (s_text, t_text) in enumerate(pairs):
        ss, ts = sentence_spans(s_text, bounds), sentence_spans(t_text, bounds)
        if not ss or not ts:
            continue
        sv = [lex.source(x) for x in sentence_tokens(s_text.replace("\0", " "), ss)]
        tv = [lex.target(x) for x in sentence_tokens(t_text.replace("\0", " "), ts)]
        at.append(i)
        spans.append((ss, ts))
        likes.append(overlap(sv, tv))
        masses.append((np.maximum([len(x) for x in sv], 0.5), np.maximum([sum(x.values()) for x in tv], 0.5)))
    for i, (ss, ts), like, (a, b), plan in zip(at, spans, likes, masses, transports(likes, masses)):
        share = plan / np.minimum(a[:, None], b)
        linked = share >= SHARE
        out[i] = [(*ss[x], *ts[y], float(min(share[x, y], 1))) for x, y in zip(*np.nonzero(linked))]
        if unlinked:
            gone, new = 1 - plan.sum(axis=1) / a, 1 - plan.sum(axis=0) / b
            out[i] += [(*ss[x], None, None, float(min(max(gone[x], 0), 1))) for x in np.flatnonzero(~linked.any(axis=1))]
            out[i] += [(None, None, *ts[y], float(min(max(new[y], 0), 1))) for y in np.flatnonzero(~linked.any(axis=0))]
    return out


def aligned_sentences(df: DataFrame, id_col: str, src: str, tgt: str, lex: Lexicon, bounds: BoundaryModel, unlinked: bool = False) -> DataFrame:
    """(<id>, src_start, src_end, tgt_start, tgt_end, share, kind), one row per link; kind is one, merge (several source
    sentences in one), split (one source sentence in several) or mixed. With unlinked, also a row per sentence left out
    (omission) or added (addition), the other side null."""

    def link(batch):
        rows = [(rid, s, t) for rid, s, t in zip(batch["_id"], batch["_s"], batch["_t"]) if s and t]
        for at in range(0, len(rows), 2000):
            part = rows[at : at + 2000]
            for (rid, _, _), links in zip(part, align_all([(s, t) for _, s, t in part], lex, bounds, unlinked)):
                for x in links:
                    if x[0] is None or x[2] is None:
                        yield rid, *x, "addition" if x[0] is None else "omission"
                links = [x for x in links if x[0] is not None and x[2] is not None]
                up, down = Counter(x[0] for x in links), Counter(x[2] for x in links)
                for x in links:
                    many_t, many_s = up[x[0]] > 1, down[x[2]] > 1
                    yield rid, *x, "mixed" if many_s and many_t else "merge" if many_s else "split" if many_t else "one"

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, src_start long, src_end long, tgt_start long, tgt_end long, share double, kind string"
    return arrow_stage(spread(df.select(F.col(id_col).alias("_id"), F.col(src).alias("_s"), F.col(tgt).alias("_t"))), schema, link)
