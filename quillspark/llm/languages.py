"""Problem 1: languages of documents and of their single-language stretches.

Every language has a smoothed n-gram model (letter n-grams of words, whole words included), trained on the texts that
carry its label, over all rows. A document is a mixture of languages: expectation-maximisation estimates the mixing
proportions from the likelihoods of its sentences under each model. The set of languages is chosen by penalised
likelihood: a language enters only if it raises the log-likelihood by more than a penalty per language. The posteriors
of the sentences then give the stretches: runs of sentences of one language.

The confidence of a stretch is the probability that it is in the language named and in none of the others nor in an
unknown one: a logistic function of its lead a word over the next best of all languages, the share of its n-grams the
language's model holds, and its length. It is fitted on the sentences of a bounded sample of labelled rows, each scored
twice: among all languages, and with its own left out, where whatever comes out is wrong.

Defined results: a null or blank text has no language; a text of no known n-gram gets the language of the best prior
model with a low confidence; a text without words the first language with one over their number; ties go to the
alphabetically first language; labels compare trimmed and case folded.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread, written
from ..arrow import arrow_stage, partition_stage
from .sentences import BoundaryModel, sentence_spans
from .words import words

ORDERS = (1, 2, 3)
LEAST = 3  # n-grams seen less often, or with less than SHARE of their language's, are smoothed as unseen
SHARE = 3e-5  # so no language has more than 1 / SHARE n-grams on the driver; one left out is scored as unseen, at most 5 nats less than it should be
CALIBRATION_ROWS = 1000  # bound of the sample of labelled rows the confidence is fitted on: the smallest hashes of their text
HELD_OUT = 0.1  # weight of a sentence scored without its own language
PENALTY = 8.0  # nats a further language of a document must gain
SENTENCE_GAIN = 4.0  # nats by which one whole sentence must prefer a further language


def word_grams(w: str) -> list[str]:
    p = f"<{w}>"
    return [p[i : i + n] for n in ORDERS for i in range(len(p) - n + 1) if n > 1 or p[i] not in "<>"] + ["=" + w]


# Weights of the confidence where no row is labelled: constant, lead a word, share of known n-grams, length, lead in all.
PRIOR_CONFIDENCE = (-6.0, 3.0, 6.0, 1.0, 2.0)


class LanguageModels:
    """Log-probabilities of n-grams by language; row 0 is the unseen n-gram's. confidence: weights of its features."""

    def __init__(self, names: list[str], index: dict[str, int], logp: np.ndarray, confidence=PRIOR_CONFIDENCE) -> None:
        self.names, self.index, self.logp, self.confidence = names, index, logp, np.asarray(confidence, dtype=np.float64)
        self.held = (logp > logp[:1] + 1e-3).astype(np.int32)
        self.known: dict[str, int] = {}
        self.table = np.zeros((0, 2 * len(names) + 2))

    def __reduce__(self):
        return LanguageModels, (self.names, self.index, self.logp, self.confidence)

    def rows_of(self, ws: list[str]) -> np.ndarray:
        """For each word the log-likelihoods, the numbers of n-grams held, the number of n-grams and 1, from a table of
        the words met so far."""
        ids = []
        for w in ws:
            i = self.known.get(w)
            if i is None:
                if len(self.known) > 100_000:
                    self.known.clear()
                    return np.concatenate([self.rows_of(ws[k : k + 50_000]) for k in range(0, len(ws), 50_000)]) if len(ws) > 50_000 else self.rows_of(ws)
                i = self.known[w] = len(self.known)
                if i >= len(self.table):
                    self.table = np.concatenate([self.table, np.zeros((max(1024, len(self.table)), self.table.shape[1]))])
                grams = [self.index.get(g, 0) for g in word_grams(w)]
                n = len(self.names)
                self.table[i, :n] = self.logp[grams].sum(axis=0, dtype=np.float64)
                self.table[i, n : 2 * n] = self.held[grams].sum(axis=0)
                self.table[i, 2 * n :] = len(grams), 1
            ids.append(i)
        return self.table[ids]

    def evidence(self, texts: list[str]) -> np.ndarray:
        """rows_of summed over the words of each text; zeros for a text without words."""
        parts = [words(t.lower()) for t in texts]
        sizes = np.array([len(p) for p in parts])
        out = np.zeros((len(texts), self.table.shape[1]))
        if sizes.any():
            rows = self.rows_of([w for p in parts for w in p])
            full = np.flatnonzero(sizes)
            out[full] = np.add.reduceat(rows, (np.cumsum(sizes) - sizes)[full], axis=0)
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log-likelihoods, texts x languages."""
        return self.evidence(texts)[:, : len(self.names)]

    def confidence_features(self, rows: np.ndarray, chosen: np.ndarray, without: np.ndarray | None = None) -> np.ndarray:
        """Features of evidence rows for their chosen languages, `without` a language each."""
        n, at = len(self.names), np.arange(len(rows))
        ll = rows[:, :n].copy()
        own = ll[at, chosen]
        ll[at, chosen] = -np.inf
        if without is not None:
            ll[at, without] = -np.inf
        lead = np.clip(own - ll.max(axis=1, initial=-1e9), -1e3, 1e3)
        count = np.maximum(rows[:, 2 * n + 1], 1)
        held = rows[at, n + chosen] / np.maximum(rows[:, 2 * n], 1)
        return np.stack([np.ones(len(rows)), np.clip(lead / count / 5, -2, 2), held, np.log1p(count) / 4, np.clip(lead / 50, -2, 2)], axis=1)

    def confidence_of(self, row: np.ndarray, chosen: int) -> float:
        x = self.confidence_features(row[None, :], np.array([chosen]))[0]
        return float(max(1 / (1 + np.exp(-np.clip(x @ self.confidence, -30, 30))), 1 / len(self.names)))


def calibrated(models: LanguageModels, sample: list[tuple[list[str], str]]) -> LanguageModels:
    """models with the confidence fitted on (sentences, language) of labelled texts. A text that is by far likelier in
    another language than its label is taken for mislabelled and left out."""
    col = {n: i for i, n in enumerate(models.names)}
    xs, ys, ws = [], [], []
    for texts, label in sample:
        rows = models.evidence(texts)
        rows = rows[rows[:, -1] > 0]
        if label not in col or not len(rows):
            continue
        own = np.full(len(rows), col[label])
        total = rows.sum(axis=0)
        if (total[: len(col)].max() - total[own[0]]) / total[-1] > 1:
            continue
        best = rows[:, : len(col)].argmax(axis=1)
        xs.append(models.confidence_features(rows, best))
        ys.append((best == own).astype(float))
        ws.append(np.ones(len(rows)))
        if len(col) > 2:
            other = rows[:, : len(col)].copy()
            other[np.arange(len(rows)), own] = -np.inf
            best = other.argmax(axis=1)
            xs.append(models.confidence_features(rows, best, own))
            ys.append(np.zeros(len(rows)))
            ws.append(np.full(len(rows), HELD_OUT))
    if not xs:
        return models
    x, y, w = np.concatenate(xs), np.concatenate(ys), np.concatenate(ws)
    if y.min() == y.max():
        return models
    b, step = np.array(PRIOR_CONFIDENCE), np.zeros(len(PRIOR_CONFIDENCE))
    for _ in range(400):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = 0.9 * step - 0.5 * (x.T @ ((p - y) * w) / w.sum() + 1e-4 * (b - PRIOR_CONFIDENCE))
        b = b + step
    return LanguageModels(models.names, models.index, models.logp, b)


def fit_languages(labelled: list[tuple[DataFrame, str, str]], names: list[str]) -> LanguageModels:
    """labelled: (table, text column, label column or expression). Only rows whose trimmed, case-folded label is one of
    names train. Counts cover all rows; the driver gets n-grams seen LEAST times or more that make up SHARE of their
    language's, so at most 1 / SHARE of them a language, whatever the size of the tables."""
    fold = {n.casefold(): n for n in names}
    parts = None
    for df, text, label in labelled:
        def expanded(by_word):
            for lang, ws in by_word.items():
                n: Counter = Counter()
                for w, k in ws.items():
                    for g in word_grams(w):
                        n[g] += k
                yield from ((lang, g, k) for g, k in n.items())

        def counted(feed):
            by_word: dict[str, Counter] = {}
            for batch in feed:
                for t, lab in zip(batch["t"], batch["lab"]):
                    lang = fold.get((lab or "").strip().casefold())
                    if lang and t:
                        by_word.setdefault(lang, Counter()).update(words(t.lower()))
                if sum(map(len, by_word.values())) > 200_000:
                    yield from expanded(by_word)
                    by_word = {}
            yield from expanded(by_word)

        p = partition_stage(df.select(F.col(text).alias("t"), F.expr(label).alias("lab")), "lang string, gram string, n long", counted)
        parts = p if parts is None else parts.unionByName(p)
    counts = written(parts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    least = {r.lang: max(LEAST, math.ceil(r.n * SHARE)) for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    enough = F.lit(False)
    for lang, n in least.items():
        enough = enough | ((F.col("lang") == lang) & (F.col("n") >= n))
    return language_models(((r.lang, r.gram, r.n) for r in counts.where(enough).toLocalIterator()), names)


def labelled_sample(df: DataFrame, text: str, label: str, names: list[str], boundaries: BoundaryModel) -> list[tuple[list[str], str]]:
    """(sentences, language) of CALIBRATION_ROWS rows with a known label, chosen by the hash of their text."""
    fold = {n.casefold(): n for n in names}
    lab = F.lower(F.trim(F.col(label)))
    rows = df.where(lab.isin(list(fold)) & (F.trim(text) != "")).select(F.col(text).alias("t"), lab.alias("l")).orderBy(F.xxhash64("t"), "l").limit(CALIBRATION_ROWS).collect()
    return [([r.t[a:b] for a, b in sentence_spans(r.t, boundaries)], fold[r.l]) for r in rows]


def language_models(counts, names: list[str]) -> LanguageModels:
    """Interpolated estimates: each n-gram's share in its language, smoothed by a constant share for the unseen."""
    names = sorted(names)
    col = {n: i for i, n in enumerate(names)}
    index: dict[str, int] = {}
    cells = []
    total = np.ones(len(names))
    for lang, g, n in counts:
        i = index.setdefault(g, len(index) + 1)
        cells.append((i, col[lang], n))
        total[col[lang]] += n
    m = np.zeros((len(index) + 1, len(names)), dtype=np.float64)
    for i, j, n in cells:
        m[i, j] = n
    floor = 2e-7
    logp = np.log((m / total) * (1 - floor * 1000) + floor).astype(np.float32)
    logp[:, total <= 1] = np.log(floor / 10)
    return LanguageModels(names, index, logp)


def mixture(ll: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, float]:
    """EM for the proportions of a mixture with given log-likelihoods (sentences x languages)."""
    top = ll.max(axis=1, keepdims=True)
    p = np.exp(ll - top)
    pi = np.full(ll.shape[1], 1 / ll.shape[1])
    for _ in range(rounds):
        post = p * pi
        post /= post.sum(axis=1, keepdims=True)
        pi = post.mean(axis=0) + 1e-9
        pi /= pi.sum()
    return pi, float((np.log(p @ pi) + top[:, 0]).sum())


def choose_languages(ll: np.ndarray, penalty: float = PENALTY) -> tuple[list[int], np.ndarray]:
    """Greedy penalised likelihood over language sets: (languages, posteriors of the sentences)."""
    single = ll.sum(axis=0)
    chosen = [int(np.argmax(single))]
    best = float(single[chosen[0]])
    while len(chosen) < ll.shape[1]:
        gain = np.maximum(ll - ll[:, chosen].max(axis=1, keepdims=True), 0)
        total = gain.sum(axis=0)
        total[chosen] = 0
        j = int(np.argmax(total))
        if total[j] <= penalty or gain[:, j].max() < SENTENCE_GAIN:
            break
        _, value = mixture(ll[:, chosen + [j]])
        if value - best <= penalty:
            break
        chosen.append(j)
        best = value
    if len(chosen) == 1:
        return chosen, np.ones((len(ll), 1))
    pi, _ = mixture(ll[:, chosen])
    post = np.exp(ll[:, chosen] - ll[:, chosen].max(axis=1, keepdims=True)) * pi
    post /= post.sum(axis=1, keepdims=True)
    keep = sorted(set(post.argmax(axis=1).tolist()))
    if len(keep) < len(chosen):
        chosen = [chosen[k] for k in keep]
        post = post[:, keep] / post[:, keep].sum(axis=1, keepdims=True)
    return chosen, post


def stretches_of(text: str, models: LanguageModels, boundaries: BoundaryModel) -> list[tuple[int, int, str, float]]:
    """(start, end, language, confidence) of the runs of sentences of one language."""
    spans = sentence_spans(text, boundaries)
    if not spans:
        return []
    rows = models.evidence([text[a:b] for a, b in spans])
    ll = rows[:, : len(models.names)]
    quiet = rows[:, -1] == 0
    if quiet.all():
        return [(spans[0][0], spans[-1][1], models.names[0], 1 / len(models.names))]
    chosen, post = choose_languages(ll[~quiet])
    best = np.full(len(spans), -1)
    best[~quiet] = np.array(chosen)[post.argmax(axis=1)]
    out: list[list] = []
    for i, (a, b) in enumerate(spans):
        k = int(best[i]) if best[i] >= 0 else out[-1][2] if out else int(best[~quiet][0])  # a sentence without words goes with those before it
        if out and out[-1][2] == k:
            out[-1][1] = b
            out[-1][3].append(i)
        else:
            out.append([a, b, k, [i]])
    return [(a, b, models.names[k], models.confidence_of(rows[members].sum(axis=0), k)) for a, b, k, members in out]


def language_stretches(df: DataFrame, id_col: str, text_col: str, models: LanguageModels, boundaries: BoundaryModel, keep: list[str] | None = None) -> DataFrame:
    """(<id>, kept columns, char_start, char_end, language, confidence): the single-language stretches of every text.
    A kept column that clashes with these names is given back as <name>_in."""
    keep = keep or []

    def tag(batch):
        for i, rid in enumerate(batch[id_col]):
            text = batch["_text"][i]
            if text and text.strip():
                for row in stretches_of(text, models, boundaries):
                    yield (rid, *(batch[k][i] for k in keep), *row)

    ours = {"char_start", "char_end", "language", "confidence", id_col}
    out = [f"`{id_col}` {df.schema[id_col].dataType.simpleString()}"]
    out += [f"`{k + '_in' if k in ours else k}` {df.schema[k].dataType.simpleString()}" for k in keep]
    schema = ", ".join(out) + ", char_start long, char_end long, language string, confidence double"
    return arrow_stage(spread(df.select(id_col, *keep, F.col(text_col).alias("_text"))), schema, tag)


def label_cases(stretches: DataFrame, id_col: str, label_col: str, names: list[str]) -> DataFrame:
    """(<id>, language) of the documents whose label is missing, names no language or another one, or that hold several."""
    known = [n.casefold() for n in names]
    langs = stretches.groupBy(id_col, label_col).agg(F.collect_set("language").alias("langs"))
    label = F.lower(F.trim(F.col(label_col)))
    case = F.col(label_col).isNull() | ~label.isin(known) | (F.size("langs") > 1) | (label != F.lower(F.element_at("langs", 1)))
    return langs.where(case).select(id_col, F.explode("langs").alias("language"))
