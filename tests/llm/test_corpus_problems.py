"""Problems 7, 8 and 9, and the queries themselves."""

import random

import numpy as np
import pytest

from quillspark.llm import leaks, lookalike, mixing, neardup, queries
from quillspark.llm.words import words

IDENTITY = {}


def copies(seed=2, n=60):
    rnd = random.Random(seed)
    voc = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(n):
        base = [rnd.choice(voc) for _ in range(60)]
        for j in range(rnd.choice((1, 1, 2, 4))):
            t = list(base)
            for _ in range(rnd.randint(0, 9)):
                t[rnd.randrange(len(t))] = rnd.choice(voc)
            rows.append((f"{k:03d}_{j}", f"title {k}", " ".join(t)))
    rows += [("x1", "a", "same text here"), ("x2", "a", "same text here"), ("n1", "a", None), ("n2", "a", " "), ("s1", None, "one"), ("s2", None, "one")]
    return rows


def likeness(a, b):
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("n,threshold", [(2, 0.6), (5, 0.8)])
def test_near_copies_equal_brute_force(spark, n, threshold):
    rows = copies()
    df = spark.createDataFrame(rows, "id string, t string, o string")
    m, links = neardup.near_copies(df, "id", ["t", "o"], "o", IDENTITY, n, threshold)
    got = {(r.id_a, r.id_b) for r in neardup.record_pairs(m, links, "id").collect()}
    sets = {}
    for i, t, o in rows:
        if o and o.strip():
            w = words(f"{t or ''} {o}")
            sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or {tuple(w)}
    want = {(a, b) for a in sets for b in sets if a < b and likeness(sets[a], sets[b]) >= threshold - 1e-12}
    assert got == want


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(0)
    seed = neardup.seeds(1024)
    x = np.unique(rng.integers(0, 2**63, 900, dtype=np.uint64))
    a, b = x[:600], x[300:]
    sa, sb = neardup.sketch(a, seed), neardup.sketch(b, seed)
    assert (neardup.merge(sa, sb) == neardup.sketch(x, seed)).all()
    assert abs(neardup.joint_likeness(sa, sb, len(a), len(b)) - 300 / len(x)) < 0.06


def test_hot_copies_and_empty_tables(spark):
    df = spark.createDataFrame([(f"{i:04d}", "t", "the same words again and again") for i in range(120)], "id string, t string, o string")
    m, links = neardup.near_copies(df, "id", ["t", "o"], "o", IDENTITY)
    assert links.count() == 0 and m.select("class").distinct().count() == 1
    assert neardup.record_pairs(m, links, "id").count() == 120 * 119 // 2
    m, links = neardup.near_copies(df.limit(0), "id", ["t", "o"], "o", IDENTITY)
    assert m.count() == 0 and links.count() == 0


@pytest.mark.parametrize("in_memory", [True, False])
def test_leaks_equal_brute_force(spark, monkeypatch, in_memory):
    if not in_memory:
        monkeypatch.setattr(leaks, "IN_MEMORY", 0)
    rnd = random.Random(4)
    voc = [f"w{i}" for i in range(50)]
    items = [(i, " ".join(rnd.choice(voc) for _ in range(rnd.randint(8, 40)))) for i in range(30)] + [(30, None), (31, ""), (32, "w1 " * 15)]
    docs = []
    for d in range(60):
        w = [rnd.choice(voc) for _ in range(rnd.randint(5, 120))]
        if d % 3 == 0:
            it = items[rnd.randrange(30)][1].split()
            k = rnd.randint(6, 14)
            at = rnd.randint(0, max(len(it) - k, 0))
            w[3:3] = it[at : at + k]
        docs.append((d, ("  " if d % 2 else "\n").join(w).upper() if d % 5 else ", ".join(w)))
    docs += [(60, None), (61, " "), (62, "w1 " * 40), (62, "w1 " * 40)]
    got = {(r.d, r.i) for r in leaks.leaks(spark.createDataFrame(docs, "d long, t string"), "d", "t", spark.createDataFrame(items, "i long, t string"), "i", "t", IDENTITY).collect()}
    grams = lambda t: {tuple(w[k : k + 12]) for w in [words((t or "").lower())] for k in range(len(w) - 11)}
    want = {(d, i) for d, a in docs for i, b in items if grams(a) & grams(b)}
    assert got == want and want


def test_size_classes():
    """Every run lies whole in a domain and in a query, large domains have more registers, and short leaks in long texts are found."""
    d = leaks.Domains(12)
    assert d.counts == sorted(d.counts) and all((1 - 8 / (s - 4 + 60 - 8)) ** m <= leaks.MISS for s, m in zip(d.sizes, d.counts))
    for n in (12, 13, 64, 65, 256, 257, 1000):
        for size in (leaks.ITEM_WORDS, d.sizes[-1]):
            spans = leaks.cuts(n, size, 12)
            assert all(b - a <= size for a, b in spans) and all(any(a <= k and k + 12 <= b for a, b in spans) for k in range(n - 11))
    rnd = random.Random(1)
    items = [(i, [f"i{i}w{rnd.randrange(9999)}" for _ in range(90)]) for i in range(40)]
    known, found = leaks.Items(items, d), 0
    for i, ws in items:
        at = rnd.randrange(79)
        doc = [f"x{rnd.randrange(9999)}" for _ in range(2000)]
        doc[1500:1512] = ws[at : at + 12]
        h = d.hashes(doc)
        found += any(i in known.candidates(d.values(d.shingles(h[a:b]), m)) for a, b, m in d.spans(len(doc)))
    assert found == 40


def test_leaks_of_many_documents_are_searched_together(monkeypatch):
    """Words and shingles are hashed once for many documents, registers in half the memory; what is found is what each document holds."""
    monkeypatch.setattr(leaks, "LOOKUPS", 7)
    monkeypatch.setattr(leaks, "HITS", 50)
    rnd = random.Random(3)
    d = leaks.Domains(12)
    items = [(i, [f"v{rnd.randrange(400)}" for _ in range(80)]) for i in range(30)]
    items += [(30 + i, items[0][1][:40] + [f"y{i}"] * 14) for i in range(20)]
    docs = []
    for n in range(200):
        ws = [f"v{rnd.randrange(400)}" for _ in range(rnd.choice((12, 20, 90, 700)))]
        if n % 3 == 0:
            k, at = rnd.randint(9, 14), rnd.randrange(len(ws))
            ws[at:at] = items[rnd.randrange(50)][1][5 : 5 + k]
        docs.append((n, ws))
    docs += [(200, items[0][1]), (201, items[0][1][:11] + items[0][1][12:24])]
    calls, shingles = [], d.shingles
    known = leaks.Items(items, d)
    monkeypatch.setattr(d, "shingles", lambda h: calls.append(1) or shingles(h))
    got = [r for part in leaks.blocks(docs) for r in known.leaked(part, d)]
    assert len(calls) == len(list(leaks.blocks(docs))) <= 2 and d.minima(shingles(d.hashes(docs[0][1])), 110).dtype.itemsize == 4
    want = {(a, b) for a, x in docs for b, y in items if leaks.runs(x, 12) & leaks.runs(y, 12)}
    assert {r[:2] for r in got} == want and len(got) == len(want) > 60
    for a, b, size, share in got:
        h = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (docs[a][1], items[b][1])]
        assert size == len(docs[a][1]).bit_length() - 1 and abs(share - len(h[0] & h[1]) / len(h[1])) < 1e-9
    none = leaks.Items([], d)
    assert list(none.leaked(docs, d)) == [] and list(leaks.blocks([])) == []


@pytest.mark.parametrize("in_memory", [True, False])
def test_leaks_of_repeated_words(spark, monkeypatch, in_memory):
    """A run of one or two words over and over has one or two distinct shingles, among many others in both texts."""
    if not in_memory:
        monkeypatch.setattr(leaks, "IN_MEMORY", 0)
    refrains = [[f"la{i}"] * 12 if i % 2 else [f"la{i}", f"lo{i}"] * 6 for i in range(30)]
    fill = lambda name, n: [f"{name}{k}" for k in range(n)]
    items = [(i, " ".join([*fill(f"a{i}x", 20), *r, *fill(f"b{i}x", 30)])) for i, r in enumerate(refrains)]
    docs = [(i, " ".join([*fill(f"c{i}x", 150), *r[i % 3 // 2 :], *fill(f"d{i}x", 90)])) for i, r in enumerate(refrains)]
    got = {(r.d, r.i) for r in leaks.leaks(spark.createDataFrame(docs, "d long, t string"), "d", "t", spark.createDataFrame(items, "i long, t string"), "i", "t", IDENTITY).collect()}
    assert got == {(i, i) for i in range(30) if i % 3 < 2}
    g = np.array([5, 7, 5, 5, 7, 9], dtype=np.uint64)
    assert len(set(leaks.numbered(g).tolist())) == 6 and set(leaks.numbered(g[:4]).tolist()) < set(leaks.numbered(g).tolist())


@pytest.mark.parametrize("size", [32, 256])
def test_registers_agree_as_often_as_shingles_are_shared(size):
    d, rng = leaks.Domains(12), np.random.default_rng(5)
    m, n, likeness = d.counts[d.sizes.index(size)], size - 4, 8 / (size - 4 + 60 - 8)
    agree = []
    for _ in range(4000):
        g = rng.integers(0, 2**64, n + 52, dtype=np.uint64)  # 60 shingles of a query, 8 of them in the domain
        agree.append(d.values(g[:n], m) == d.values(g[n - 8 :], m))
    agree = np.array(agree)
    assert abs(agree.sum(axis=1).mean() / m - likeness) < 0.001 and abs(agree.sum(axis=1).var() / (m * likeness * (1 - likeness)) - 1) < 0.1
    assert abs((~agree[:, : m // 4].any(axis=1)).mean() - (1 - likeness) ** (m // 4)) < 0.015


def test_mix(spark):
    rnd = random.Random(6)
    docs = [(i, "big" if i % 3 else " Small ", " ".join(["word"] * rnd.randint(5, 30)) + f" {i}") for i in range(600)]
    docs += [(600, "big", None), (601, "big", " "), (602, "big", docs[1][2]), (603, None, "x y"), (604, "other", "x z")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    t = spark.createDataFrame([("big", 0.3, 1), ("SMALL", 0.6, 2), ("absent", 0.1, 5)], "source string, target_share double, max_repeats int")
    chosen, shares = mixing.mix(df, t)
    s = {r.source: r for r in shares.collect()}
    assert abs(s["big"].actual_share - 0.3 / 0.9) < 0.01 and abs(s["small"].actual_share - 0.6 / 0.9) < 0.01 and s["absent"].tokens_used == 0
    rows = chosen.collect()
    assert len({r.doc_id for r in rows}) == len(rows) and not {600, 601, 602, 603, 604} & {r.doc_id for r in rows}
    assert all(1 <= r.copies <= {"big": 1, "small": 2}[r.source] for r in rows)
    assert {r.doc_id for r in rows} == {r.doc_id for r in mixing.mix(df.repartition(7), t)[0].collect()}
    assert mixing.mix(df.limit(0), t)[0].count() == 0
    few = {r.source: r.tokens_used for r in mixing.mix(df, t, total_tokens=900)[1].collect()}
    assert abs(few["big"] - 300) < 40 and abs(few["small"] - 600) < 40


def test_mix_keeps_texts_first_seen_outside_the_targets(spark):
    docs = [(1, "other", "shared one"), (2, "big", "shared one"), (3, None, "shared two"), (4, "big", "shared two"), (5, "small", "shared two"), (6, "other", "only there")]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    t = spark.createDataFrame([("big", 0.5, 1), ("small", 0.5, 1)], "source string, target_share double, max_repeats int")
    chosen, shares = mixing.mix(df, t)
    assert {(r.doc_id, r.source, r.copies) for r in chosen.collect()} == {(2, "big", 1), (4, "big", 1)}
    assert {r.source: (r.texts, r.texts_of_other_sources) for r in shares.collect()} == {"big": (2, 0), "small": (0, 1)}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run(spark, data, name):
    assert queries.QUERIES[name](spark, data).count() > 0


def test_token_counts_of_each_text_add_up_to_the_budget(spark, data):
    counts = queries.QUERIES["p2_token_counts"](spark, data).collect()
    texts = [r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()] + [r.original_poem for r in spark.read.parquet(f"{data}/source_records.parquet").collect()]
    assert len({(r.table_name, r.id) for r in counts}) == len(counts) == sum(t is not None for t in texts)
    sums = {}
    for r in counts:
        n = sums.setdefault((r.source, r.language, r.text_domain), [0, 0, 0])
        n[:] = n[0] + 1, n[1] + r.n_tokens, n[2] + r.n_longest_match
    budget = queries.p2_token_budget(spark, data).collect()
    assert {(r.source, r.language, r.text_domain): [r.n_texts, r.n_tokens, r.n_longest_match] for r in budget} == sums


def test_normal_form_feeds_near_copies(spark):
    rows = [("a", "Тhe", "one two three four five six"), ("b", "The", "one two three four ﬁve​ six"), ("c", "The", "one two three four five six")]
    df = spark.createDataFrame(rows, "id string, t string, o string")
    m = lookalike.fit_representatives([(df, ["t", "o"])])
    members, links = neardup.near_copies(df, "id", ["t", "o"], "o", m, 2, 0.6)
    assert ("a", "c") in {(r.id_a, r.id_b) for r in neardup.record_pairs(members, links, "id").collect()}
