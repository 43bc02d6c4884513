"""Requests, targets, budgets and tables with nothing in them."""

import pytest
from pyspark.sql import functions as F

from quillspark.operators import annotation, assembly, corpus, ledger, nested, planning, segments, vectors

CHAT = "model string, messages array<struct<role string, content string>>, t double, p double, n int"
OK = [("system", "be brief"), ("user", "hello")]


@pytest.mark.parametrize("row,want", [
    (("m", OK, 0.1, 0.9, 10), None), ((" ", OK, 0.1, 0.9, 10), "model"), (("m", [], 0.1, 0.9, 10), "no_messages"), (("m", None, 0.1, 0.9, 10), "no_messages"),
    (("m", [("robot", "x")], 0.1, 0.9, 10), "role"), (("m", [("user", " ")], 0.1, 0.9, 10), "blank_content"), (("m", [("system", "x")], 0.1, 0.9, 10), "no_user_turn"),
    (("m", OK, 2.5, 0.9, 10), "temperature"), (("m", OK, 0.1, 1.1, 10), "top_p"), (("m", OK, 0.1, 0.9, 0), "max_tokens"),
])
def test_chat_requests(spark, row, want):
    df = spark.createDataFrame([row], CHAT)
    assert df.select(assembly.chat_fault(*(F.col(c) for c in ("model", "messages", "t", "p", "n")))).first()[0] == want


def test_targets(spark):
    r = spark.createDataFrame([("a", "Hindi"), ("b", "Hindi"), ("c", "Tamil")], "poem_id string, language string")
    ids = lambda df: [x.poem_id for x in df.orderBy("poem_id").collect()]
    assert ids(assembly.targets(r)) == ["a", "b", "c"]
    assert ids(assembly.targets(r, language="Hindi", limit=1)) == ["a"]
    assert ids(assembly.targets(r, poem_id="c", language="Tamil")) == ["c"]
    assert ids(assembly.targets(r, assigned=r.where("poem_id <> 'a'"), language="Hindi", excluded=r.where("poem_id = 'b'"))) == ["c"]
    with pytest.raises(ValueError):
        assembly.targets(r, poem_id="c")


def test_budgets_and_estimates(spark):
    df = spark.createDataFrame([(i, "x" * i) for i in range(0, 45)], "i int, s string")
    got = df.select("i", assembly.token_estimate(F.col("s")).alias("e"), ledger.token_tier(F.col("i")).alias("b"), assembly.answer_budget(F.col("i")).alias("a")).collect()
    assert all(r.e == round(r.i / 4) and r.a == max(1536, min(2048, 1536 + 300 * max(r.i - 1, 0))) for r in got)
    assert {r.i: r.b for r in got if r.i in (0, 1, 20, 21, 30, 31, 40, 41)} == {0: None, 1: 4096, 20: 4096, 21: 8192, 30: 8192, 31: 24576, 40: 24576, 41: None}


def test_latest_and_once_keep_nulls_and_ties(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 1, "b"), (None, 2, "c"), (None, 2, "c")], "k string, n int, v string")
    assert sorted(r.v for r in ledger.once(df, "k", ["n", "v"]).collect()) == ["a", "c", "c"]
    assert [r.v for r in ledger.latest(df.where("k is not null"), ["k"], ["n", "v"]).collect()] == ["b"]


def test_empty_tables(spark):
    poems = spark.createDataFrame([], "poem_id string, poem_title string, language string, original_poem string, translated_poem string")
    results = spark.createDataFrame([], "result_id long, poem_id string, normalized_annotation string")
    b = nested.occurrences(results, "result_id", "normalized_annotation")
    for df in (
        segments.line_index(poems, "poem_id", "original_poem"), segments.stanza_alignment(poems, "poem_id", "original_poem", "translated_poem"), annotation.completeness(b),
        annotation.risk_findings(b), annotation.marker_findings(b, results, poems), corpus.deal(poems, F.col("language"), "poem_id", 3),
        planning.batches(planning.units(spark.createDataFrame([], "k string, p string"), "k", "p"), "k"), assembly.prompts(poems),
        vectors.top_k(spark.createDataFrame([], "id long, v array<double>"), "id", "v", F.col("id") % 100 == 0, 3),
    ):
        assert df.count() == 0


def test_alignment_with_cosines(spark):
    df = spark.createDataFrame([("a", "x\n\ny", "x\n\ny", [0.9, 0.3]), ("b", "x\n\ny", "x\n\ny", [0.9, 0.9]), ("c", "x", None, []), ("d", None, None, [])], "id string, s string, t string, c array<double>")
    got = {r.id: (r.status, r.confidence) for r in segments.stanza_alignment(df, "id", "s", "t", "c").collect()}
    assert got == {"a": ("alignment_risk", 0.84), "b": ("aligned", 0.96), "c": ("alignment_risk", 0.0), "d": ("alignment_risk", 0.4)}
