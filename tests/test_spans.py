import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.functions import text as tx
from quillspark.operators import segments, spans

CASES = [
    ("abc  \ndef  \n", "abc  \ndef", "L1-L2", "exact", ["L1-L2"]),
    ("xxx abc yyy\nzzz def www\n", "abc yyy\nzzz def", "L1-L2", "exact", ["L1-L2"]),
    ("  first line\n  second line\n", "first line\nsecond line", "L1-L2", "exact", ["L1-L2"]),
    ("alpha\nxxx abc yyy\nzzz def www\n", "abc yyy\nzzz def", "L1", "not_found", []),
    ("abc  \ndef  \nabc  \ndef  \n", "abc  \ndef", "L1-L4", "ambiguous", ["L1-L2", "L3-L4"]),
    ("café  \nbar  \n", "café  \nbar", "L1-L2", "nfc_equivalent", ["L1-L2"]),
    ("hello world  \nsecond line\n", "hello world  ", "L1", "exact", ["L1"]),
    ("hello world  \nsecond line\n", "hello world", "L1", "exact", ["L1"]),
    ("hello world  \nsecond line\n", "nonexistent phrase", "L1", "not_found", []),
    ("abc  \ndef  \n", "abc \ndef", "L1-L2", "not_found", []),
    ("abc,  \ndef  \n", "abc.  \ndef", "L1-L2", "not_found", []),
    ("Abc  \ndef  \n", "abc  \ndef", "L1-L2", "not_found", []),
    ("aaa\n", "aa", None, "ambiguous", ["L1"]),
    ("aaa\n", "", None, "invalid_input", []),
    ("aaa\n", None, None, "invalid_input", []),
    ("aaa\n", "a", "L2-L1", "invalid_input", []),
    ("aaa\n", "a", "L7", "not_found", []),
    ("ab\r\n \rba", "b\nb", None, "exact", ["L1-L2"]),
    (" a\nb \n", "\nb", None, "exact", ["L1-L2"]),
]


def test_truth_table(spark):
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(CASES)], "id int, text string, span string, ref string")
    got = {r.id: (r.m_status, r.m_refs or []) for r in spans.ground_column(df, ["id"], "span", "text", "ref", "m").collect()}
    assert got == {i: (c[3], c[4]) for i, c in enumerate(CASES)}


@pytest.mark.parametrize("ref,want", [("L1", (1, 1)), (" L2-L5 ", (2, 5)), ("L5-L2", None), ("L01", None), ("l1", None), ("L0", None), ("", None), (None, None)])
def test_line_refs(spark, ref, want):
    r = spark.createDataFrame([(ref,)], "r string").select(tx.parse_line_ref(F.col("r")).alias("p")).first().p
    assert (tuple(r) if r else None) == want


@settings(max_examples=200, deadline=None)
@given(st.text("ab", max_size=12), st.text("ab", min_size=1, max_size=3))
def test_overlaps_equal_a_naive_count(t, s):
    assert spans.places(t, s) == [i for i in range(len(t) - len(s) + 1) if t[i : i + len(s)] == s]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab ", max_size=4), min_size=1, max_size=4), st.text("ab \n", min_size=1, max_size=5))
def test_raw_search_equals_a_walk_through_the_characters(texts, span):
    lines = [(k, l) for k, l in enumerate(texts, 1)]
    owner = [(k, c) for k, l in lines for c in [*l, "\n"]][:-1]
    joined = "".join(c for _, c in owner)
    want = []
    for i in range(len(joined) - len(span) + 1):
        part = owner[i : i + len(span)]
        if joined[i : i + len(span)] == span and part[0][1] != "\n" and part[-1][1] != "\n":
            want.append(spans.ref(part[0][0], part[-1][0]))
    assert spans.in_raw(span, lines) == (len(want), want)


def test_crlf_and_partitioning_change_nothing(spark, data):
    p = spark.read.parquet(f"{data}/source_records.parquet").select("poem_id", "original_poem")
    a = {tuple(r) for r in segments.line_index(p, "poem_id", "original_poem").drop("line_text").collect()}
    unix = F.regexp_replace(F.regexp_replace("original_poem", "\r\n", "\n"), "\n", "\r\n")
    b = {tuple(r) for r in segments.line_index(p.withColumn("original_poem", unix).repartition(7), "poem_id", "original_poem").drop("line_text").collect()}
    assert a == b


def test_term_presence(spark):
    rows = [("Ganga (river)", "the ganga flows", True), ("two  words", "a TWO words b", True), ("twowords", "two words", True), ("x", None, False), ("", "abc", False), (None, "a", False)]
    df = spark.createDataFrame([(a, b) for a, b, _ in rows], "a string, b string")
    assert [r[0] for r in df.select(tx.term_present(F.col("a"), F.col("b"))).collect()] == [w for *_, w in rows]
