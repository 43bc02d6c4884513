"""Nested records, paths, patches, planning, calls, sources and sinks."""

import json
import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillspark.functions import json_paths as jp
from quillspark.operators import calls, corpus, nested, planning, vectors
from quillspark.plans import records
from quillspark.sources import sinks, tables

ANN = {"recitation_style": "lament", "stanzas": [{"index": 1, "metaphor_spans": {"vehicle": "a", "metaphor_mapping": {"vehicle_concept": "x"}}}, None, {"index": 3, "metaphor_spans": [None, {"vehicle": "b"}], "translation_loss": [{"severity": "low"}]}], "cultural_entities": [{"term": "t"}, {"term": "t"}]}
PATHS = {"$", "stanzas[0]", "stanzas[0].metaphor_spans[0]", "stanzas[0].metaphor_spans[0].metaphor_mapping", "stanzas[2]", "stanzas[2].metaphor_spans[1]", "stanzas[2].translation_loss[0]", "cultural_entities[0]", "cultural_entities[1]"}
COMPACT = {"rs": "lament", "st": [{"i": 1, "ms": [{"src": "a"}]}], "ce": {"tm": "t"}}


def texts_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "result_id long, j string"), "result_id", "j"


def bridge(spark, texts):
    return nested.occurrences(*texts_of(spark, texts))


@pytest.mark.parametrize("wrap", [json.dumps, lambda a: "```json\n" + json.dumps(a) + "\n```", lambda a: json.dumps(json.dumps(a)), lambda a: json.dumps({"schema_version": "1.1", "annotation": a})])
def test_shapes(spark, wrap):
    assert {r.object_path for r in bridge(spark, [wrap(ANN)]).collect()} == PATHS


def test_broken_null_empty_and_compact(spark):
    rows = bridge(spark, [json.dumps(ANN)[:-7], None, "", "[]", "7", json.dumps(COMPACT)]).collect()
    assert {r.result_id for r in rows} == {5}
    assert {r.object_path for r in rows} == {"$", "stanzas[0]", "stanzas[0].metaphor_spans[0]", "cultural_entities[0]"}
    assert json.loads(next(r.fields for r in rows if r.kind == "cultural_entity")) == {"term": "t"}
    assert nested.distinct_objects(*texts_of(spark, [])).count() == 0


SHAPES = {"plain": json.dumps, "indented": lambda a: json.dumps(a, indent=1), "fence": lambda a: "```json\n" + json.dumps(a) + "\n```", "string": lambda a: json.dumps(json.dumps(a)),
          "wrapper": lambda a: json.dumps({"schema_version": "1.1", "annotation": a})}


def delivered(spark, tmp_path, rows, issues=()):
    spark.createDataFrame(rows, "result_id long, poem_id string, attempt_no int, normalized_annotation string").write.parquet(f"{tmp_path}/validation_results.parquet")
    spark.createDataFrame(list(issues), "issue_id long, result_id long, field_path string").write.parquet(f"{tmp_path}/invalid_path_issues.parquet")
    return str(tmp_path)


def test_issue_values_in_every_shape(spark, tmp_path):
    a = {"recitation_style": "lament", "stanzas": [{"index": 1, "emotion": "grief", "metaphor_spans": {"source_term": "a"}}]}
    c = {"rs": "lament", "st": [{"i": 1, "em": "grief", "ms": {"src": "a"}}]}
    texts = [w(a) for w in SHAPES.values()] + [w(c) for w in SHAPES.values()] + [json.dumps(a)[:-7], None]
    paths = {"stanzas[0].emotion": '"grief"', "/annotation/stanzas/0/metaphor_spans/0/source_term": '"a"', "stanzas[0].metaphor_spans.source_term": '"a"', "st[0].em": '"grief"', "stanzas[0].tone": None}
    issues = [(r * 10 + n, r, p) for r in range(len(texts)) for n, p in enumerate(paths)]
    d = delivered(spark, tmp_path, [(r, f"p{r}", 1, t) for r, t in enumerate(texts)], issues)
    got = {r.issue_id: (r.status, r.value) for r in records.issue_values(spark, d).collect()}
    for i, r, p in issues:
        v = paths[p]
        assert got[i] == (("bad_json", None) if r >= len(texts) - 2 else ("found", v) if v else ("missing_key", None)), (r, p)


def test_attempts_differ_by_content_not_shape(spark, tmp_path):
    a = {"recitation_style": "lament", "stanzas": [{"index": 1, "emotion": "grief"}]}
    c = {"rs": "lament", "st": [{"i": 1, "em": "fear"}]}
    rows = [(n, k, no, t) for n, (k, no, t) in enumerate(x for k, w in SHAPES.items() for x in ((k, 1, json.dumps(a)), (k, 2, w(a)), ("c" + k, 1, json.dumps(a)), ("c" + k, 2, w(c))))]
    got = {tuple(r) for r in records.attempt_differences(spark, delivered(spark, tmp_path, rows)).select("poem_id", "path", "before", "after").collect()}
    assert got == {("c" + k, "stanzas[0].emotion", '"grief"', '"fear"') for k in SHAPES}


def test_identical_subtrees_share_a_hash(spark):
    texts = [json.dumps(ANN), json.dumps(ANN | {"theme": "x"})]
    b = bridge(spark, texts)
    h = {(r.result_id, r.object_path): r.object_hash for r in b.collect()}
    assert h[0, "cultural_entities[0]"] == h[0, "cultural_entities[1]"] == h[1, "cultural_entities[0]"]
    assert h[0, "stanzas[2]"] == h[1, "stanzas[2]"] and h[0, "$"] != h[1, "$"]
    o = nested.distinct_objects(*texts_of(spark, texts))
    assert o.agg(F.sum("n_occurrences")).first()[0] == b.count() and o.count() == len({r.object_hash for r in b.collect()})
    assert "fields" not in nested.bridge(*texts_of(spark, texts)).columns and not o.where("fields IS NULL").count()


def test_annotations_are_rebuilt_from_objects_stored_once(spark):
    """Bridge and objects hold everything but the elements of lists that are no objects, which come back as null."""
    more = [ANN, ANN | {"theme": "x"}, ANN, {"recitation_style": "lament", "stanzas": [], "odd": {"a": [1, {"b": None}]}}, COMPACT]
    args = texts_of(spark, [json.dumps(a) for a in more])
    got = {r.result_id: json.loads(r.tree) for r in nested.rebuilt(nested.bridge(*args), nested.distinct_objects(*args), "result_id").collect()}
    for i, a in enumerate(more):
        want = nested.full_object(a, "annotation")
        assert {k: v for k, v in want.items() if v != []} == got[i], (want, got[i])


def test_wrappers_and_depth_without_limit(spark):
    wrapped = json.dumps(ANN)
    for k in range(40):
        wrapped = json.dumps(json.dumps({"annotation": json.loads(wrapped)}) if k % 9 == 0 else {"annotation": json.loads(wrapped)})
    deep = json.dumps(ANN)[:-1] + ', "deep": ' + '{"x": [' * 40_000 + '"]} \\" é"' + "]}" * 40_000 + "}"
    b = bridge(spark, [wrapped, deep, deep[:-1]])
    assert {(r.result_id, r.object_path) for r in b.collect()} == {(i, p) for i in (0, 1) for p in PATHS}
    s = nested.statuses(*texts_of(spark, [wrapped, deep, deep[:-1], None, " ", "[1, 2]"]))
    assert [r.status for r in s.orderBy("result_id").collect()] == ["read", "read", "unreadable", "null", "blank", "unreadable"]


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.floats(allow_nan=False, allow_infinity=False) | st.text(max_size=4), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3), max_leaves=12), st.integers(0, 60))
def test_deep_reader_reads_what_json_reads(value, cut):
    text = json.dumps(value, indent=cut % 3 or None)
    assert nested.load_deep(text) == value and nested.canonical_deep(value) == nested.canonical(value)
    part = text[:cut]
    try:
        want = json.loads(part)
    except ValueError:
        with pytest.raises(ValueError):
            nested.load_deep(part)
    else:
        assert nested.load_deep(part) == want

@pytest.mark.parametrize("path,want", [
    ("$", "$"), ("theme", "$"), ("cultural_entities", "$"), ("/stanzas/0/loss_note", "stanzas[0]"), (" $.stanzas[1].metaphor_spans ", "stanzas[1]"),
    ("annotation.stanzas.0.metaphor_spans.2.tenor", "stanzas[0].metaphor_spans[2]"), ("st[0].ms[1].am", "stanzas[0].metaphor_spans[1]"),
    ("stanzas[0].metaphor_spans[1].metaphor_mapping.transferred_attributes[2]", "stanzas[0].metaphor_spans[1].metaphor_mapping"),
    ("stanzas[0].metaphor_spans[1].metaphor_mapping", "stanzas[0].metaphor_spans[1].metaphor_mapping"), (None, None), ("  ", None),
])
def test_paths_to_objects(path, want):
    assert nested.object_of_path(path) == want


def test_clashing_and_extra_columns(spark):
    df = spark.createDataFrame([(1, json.dumps(ANN), "x", "y")], "result_id long, j string, object_path string, kind string")
    assert nested.occurrences(df, "result_id", "j").count() == len(PATHS)


JSON = st.recursive(st.none() | st.booleans() | st.integers(-9, 9) | st.text("abc", max_size=3), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text("xyz", min_size=1, max_size=2), x, max_size=3), max_leaves=12)


@settings(max_examples=120, deadline=None)
@given(JSON)
def test_paths_round_trip(value):
    assert jp.differences(value, value) == []
    for path, leaf in jp.leaves(value):
        if path and not path.startswith("["):
            assert jp.walk(value, path) == leaf
            changed = jp.put(value, path, "new!")
            assert jp.walk(changed, path) == "new!" and jp.differences(value, changed) == [path]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.text("xyz", min_size=1, max_size=2), JSON, min_size=1, max_size=4), st.data())
def test_cut_off_json_is_closed(value, draw):
    text = json.dumps(value)
    cut = draw.draw(st.integers(1, len(text)))
    got = jp.close_json(text[:cut])
    assert isinstance(got, dict)
    if cut == len(text):
        assert got == value


@pytest.mark.parametrize("path,code", [("", "empty_path"), ("a..b", "bad_syntax"), ("a[-1]", "bad_syntax"), ("q", "missing_key"), ("a[7]", "index_out_of_range"), ("b[0]", "not_a_list"), ("b.c", "not_an_object")])
def test_path_errors(path, code):
    with pytest.raises(jp.PathError) as e:
        jp.walk({"a": [1], "b": 2}, path)
    assert e.value.code == code
    assert jp.get({"a": [1], "b": 2}, path, "none") == "none"


def test_repair_presence():
    assert jp.repair_value("old", "p", {"p": "new"}, set()) == ("new", False)
    assert jp.repair_value("old", "p", {"p": None}, set()) == (None, False)
    assert jp.repair_value("old", "p", {}, set()) == ("old", True)
    assert jp.repair_value("old", "p", {"p": None}, {"p"}) == ("old", True)


def test_patches_are_all_or_nothing():
    doc = {"a": None, "b": [], "c": "kept"}
    assert jp.apply_patches(doc, [("a", "x"), ("b", ["y"])]) == ({"a": "x", "b": ["y"], "c": "kept"}, [])
    assert jp.apply_patches(doc, [("a", "x"), ("c", "z")]) == (doc, [("c", "already_filled")])
    assert jp.apply_patches(doc, [("a", "x"), ("q", 1)])[1] == [("q", "missing_key")]
    assert jp.apply_patches(doc, [("a", "x")], {"b"})[1] == [("a", "not_requested")]


def naive_pack(sizes, paths, units):
    out, b, p, u = [], 0, 0, 0
    for n in sizes:
        if u == 0 or p + n > paths or u + 1 > units:
            b, p, u = b + 1, n, 1
        else:
            p, u = p + n, u + 1
        out.append(b)
    return out


def test_packing_equals_a_loop(spark):
    import random

    rnd = random.Random(3)
    rows = [(k, f"cultural_entities[{e}].f{j}") for k in range(12) for e in range(rnd.randint(1, 9)) for j in range(rnd.randint(1, 5))]
    us = planning.units(spark.createDataFrame(rows, "k int, p string"), "k", "p")
    got = {r.k: r.b for r in us.select("k", planning.batch_numbers(F.col("units"), 6, 3).alias("b")).collect()}
    sizes = {r.k: [len(u.paths) for u in r.units] for r in us.collect()}
    assert got == {k: naive_pack(s, 6, 3) for k, s in sizes.items()}
    parts = planning.split_parts(us, "k", 3, 8)
    assert sorted((r.k, p) for r in parts.collect() for p in r.paths) == sorted(set(rows))


def test_results_with_a_unit_over_the_cap_are_reported(spark, tmp_path):
    """Result 1 has one unit of 21 paths and a fitting one, 2 splits into three parts, 3 has two units."""
    from quillspark.plans import planning as plans

    big = [(1, f"cultural_entities[0].f{j}") for j in range(21)] + [(1, "stanzas[0].emotion")]
    rest = [(2, f"stanzas[{i}].emotion") for i in range(3)] + [(3, f"stanzas[{i}].tone") for i in range(2)]
    rows = [(n, r, p, None) for n, (r, p) in enumerate(big + rest)]
    spark.createDataFrame(rows, "issue_id long, result_id long, field_path string, validation_reason string").write.parquet(f"{tmp_path}/invalid_path_issues.parquet")
    got = {(r.result_id, r.part_index, r.n_parts, r.reason, r.n_units, len(r.paths.split(";"))) for r in plans.split_overlay(spark, str(tmp_path)).collect()}
    assert got == {(1, None, 0, "unit_over_cap", 2, 22), *((2, i, 3, None, 1, 1) for i in (1, 2, 3)), *((3, i, 2, "fewer_units", 1, 1) for i in (1, 2))}
    faults = plans.coverage_faults(spark, str(tmp_path)).collect()
    assert {(r.result_id, r.path, r.n) for r in faults} == {(r, p, None) for r, p in big} and len(faults) == 22


def test_deal_is_fair_and_ordered(spark):
    rows = [("Hindi" if i % 3 else "Tamil", f"id_{i:05d}") for i in range(1000)]
    got = {r.id: r.worker for r in corpus.deal(spark.createDataFrame(rows, "lang string, id string"), F.col("lang"), "id", 3).collect()}
    assert got == {i: k % 3 for k, (_, i) in enumerate(sorted(rows))}


def test_running_sums_equal_a_loop(spark):
    """Ids of many lengths, ties, nulls among the group keys; blocks of one and of many rows."""
    import random

    rnd = random.Random(5)
    rows = sorted({(rnd.choice([None, "a", "b"]), "".join(rnd.choice("xyz") for _ in range(rnd.randint(0, 9)))) for _ in range(400)}, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    rows = [(g, i, k % 7) for k, (g, i) in enumerate(rows)]
    df = spark.createDataFrame(rows, "g string, i string, v int").repartition(5)
    keyed = df.withColumns({"s": F.substring("i", 1, 1), "b": F.substring("i", 1, 3)})
    got = {(r.g, r.i): (r.n, r.total) for r in corpus.running(keyed, ["g", "s"], ["b"], ["i"], {"total": "v"}, "n").collect()}
    total, want = 0, {}
    for n, (g, i, v) in enumerate(rows, 1):
        total += v
        want[g, i] = (n, total)
    assert got == want
    assert {(r.g, r.i): r.n for r in corpus.exact_numbers(df, ["g"], "i", "n", 2, 1).collect()} == {k: n for k, (n, _) in want.items()}


def test_written_tables_are_swept(spark):
    import pathlib

    from quillspark import session

    df = session.written(spark.range(3).toDF("id"), "swept")
    path = pathlib.Path(next(p for _, p in session._written if "swept" in p).removeprefix("file://"))
    assert df.count() == 3 and path.exists()
    assert session.sweep() > 0 and not path.exists()


def test_clusters_need_a_shared_folder():
    from quillspark import session

    class Context:
        master, applicationId = "spark://somewhere:7077", "x"

    class Conf:
        get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError):
        session.shared_dir(type("S", (), {"conf": Conf, "sparkContext": Context})())


def test_retries():
    waits, codes = [], [503, 429]

    def client(request):
        if codes:
            raise calls.CallError(codes.pop(0))
        return {"text": "ok", "finish_reason": "STOP"}

    assert calls.call(client, {}, waits.append) == ("success", 3, None, "ok", "STOP") and waits == [2.0, 4.0]

    def refuse(request):
        raise calls.CallError(403)

    assert calls.call(refuse, {}, waits.append)[:3] == ("failed", 1, 403)


def test_chain_of_clients():
    def broken(request):
        raise calls.CallError(403)

    tells = lambda request: {"text": f"after {request['previous']}", "finish_reason": "STOP"}
    assert calls.call_chain([broken, lambda r: {"text": "{", "finish_reason": "STOP"}, tells], {}, lambda t: t.startswith("after"))[:5] == (2, "success", 1, None, "after {")
    assert calls.call_chain([broken], {}, bool)[0] == -1


def test_batches_run_in_order_and_stop(spark):
    from quillspark.operators import progress

    ran = []
    assert progress.run_sequence([1, 2, 3, 4], lambda b: ran.append(b) or b != 3, {1}) == [(2, "success"), (3, "failed")] and ran == [2, 3]
    parts = spark.createDataFrame([(1, 1, 3, None, 1, ["a"]), (1, 2, 3, None, 3, ["b", "c", "d"]), (2, 1, 2, None, 1, ["a"]), (2, 1, 2, None, 1, ["a"]), (3, None, 0, "unit_over_cap", 1, ["x"]), (4, 1, 1, "fewer_units", 1, ["y"])],
                                  "k int, part_index int, n_parts int, reason string, n_units int, paths array<string>")
    got = {(r.k, r.rule) for r in progress.overlay_faults(parts, "k", 2).collect()}
    assert got == {(1, "part_over_cap"), (1, "uneven_parts"), (1, "part_numbers"), (2, "part_numbers"), (2, "path_in_two_parts"), (2, "reason_missing"), (3, "not_split")}


def test_repairs_four_ways(spark):
    """Left open wins over absent, absent over null, null over a value; unasked answers change nothing."""
    from quillspark.operators import patches

    asked = spark.createDataFrame([(1, p, "old") for p in ("value", "null", "absent", "open_absent", "open_null")] + [(2, "x", None)], "k int, path string, old string")
    text = json.dumps({"value": "new", "null": None, "open_null": None, "other": "z", "unresolved_items": [{"field_path": "open_absent", "candidate_value": "c"}, {"field_path": "open_null"}]})
    answers = patches.answer_rows(spark.createDataFrame([(1, f"```json\n{text}\n```"), (2, "{")], "k int, t string"), "k", "t")
    got = {(r.k, r.path): (r.answer, r.value, r.unresolved) for r in patches.repaired(asked, answers, "k").collect()}
    assert got == {(1, "value"): ("value", "new", False), (1, "null"): ("null", None, False), (1, "absent"): ("absent", "old", True), (1, "open_absent"): ("left_open", "old", True), (1, "open_null"): ("left_open", "old", True), (2, "x"): ("absent", None, True)}


def test_patches_of_a_document_are_applied_together(spark):
    from quillspark.operators import patches

    tree = {"recitation_style": "lament", "stanzas": [{"index": 1, "emotion": None, "tone": "prayer"}]}
    b = bridge(spark, [json.dumps(tree)] * 3)
    p = [(0, 1, "stanzas[0].emotion", "grief"), (0, 2, "theme", "t"), (1, 3, "stanzas[0].emotion", "joy"), (1, 4, "theme", "t"), (2, 5, "stanzas[0].tone", "wonder"), (2, 6, "stanzas[4].tone", "wonder"), (2, 7, "stanzas[0].term", "x"), (2, 8, "theme", None), (2, 9, "a..b", "x"), (2, 10, "recitation_style", "lament"), (2, 11, "nothing", "x")]
    v = patches.verdicts(spark.createDataFrame(p, "result_id long, issue_id int, path string, value string"), b)
    assert {r.issue_id: r.verdict for r in v.collect()} == {1: "ok", 2: "ok", 3: "outside_vocabulary", 4: "ok", 5: "already_filled", 6: "no_object", 7: "unknown_field", 8: "no_value", 9: "bad_syntax", 10: "ok", 11: "unknown_field"}
    assert {r.issue_id for r in v.where("applied").collect()} == {1, 2}
    after = {(r.result_id, r.object_path, r.field): r.value for r in patches.patched_fields(patches.fields(b), v).collect()}
    assert after[0, "stanzas[0]", "emotion"] == "grief" and after[0, "$", "theme"] == "t" and (1, "$", "theme") not in after and after[2, "stanzas[0]", "tone"] == "prayer"


def test_calls_and_repair_rounds(spark):
    df = spark.createDataFrame([(i, f"p{i}") for i in range(6)], "id int, prompt string")
    done = calls.run_calls(df, ["id"], "prompt", lambda: lambda r: {"text": r["prompt"].upper(), "finish_reason": "STOP"}, sleep=lambda s: None)
    assert {(r.id, r.text) for r in done.collect()} == {(i, f"P{i}") for i in range(6)}
    assert {r.outcome for r in calls.run_calls(df, ["id"], "prompt", None, dry_run=True).collect()} == {"planned"}
    again = calls.run_calls(df, ["id"], "prompt", lambda: lambda r: {"text": r["request_key"], "finish_reason": "STOP"}, sleep=lambda s: None, ledger=done.where("id < 4"))
    assert {r.id for r in again.collect()} == {4, 5} and len({r.text for r in again.collect()}) == 2
    state, n = calls.repair_rounds(spark.createDataFrame([(1, 3), (2, 0), (3, 1)], "id int, left int"), lambda s: s.where("left > 0"), lambda s, todo, k: s.withColumn("left", F.greatest(F.col("left") - 1, F.lit(0))))
    assert n == 2 and {(r.id, r.left) for r in state.collect()} == {(1, 1), (2, 0), (3, 0)}


def test_sources(spark, tmp_path):
    rec = {"poem_id": "p1", "poem_title": "t", "language": "Hindi", "original_poem": "a", "translated_poem": "b"}
    d = tmp_path / "records"
    d.mkdir()
    (d / "p1.json").write_text(json.dumps(rec, indent=1))  # a record of several lines
    (d / "p2.json").write_text(json.dumps(rec | {"poem_id": "p2", "more": 1}))
    (d / "p3.json").write_text(json.dumps({k: v for k, v in rec.items() if k != "language"}))
    (d / "p4.json").write_text(json.dumps(rec))
    assert [r.key_fault for r in tables.record_files(spark, str(d)).orderBy("path").collect()] == [None, "extra:more", "missing:language", "id_is_not_the_file_name"]
    for k, v in enumerate(([rec], {"poems": [rec, rec]})):
        (tmp_path / f"a{k}.json").write_text(json.dumps(v, indent=k))
        assert tables.record_array(spark, str(tmp_path / f"a{k}.json")).count() == k + 1
    (tmp_path / "a.csv").write_text("poem_id,language,assignee\n p1 ,Hindi,x\np1,Hindi,y\n")
    (tmp_path / "a.csv").write_text("poem_id,language,assignee\n p1 ,Hindi,x\n\np1,Hindi,y\np2,,\"z, w\"\n")
    rows, faults = tables.assignment_csv(spark, str(tmp_path / "a.csv"))
    assert {tuple(r) for r in rows.collect()} == {("p1", "Hindi", "x", 2), ("p1", "Hindi", "y", 4), ("p2", None, "z, w", 5)}
    assert {(r.poem_id, r.fault, tuple(r.lines)) for r in faults.collect()} == {("p1", "repeated_id", (2, 4)), ("p2", "blank_language", (5,))}
    recs = tables.validated(spark.createDataFrame([("a", "Hindi"), ("b", " "), ("c", "Klingon"), ("d", "hindi "), ("d", "Hindi"), (None, "Hindi")], "poem_id string, language string"), ["Hindi"])
    assert sorted((r.poem_id or "", r.fault or "") for r in recs.collect()) == [("", "blank_id"), ("a", ""), ("b", "no_language"), ("c", "unknown_language"), ("d", "repeated_id"), ("d", "repeated_id")]
    assert tables.or_raise(recs.where("fault IS NULL"), "fault", "poem_id").count() == 1
    with pytest.raises(Exception, match="unknown_language"):
        tables.or_raise(recs.where("poem_id = 'c'"), "fault", "poem_id").collect()
    d = tmp_path / "profiles"
    d.mkdir()
    for name, body in (("a.json", '{"language": "Hindi", "rules": []}'), ("b.JSON", '{"language": "hindi", "rules": []}'), ("c.json", '{"language": "Tamil"}'), ("e.json", "{"), ("x.txt", "no")):
        (d / name).write_text(body)
    got = {(r.path.rsplit("/", 1)[1], r.fault) for r in tables.profiles(spark, str(d), ["language", "rules"]).collect()}
    assert got == {("a.json", "repeated_language"), ("b.JSON", "repeated_language"), ("c.json", "missing:rules"), ("e.json", "not_json")}
    b = spark.createDataFrame([("q", 1, "q1"), ("p", 2, "p2"), ("p", 1, "p1")], "poem_id string, batch_index int, batch_id string")
    done = spark.createDataFrame([("p1",), ("zz",)], "batch_id string")
    assert [r.batch_id for r in tables.open_batches(b, done).collect()] == ["p2", "q1"] and tables.unknown_batches(done, b).first().batch_id == "zz"
    (tmp_path / "t.jsonl").write_text('{"term": "a"}\nbroken\n')
    assert {(r.term, r._corrupt) for r in tables.json_lines(spark, str(tmp_path / "t.jsonl"), "term string").collect()} == {("a", None), (None, "broken")}


def test_sheet(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>id</t></si><si><t>title</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row>'
                   '<row r="3"><c r="A3"><v>7</v></c><c r="C3" t="inlineStr"><is><t>x</t></is></c></row></sheetData></worksheet>')  # fmt: skip
    assert tables.sheet_rows(str(tmp_path / "b.xlsx")) == [(1, ["id", "", "title"]), (3, ["7", "", "x"])]
    got = tables.sheet(spark, str(tmp_path / "b.xlsx"), ["id", "", "title"][:1])
    assert [tuple(r) for r in got.collect()] == [(3, "7")]
    assert tables.column_number("AA") == 26


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "id string, lang string, n int")
    sinks.full_refresh(df, str(tmp_path / "j"), "lang")
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    assert sinks.append_new(df, str(tmp_path / "p"), "id") == 2
    assert sinks.append_new(df.unionByName(spark.createDataFrame([("c", "x", 3)], df.schema)), str(tmp_path / "p"), "id") == 1
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3
    sinks.per_worker_csv(df, str(tmp_path / "c"), "lang", "id")
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 2
    out = spark.createDataFrame([("b1", 1, "safety"), ("b1", 2, "odd"), ("b1", 1, "safety")], "batch string, attempt int, classification string")
    assert sinks.record_outcomes(out, str(tmp_path / "o"), ["batch", "attempt"]) == 2 and sinks.record_outcomes(out, str(tmp_path / "o"), ["batch", "attempt"]) == 0
    assert {r.classification for r in spark.read.parquet(str(tmp_path / "o")).collect()} == {"SAFETY", "UNKNOWN"}
    sinks.metadata_manifest(df, str(tmp_path / "m"), "id", ["lang"])
    assert spark.read.json(str(tmp_path / "m")).columns == ["id", "n"]
    sinks.inventory_files(df, str(tmp_path / "i"))
    assert spark.read.json(str(tmp_path / "i/json")).count() == spark.read.option("header", True).csv(str(tmp_path / "i/csv")).count() == 2
    assert "id" in [c for c in sinks.write_and_check(df, str(tmp_path / "w"), lambda x: x.where("n > 1")).columns]
    assert "Rejected records: 1" in sinks.reject_report(spark.createDataFrame([("a", "blank"), ("b", "canonical")], "id string, route string"), "id")


def test_top_k_equals_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    v = rng.normal(size=(700, 8))
    v[5] = v[6]
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id long, v array<double>").repartition(3)
    got = {(r.query_id, r.rank): r.id for r in vectors.top_k(df, "id", "v", F.col("id") % 100 == 0, 4).collect()}
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    for q in range(0, 700, 100):
        s = u @ u[q]
        order = [i for i in sorted(range(700), key=lambda i: (-round(s[i], 12), i)) if i != q][:4]
        assert [got[q, k + 1] for k in range(4)] == order
    one = spark.createDataFrame([([1.0, 0.0], None), ([0.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in one.select(vectors.cosine(F.col("a"), F.col("b"))).collect()] == [0.0, 0.0, 1.0]


def test_streams(spark, tmp_path):
    from quillspark.streaming import calls as cs

    rows = [("p", "overview", "r1", 5), ("p", "overview", "r1", 5), ("q", "loss", "r2", 7)]
    df = spark.createDataFrame(rows, "poem_id string, section_name string, response_id string, total_token_count int").withColumn("requested_at", F.to_timestamp(F.lit("2025-01-01 00:10:00")))
    df.repartition(2).write.parquet(str(tmp_path / "calls.parquet"))
    s = lambda: cs.call_stream(spark, str(tmp_path / "calls.parquet"), 2)
    assert cs.drain(cs.unique(s()), "u").count() == 2
    totals = {r.poem_id: (r.calls, r.tokens) for r in cs.drain(cs.running_totals(s()), "t", "update").collect()}
    assert totals == {"p": (2, 10), "q": (1, 7)}
    assert cs.drain(cs.hourly(s()), "h", "update").agg(F.sum("n")).first()[0] == 3
