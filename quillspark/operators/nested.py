"""Problem 3: nested annotations as flat tables with parent-child links.

Every annotation is read bottom-up into a Merkle tree: an object's identity is the hash of its kind, its own fields in
canonical form and the identities of its children, in order. Identical objects, and so identical subtrees, are stored
once; every occurrence is a bridge row with its place, ordinal and parent.

Defined results: null, blank and broken-off JSON gives no rows but a status; nesting of any depth is read; wrappers, code fences and JSON inside a JSON string are
taken off; compact keys are read as full ones (a full key wins); an object where a list belongs is a list of one; null
and other elements that are no objects keep their position and give no row; repeated result ids give their rows each.
"""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import arrow_stage, partition_stage
from ..session import spread

# Compact keys by kind of object, and the fields that hold objects.
COMPACT = {
    "annotation": {"rs": "recitation_style", "ea": "emotional_arc", "st": "stanzas", "ce": "cultural_entities"},
    "stanza": {"i": "index", "em": "emotion", "to": "tone", "tq": "translation_quality", "ln": "loss_note", "ms": "metaphor_spans"},
    "metaphor_span": {"src": "source_term", "am": "abstract_meaning"},
    "cultural_entity": {"tm": "term", "rm": "romanization", "ct": "category", "si": "stanza_index", "pr": "preserved", "tn": "translation_note"},
    "translation_loss": {},
    "metaphor_mapping": {},
}
CHILD_LISTS = {
    "annotation": {"stanzas": "stanza", "cultural_entities": "cultural_entity"},
    "stanza": {"metaphor_spans": "metaphor_span", "translation_loss": "translation_loss"},
}
CHILD_OBJECTS = {"metaphor_span": {"metaphor_mapping": "metaphor_mapping"}}
TOP_KEYS = {"recitation_style", "emotional_arc", "theme", "stanzas", "cultural_entities", "rs", "ea", "st", "ce"}

FENCE = re.compile(r"```[A-Za-z]*\s*(.*?)\s*```", re.S)
TOKEN = re.compile(r"[ \t\n\r]*([\[\]{},:]|[^\s\[\]{},:\"][^\s\[\]{},:]*|\")")


def load(text: str) -> object:
    """json.loads; text nested deeper than its parser goes is read with a stack of our own."""
    try:
        return json.loads(text)
    except RecursionError:
        return load_deep(text)


def load_deep(text: str) -> object:
    """JSON of any depth. Containers are on a stack, scalars are read by json; ValueError for what is no JSON."""
    scalar = json.JSONDecoder().raw_decode
    root: list = []
    stack: list[tuple[object, object]] = [(root, None)]  # container, key that waits for its value
    at, want = 0, "value"

    def put(v: object) -> None:
        box, key = stack[-1]
        if isinstance(box, list):
            box.append(v)
        else:
            box[key] = v

    while True:
        m = TOKEN.match(text, at)
        if not m:
            if text[at:].strip(" \t\n\r") or len(stack) > 1 or want != "next" or len(root) != 1:
                raise ValueError("not JSON")
            return root[0]
        t, start = m.group(1), m.start(1)
        at = m.end()
        if t in "]}" and (want == "next" or want == "first") and len(stack) > 1 and isinstance(stack[-1][0], list if t == "]" else dict):
            stack.pop()
            want = "next"
        elif t == "," and want == "next" and len(stack) > 1:
            want = "value" if isinstance(stack[-1][0], list) else "key"
        elif want in ("value", "first") and isinstance(stack[-1][0], list) or want == "value":
            if len(stack) == 1 and root:
                raise ValueError("not JSON")
            if t in "[{":
                box: object = [] if t == "[" else {}
                put(box)
                stack.append((box, None))
                want = "first"
            elif t in "]},:":
                raise ValueError("not JSON")
            else:
                v, at = scalar(text, start)
                put(v)
                want = "next"
        elif want in ("key", "first") and t == '"':
            key, at = scalar(text, start)
            colon = TOKEN.match(text, at)
            if not colon or colon.group(1) != ":":
                raise ValueError("not JSON")
            at = colon.end()
            stack[-1] = (stack[-1][0], key)
            want = "value"
        else:
            raise ValueError("not JSON")


def parse_annotation(text: str | None) -> dict | None:
    """The annotation in a delivered text, without its wrappers, however many; None if there is none."""
    value: object = text
    while True:
        if isinstance(value, str):
            s = value.strip().lstrip("\ufeff")
            if m := FENCE.search(s):
                s = m.group(1)
            try:
                value = load(s)
            except ValueError:
                a, b = s.find("{"), s.rfind("}")
                if a < 0 or b <= a or (a == 0 and b == len(s) - 1):
                    return None
                try:
                    value = load(s[a : b + 1])
                except ValueError:
                    return None
        elif isinstance(value, dict):
            if TOP_KEYS & value.keys():
                return value
            inner = value.get("annotation")
            if inner is None:
                held = [v for v in value.values() if isinstance(v, dict) and (TOP_KEYS | {"annotation"}) & v.keys()]
                if len(held) != 1:
                    return None if value else value
                inner = held[0]
            value = inner
        elif isinstance(value, list) and len(value) == 1:
            value = value[0]
        else:
            return None


def status_of(text: str | None) -> str:
    """null, blank, read, or unreadable: broken off, or no annotation at all."""
    return "null" if text is None else "blank" if not text.strip() else "unreadable" if parse_annotation(text) is None else "read"


def full_keys(obj: dict, kind: str) -> dict:
    short = COMPACT[kind]
    out = {}
    for k, v in obj.items():
        name = short.get(k, k)
        if name == k or name not in obj:
            out[name] = v
    return out


def full_object(obj: dict, kind: str) -> dict:
    """The object with full keys, in all objects below too, and a list of one where an object stands for a list."""
    lists, singles = CHILD_LISTS.get(kind, {}), CHILD_OBJECTS.get(kind, {})
    out = {}
    for name, value in full_keys(obj, kind).items():
        if name in lists and isinstance(value, (dict, list)):
            many = [value] if isinstance(value, dict) else value
            value = [full_object(x, lists[name]) if isinstance(x, dict) else x for x in many]
        elif name in singles and isinstance(value, dict):
            value = full_object(value, singles[name])
        out[name] = value
    return out


def read_annotation(text: str | None) -> dict:
    """The annotation in a delivered text, in full form; ValueError if there is none."""
    tree = parse_annotation(text)
    if tree is None:
        raise ValueError("no annotation")
    return full_object(tree, "annotation")


def full_path(path: str) -> str:
    """A path in the notation key[n].key with full keys; a list without a position before a key is its first element."""
    kind, out, parts = "annotation", [], path.split(".")
    for n, part in enumerate(parts):
        key, bracket, index = part.partition("[")
        name, at = COMPACT.get(kind, {}).get(key, key), bracket + index
        lists, singles = CHILD_LISTS.get(kind, {}), CHILD_OBJECTS.get(kind, {})
        if name in lists and not at and n + 1 < len(parts):
            at = "[0]"
        kind = lists.get(name) or singles.get(name) or ""
        out.append(name + at)
    return ".".join(out)


def digest(*parts: str) -> str:
    return hashlib.sha256("\0".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def canonical(value: object) -> str:
    try:
        return json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
    except RecursionError:
        return canonical_deep(value)


def canonical_deep(value: object) -> str:
    """As canonical, at any depth: what is still to be written is on a stack."""
    out: list[str] = []
    todo: list[tuple[bool, object]] = [(False, value)]
    while todo:
        ready, v = todo.pop()
        if ready:
            out.append(v)
        elif isinstance(v, dict) and v:
            parts: list[tuple[bool, object]] = []
            for k in sorted(v):
                parts += [(True, ("," if parts else "{") + json.dumps(k, ensure_ascii=False) + ":"), (False, v[k])]
            todo += reversed([*parts, (True, "}")])
        elif isinstance(v, list) and v:
            parts = []
            for x in v:
                parts += [(True, "," if parts else "["), (False, x)]
            todo += reversed([*parts, (True, "]")])
        else:
            out.append(json.dumps(v, ensure_ascii=False))
    return "".join(out)


def flatten(obj: dict, kind: str, path: str, parent: str, ordinal: int, out: list) -> str:
    """Append (parent_path, object_path, kind, ordinal, n_children, hash, fields) of obj and all objects below; its hash."""
    obj = full_keys(obj, kind)
    prefix = "" if path == "$" else path + "."
    own, hashes, children = {}, [], 0
    lists, singles = CHILD_LISTS.get(kind, {}), CHILD_OBJECTS.get(kind, {})
    at = len(out)
    out.append(None)
    for name in sorted(obj):
        value = obj[name]
        if name in lists:
            many = [value] if isinstance(value, dict) else value if isinstance(value, list) else None
            if many is None:
                own[name] = value
                continue
            for i, x in enumerate(many):
                if isinstance(x, dict):
                    children += 1
                    hashes.append(f"{name}[{i}]=" + flatten(x, lists[name], f"{prefix}{name}[{i}]", path, i, out))
                else:
                    hashes.append(f"{name}[{i}]:" + canonical(x))
        elif name in singles and isinstance(value, dict):
            children += 1
            hashes.append(f"{name}=" + flatten(value, singles[name], f"{prefix}{name}", path, 0, out))
        else:
            own[name] = value
    fields = canonical(own)
    h = digest(kind, fields, *hashes)
    out[at] = (parent, path, kind, ordinal, children, h, fields)
    return h


def objects_of(tree: dict) -> list[tuple[str, str, dict]]:
    """(path, kind, object with full keys) of an annotation and all objects below it."""
    out, todo = [], [("$", "annotation", tree)]
    while todo:
        path, kind, obj = todo.pop()
        obj = full_keys(obj, kind)
        out.append((path, kind, obj))
        prefix = "" if path == "$" else path + "."
        for name, below in CHILD_LISTS.get(kind, {}).items():
            value = obj.get(name)
            many = [value] if isinstance(value, dict) else value if isinstance(value, list) else []
            todo += [(f"{prefix}{name}[{i}]", below, x) for i, x in enumerate(many) if isinstance(x, dict)]
        for name, below in CHILD_OBJECTS.get(kind, {}).items():
            if isinstance(obj.get(name), dict):
                todo.append((f"{prefix}{name}", below, obj[name]))
    return out


def tree_stage(df: DataFrame, id_col: str, json_col: str, once: bool) -> DataFrame:
    def read(feed):
        known: set[str] = set()
        for batch in feed:
            for rid, text in zip(batch["_id"], batch["_json"]):
                tree = parse_annotation(text)
                if tree is None:
                    continue
                out: list = []
                flatten(tree, "annotation", "$", "", 0, out)
                for parent, path, kind, ordinal, children, h, fields in out:
                    if not once:
                        yield rid, parent, path, kind, ordinal, children, h, fields
                        continue
                    yield rid, parent, path, kind, ordinal, children, h, None if h in known else fields
                    if len(known) > 1_000_000:
                        known.clear()
                    known.add(h)

    key = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {key}, parent_path string, object_path string, kind string, ordinal int, n_children int, object_hash string, fields string"
    return partition_stage(spread(df.select(F.col(id_col).alias("_id"), F.col(json_col).alias("_json"))), schema, read)


def occurrences(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(<id>, parent_path, object_path, kind, ordinal, n_children, object_hash, fields), one row per occurrence with the
    own fields of its object beside it: for rules, which read every occurrence and then need no join."""
    return tree_stage(df, id_col, json_col, False)


def bridge(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """Bridge rows: (<id>, parent_path, object_path, kind, ordinal, n_children, object_hash), one per occurrence."""
    return tree_stage(df, id_col, json_col, True).drop("fields")


def distinct_objects(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(object_hash, kind, fields, n_occurrences): identical objects once. A partition gives the fields of an object with
    its first occurrence only, and counts are summed before the shuffle, so what is shuffled grows with the objects."""
    t = tree_stage(df, id_col, json_col, True)
    return t.groupBy("object_hash").agg(F.first("kind").alias("kind"), F.first("fields", ignorenulls=True).alias("fields"), F.count("*").alias("n_occurrences"))


def statuses(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(<id>, status): one row for every record, also for those that give no objects."""
    def read(batch):
        for rid, text in zip(batch["_id"], batch["_json"]):
            yield rid, status_of(text)

    key = df.schema[id_col].dataType.simpleString()
    return arrow_stage(spread(df.select(F.col(id_col).alias("_id"), F.col(json_col).alias("_json"))), f"`{id_col}` {key}, status string", read)


def rebuilt(bridge_rows: DataFrame, objects: DataFrame, id_col: str) -> DataFrame:
    """(<id>, tree): the annotations in full form as JSON, from the bridge and the objects that are stored once. Rows of
    one annotation are few; elements of lists that are no objects come back as null."""
    rows = bridge_rows.join(objects.select("object_hash", "fields"), "object_hash").groupBy(id_col).agg(
        F.collect_list(F.struct("object_path", "parent_path", "fields")).alias("rows"))

    def build(batch):
        for rid, rows in zip(batch["_id"], batch["rows"]):
            at = {r["object_path"]: json.loads(r["fields"]) for r in rows}
            for r in sorted(rows, key=lambda r: len(r["object_path"])):
                if r["object_path"] == "$":
                    continue
                name, _, place = r["object_path"].rpartition(".")[2].partition("[")
                up = at[r["parent_path"]]
                if place:
                    xs = up.setdefault(name, [])
                    xs += [None] * (int(place[:-1]) + 1 - len(xs))
                    xs[int(place[:-1])] = at[r["object_path"]]
                else:
                    up[name] = at[r["object_path"]]
            yield rid, canonical(at["$"])

    key = bridge_rows.schema[id_col].dataType.simpleString()
    return arrow_stage(rows.withColumnRenamed(id_col, "_id"), f"`{id_col}` {key}, tree string", build)


STEP = re.compile(r"\[\s*(?:'([^']*)'|\"([^\"]*)\"|(\d+))\s*\]|([^.\[\]/]+)")


def object_of_path(path: str | None) -> str | None:
    """The object a path names, or the object that holds the field it names; None for no path at all."""
    if path is None or not path.strip():
        return None
    steps: list = []
    for m in STEP.finditer(path.strip()):
        key = m.group(1) or m.group(2) or m.group(4)
        if m.group(3) is not None or key is not None and key.strip().isdigit():
            steps.append(int(m.group(3) if m.group(3) is not None else key))
        elif key is not None and key.strip():
            steps.append(key.strip())
    while steps and steps[0] in ("$", "annotation"):
        steps = steps[1:]
    kind, at = "annotation", "$"
    while steps:
        head = steps[0]
        if not isinstance(head, str):
            return at
        name = COMPACT[kind].get(head, head)
        prefix = "" if at == "$" else at + "."
        if name in CHILD_LISTS.get(kind, {}):
            if len(steps) == 1:
                return at
            i, rest = (steps[1], steps[2:]) if isinstance(steps[1], int) else (0, steps[1:])
            kind, at, steps = CHILD_LISTS[kind][name], f"{prefix}{name}[{i}]", rest
        elif name in CHILD_OBJECTS.get(kind, {}):
            kind, at, steps = CHILD_OBJECTS[kind][name], f"{prefix}{name}", steps[1:]
        else:
            return at
    return at


def issue_objects(issues: DataFrame, result_col: str, issue_col: str, path_col: str) -> DataFrame:
    """(<result>, <issue>, object_path): the object each issue is about, whether it exists or not."""

    def resolve(batch):
        for r, i, p in zip(batch["_r"], batch["_i"], batch["_p"]):
            o = object_of_path(p)
            if o is not None:
                yield r, i, o

    rk, ik = issues.schema[result_col].dataType.simpleString(), issues.schema[issue_col].dataType.simpleString()
    cols = issues.select(F.col(result_col).alias("_r"), F.col(issue_col).alias("_i"), F.col(path_col).alias("_p"))
    return arrow_stage(cols, f"`{result_col}` {rk}, `{issue_col}` {ik}, object_path string", resolve)


def objects_with_issues(bridge_rows: DataFrame, about: DataFrame, result_col: str, issue_col: str) -> DataFrame:
    """(<result>, parent_path, object_path, <issue>): every object with each issue about it, 0 where it has none."""
    left = bridge_rows.select(result_col, "parent_path", "object_path")
    return left.join(about, [result_col, "object_path"], "left").select(
        result_col, "parent_path", "object_path", F.coalesce(F.col(issue_col), F.lit(0).cast("long")).alias(issue_col)
    )
