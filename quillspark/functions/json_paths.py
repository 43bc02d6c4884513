"""Dynamic paths into JSON: parse, get, set, diff, leaves, patches, and repair of cut-off JSON.

Spark reads variants at constant paths only and writes none, so these run in Arrow stages, on the rows that need them.
"""

from __future__ import annotations

import copy
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..arrow import arrow_stage

SEGMENT = re.compile(r"([A-Za-z_][A-Za-z0-9_]*)((?:\[[0-9]+\])*)\Z")
MISSING = object()


class PathError(ValueError):
    """code: empty_path, bad_syntax, missing_key, index_out_of_range, not_an_object or not_a_list"""

    def __init__(self, code: str, path: str) -> None:
        super().__init__(f"{code}: {path}")
        self.code = code


def steps(path: str) -> list[str | int]:
    if not path:
        raise PathError("empty_path", path)
    out: list[str | int] = []
    for part in path.split("."):
        m = SEGMENT.match(part)
        if not m:
            raise PathError("bad_syntax", path)
        out.append(m.group(1))
        out += [int(x) for x in re.findall(r"[0-9]+", m.group(2))]
    return out


def walk(value: object, path: str) -> object:
    """The value at a path, strictly."""
    for s in steps(path):
        if isinstance(s, str):
            if not isinstance(value, dict):
                raise PathError("not_an_object", path)
            if s not in value:
                raise PathError("missing_key", path)
        elif not isinstance(value, list):
            raise PathError("not_a_list", path)
        elif s >= len(value):
            raise PathError("index_out_of_range", path)
        value = value[s]
    return value


def get(value: object, path: str, default: object = None) -> object:
    """The value at a path, or the default where there is none."""
    try:
        return walk(value, path)
    except PathError:
        return default


def put(value: object, path: str, new: object) -> object:
    """A copy with another value at an existing path: no key is created, no list extended."""
    out = copy.deepcopy(value)
    *front, last = steps(path)
    walk(out, path)
    at = out
    for s in front:
        at = at[s]
    at[last] = new
    return out


def leaves(value: object, prefix: str = "") -> list[tuple[str, object]]:
    """(path, scalar) of every leaf; empty objects and lists are leaves."""
    if isinstance(value, dict) and value:
        return [x for k in sorted(value) for x in leaves(value[k], f"{prefix}.{k}" if prefix else k)]
    if isinstance(value, list) and value:
        return [x for i, v in enumerate(value) for x in leaves(v, f"{prefix}[{i}]")]
    return [(prefix, value)]


def differences(a: object, b: object, prefix: str = "") -> list[str]:
    """Paths at which two values differ; lists of different lengths differ as one."""
    if isinstance(a, dict) and isinstance(b, dict):
        out = []
        for k in sorted(a.keys() | b.keys()):
            p = f"{prefix}.{k}" if prefix else k
            out += differences(a[k], b[k], p) if k in a and k in b else [p]
        return out
    if isinstance(a, list) and isinstance(b, list) and len(a) == len(b):
        return [x for i, (u, v) in enumerate(zip(a, b)) for x in differences(u, v, f"{prefix}[{i}]")]
    return [] if type(a) is type(b) and a == b else [prefix]


def close_json(text: str) -> object:
    """The longest readable part of cut-off JSON: open strings and brackets are closed, an unfinished member dropped."""
    stack, in_string, escaped, safe = [], False, False, []
    for i, c in enumerate(text):
        if in_string:
            if escaped:
                escaped = False
            elif c == "\\":
                escaped = True
            elif c == '"':
                in_string = False
            continue
        if c == '"':
            in_string = True
        elif c in "{[":
            stack.append("}" if c == "{" else "]")
            safe.append((i + 1, tuple(stack)))
        elif c in "}]":
            if not stack or stack.pop() != c:
                return MISSING
            safe.append((i + 1, tuple(stack)))
        elif c == ",":
            safe.append((i, tuple(stack)))
    for end, open_ in [(len(text), tuple(stack))] + safe[::-1]:
        try:
            return json.loads(text[:end] + "".join(reversed(open_)))
        except ValueError:
            continue
    return MISSING


def repair_value(old: object, path: str, response: dict, unresolved: set[str]) -> tuple[object, bool]:
    """(value, still unresolved) of a requested path: unresolved wins over absent, absent over null, null over a value."""
    if path in unresolved or path not in response:
        return old, True
    return response[path], False


def patch_faults(document: object, patches: list[tuple[str, object]], requested: set[str] | None = None) -> list[tuple[str, str]]:
    """(path, code) of the patches that cannot be applied: bad paths, repeated or unrequested ones, protected nulls."""
    out, seen = [], set()
    for path, value in patches:
        try:
            old = walk(document, path)
        except PathError as e:
            out.append((path, e.code))
            continue
        if path in seen:
            out.append((path, "repeated"))
        elif requested is not None and path not in requested:
            out.append((path, "not_requested"))
        elif old not in (None, [], "") and old != value:
            out.append((path, "already_filled"))
        seen.add(path)
    return out


def apply_patches(document: object, patches: list[tuple[str, object]], requested: set[str] | None = None) -> tuple[object, list[tuple[str, str]]]:
    """All patches or none; then the differences are exactly the patched paths."""
    faults = patch_faults(document, patches, requested)
    if faults:
        return document, faults
    out = document
    for path, value in patches:
        out = put(out, path, value)
    stray = [p for p in differences(document, out) if not any(p == q or p.startswith((q + ".", q + "[")) for q, _ in patches)]
    return (document, [(p, "stray_change") for p in stray]) if stray else (out, [])


def values_at(df: DataFrame, keep: list[str], json_col: str, path_col: str, load=json.loads, locate=str) -> DataFrame:
    """Kept columns with status (found or the path error) and the value at each row's path as JSON text. load reads a
    text (ValueError: bad_json), locate gives the path to walk in what it read."""
    def read(batch):
        for i, (text, path) in enumerate(zip(batch["_json"], batch["_path"])):
            row = tuple(batch[k][i] for k in keep)
            try:
                yield (*row, "found", json.dumps(walk(load(text), locate(path or "")), ensure_ascii=False, sort_keys=True))
            except PathError as e:
                yield (*row, e.code, None)
            except (TypeError, ValueError, RecursionError):
                yield (*row, "bad_json", None)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema) + ", status string, value string"
    return arrow_stage(df.select(*keep, F.col(json_col).alias("_json"), F.col(path_col).alias("_path")), schema, read)


def leaf_rows(df: DataFrame, keep: list[str], json_col: str, load=json.loads) -> DataFrame:
    """Kept columns with (path, value) of every leaf; text that load cannot read gives no row."""
    def read(batch):
        for i, text in enumerate(batch["_json"]):
            try:
                rows = leaves(load(text))
            except (TypeError, ValueError, RecursionError):
                continue
            for p, v in rows:
                yield (*(batch[k][i] for k in keep), p, json.dumps(v, ensure_ascii=False))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema) + ", path string, value string"
    return arrow_stage(df.select(*keep, F.col(json_col).alias("_json")), schema, read)


def closed(df: DataFrame, keep: list[str], json_col: str) -> DataFrame:
    """Kept columns with (state, repaired): whole, repaired or lost; only broken rows reach Python."""
    whole = F.try_parse_json(json_col).isNotNull()
    good = df.where(F.col(json_col).isNotNull() & whole).select(*keep, F.lit("whole").alias("state"), F.col(json_col).alias("repaired"))

    def fix(batch):
        for i, text in enumerate(batch["_json"]):
            s = re.sub(r"^\s*```[A-Za-z]*\s*|\s*```\s*$", "", text)
            v = close_json(s) if s.lstrip()[:1] in ("{", "[", '"') else MISSING
            row = tuple(batch[k][i] for k in keep)
            yield (*row, "lost", None) if v is MISSING else (*row, "repaired", json.dumps(v, ensure_ascii=False))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema) + ", state string, repaired string"
    bad = df.where(F.col(json_col).isNotNull() & ~whole).select(*keep, F.col(json_col).alias("_json"))
    return good.unionByName(arrow_stage(bad, schema, fix))
