"""Sources: records as JSON, JSON lines and arrays, assignment CSVs, manifests, and spreadsheets."""

from __future__ import annotations

import re
import zipfile
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

RECORD_KEYS = ("poem_id", "poem_title", "language", "original_poem", "translated_poem")
RECORD = ", ".join(f"{k} STRING" for k in RECORD_KEYS)
SHEET_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL_NS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def record_files(spark: SparkSession, path: str) -> DataFrame:
    """One record per JSON file: the five columns, path, file_sha256 and key_fault (missing or extra keys, wrong place)."""
    raw = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    allowed = F.array(*(F.lit(k) for k in RECORD_KEYS))
    keys = F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>"))
    r = raw.select("path", F.sha2("value", 256).alias("file_sha256"), keys.alias("keys"), F.from_json("value", RECORD).alias("r")).select("path", "file_sha256", "keys", "r.*")
    extra, missing = F.array_sort(F.array_except("keys", allowed)), F.array_sort(F.array_except(allowed, F.col("keys")))
    stem = F.regexp_extract("path", r"([^/]+)\.[jJ][sS][oO][nN]$", 1)
    fault = F.when(F.size(missing) > 0, F.concat(F.lit("missing:"), F.array_join(missing, ","))).when(F.size(extra) > 0, F.concat(F.lit("extra:"), F.array_join(extra, ","))).when(F.url_decode(stem) != F.col("poem_id"), "id_is_not_the_file_name")
    return r.select(*RECORD_KEYS, "path", "file_sha256", fault.alias("key_fault"))


def validated(records: DataFrame, labels: list[str]) -> DataFrame:
    """records with fault: the first of a blank id, a repeated id, a missing or blank label, an unknown label; null for none."""
    n = records.groupBy("poem_id").agg(F.count("*").alias("_n"))
    r = records.join(n, records["poem_id"].eqNullSafe(n["poem_id"]), "left").drop(n["poem_id"])
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    known = F.lower(F.trim("language")).isin(*(l.lower() for l in labels))
    fault = F.when(blank("poem_id"), "blank_id").when(F.col("_n") > 1, "repeated_id").when(blank("language"), "no_language").when(~known, "unknown_language")
    return r.withColumn("fault", fault).drop("_n")


def or_raise(df: DataFrame, fault: str, key: str) -> DataFrame:
    """df without its fault column; reading a row with a fault fails the job and names the row."""
    ok = F.when(F.col(fault).isNull(), F.lit(True)).otherwise(F.raise_error(F.concat_ws(": ", F.coalesce(F.col(key).cast("string"), F.lit("?")), F.col(fault))))
    return df.where(ok).drop(fault)


def json_documents(spark: SparkSession, path: str, suffix: str = "json") -> DataFrame:
    """(path, name, value) of the files with a suffix, in whatever case it is written."""
    every = "".join(f"[{c.lower()}{c.upper()}]" for c in suffix)
    raw = spark.read.option("pathGlobFilter", f"*.{every}").text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("path"))
    return raw.select("path", F.url_decode(F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)).alias("name"), "value")


def profiles(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    """(path, language, profile, fault) of a folder of language profiles: not_json, missing:<keys>, or repeated_language."""
    d = json_documents(spark, path)
    keys = F.coalesce(F.json_object_keys("value"), F.array().cast("array<string>"))
    lack = F.array_sort(F.array_except(F.array(*map(F.lit, required)), keys))
    p = d.select("path", F.get_json_object("value", "$.language").alias("language"), F.col("value").alias("profile"), F.try_parse_json("value").isNull().alias("bad"), lack.alias("lack"))
    n = p.where("language IS NOT NULL").groupBy(F.lower("language").alias("_l")).agg(F.count("*").alias("_n"))
    p = p.join(n, F.lower("language") == F.col("_l"), "left")
    fault = F.when(F.col("bad"), "not_json").when(F.size("lack") > 0, F.concat(F.lit("missing:"), F.array_join("lack", ","))).when(F.col("_n") > 1, "repeated_language")
    return p.select("path", "language", "profile", fault.alias("fault"))


def open_batches(batches: DataFrame, done: DataFrame) -> DataFrame:
    """batches (poem_id, batch_index, batch_id) that are not done, in order of poem and index."""
    return batches.join(done.select("batch_id").distinct(), "batch_id", "left_anti").orderBy("poem_id", "batch_index")


def unknown_batches(asked: DataFrame, batches: DataFrame) -> DataFrame:
    return asked.join(batches.select("batch_id"), "batch_id", "left_anti")


def record_array(spark: SparkSession, path: str) -> DataFrame:
    """Records of a JSON array, or of the list under "poems" or "records" of an object."""
    raw = spark.read.text(path, wholetext=True)
    items = f"array<struct<{', '.join(f'{k}: string' for k in RECORD_KEYS)}>>"
    listed = F.when(F.ltrim("value").startswith("["), F.col("value")).otherwise(F.coalesce(F.get_json_object("value", "$.poems"), F.get_json_object("value", "$.records")))
    return raw.select(F.inline(F.from_json(listed, items))).select(*RECORD_KEYS)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One row per line, malformed ones too: their columns are null and _corrupt holds the line."""
    return spark.read.schema(schema + ", _corrupt STRING").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


ASSIGNMENT = ("poem_id", "language", "assignee")


def assignment_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows, faults): trimmed assignments with the number of their line in the file, and (poem_id, fault, lines) of the
    blank fields and of the ids given more than once, with the lines that give them."""
    raw = spark.read.text(path, wholetext=True)
    lines = raw.select(F.posexplode(F.split("value", "\r\n?|\n")).alias("at", "line")).where("trim(line) <> ''")
    head = lines.orderBy("at").first()
    names = [c.strip().strip('"') for c in head.line.lstrip("\ufeff").split(",")] if head else []
    lacking = set(ASSIGNMENT) - set(names)
    if lacking:
        raise ValueError(f"columns missing in {path}: {sorted(lacking)}")
    cells = F.from_csv("line", F.lit(", ".join(f"`{n}` STRING" for n in names)))
    rows = lines.where(F.col("at") > head["at"]).select(F.col("at").alias("n"), cells.alias("r"))
    rows = rows.select(*(F.trim(F.col("r")[c]).alias(c) for c in ASSIGNMENT), (F.col("n") + 1).cast("int").alias("line"))
    blank = F.array_compact(F.array(*(F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit(f"blank_{c}")) for c in ASSIGNMENT)))
    blanks = rows.select("poem_id", F.explode(blank).alias("fault"), F.array("line").alias("lines"))
    twice = rows.where("poem_id <> ''").groupBy("poem_id").agg(F.array_sort(F.collect_list("line")).alias("lines")).where("size(lines) > 1")
    return rows, blanks.unionByName(twice.select("poem_id", F.lit("repeated_id").alias("fault"), "lines"))


def column_number(letters: str) -> int:
    n = 0
    for c in letters:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_rows(path: str) -> list[tuple[int, list[str]]]:
    """(row number, cells) of the workbook's first sheet in workbook order; gaps are empty cells."""
    with zipfile.ZipFile(path) as z:
        names = set(z.namelist())
        shared = ["".join(t.text or "" for t in si.iter(SHEET_NS + "t")) for si in ET.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        target = next((n for n in sorted(names) if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), None)
        if {"xl/workbook.xml", "xl/_rels/workbook.xml.rels"} <= names:
            first = ET.fromstring(z.read("xl/workbook.xml")).find(f"{SHEET_NS}sheets/{SHEET_NS}sheet")
            for rel in ET.fromstring(z.read("xl/_rels/workbook.xml.rels")):
                if first is not None and rel.get("Id") == first.get(REL_NS + "id"):
                    target = "xl/" + rel.get("Target").removeprefix("/xl/")
        if target is None:
            return []
        out, width = [], 0
        for k, row in enumerate(ET.fromstring(z.read(target)).iter(SHEET_NS + "row"), 1):
            cells: list[str] = []
            for c in row.iter(SHEET_NS + "c"):
                at = column_number(re.match("[A-Z]+", c.get("r", "")).group()) if c.get("r") else len(cells)
                cells += [""] * (at + 1 - len(cells))
                v = c.find(SHEET_NS + "v")
                if c.get("t") == "s":
                    cells[at] = shared[int(v.text)] if v is not None else ""
                elif c.get("t") == "inlineStr":
                    cells[at] = "".join(t.text or "" for t in c.iter(SHEET_NS + "t"))
                else:
                    cells[at] = v.text or "" if v is not None else ""
            width = max(width, len(cells))
            out.append((int(row.get("r", k)), cells))
    return [(n, cells + [""] * (width - len(cells))) for n, cells in out]


class SheetSource(DataSource):
    """spark.read.format("sheet").load(path): row_num INT, cells ARRAY<STRING>."""

    @classmethod
    def name(cls) -> str:
        return "sheet"

    def schema(self) -> str:
        return "row_num INT, cells ARRAY<STRING>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return SheetReader(self.options["path"])


class SheetReader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path.removeprefix("file:")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition):
        yield from sheet_rows(self.path)


def sheet(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """Rows of a sheet under an expected header, which must be its first row; short rows are filled with ''."""
    spark.dataSource.register(SheetSource)
    rows = spark.read.format("sheet").load(path)
    first = rows.where("row_num = 1").select("cells").first()
    if first is None or first.cells[: len(header)] != header:
        raise ValueError(f"unexpected header in {path}")
    cells = [F.coalesce(F.get("cells", F.lit(i)), F.lit("")).alias(h) for i, h in enumerate(header)]
    return rows.where("row_num > 1").select("row_num", *cells)
