"""Lines, stanzas and their alignment. All of it is array work within a row: nothing is shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab
from ..functions.text import WS, numbered_lines, presence_key, raw_lines, stanza_starts, strip, unix_lines


def line_index(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(<id>, line_number, position, stanza_index, line_text): numbered lines; blank ones separate stanzas.
    A null text has no line."""
    a = df.where(F.col(text_col).isNotNull()).select(id_col, numbered_lines(F.col(text_col)).alias("lines"))
    b = a.select(id_col, "lines", stanza_starts(F.col("lines")).alias("starts"))
    c = b.select(id_col, "starts", F.inline("lines"))
    return c.select(
        id_col, "line_number", "position",
        F.size(F.filter("starts", lambda s: s <= F.col("position"))).alias("stanza_index"), F.col("text").alias("line_text"),
    )


def stanza_texts(text: Column) -> Column:
    """array<array<string>>: stripped lines of each stanza."""
    cut = F.split(F.regexp_replace(unix_lines(text), rf"\n({WS}*\n)+", "\x1e"), "\x1e")
    lines = F.transform(cut, lambda s: F.filter(F.transform(F.split(s, "\n"), strip), lambda l: l != ""))
    return F.filter(lines, lambda s: F.size(s) > 0)


def stanzas(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(<id>, stanza_index from 1, line_count, stanza_text)"""
    a = df.select(id_col, F.posexplode(stanza_texts(F.col(text_col))).alias("i", "lines"))
    return a.select(id_col, (F.col("i") + 1).alias("stanza_index"), F.size("lines").alias("line_count"), F.array_join("lines", "\n").alias("stanza_text"))


def raw_stanzas(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(<id>, part_index, part_text): the text cut at two line feeds only, parts stripped, empty ones dropped."""
    parts = F.filter(F.transform(F.split(F.col(text_col), "\n\n"), strip), lambda p: p != "")
    return df.select(id_col, F.posexplode(parts).alias("part_index", "part_text"))


def without_title_line(df: DataFrame, text_col: str, title_col: str, out: str) -> DataFrame:
    """The text without its first line that is not blank, where that equals the title but for case and outer space."""
    lines = raw_lines(F.col(text_col))
    first = F.array_min(F.transform(F.filter(F.transform(lines, lambda l, i: F.struct(l.alias("l"), i.alias("i"))), lambda x: strip(x["l"]) != ""), lambda x: x["i"]))
    same = presence_key(F.get(lines, first)) == presence_key(F.col(title_col))
    rest = F.array_join(F.filter(lines, lambda l, i: i != first), "\n")
    return df.withColumn(out, F.when(F.coalesce(same, F.lit(False)), rest).otherwise(unix_lines(F.col(text_col))))


def rendering(text: Column, mark: str = "L") -> Column:
    """Numbered lines as text, or a placeholder where there is none."""
    lines = F.transform(numbered_lines(text), lambda x: F.concat(F.lit(mark), x["line_number"].cast("string"), F.lit(": "), x["text"]))
    return F.when(F.size(lines) > 0, F.array_join(lines, "\n")).otherwise(F.lit("(no lines)"))


def stanza_rendering(text: Column) -> Column:
    blocks = F.transform(stanza_texts(text), lambda s, i: F.concat(F.lit("[STANZA "), (i + 1).cast("string"), F.lit("]\n"), F.array_join(s, "\n")))
    return F.when(F.size(blocks) > 0, F.array_join(blocks, "\n\n")).otherwise(F.lit("(no stanzas)"))


def stanza_alignment(df: DataFrame, id_col: str, src: str, tgt: str, cosines: str | None = None) -> DataFrame:
    """(<id>, n_source, n_target, count_score, length_score, confidence, status).

    Stanzas are paired by position. A pair's length ratio is the shorter over the longer in characters, 1 for two empty
    sides and 0 for one. cosines names a column of pair similarities; without it the length score stands in."""
    size = lambda c: F.transform(stanza_texts(F.coalesce(F.col(c), F.lit(""))), lambda s: F.aggregate(s, F.lit(0), lambda acc, l: acc + F.char_length(l)))
    a = df.select(id_col, size(src).alias("s"), size(tgt).alias("t"), *([F.col(cosines).alias("cos")] if cosines else []))
    a = a.withColumns({"n_source": F.size("s"), "n_target": F.size("t")})
    ratio = F.zip_with("s", "t", lambda x, y: F.when(x.isNull() | y.isNull(), None).when((x == 0) & (y == 0), 1.0).otherwise(F.least(x, y) / F.greatest(x, y)))
    pairs = F.filter(ratio, lambda r: r.isNotNull())
    length = F.when(F.size(pairs) > 0, F.aggregate(pairs, F.lit(0.0), lambda acc, r: acc + r) / F.size(pairs)).otherwise(0.0)
    gap = F.abs(F.col("n_source") - F.col("n_target"))
    a = a.withColumns({"length_score": length, "count_score": F.greatest(F.lit(0.0), 1 - gap / F.greatest("n_source", F.lit(1)))})
    if cosines:
        has = F.size("cos") > 0
        semantic = F.when(has, F.aggregate("cos", F.lit(0.0), lambda acc, r: acc + r) / F.size("cos")).otherwise(F.col("length_score"))
        low = has & (F.array_min("cos") < vocab.ALIGN_MIN_COSINE)
    else:
        semantic, low = F.col("length_score"), F.lit(False)
    a = a.withColumn("confidence", F.round(0.4 * F.col("count_score") + 0.2 * F.col("length_score") + 0.4 * semantic, 4))
    status = (
        F.when((F.col("confidence") < vocab.ALIGN_RISK) | (gap > 1) | low, "alignment_risk")
        .when((gap == 0) & (F.col("confidence") >= vocab.ALIGN_OK), "aligned")
        .otherwise("aligned_low")
    )
    return a.select(id_col, "n_source", "n_target", F.round("count_score", 6).alias("count_score"), F.round("length_score", 6).alias("length_score"), "confidence", status.alias("status"))
