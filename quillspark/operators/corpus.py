"""Routing, inventory, dealing and joins of a corpus."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_blank, strip, unix_lines


def folded(c: Column) -> Column:
    return F.lower(strip(c))


def route(df: DataFrame, label: str, known: DataFrame, content: list[str]) -> DataFrame:
    """route: blank (no content at all), trailing (content, no label), anomalous (unknown label) or canonical.
    known: one column of labels, joined by its folded value."""
    k = known.select(folded(F.col(known.columns[0])).alias("_label")).distinct().withColumn("_known", F.lit(True))
    empty = F.lit(True)
    for c in content:
        empty = empty & is_blank(F.col(c))
    r = F.when(empty, "blank").when(is_blank(F.col(label)), "trailing").when(F.col("_known").isNull(), "anomalous").otherwise("canonical")
    return df.withColumn("_label", folded(F.col(label))).join(k, "_label", "left").withColumn("route", r).drop("_label", "_known")


def running(df: DataFrame, coarse: list[str], fine: list[str], order: list, sums: dict[str, str], number: str) -> DataFrame:
    """df with its 1-based position over a total order as <number>, and for each <out>: <value> of sums the running sum.

    The order is by the columns of coarse, those of fine, then by order. Three windows share the work: one over the coarse
    blocks (few rows), one over the fine blocks of each coarse one, one over the rows of each fine block. No task sees
    more than one of these, and the result does not depend on the partitioning."""
    every = coarse + fine
    aggs = {"_n": F.count("*")} | {f"_{k}": F.sum(v) for k, v in sums.items()}
    parts = df.groupBy(*every).agg(*(a.alias(k) for k, a in aggs.items()))
    tops = parts.groupBy(*coarse).agg(*(F.sum(k).alias(k) for k in aggs))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    above, beside = before(Window.orderBy(*coarse)), before(Window.partitionBy(*coarse).orderBy(*fine))
    shift = lambda d, w, tag: [F.coalesce(F.sum(k).over(w), F.lit(0)).alias(k + tag) for k in aggs]
    tops = tops.select(*coarse, *shift(tops, above, "0"))
    parts = parts.select(*every, *shift(parts, beside, "1"))
    same = lambda cols, tag: functools.reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(tag + c)) for c in cols))
    named = lambda d, cols, tag: d.withColumnsRenamed({c: tag + c for c in cols})
    parts = parts.join(named(tops, coarse, "_t_"), same(coarse, "_t_"))
    parts = named(parts.select(*every, *((F.col(k + "0") + F.col(k + "1")).alias("_before" + k) for k in aggs)), every, "_p_")
    inside = Window.partitionBy(*every).orderBy(*order)
    out = df.join(parts, same(every, "_p_")).withColumn(number, F.col("_before_n") + F.row_number().over(inside))
    for k, v in sums.items():
        out = out.withColumn(k, F.col(f"_before_{k}") + F.sum(v).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    return out.drop(*("_before" + k for k in aggs), *("_p_" + c for c in every))


BLOCK, SUPER = 9, 6  # characters of an id that name its block and its block of blocks; ids of one length go 1,000 to each


def exact_numbers(df: DataFrame, by: list[str], id_col: str, out: str, block: int = BLOCK, over: int = SUPER) -> DataFrame:
    """1-based positions by the columns of `by`, then by id. Blocks are prefixes of the id, which any ids sort by first."""
    text = F.col(id_col).cast("string")
    keyed = df.withColumns({"_s": F.substring(text, 1, over), "_b": F.substring(text, 1, block)})
    return running(keyed, [*by, "_s"], ["_b"], [id_col], {}, out).drop("_s", "_b")


def deal(df: DataFrame, group: Column, id_col: str, workers: int) -> DataFrame:
    """Round-robin over rows ordered by (group, id), the turn carried across groups. A hot group is split into blocks of
    its ids, so no window holds it whole."""
    n = exact_numbers(df.withColumn("_g", group), ["_g"], id_col, "_n")
    return n.withColumn("worker", ((F.col("_n") - 1) % workers).cast("int")).drop("_g", "_n")


def inventory(df: DataFrame, label: Column, id_col: str, source: str, target: str) -> DataFrame:
    return df.groupBy(label.alias("language")).agg(
        F.count("*").alias("n_records"), F.count_distinct(id_col).alias("n_ids"),
        F.count_if(is_blank(F.col(source))).alias("n_empty_source"), F.count_if(is_blank(F.col(target))).alias("n_missing_translation"),
        F.sum(F.char_length(unix_lines(F.coalesce(F.col(source), F.lit(""))))).alias("source_chars"),
    )


def duplicates(df: DataFrame, keys: list[Column], id_col: str) -> DataFrame:
    """Keys that occur more than once, with their count and first and last id."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"), F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id")).where("n > 1")


def text_hashes(df: DataFrame, id_col: str, cols: list[str]) -> DataFrame:
    one = lambda c: F.sha2(F.encode(F.coalesce(F.col(c), F.lit("")), "UTF-8"), 256)
    parts = F.concat_ws("\0", *(F.coalesce(F.col(c), F.lit("")) for c in cols))
    return df.select(id_col, *(one(c).alias(f"{c}_sha256") for c in cols), F.sha2(F.encode(parts, "UTF-8"), 256).alias("record_sha256"))
