"""Progress of repair work: which batch is next, what counts as done, from where a part starts, what earlier parts did.

Defined results: a batch without a run is unfinished; of several runs the latest counts; an item without batches has no
row; the first unfinished batch blocks those behind it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import ledger

COMPLETE = ("success", "adjudicated_success", "split_success")  # fixed values: states that count as complete


def latest_runs(runs: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """(<keys>, status, complete, n_runs): the last run of each batch by order. max_by pre-aggregates."""
    g = runs.groupBy(*keys).agg(F.max_by("status", F.struct(*order)).alias("status"), F.count("*").alias("n_runs"))
    return g.withColumn("complete", F.coalesce(F.col("status").isin(*COMPLETE), F.lit(False)))


def progress(batches: DataFrame, runs: DataFrame, key: str) -> DataFrame:
    """(<key>, n_batches, n_complete, next_batch, n_blocked, fully_done): batches (<key>, batch_no) against their latest runs
    (<key>, batch_no, complete). next_batch is null where all are complete."""
    j = batches.select(key, "batch_no").join(runs.select(key, "batch_no", "complete"), [key, "batch_no"], "left").withColumn("complete", F.coalesce("complete", F.lit(False)))
    g = j.groupBy(key).agg(F.count("*").alias("n_batches"), F.count_if("complete").alias("n_complete"), F.min(F.when(~F.col("complete"), F.col("batch_no"))).alias("next_batch"), F.max("batch_no").alias("_last"))
    return g.select(key, "n_batches", "n_complete", "next_batch", F.coalesce(F.col("_last") - F.col("next_batch"), F.lit(0)).alias("n_blocked"), F.col("next_batch").isNull().alias("fully_done"))


def next_attempts(runs: DataFrame, key: str, attempt: str) -> DataFrame:
    return runs.groupBy(key).agg((F.max(F.coalesce(attempt, F.lit(0))) + 1).alias("next_attempt"), F.count("*").alias("n_attempts"))


def starting_copies(parts: DataFrame, key: str) -> DataFrame:
    """parts (<key>, part_index, paths, candidate) with start and paths_before: part k starts from part k - 1, the first one
    from the latest candidate, else from the initial text; paths_before are those of all earlier parts. A key has few
    parts: they are bounded by its semantic units."""
    w = Window.partitionBy(key).orderBy("part_index")
    before = F.flatten(F.collect_list("paths").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    start = F.when(F.lag("part_index").over(w).isNotNull(), F.concat(F.lit("part "), F.lag("part_index").over(w).cast("string"))).when(F.col("candidate").isNotNull(), F.concat(F.lit("attempt "), F.col("candidate").cast("string"))).otherwise("initial")
    return parts.select(key, "part_index", start.alias("start"), F.array_join(F.array_sort(before), ";").alias("paths_before"))


def effective_paths(planned: DataFrame, excluded: DataFrame, key: str) -> DataFrame:
    """(<key>, applied, deferred): the paths a key's batches work on, without those excluded, and these."""
    j = planned.select(key, "path").distinct().join(excluded.select(key, "path").distinct().withColumn("out", F.lit(True)), [key, "path"], "left")
    pick = lambda test: F.array_join(F.array_sort(F.collect_set(F.when(test, F.col("path")))), ";")
    return j.groupBy(key).agg(pick(F.col("out").isNull()).alias("applied"), pick(F.col("out")).alias("deferred"))


def overlay_faults(parts: DataFrame, key: str, cap: int) -> DataFrame:
    """(<key>, rule) of split overlays: part numbers that do not run from 1 to n_parts, parts above the cap, uneven parts
    (units differing by more than one), paths in two parts, a reason where none is due."""
    flat = parts.select(key, F.explode("paths").alias("path")).groupBy(key, "path").agg(F.count("*").alias("_n")).groupBy(key).agg(F.max("_n").alias("_most"))
    g = parts.groupBy(key).agg(F.count("*").alias("_k"), F.max("n_parts").alias("_n"), F.min("part_index").alias("_lo"), F.max("part_index").alias("_hi"), F.max(F.size("paths")).alias("_big"),
                               (F.max("n_units") - F.min("n_units")).alias("_gap"), F.max("reason").alias("_reason")).join(flat, key)
    rules = F.array_compact(F.array(
        F.when(F.col("_lo").isNull(), "not_split"), F.when(F.col("_lo").isNotNull() & (F.col("_lo") != 1) | (F.col("_hi") != F.col("_n")) | (F.col("_lo").isNotNull() & (F.col("_k") != F.col("_n"))), "part_numbers"), F.when(F.col("_lo").isNotNull() & (F.col("_big") > cap), "part_over_cap"),
        F.when(F.col("_gap") > 1, "uneven_parts"), F.when(F.col("_most") > 1, "path_in_two_parts"), F.when(F.col("_reason").isNull() & (F.col("_n") != 3), "reason_missing"),
    ))
    return g.select(key, F.explode(rules).alias("rule"))


def run_sequence(batches: list, run, done=()) -> list[tuple]:
    """(batch, outcome) of batches run in order, each only once the one before succeeded: done ones are passed over, the
    first failure stops."""
    out = []
    for b in batches:
        if b in done:
            continue
        ok = bool(run(b))
        out.append((b, "success" if ok else "failed"))
        if not ok:
            break
    return out


def latest_attempts(results: DataFrame) -> DataFrame:
    return ledger.latest(results.select("poem_id", "result_id", "attempt_no"), ["poem_id"], ["attempt_no", "result_id"]).select("poem_id", F.col("attempt_no").alias("candidate"))
