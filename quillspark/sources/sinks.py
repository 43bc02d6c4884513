"""Sinks: full refresh by language, files per worker, appends that never overwrite, reports of rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written


def full_refresh(df: DataFrame, path: str, by: str, form: str = "json") -> None:
    df.write.mode("overwrite").partitionBy(by).format(form).save(path)


def per_worker_csv(df: DataFrame, path: str, worker: str, order: str) -> None:
    df.repartition(worker).sortWithinPartitions(worker, order).write.mode("overwrite").option("header", True).partitionBy(worker).csv(path)


def append_new(df: DataFrame, path: str, key: str) -> int:
    """Append the rows whose key is not there yet; how many that were. Existing rows are never written again."""
    spark = df.sparkSession
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    new = df.dropDuplicates([key])
    if jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath):  # any other fault of the table is an error
        new = new.join(spark.read.schema(df.schema).parquet(path).select(key), key, "left_anti")
    new = written(new.select(*df.columns), "new")  # fixed before the table it was compared with grows
    n = new.count()
    new.write.mode("append").parquet(path)
    return n


def write_and_check(df: DataFrame, path: str, faults) -> DataFrame:
    """Write, read again, and give back the rule violations of what was read."""
    df.write.mode("errorifexists").parquet(path)
    return faults(df.sparkSession.read.schema(df.schema).parquet(path))


def reject_report(routed: DataFrame, id_col: str, limit: int = 1000) -> str:
    """Markdown of the records that are not canonical. The report is for readers: it shows the first `limit` rows and
    always the full count."""
    bad = routed.where("route <> 'canonical'")
    total = bad.count()
    rows = bad.orderBy(id_col).select(id_col, "route").limit(limit).collect()
    return "\n".join([f"# Rejected records: {total}", "", f"| {id_col} | route |", "| --- | --- |", *(f"| {r[0]} | {r[1]} |" for r in rows)])


def metadata_manifest(df: DataFrame, path: str, key: str, inputs: list[str]) -> None:
    """The columns that are no input of the annotation, by key, as a table of their own."""
    df.select(key, *(c for c in df.columns if c not in inputs and c != key)).write.mode("overwrite").json(path)


def inventory_files(df: DataFrame, path: str) -> None:
    """An aggregate as JSON lines and as CSV."""
    df.write.mode("overwrite").json(f"{path}/json")
    df.write.mode("overwrite").option("header", True).csv(f"{path}/csv")


# Classes of failure that are kept; any other becomes UNKNOWN.
FAILURE_CLASSES = ("PROVIDER_ERROR", "MAX_TOKENS", "SAFETY", "SCHEMA_FAILURE", "GROUNDING_FAILURE", "COMPLETENESS_FAILURE", "MALFORMED_OR_UNKNOWN")


def record_outcomes(df: DataFrame, path: str, keys: list[str]) -> int:
    """Append outcomes keyed by several columns (a batch and its attempt): a key that is there is never written again."""
    known = F.when(F.upper("classification").isin(*FAILURE_CLASSES), F.upper("classification")).otherwise("UNKNOWN") if "classification" in df.columns else None
    d = df if known is None else df.withColumn("classification", known)
    return append_new(d.withColumn("outcome_key", F.concat_ws("|", *keys)), path, "outcome_key")
