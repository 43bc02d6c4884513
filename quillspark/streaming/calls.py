"""Structured Streaming over provider calls: redelivery, windows and late rows, keyed state, incremental append."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import own_path


def call_stream(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """The table as a stream of its files."""
    table = spark.read.parquet(path)
    folder, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max_files)
    if any(f.endswith("/" + name) for f in table.inputFiles()):  # a table of one file: stream its folder, filtered to it
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def unique(stream: DataFrame, late: str = "30 days") -> DataFrame:
    """One row per response_id within the watermark; rows without an id are kept."""
    s = stream.withColumn("requested_at", F.col("requested_at").cast("timestamp")).withWatermark("requested_at", late)
    keyed = s.withColumn("_key", F.coalesce("response_id", F.concat_ws("|", "poem_id", "section_name", F.col("requested_at").cast("string"))))
    return keyed.dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def hourly(stream: DataFrame, late: str = "2 hours") -> DataFrame:
    """Calls and tokens per hour; a window closes when the watermark passes its end."""
    s = stream.withColumn("requested_at", F.col("requested_at").cast("timestamp")).withWatermark("requested_at", late)
    return s.groupBy(F.window("requested_at", "1 hour").alias("w"), "section_name").agg(F.count("*").alias("n"), F.sum("total_token_count").alias("tokens"))


def running_totals(stream: DataFrame) -> DataFrame:
    """(poem_id, calls, tokens): custom keyed state, updated batch by batch."""
    def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        calls, tokens = state.get if state.exists else (0, 0)
        for f in frames:
            calls += len(f)
            tokens += int(f["total_token_count"].fillna(0).sum())
        state.update((calls, tokens))
        yield pd.DataFrame({"poem_id": [key[0]], "calls": [calls], "tokens": [tokens]})

    return stream.groupBy("poem_id").applyInPandasWithState(update, "poem_id string, calls long, tokens long", "calls long, tokens long", "update", "NoTimeout")


def drain(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there, into a table of the shared folder, and read it. Appends are exactly once: the
    batch id names each batch's folder, so a repeated batch overwrites its own rows only."""
    spark = stream.sparkSession
    base = own_path(spark, name)

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/rows/batch={batch_id}")

    q = stream.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema.add("batch", "long")).parquet(f"{base}/rows")
