"""Arrow-batched Python stages."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


def arrow_stage(df: DataFrame, schema: str | StructType, fn: Callable[[dict[str, list]], Iterable[tuple]]) -> DataFrame:
    """Run fn over each Arrow batch of df: it gets the columns as lists and gives output rows as tuples."""
    st = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(st)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
            rows, size = [], 0
            for row in fn(cols):
                rows.append(row)
                size += 1
                if size >= 50_000:
                    yield _batch(rows, arrow)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, arrow)

    return df.mapInArrow(run, st)


def partition_stage(df: DataFrame, schema: str | StructType, fn: Callable[[Iterator[dict[str, list]]], Iterable[tuple]]) -> DataFrame:
    """As arrow_stage, but fn sees all batches of a partition: for counts that are pre-aggregated before a shuffle."""
    st = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(st)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feed = ({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)} for b in batches if b.num_rows)
        rows = []
        for row in fn(feed):
            rows.append(row)
            if len(rows) >= 50_000:
                yield _batch(rows, arrow)
                rows = []
        if rows:
            yield _batch(rows, arrow)

    return df.mapInArrow(run, st)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def column_stage(df: DataFrame, schema: str | StructType, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[tuple]]) -> DataFrame:
    """As partition_stage, but fn reads Arrow batches and gives tuples of columns (arrays or lists) in place of rows."""
    st = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(st)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in fn(b for b in batches if b.num_rows):
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, arrow)], schema=arrow)

    return df.mapInArrow(run, st)
