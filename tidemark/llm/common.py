"""Helpers shared by the operators: Arrow batches, words, bounded broadcasts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A table is broadcast only when its counted rows and their bytes, written as JSON, stay below these bounds.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 128 << 20


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows of bounded size, else as it is (a shuffled join)."""
    return F.broadcast(df) if is_small(df, rows) else df


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    counted = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes")).first()
    return counted["n"] <= rows and counted["bytes"] <= BROADCAST_BYTES


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8; ``bytes.split`` cuts at exactly these six bytes."""
    return text.encode().split() if text else []


def map_rows(df: DataFrame, schema: str, function: Callable[[dict[str, list]], dict[str, list | np.ndarray]], rows: int = 256) -> DataFrame:
    """Map slices of at most ``rows`` rows, given and returned as columns; streams, keeps no state."""
    arrow = pa_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                out = function(batch.slice(at, rows).to_pydict())
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def pa_schema(schema: str) -> pa.Schema:
    """An Arrow schema of flat fields from ``"name type, name type"``."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.strip().split(" ", 1) for f in schema.split(","))])
