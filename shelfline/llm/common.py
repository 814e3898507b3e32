"""Helpers shared by the operators of this subpackage: reading, batches for Arrow functions, ragged arrays."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import configure, scratch_dir, written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of text that an Arrow function works on at once, whatever the batch brought.
SLICE_BYTES = 4 << 20
#: Bytes of a batch that Spark hands to an Arrow function, but for a single row that is larger.
BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the library, and shuffle files removed when the job that made them has ended.

    Operators of several jobs write what later jobs need to the shared folder, so old shuffle files are dead weight.
    """
    configure(spark).conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    # Batches for Arrow functions are bounded by bytes, as texts may be of any length.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bucketed(df: DataFrame, label: str, key: str) -> DataFrame:
    """``df`` written in buckets by a key, so that joins on it leave the rows where they are; gone with its scratch scope."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    path = os.path.join(scratch_dir(spark), name)
    written("table", name)
    written("folder", path)
    df.write.option("compression", "zstd").option("path", path).bucketBy(parts(spark), key).saveAsTable(name)
    return spark.table(name)


def kind(df: DataFrame, column: str) -> str:
    """The DDL type of a column, for the schema of an Arrow function."""
    return df.schema[column].dataType.simpleString()


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII takes the fast built-in, which changes nothing else there."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; an unknown id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes in each (one row at least).

    Workers outlive their tasks, so at the end what Arrow's pool has kept of freed memory goes back to the system.
    """
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        text = batch.column(column)
        sizes = np.diff(np.frombuffer(text.buffers()[1], dtype=np.int64 if pa.types.is_large_string(text.type) else np.int32)[text.offset : text.offset + n + 1])
        ends = np.cumsum(sizes)
        at = 0
        while at < n:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, stop - at)
            at = stop
    pa.default_memory_pool().release_unused()


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges ``starts[i] .. starts[i] + lengths[i]``."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def binaries(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Binary cells that split the bytes of ``flat``; ``lengths`` counts its elements."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths * flat.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))]).cast(pa.binary())


def bytes_of(df: DataFrame, text: str) -> int:
    """UTF-8 bytes of a text column, over all rows."""
    return df.agg(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def is_integer(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)
