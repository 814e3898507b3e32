"""Session settings, size-checked broadcasts and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Repeated JSON keys must resolve to the last one, and timestamps are plain UTC.
SETTINGS = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local master, where all tasks share a disk, may go without; anywhere else each executor would write to its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfline-"))
    return spark.sparkContext.getCheckpointDir()


class _Scopes(threading.local):
    """What was written for a while, by open scope of this thread: folders, and tables that point into folders."""

    def __init__(self):
        self.open: list[list[tuple[str, str]]] = []


_scopes = _Scopes()


def written(kind: str, name: str) -> None:
    """Note a scratch ``folder`` or ``table`` for the scope that is open, if any."""
    if _scopes.open:
        _scopes.open[-1].append((kind, name))


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the intermediate tables written inside when it ends, also after an error.

    Frames that read them are of no use afterwards, so what is to stay is written inside, by the caller's own write.
    """
    _scopes.open.append([])
    try:
        yield
    finally:
        for kind, name in _scopes.open.pop():
            if kind == "table":
                spark.sql(f"DROP TABLE IF EXISTS `{name}`")
            else:
                remove_folder(spark, name)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later branches then read only the columns they need, and a lost executor costs a re-read instead
    of a second pass over the page bodies.
    """
    spark = df.sparkSession
    path = os.path.join(scratch_dir(spark), f"{label}-{uuid.uuid4().hex}")
    written("folder", path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def deal(df: DataFrame, work: int, each: int) -> DataFrame:
    """``df`` dealt evenly over as many tasks as ``work`` rows need with ``each`` to a task, whatever it lies in.

    For compact tables with much work to a row: their splits follow bytes, and adaptive execution leaves a given number alone.
    """
    tasks = -(-work // each)
    return df.repartition(tasks) if tasks > 1 else df


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Prove by a bounded count and byte sum that ``df`` may be broadcast; reads at most ``rows + 1`` rows."""
    width = F.coalesce(F.octet_length(F.to_json(F.struct(*df.columns))), F.lit(0))
    seen = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return seen["n"] <= rows and seen["b"] <= max_bytes


def narrow(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of a large table that can match ``keys`` (one column, shared by name).

    A key set proven small is broadcast, so the table is filtered where it lies and only the matching rows
    go on to a shuffle. A larger key set leaves the table as it is for the join that follows. ``keys`` should
    be cheap to read, as the proof reads it once more.
    """
    (name,) = keys.columns
    distinct = keys.distinct()
    return df.join(F.broadcast(distinct), name, "left_semi") if is_small(distinct) else df
