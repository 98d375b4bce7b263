"""Helpers that the training-data operators share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_scratch: list[tuple[SparkSession, str]] = []  # what is left is deleted when the driver ends


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session without the setting gets a folder of its own; on a
    cluster a missing setting is an error, since executors could not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = "file://" + tempfile.mkdtemp(prefix="rankdelta-shared-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured if ":/" in configured else f"file://{configured}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; it is deleted when the driver ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(drop_scratch)
    _scratch.append((spark, path))
    return path


def drop_scratch() -> None:
    while _scratch:
        spark, path = _scratch.pop()
        try:
            delete_path(spark, path)
        except Exception:  # the session may have ended before
            continue


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._scratch_path = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete ``written`` tables that nothing reads any more, also not lazily."""
    for t in tables:
        path = vars(t).get("_scratch_path")
        if path:
            delete_path(t.sparkSession, path)


def fitting(df: DataFrame, rows: int, name: str) -> DataFrame:
    """``df`` (written first) marked for a broadcast if it has at most ``rows`` rows; else as it is, for a shuffled join."""
    df = written(df, name)
    return F.broadcast(df) if df.count() <= rows else df


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, nothing else (``lower`` alone would fold other letters too)."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_key(*cols: Column) -> Column:
    """64-bit key of a row's content; rows of equal content share it on purpose."""
    return F.xxhash64(*cols)


def utf8(col: Column) -> Column:
    """The bytes of a string; null as empty."""
    return F.coalesce(col.cast("binary"), F.lit(b""))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to about ``limit`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        lengths = [len(x) if x is not None else 0 for x in batch.column(column).to_pylist()] if batch.num_rows else []
        start, held = 0, 0
        for i, n in enumerate(lengths):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)
