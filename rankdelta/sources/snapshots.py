"""The append-only snapshot table (SRC-5..10) on partitioned parquet.

Layout: ``<path>/channel=<c>/capture_date=<d>/part-*.parquet`` with the
canonical ``SNAPSHOT_SCHEMA``.  Channel and day filters prune directories;
time ranges and ranks reach the parquet reader as pushed filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankdelta.operators.ordinal import numbered
from rankdelta.schema import LOCAL_TZ, PURGE_KEYS, SNAPSHOT_COLUMNS, SNAPSHOT_SCHEMA
from rankdelta.session import scratch_path

PARTITION_COLS = ("channel", "capture_date")
TABLE_SCHEMA = T.StructType(SNAPSHOT_SCHEMA.fields + [T.StructField("capture_date", T.DateType())])


def ntz(value: dt.datetime | str) -> Column:
    """A wall-clock literal; it goes through text, so the host's time zone plays no part."""
    return F.lit(value if isinstance(value, str) else value.isoformat(sep=" ")).cast("timestamp_ntz")


def ensure_snapshot_table(spark: SparkSession, path: str) -> None:
    """SRC-7: create an empty partitioned table when none exists (no-op otherwise)."""
    empty = spark.createDataFrame([], TABLE_SCHEMA)
    empty.write.mode("ignore").partitionBy(*PARTITION_COLS).parquet(path)


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """The table with its fixed schema (no inference)."""
    return spark.read.schema(TABLE_SCHEMA).parquet(path).select(*SNAPSHOT_COLUMNS, "capture_date")


def scan(df: DataFrame, channel: str | None = None, start=None, end=None,
         columns: list[str] | None = None) -> DataFrame:
    """SRC-5 / FLT-3: channel equality and a half-open capture-time range.

    The range stays a plain comparison on the column, so the parquet reader
    gets it as a pushed filter; on the table, ``capture_date`` bounds prune
    whole directories as well.
    """
    out = df
    if channel is not None:
        out = out.filter(F.col("channel") == channel)
    if start is not None:
        out = out.filter(F.col("captured_at") >= ntz(start))
        if "capture_date" in df.columns:
            out = out.filter(F.col("capture_date") >= ntz(start).cast("date"))
    if end is not None:
        out = out.filter(F.col("captured_at") < ntz(end))
        if "capture_date" in df.columns:
            out = out.filter(F.col("capture_date") <= ntz(end).cast("date"))
    return out.select(*columns) if columns else out


POINT_COLUMNS = ("rank", "brand", "product", "old_price", "price", "captured_at", "channel", "created_at")


def point_scan(df: DataFrame, limit: int | None = None, group: tuple[str, ...] = ("channel", "created_at"),
               order: tuple[str, ...] = ("rank", "id"), *, at: dt.datetime | str | None = None,
               columns: list[str] | None = None) -> DataFrame:
    """SRC-6 / LIM-1: rows of each snapshot (``group``) in rank order, the first ``limit`` if given.

    The cut is a group limit, so a map task forwards at most ``limit`` rows per
    snapshot.  With ``at`` it is the one snapshot with that stamp: a pushed filter
    and a top-k read of ``columns`` (those of a baseline if not given).
    """
    if at is not None:
        rows = df.filter(F.col("created_at") == ntz(at)).orderBy(*order)
        rows = rows if limit is None else rows.limit(limit)
        return rows.select(*(columns or POINT_COLUMNS))
    if limit is not None:
        w = Window.partitionBy(*group).orderBy(*order)
        df = df.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= limit).drop("_k")
    return df.select(*columns) if columns else df


def stamp_batch(df: DataFrame, start_id: int, created_at: dt.datetime | None = None,
                order: tuple[str, ...] = ("channel", "captured_at", "rank", "id")) -> DataFrame:
    """SRC-9 / PRJ-1: surrogate ids continuing after ``start_id - 1`` and one
    insert stamp for the whole batch (Seoul wall time when not given).

    Ids follow ``order``, which must be total.
    """
    stamp = (ntz(created_at) if created_at is not None
             else F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_TZ), F.current_timestamp().cast("timestamp_ntz")))
    rows = numbered(df, list(order), name="_new_id", start=start_id)
    return (rows.withColumn("id", F.col("_new_id").cast("long")).drop("_new_id")
            .withColumn("created_at", stamp)
            .withColumn("collected_at", F.date_format("captured_at", "yyyy-MM-dd HH:mm:ss")))


def next_id(spark: SparkSession, path: str) -> int:
    """One more than the largest id in the table (1 for an empty table)."""
    row = read_snapshots(spark, path).agg(F.max("id").alias("m")).collect()[0]
    return (row["m"] or 0) + 1


def append_snapshot(spark: SparkSession, df: DataFrame, path: str,
                    created_at: dt.datetime | None = None, enabled: bool = True) -> int | None:
    """SRC-8: append one batch; ids continue the table, one stamp per batch.

    Returns the first id used.  An empty batch writes nothing; a disabled sink
    does nothing and returns None.  One writer at a time: two that append at
    once would take the same ids.
    """
    if not enabled:
        return None
    ensure_snapshot_table(spark, path)
    start = next_id(spark, path)
    batch = stamp_batch(df.select(*SNAPSHOT_COLUMNS), start, created_at)
    out = batch.select(*SNAPSHOT_COLUMNS).withColumn("capture_date", F.to_date("captured_at"))
    out.write.mode("append").partitionBy(*PARTITION_COLS).parquet(path)
    return start


def purge_duplicates(df: DataFrame, keys: tuple[str, ...] = PURGE_KEYS) -> DataFrame:
    """SRC-10 / A3: keep the smallest id per key (NULLs group together); ids are unique.

    The smallest ids come from a hash aggregate that is summed before the
    shuffle, so a key with a third of all rows moves one row per map task; the
    rows are then kept by a semi-join on the id.
    """
    first = df.groupBy(*keys).agg(F.min("id").alias("id")).select("id")
    return df.join(first, "id", "left_semi")


def purge_table(spark: SparkSession, path: str) -> None:
    """Purge the table's days that hold duplicates; others are not rewritten.

    Channel and capture time are part of the key, so a purge works within a
    (channel, day) partition and never empties one.  The purged days are first
    written beside the table, then swapped in partition by partition (dynamic
    overwrite): a stop in between leaves each day either old or purged, and a
    second run finishes the work.
    """
    table = read_snapshots(spark, path)
    touched = (table.groupBy(*PURGE_KEYS, "capture_date").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
               .select(*PARTITION_COLS).distinct())
    match = table["channel"].eqNullSafe(touched["channel"]) & table["capture_date"].eqNullSafe(touched["capture_date"])
    staged = scratch_path(spark, "purged")
    purge_duplicates(table.join(touched, match, "left_semi")).write.partitionBy(*PARTITION_COLS).parquet(staged)
    (spark.read.schema(TABLE_SCHEMA).parquet(staged).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITION_COLS).parquet(path))
