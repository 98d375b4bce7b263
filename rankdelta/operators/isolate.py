"""Channels that fail alone (SRC-12): errors as rows, inside one job.

Collected rows arrive as text.  Values that cannot be read become NULL by
try-expressions and leave a message in ``_error``; no value raises.  A channel
with such a row is left out of the reports as a whole and listed with its first
message; an expected channel without rows is listed too.  The other channels
go through the same job untouched, and nothing is run twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankdelta.functions.text import clean_title_plain
from rankdelta.schema import SNAPSHOT_SCHEMA

NO_ROWS = "no rows"


def _unread(name: str, text: Column, value: Column) -> Column:
    return F.when(text.isNotNull() & value.isNull(), F.concat(F.lit(f"{name}: "), text))


def read_rows(raw: DataFrame) -> DataFrame:
    """Snapshot columns from text columns, and ``_error``: what a row could not be read for, or NULL.

    ``id``, ``rank``, ``captured_at`` and ``created_at`` are read by try-casts.  A
    missing column is an error of every row, a NULL value is not one, and a rank
    that is no number is not one either (such rows are dropped by the cleaning,
    PRJ-4).  Other columns are dropped.
    """
    out, errors = [], []
    for f in SNAPSHOT_SCHEMA.fields:
        if f.name not in raw.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            errors.append(F.lit(f"{f.name}: missing"))
            continue
        value = F.col(f.name).try_cast(f.dataType)
        out.append(value.alias(f.name) if f.name != "rank" else F.col("rank"))
        if f.name != "rank":
            errors.append(_unread(f.name, F.col(f.name).cast("string"), value))
    return raw.select(*out, F.coalesce(*errors).alias("_error"))


def channel_states(read: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """(channel, n_rows, n_bad, error): one row per channel; ``error`` is NULL where all rows could be read.

    The first message is that of the smallest (id, text).  ``expected``: names
    that must appear; one without rows gets the error "no rows".  Counts are
    summed before the shuffle, so a hot channel is a few rows.
    """
    bad = F.col("_error").isNotNull()
    states = read.withColumn("channel", clean_title_plain("channel")).groupBy("channel").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_bad"),
        F.min(F.when(bad, F.struct(F.col("id").isNull().alias("no_id"), "id", F.col("_error").alias("error"))))["error"].alias("error"))
    if expected is None:
        return states
    names = expected.select(clean_title_plain("channel").alias("channel")).distinct()
    return names.join(states, "channel", "full").select(
        "channel", F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"), F.coalesce("n_bad", F.lit(0).cast("long")).alias("n_bad"),
        F.when(F.col("n_rows").isNull(), F.lit(NO_ROWS)).otherwise(F.col("error")).alias("error"))


def good_rows(read: DataFrame) -> DataFrame:
    """The rows of the channels without an error, ready for the comparisons."""
    failed = channel_states(read).filter("error is not null").select(F.col("channel").alias("_failed"))
    named = read.withColumn("_name", clean_title_plain("channel"))
    return named.join(failed, F.col("_name") == F.col("_failed"), "left_anti").drop("_name", "_error")
