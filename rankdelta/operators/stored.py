"""Reports straight from the stored snapshot table (J6, J8 over SRC-5).

Which snapshots a report compares is resolved on the table's catalogue, which
the append log keeps beside the data.  The picks then meet the partitioned table
in one equi-join that carries the partition columns: Spark turns their values
into a dynamic partition filter, so only the folders of days that some report
uses are opened.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdelta.operators import baseline as B
from rankdelta.operators import changes as C
from rankdelta.operators.clean import mark_comparable, normalise_names
from rankdelta.schema import DAY_OFFSET_DAYS, WEEK_OFFSET_DAYS
from rankdelta.session import staged
from rankdelta.sources import snapshot_log as LOG

PRUNED_BY = ("stored_channel", "capture_date")


def stored_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(channel, captured_at, created_at, stored_channel, capture_date): the snapshots in the table, from the log."""
    cat = LOG.read_catalogue(spark, path).select(
        F.col("channel").alias("stored_channel"), "capture_date", "channel", "captured_at", "created_at")
    return normalise_names(cat, ("channel",)).distinct()


def stored_baselines(spark: SparkSession, path: str, day_days: int = DAY_OFFSET_DAYS, week_days: int = WEEK_OFFSET_DAYS,
                     run_at: dt.datetime | None = None) -> DataFrame:
    """J6 over the stored table: the picks of ``baseline.resolve``, from the catalogue alone."""
    cat = staged(stored_catalogue(spark, path), "stored-catalogue")
    latest, at = C.at_run_time(B.latest_per_day(cat), run_at)
    return B.resolve(B.requests(latest, (day_days, week_days), at), cat)


def report_from_table(spark: SparkSession, path: str, run_at: dt.datetime | None = None,
                      day_days: int = DAY_OFFSET_DAYS, week_days: int = WEEK_OFFSET_DAYS) -> C.ChangeSet:
    """J8 over the stored table: the reports of ``run_at``'s day, or of every day.

    Rows without channel or capture time lie in folders that no report asks for.
    """
    cat = staged(stored_catalogue(spark, path), "stored-catalogue")
    latest, at = C.at_run_time(B.latest_per_day(cat), run_at)
    pairs = B.resolve(B.requests(latest, (day_days, week_days), at), cat)
    serves = C.dealing(cat, latest, pairs, day_days, week_days)
    # back to the stored names of channel and day; written, so that its size is known when the join is planned
    names = cat.select(*C.REPORT_KEY, F.col("created_at").alias("_stamp"), *PRUNED_BY)
    serves = serves.join(names, C.REPORT_KEY).filter(F.col("created_at").eqNullSafe(F.col("_stamp"))).drop("_stamp")
    serves = staged(serves.distinct(), "stored-picks")
    marked = mark_comparable(LOG.read_table(spark, path).withColumn("stored_channel", F.col("channel")).drop("batch"))
    deal = C.deal_batches(marked, serves, PRUNED_BY)
    return C.ChangeSet(lambda roles: deal(roles).drop(*PRUNED_BY))
