"""Snapshot picks (J4-J7, A1), resolved on the snapshot catalogue, never on rows.

The catalogue holds one row per (channel, captured_at, created_at) batch; its
size grows with the number of crawls, not with the rows inside them, so every
window here is over metadata.  Rows are reached afterwards by equi-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankdelta.functions.status import day_start, minus_days, plus_hours
from rankdelta.operators.clean import normalise_names
from rankdelta.schema import BASELINE_ANCHOR_HOUR


def catalogue(rows: DataFrame) -> DataFrame:
    """Distinct snapshot batches: (channel, captured_at, created_at).

    Channel is normalised the same way the comparison does it.  Partial
    aggregation collapses every batch map-side, so the shuffle carries
    one row per batch and task.
    """
    return (normalise_names(rows.select("channel", "captured_at", "created_at"), ("channel",))
            .groupBy("channel", "captured_at", "created_at").agg(F.count(F.lit(1)).alias("n_rows")))


def latest_per_day(cat: DataFrame) -> DataFrame:
    """Per (channel, day) the latest capture time of that day, from the catalogue.

    Output: channel, day, captured_at (the current snapshot of the day).
    """
    c = cat.filter(F.col("captured_at").isNotNull())
    return c.groupBy("channel", day_start("captured_at").alias("day")).agg(F.max("captured_at").alias("captured_at"))


def requests(latest: DataFrame, offsets: tuple[int, ...], run_at: Column | None = None) -> DataFrame:
    """One baseline request per current snapshot and offset: channel, captured_at, offset_days, target_at.

    The run time is the snapshot's own capture time, unless ``run_at`` is given.
    """
    rows = latest.select("channel", "captured_at", F.explode(F.array(*[F.lit(k) for k in offsets])).alias("offset_days"))
    run = F.col("captured_at") if run_at is None else run_at
    target = None
    for k in offsets:
        this = F.when(F.col("offset_days") == k, minus_days(run, k))
        target = this if target is None else F.coalesce(target, this)
    return rows.withColumn("target_at", target)


REQUEST_KEY = ["channel", "captured_at", "offset_days"]


def day_picks(cat: DataFrame, anchor_hour: int = BASELINE_ANCHOR_HOUR) -> DataFrame:
    """(channel, target_day, nearest_created_at): among the batches captured on a day, the created_at
    nearest to the anchor hour; equal distance goes to the later one; NULL stamps ignored.

    The pick of a day is the same for every request, so it is one aggregate of the catalogue.
    """
    c = cat.filter(F.col("created_at").isNotNull() & F.col("captured_at").isNotNull()).select(
        "channel", day_start("captured_at").alias("target_day"), "created_at")
    diff = F.timestamp_diff("MICROSECOND", plus_hours(F.col("target_day"), anchor_hour), F.col("created_at"))
    return c.groupBy("channel", "target_day").agg(
        F.min_by("created_at", F.struct(F.abs(diff), -diff)).alias("nearest_created_at"))


def nearest_pick(reqs: DataFrame, cat: DataFrame, anchor_hour: int = BASELINE_ANCHOR_HOUR) -> DataFrame:
    """The pick of the target day, for requests whose day has one."""
    r = reqs.withColumn("target_day", day_start("target_at"))
    return r.join(day_picks(cat, anchor_hour), ["channel", "target_day"]).select(*REQUEST_KEY, "nearest_created_at")


def asof_pick(reqs: DataFrame, cat: DataFrame) -> DataFrame:
    """The latest created_at strictly before the target time, any day.

    Requests and batches of a (channel, month) go into one ordered stream, where
    a request takes the last stamp seen before it; on equal times the request
    sorts first, which makes the comparison strict.  What earlier months left
    is one stamp per (channel, month), carried forward over months only.
    """
    def month(c):
        return F.date_trunc("month", c).cast("timestamp_ntz")

    batches = (cat.filter(F.col("created_at").isNotNull())
               .select("channel", F.col("created_at").alias("t"), F.lit(1).alias("kind"),
                       F.col("created_at").alias("stamp"),
                       F.lit(None).cast("timestamp_ntz").alias("captured_at"),
                       F.lit(None).cast("int").alias("offset_days")))
    asks = reqs.select("channel", F.col("target_at").alias("t"), F.lit(0).alias("kind"),
                       F.lit(None).cast("timestamp_ntz").alias("stamp"), "captured_at", "offset_days")
    stream = batches.unionByName(asks).withColumn("month", month(F.col("t")))
    per_month = stream.groupBy("channel", "month").agg(F.max("stamp").alias("top"))
    before = Window.partitionBy("channel").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    carried = (per_month.withColumn("carried", F.max("top").over(before))
               .select(F.col("channel").alias("_c"), F.col("month").alias("_m"), "carried"))
    inside = (Window.partitionBy("channel", "month").orderBy("t", "kind")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = (stream.withColumn("seen", F.last("stamp", ignorenulls=True).over(inside)).filter(F.col("kind") == 0))
    return (seen.join(carried, seen["channel"].eqNullSafe(carried["_c"]) & (seen["month"] == carried["_m"]), "left")
            .select(*REQUEST_KEY, F.col("t").alias("target_at"), F.coalesce("seen", "carried").alias("asof_created_at")))


def resolve(reqs: DataFrame, cat: DataFrame) -> DataFrame:
    """Nearest pick on the target day, else the strict as-of fallback.

    Output: channel, captured_at, offset_days, target_at, base_created_at (NULL
    when there is nothing to compare with), how ('nearest'/'asof').
    """
    r = reqs.withColumn("target_day", day_start("target_at"))
    r = r.join(day_picks(cat), ["channel", "target_day"], "left")
    found = r.filter("nearest_created_at is not null").select(
        *REQUEST_KEY, "target_at", F.col("nearest_created_at").alias("base_created_at"), F.lit("nearest").alias("how"))
    asof = asof_pick(r.filter("nearest_created_at is null").select(*reqs.columns), cat).select(
        *REQUEST_KEY, "target_at", F.col("asof_created_at").alias("base_created_at"),
        F.when(F.col("asof_created_at").isNotNull(), F.lit("asof")).alias("how"))
    return found.unionByName(asof)
