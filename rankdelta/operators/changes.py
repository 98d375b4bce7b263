"""Rank movement against a day-ago and a week-ago baseline (J1-J3, J8, FMT-2).

A *report* is one current snapshot, keyed (channel, captured_at).  A snapshot
row can serve several reports: its own as a current row, a later one as the day
baseline, another as the week baseline.  Every row is dealt to the reports it
serves, with its role, and the dealt rows meet in one shuffle by report.  Inside
a report, rows with the same match key find each other in windows over
(report, brand_key, product_key): previous ranks, movement and chart-outs all
come from that one exchange, with no join of rows.  A report's group is its
chart and two baselines, so it is bounded by the size of a chart.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankdelta.functions.status import day_start, movement_status, plus_days
from rankdelta.operators import baseline as B
from rankdelta.operators.clean import mark_comparable
from rankdelta.schema import (
    DAY_OFFSET_DAYS, STATUS_CHART_OUT, STATUS_SAME, WEEK_OFFSET_DAYS,
)
from rankdelta.session import input_bytes, staged

REPORT_KEY = ["channel", "captured_at"]
ROW_KEY = REPORT_KEY + ["brand_key", "product_key"]
_BASE_COLS = ["brand", "product", "brand_key", "product_key", "rank"]

PART_BYTES = 2 << 20  # input of a part of rows that meet by match key, about; they are wider than the events they come from

# What a row is to the report it is dealt to.  SEEN rows cannot be compared
# (no product or rank) and only prove that the report exists.
CURRENT, DAY, WEEK, SEEN = 0, 1, 2, 3


def _shift(offset):
    """An int is a number of days; a callable maps a capture time to the
    capture time of the report it serves (e.g. one month later)."""
    if callable(offset):
        return offset
    return lambda c: plus_days(c, offset)


def baseline_present(base: DataFrame) -> DataFrame:
    """Reports whose baseline still has rows after cleaning."""
    return base.select(*REPORT_KEY).distinct().withColumn("has_baseline", F.lit(True))


class ChangeSet:
    """Annotated rows, chart-outs and the baselines behind them, built lazily.

    ``deal(roles)`` gives the comparable rows (and SEEN ones) dealt to the
    reports they serve in one of ``roles``: the row's columns with
    ``captured_at`` of the report, ``base_captured_at`` of the row, ``role``.
    """

    def __init__(self, deal: Callable[[tuple[int, ...]], DataFrame]):
        self.deal = deal

    def _rows(self, role: int) -> DataFrame:
        return self.deal((role,)).filter(F.col("role") == role)

    @property
    def current(self) -> DataFrame:
        return self._rows(CURRENT).drop("role", "base_captured_at", "comparable")

    @property
    def base_day(self) -> DataFrame:
        return self._rows(DAY).select(*REPORT_KEY, "base_captured_at", *_BASE_COLS)

    @property
    def base_week(self) -> DataFrame:
        return self._rows(WEEK).select(*REPORT_KEY, "base_captured_at", *_BASE_COLS)

    @property
    def reports(self) -> DataFrame:
        return self.deal((CURRENT, SEEN)).select(*REPORT_KEY).distinct()

    def compared(self, *roles: int) -> DataFrame:
        """Every dealt row with what its report holds: one exchange, one sort.

        ``is_report``: the report exists; ``has_week``: it has a weekly baseline;
        ``day_ranks``, ``week_ranks``: ranks of the rows with the same match key in
        its baselines; ``now``: a current row has that key.
        """
        dealt = self.deal(roles or (CURRENT, DAY, WEEK, SEEN))
        report, row = Window.partitionBy(*REPORT_KEY), Window.partitionBy(*ROW_KEY)
        role = F.col("role")
        dealt = dealt.repartition(*REPORT_KEY).sortWithinPartitions(*ROW_KEY)
        dealt = dealt.withColumns({"is_report": F.max(role.isin(CURRENT, SEEN)).over(report),
                                   "has_week": F.max(role == WEEK).over(report)})
        return dealt.withColumns({"day_ranks": F.collect_list(F.when(role == DAY, F.col("rank"))).over(row),
                                  "week_ranks": F.collect_list(F.when(role == WEEK, F.col("rank"))).over(row),
                                  "now": F.max(role == CURRENT).over(row)})

    def charted(self, limit: int) -> DataFrame:
        """The rows of ``compared`` that a chart of ``limit`` ranks needs, lying by report.

        Rows meet by match key, so a task holds names, never a whole snapshot.  Of
        what they give, a report gathers its current rows and chart-outs within
        ``limit``, and of the others the first one in each role: it tells that the
        report exists and which snapshot a baseline is.
        """
        dealt = self.deal((CURRENT, DAY, WEEK, SEEN)).select(*REPORT_KEY, "role", "base_captured_at", *_BASE_COLS)
        role, row = F.col("role"), Window.partitionBy(*ROW_KEY)
        parts = max(int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes(dealt) // PART_BYTES))
        met = dealt.repartition(parts, *ROW_KEY).withColumns({
            "day_ranks": F.collect_list(F.when(role == DAY, F.col("rank"))).over(row), "now": F.max(role == CURRENT).over(row)})
        line = F.struct("role", "base_captured_at", *_BASE_COLS, "day_ranks", "now")
        shown = F.coalesce((F.col("rank") <= limit) & ((role == CURRENT) | ((role == DAY) & ~F.col("now"))), F.lit(False))
        order = F.struct(F.col("base_captured_at").isNull(), "rank", "brand_key", "product_key")
        others = [F.min_by(line, F.when(~shown & (role == r), order)) for r in (CURRENT, DAY, WEEK, SEEN)]
        per = met.groupBy(*REPORT_KEY).agg(F.collect_list(F.when(shown, line)).alias("_shown"),
                                           F.array_compact(F.array(*others)).alias("_others"))
        per = per.withColumn("_lines", F.concat("_shown", "_others"))
        is_report = F.exists("_lines", lambda x: x["role"].isin(CURRENT, SEEN))
        return per.select(*REPORT_KEY, is_report.alias("is_report"), F.inline("_lines"))

    def daily(self) -> DataFrame:
        """Previous rank, delta and status of every current row; duplicate keys
        multiply rows, as a join does.  Without a baseline every row is new."""
        return _daily(self.compared(CURRENT, DAY)).drop(*_HELPERS)

    def weekly(self) -> DataFrame:
        """A report without a weekly baseline gets the unchanged status."""
        d = _daily(self.compared(CURRENT, DAY, WEEK)).withColumn("prev_rank_week", F.explode_outer("week_ranks"))
        d = d.withColumn("delta_week", F.col("prev_rank_week") - F.col("rank"))
        status = F.when(F.col("has_week"), movement_status("delta_week")).otherwise(F.lit(STATUS_SAME))
        return d.withColumn("status_week", status).drop(*_HELPERS)

    def chart_outs(self) -> DataFrame:
        """Day baseline rows of existing reports whose key no current row has."""
        gone = self.compared(CURRENT, DAY, SEEN).filter(
            (F.col("role") == DAY) & F.col("is_report") & ~F.col("now"))
        return gone.select(
            "channel", "captured_at", "brand", "product", "brand_key", "product_key",
            F.col("rank").alias("prev_rank_day"), F.lit(STATUS_CHART_OUT).alias("status_day"))


_HELPERS = ("role", "base_captured_at", "comparable", "is_report", "has_week", "day_ranks", "week_ranks", "now")


def _daily(compared: DataFrame) -> DataFrame:
    d = compared.filter(F.col("role") == CURRENT).withColumn("prev_rank_day", F.explode_outer("day_ranks"))
    d = d.withColumn("delta_day", F.col("prev_rank_day") - F.col("rank"))
    return d.withColumn("status_day", movement_status("delta_day"))


def dedup_keys(clean: DataFrame, group: list[str], order: tuple[str, ...] = ("rank", "id"), limit: int | None = None) -> DataFrame:
    """The best-ranked row per match key within ``group``; at most ``limit`` best ranks if given."""
    if limit is not None:
        clean = clean.filter(F.col("rank") <= limit)
    w = Window.partitionBy(*group, "brand_key", "product_key").orderBy(*order)
    return clean.withColumn("_k", F.row_number().over(w)).filter(F.col("_k") == 1).drop("_k")


def by_offset(rows: DataFrame, day_days=DAY_OFFSET_DAYS, week_days=WEEK_OFFSET_DAYS, dedup: bool = False) -> ChangeSet:
    """Every snapshot is a report; baselines are the snapshots exactly
    ``day_days`` / ``week_days`` earlier.  ``dedup``: match keys are made
    unique within each snapshot first (else they multiply rows)."""
    marked = mark_comparable(rows)
    if dedup:
        marked = dedup_keys(marked, [*REPORT_KEY, "comparable"])
    at = {CURRENT: F.col("captured_at"), DAY: _shift(day_days)(F.col("captured_at")), WEEK: _shift(week_days)(F.col("captured_at"))}

    def deal(roles):
        # a row without capture time serves no later report
        served = [F.when(F.lit(r == CURRENT) | F.col("captured_at").isNotNull(),
                         F.struct(F.lit(r).alias("role"), at[r].alias("report_at"))) for r in (CURRENT, DAY, WEEK) if r in roles]
        none = F.lit(None).cast("array<struct<role: int, report_at: timestamp_ntz>>")
        wanted = F.when(F.col("comparable"), F.array_compact(F.array(*served)) if served else none)
        if SEEN in roles:
            wanted = wanted.otherwise(F.array(F.struct(F.lit(SEEN).alias("role"), F.col("captured_at").alias("report_at"))))
        dealt = marked.withColumn("_r", F.explode(wanted)).withColumnRenamed("captured_at", "base_captured_at")
        return dealt.withColumns({"role": F.col("_r.role"), "captured_at": F.col("_r.report_at")}).drop("_r")
    return ChangeSet(deal)


def dealing(cat: DataFrame, latest: DataFrame, pairs: DataFrame, day_days: int, week_days: int) -> DataFrame:
    """(channel, captured_at, created_at, report_at, role): which batch serves which report, from metadata alone."""
    now = cat.join(latest.select(*REPORT_KEY), REPORT_KEY).select(
        *REPORT_KEY, "created_at", F.col("captured_at").alias("report_at"), F.lit(CURRENT).alias("role"))
    picks = pairs.filter("base_created_at is not null").select(
        "channel", F.col("base_created_at").alias("created_at"), F.col("captured_at").alias("report_at"),
        F.when(F.col("offset_days") == day_days, DAY).when(F.col("offset_days") == week_days, WEEK).alias("role"))
    base = cat.join(picks, ["channel", "created_at"]).select(*REPORT_KEY, "created_at", "report_at", "role")
    return now.unionByName(base)


def deal_batches(marked: DataFrame, serves: DataFrame, more: tuple[str, ...] = ()) -> Callable[[tuple[int, ...]], DataFrame]:
    """The ``deal`` of a change set whose rows find their reports through ``serves``.

    One equi-join of the rows with metadata; ``more`` names further columns that
    both sides share (partition columns of a stored table).
    """
    s = serves.withColumnsRenamed({c: f"_{c}" for c in ("channel", "captured_at", "created_at", *more)})
    same = (F.col("channel") == F.col("_channel")) & F.col("captured_at").eqNullSafe(F.col("_captured_at")) \
        & F.col("created_at").eqNullSafe(F.col("_created_at"))
    for c in more:
        same = same & (F.col(c) == F.col(f"_{c}"))

    def deal(roles):
        asked = [CURRENT if r == SEEN else r for r in roles]
        served = s.filter(F.col("role").isin(*asked))
        dealt = marked.join(served, same).drop("_channel", "_captured_at", "_created_at", *[f"_{c}" for c in more])
        dealt = dealt.withColumn("role", F.when(F.col("comparable"), F.col("role")).when(F.col("role") == CURRENT, F.lit(SEEN)))
        dealt = dealt.filter(F.col("role").isin(*roles))
        return dealt.withColumnsRenamed({"captured_at": "base_captured_at", "report_at": "captured_at"})
    return deal


def at_run_time(latest: DataFrame, run_at: dt.datetime | None):
    """(latest snapshots of the run's day, run time as a column); all days when there is no run time."""
    if run_at is None:
        return latest, None
    at = F.lit(run_at.isoformat(sep=" ")).cast("timestamp_ntz")
    return latest.filter(F.col("day") == day_start(at)), at


def by_resolution(rows: DataFrame, day_days: int = DAY_OFFSET_DAYS, week_days: int = WEEK_OFFSET_DAYS,
                  run_at: dt.datetime | None = None) -> tuple[ChangeSet, DataFrame, DataFrame]:
    """The latest snapshot of each day is the report; baselines are
    resolved per report (nearest to 08:00 on the target day, else as-of).

    ``run_at``: only that day's reports, with targets counted from the run time
    instead of each snapshot's capture time.  Returns the change set and the
    day/week pick tables.  The rows are cleaned and written once; the catalogue
    of batches comes from that copy.
    """
    marked = staged(mark_comparable(rows), "marked")
    cat = staged(B.catalogue(marked), "catalogue")  # one row per batch, i.e. metadata
    latest, at = at_run_time(B.latest_per_day(cat), run_at)
    pairs = staged(B.resolve(B.requests(latest, (day_days, week_days), at), cat), "picks")
    day_pairs = pairs.filter(F.col("offset_days") == day_days).drop("offset_days")
    week_pairs = pairs.filter(F.col("offset_days") == week_days).drop("offset_days")
    return ChangeSet(deal_batches(marked, dealing(cat, latest, pairs, day_days, week_days))), day_pairs, week_pairs


def report_channels(names, build, write) -> dict[str, str]:
    """SRC-12: ``write(name, build(name))`` for each channel; a failing one does not stop the others.

    Returns the failures: channel -> message.
    """
    failed = {}
    for name in names:
        try:
            write(name, build(name))
        except Exception as exc:  # reported to the caller
            failed[name] = f"{type(exc).__name__}: {exc}"
    return failed
