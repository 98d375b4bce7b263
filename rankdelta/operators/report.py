"""Report shapes over annotated rows (W2-W4, A2, A4-A7, PRC-4, FMT-3..5).

Every window here is partitioned by the report key (channel, captured_at)
and works on rows already cut to the report limit, so groups are bounded
by the chart size, never by the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankdelta.functions.status import minute_label, movement_status, snapshot_label, trend_class
from rankdelta.operators.changes import CURRENT, DAY, REPORT_KEY, WEEK
from rankdelta.schema import (
    DIGEST_CHART_OUT_HEAD, DIGEST_COUNT_KEEP, DIGEST_COUNT_NEW, DIGEST_DAY_BASE,
    DIGEST_NO_DATA, DIGEST_WEEK_BASE, STATUS_DOWN, STATUS_NEW, STATUS_SAME, STATUS_UP,
    ReportParams,
)

# Tie-breaks appended to every rank order so results are deterministic.
_TIES = ["brand_key", "product_key"]


def _report_window(*order: Column) -> Window:
    return Window.partitionBy(*REPORT_KEY).orderBy(*order)


def movement_counts(annotated: DataFrame, p: ReportParams = ReportParams()) -> DataFrame:
    """A2: up / down / new / unchanged among rows ranked within the limit."""
    a = annotated.filter(F.col("rank") <= p.report_limit)
    return a.groupBy(*REPORT_KEY).agg(
        F.count_if(F.col("delta_day") > 0).alias("up_count"),
        F.count_if(F.col("delta_day") < 0).alias("down_count"),
        F.count_if(F.col("status_day") == STATUS_NEW).alias("new_count"),
        F.count_if(F.col("status_day") == STATUS_SAME).alias("keep_count"),
    )


def chart_out_counts(chart_out: DataFrame, p: ReportParams = ReportParams()) -> DataFrame:
    """A4: chart-outs whose previous rank was within the limit."""
    c = chart_out.filter(F.col("prev_rank_day").isNotNull() & (F.col("prev_rank_day") <= p.report_limit))
    return c.groupBy(*REPORT_KEY).agg(F.count(F.lit(1)).alias("chart_out_count"))


def chart_out_top(chart_out: DataFrame, p: ReportParams = ReportParams()) -> DataFrame:
    """The best previous ranks among those chart-outs."""
    c = chart_out.filter(F.col("prev_rank_day").isNotNull() & (F.col("prev_rank_day") <= p.report_limit))
    w = _report_window(F.col("prev_rank_day"), *[F.col(t) for t in _TIES])
    return (c.withColumn("pos", F.row_number().over(w).cast("int"))
            .filter(F.col("pos") <= p.chart_out_top))


def distinct_channels(annotated: DataFrame) -> DataFrame:
    """A5: channels present, NULL skipped."""
    return annotated.select("channel").filter(F.col("channel").isNotNull()).distinct()


def top_n(annotated: DataFrame, p: ReportParams = ReportParams()) -> DataFrame:
    """W4 + PRJ-3 + PRC-4 + FMT-3: the first ``report_limit`` rows by rank.

    A row cut, as ``head(n)`` is: duplicate keys can push ranks past n out.
    Spark plans this as a WindowGroupLimit, so each map task keeps at most
    n rows per report before the shuffle.
    """
    w = _report_window(F.col("rank"), *[F.col(t) for t in _TIES],
                       F.col("prev_rank_day").asc_nulls_first(), F.col("prev_rank_week").asc_nulls_first())
    cut = (annotated.filter(F.col("rank").isNotNull())
           .withColumn("pos", F.row_number().over(w)).filter(F.col("pos") <= p.report_limit))
    price = F.when(F.col("channel").isin(*p.dollar_channels) & F.col("price").isNotNull(),
                   F.concat(F.lit("$"), F.col("price"))).otherwise(F.col("price"))
    return cut.select(
        *REPORT_KEY, F.col("pos").cast("int").alias("pos"), "rank", "brand", "product",
        price.alias("price"),
        F.coalesce("status_day", F.lit(STATUS_SAME)).alias("status_day"),
        F.coalesce("status_week", F.lit(STATUS_SAME)).alias("status_week"),
        F.lit("").alias("remark"),
    )


def with_trend(report: DataFrame) -> DataFrame:
    """FMT-4: the colour class of each status cell as data."""
    return report.withColumns({"trend_day": trend_class("status_day"),
                               "trend_week": trend_class("status_week")})


def _tiers(p: ReportParams) -> Column:
    """The tiers a row enters, with their two sort values: array of (tier, o1, o2)."""
    size = F.abs(F.col("delta_day"))
    seen = (F.col("rank") <= p.report_limit) & F.col("status_day").isNotNull() & ~F.col("status_day").isin("", STATUS_SAME)
    least = F.lit(0) if p.tier2_include_new else F.when(F.col("status_day") == STATUS_NEW, F.lit(1)).otherwise(F.lit(0))
    moved = F.coalesce(size, F.lit(0)) > least
    if p.tier2_include_new:
        moved = moved | (F.col("status_day") == STATUS_NEW)

    def tier(n, when, o1, o2):
        return F.when(seen & when, F.struct(F.lit(n).alias("tier"), o1.cast("int").alias("o1"), o2.cast("int").alias("o2")))
    return F.array_compact(F.array(
        tier(1, size >= p.min_move, -size, F.col("rank")),
        tier(2, F.lower("brand").isin(*p.watch_brands) & moved, -size, F.col("rank")),
        tier(3, F.col("rank") <= p.top_rank, F.col("rank"), F.lit(0))))


def _chosen_lines(cand: DataFrame, p: ReportParams) -> DataFrame:
    """Adds ``line_no`` and ``line`` to rows exploded to their tiers (column ``t``); null where a row gives no line."""
    report = Window.partitionBy(*REPORT_KEY)
    order = [F.col("t.tier"), F.col("t.o1"), F.col("t.o2"), F.col("delta_day").desc_nulls_last(), *[F.col(t) for t in _TIES]]
    t1_keys = F.size(F.collect_set(F.when(F.col("t.tier") == 1, F.struct("brand", "product"))).over(report))
    gate = (F.col("t.tier") != 2) | (F.least(F.col("_t1"), F.lit(p.highlight_max)) < p.tier2_gate)
    cand = cand.withColumn("_t1", t1_keys).withColumn("_in", F.col("t").isNotNull() & F.coalesce(gate, F.lit(False)))
    first = F.row_number().over(Window.partitionBy(*REPORT_KEY, "brand", "product", "_in").orderBy(*order)) == 1
    cand = cand.withColumn("_in", F.col("_in") & first)
    no = F.row_number().over(Window.partitionBy(*REPORT_KEY, "_in").orderBy(*order)).cast("int")
    line = F.concat(F.lit("  "), F.col("status_day"), F.lit(": "), F.col("brand"), F.lit(" - "),
                    F.col("product"), F.lit("(#"), F.col("rank").cast("string"), F.lit(")"))
    cand = cand.withColumn("line_no", F.when(F.col("_in") & (no <= p.highlight_max), no))
    return cand.withColumn("line", F.when(F.col("line_no").isNotNull(), line)).drop("_t1", "_in")


def highlights(annotated: DataFrame, p: ReportParams = ReportParams()) -> DataFrame:
    """At most ``highlight_max`` lines per report, unique by (brand, product).

    Tier 1: |delta| >= min_move, by |delta| desc then rank.
    Tier 2 (only while tier 1 gave fewer than ``tier2_gate`` lines):
      watch-list brands that moved, same order.
    Tier 3: rank <= top_rank and not unchanged, by rank.
    The gate is applied before de-duplication, a key keeps its first (tier,
    order) occurrence, and the first lines per report win.  A row is exploded to
    the tiers it enters, so the annotated rows are read once.
    """
    cand = annotated.filter(F.col("rank") <= p.report_limit).withColumn("t", F.explode(_tiers(p)))
    lined = _chosen_lines(cand, p).filter(F.col("line_no").isNotNull())
    return lined.select(*REPORT_KEY, "line_no", F.col("t.tier").alias("tier"), "brand", "product", "rank", "status_day", "line")


def baseline_labels(base: DataFrame) -> DataFrame:
    """The first non-NULL capture time (by rank) of each report's baseline."""
    b = base.filter(F.col("base_captured_at").isNotNull())
    first = b.groupBy(*REPORT_KEY).agg(
        F.min_by("base_captured_at", F.struct("rank", *_TIES)).alias("base_captured_at"))
    return first.withColumn("label", snapshot_label("base_captured_at"))


def pick_labels(pairs: DataFrame) -> DataFrame:
    """DT-4: minute label of each picked baseline stamp."""
    return pairs.withColumn("pick_label", minute_label("base_created_at"))


def digest(compared: DataFrame, p: ReportParams = ReportParams()) -> DataFrame:
    """FMT-5: one text digest per report, from the compared or charted rows of a change set.

    Lines: day/week baseline labels (or "no data"), a blank, the movement
    count line, highlight lines plus a blank, then the chart-out block.  The rows
    lie by report already, so labels, counts, lines and chart-outs come from one
    aggregate without a further exchange; it gathers at most 7 + 5 lines.
    """
    role, rank = F.col("role"), F.col("rank")
    rows = compared.filter(F.col("is_report"))
    rows = rows.withColumn("prev_rank_day", F.explode_outer(F.when(role == CURRENT, F.col("day_ranks"))))
    rows = rows.withColumn("delta_day", F.when(role == CURRENT, F.col("prev_rank_day") - rank))
    rows = rows.withColumn("status_day", F.when(role == CURRENT, movement_status("delta_day")))
    rows = rows.select("*", F.posexplode_outer(_tiers(p)).alias("_i", "t"))
    rows = _chosen_lines(rows, p)
    once = F.coalesce(F.col("_i"), F.lit(0)) == 0  # a row counts once, however many tiers it enters
    shown = once & (role == CURRENT) & (rank <= p.report_limit)
    gone = (role == DAY) & ~F.col("now") & (rank <= p.report_limit)
    rows = rows.withColumn("_gone", F.coalesce(gone, F.lit(False)))
    pos = F.row_number().over(Window.partitionBy(*REPORT_KEY, "_gone").orderBy("rank", *_TIES))
    rows = rows.withColumn("_pos", F.when(F.col("_gone") & (pos <= p.chart_out_top), pos))
    drop_line = F.concat(F.lit("  #"), rank.cast("string"), F.lit(" "), F.col("brand"), F.lit(" - "), F.col("product"))

    def base_label(which):
        dated = (role == which) & F.col("base_captured_at").isNotNull()
        return snapshot_label(F.min_by("base_captured_at", F.when(dated, F.struct("rank", *_TIES))))

    def lines(when, no, text):
        found = F.sort_array(F.collect_list(F.when(when, F.struct(no.alias("no"), text.alias("line")))))
        return F.transform(found, lambda x: x["line"])

    per = rows.groupBy(*REPORT_KEY).agg(
        base_label(DAY).alias("day_label"), base_label(WEEK).alias("week_label"),
        F.count_if(once & (role == CURRENT)).alias("n"),
        F.count_if(shown & (F.col("delta_day") > 0)).cast("string").alias("up"),
        F.count_if(shown & (F.col("delta_day") < 0)).cast("string").alias("down"),
        F.count_if(shown & (F.col("status_day") == STATUS_NEW)).cast("string").alias("new"),
        F.count_if(shown & (F.col("status_day") == STATUS_SAME)).cast("string").alias("keep"),
        lines(F.col("line_no").isNotNull(), F.col("line_no"), F.col("line")).alias("highlights"),
        F.count_if("_gone").alias("n_gone"), lines(F.col("_pos").isNotNull(), F.col("_pos"), drop_line).alias("gone"))
    none = F.array().cast("array<string>")
    counts = F.concat(F.lit("["), F.col("channel"), F.lit(f"] {STATUS_UP} "), F.col("up"), F.lit(f" / {STATUS_DOWN} "), F.col("down"),
                      F.lit(f" / {DIGEST_COUNT_NEW} "), F.col("new"), F.lit(f" / {DIGEST_COUNT_KEEP} "), F.col("keep"))
    before, after = DIGEST_CHART_OUT_HEAD.split("{n}")
    head = F.concat(F.lit(before), F.col("n_gone").cast("string"), F.lit(after))
    text = F.concat(
        F.array(F.concat(F.lit(DIGEST_DAY_BASE), F.coalesce("day_label", F.lit(DIGEST_NO_DATA))),
                F.concat(F.lit(DIGEST_WEEK_BASE), F.coalesce("week_label", F.lit(DIGEST_NO_DATA))), F.lit("")),
        F.when(F.col("n") > 0, F.array(counts)).otherwise(none),
        F.when(F.size("highlights") > 0, F.array_append("highlights", F.lit(""))).otherwise(none),
        F.when(F.col("n_gone") > 0, F.array_prepend("gone", head)).otherwise(none))
    return per.select(*REPORT_KEY, F.array_join(text, "\n").alias("digest"), F.size(text).cast("long").alias("n_lines"))
