"""Baseline picks, highlight tiers and report invariants on small fixtures."""

import datetime as dt

from pyspark.sql import functions as F

from rankdelta.operators import baseline as B
from rankdelta.operators import changes as C
from rankdelta.operators import report as R
from rankdelta.plans import feeds
from rankdelta.schema import SNAPSHOT_SCHEMA, ReportParams

T = dt.datetime


def snap(spark, rows):
    """rows: (id, rank, brand, product, captured_at, channel, created_at)"""
    full = [(i, r, b, p, "", "", cap, ch, cre) for i, r, b, p, cap, ch, cre in rows]
    return spark.createDataFrame(full, SNAPSHOT_SCHEMA)


def test_nearest_prefers_later_on_tie(spark):
    day0 = T(2024, 1, 1)
    rows = [
        (1, 1, "a", "x", T(2024, 1, 1, 7), "c", T(2024, 1, 1, 7)),
        (2, 1, "a", "x", T(2024, 1, 1, 9), "c", T(2024, 1, 1, 9)),
        (3, 1, "a", "x", T(2024, 1, 2, 10), "c", T(2024, 1, 2, 10)),
    ]
    df = snap(spark, rows)
    cat = B.catalogue(df)
    latest = B.latest_per_day(cat).filter(F.col("day") > day0)
    got = B.resolve(B.requests(latest, (1,)), cat).collect()
    assert len(got) == 1 and got[0]["base_created_at"] == T(2024, 1, 1, 9) and got[0]["how"] == "nearest"


def test_asof_is_strict(spark):
    # no snapshot on the target day; one exactly at the target time must not be chosen
    rows = [
        (1, 1, "a", "x", T(2023, 12, 30, 10), "c", T(2023, 12, 30, 10)),
        (2, 1, "a", "x", T(2023, 12, 31, 10), "c", T(2024, 1, 1, 10)),  # created exactly at target
        (3, 1, "a", "x", T(2024, 1, 2, 10), "c", T(2024, 1, 2, 10)),
    ]
    df = snap(spark, rows)
    cat = B.catalogue(df)
    latest = B.latest_per_day(cat).filter(F.col("captured_at") == T(2024, 1, 2, 10))
    got = B.resolve(B.requests(latest, (2,)), cat).collect()  # target = 2023-12-31 10:00, a day with a snapshot
    assert got[0]["how"] == "nearest"
    got = B.resolve(B.requests(latest, (1,)), cat).collect()  # target = 2024-01-01 10:00: no capture that day
    assert got[0]["how"] == "asof" and got[0]["base_created_at"] == T(2023, 12, 30, 10)


def _tier_fixture(spark, t1_moves, extra):
    """Current snapshot at day 2, baseline at day 1 (offset mode)."""
    d1, d2 = T(2024, 1, 1), T(2024, 1, 2)
    rows, i = [], 0
    for k, (prev, cur) in enumerate(t1_moves):
        i += 1
        rows.append((i, prev, f"b{k}", f"p{k}", d1, "c", d1))
        rows.append((i + 100, cur, f"b{k}", f"p{k}", d2, "c", d2))
    for k, (brand, prev, cur) in enumerate(extra):
        i += 1
        if prev is not None:
            rows.append((i, prev, brand, f"e{k}", d1, "c", d1))
        rows.append((i + 100, cur, brand, f"e{k}", d2, "c", d2))
    return C.by_offset(snap(spark, rows)).daily().filter(F.col("captured_at") == d2)


def test_tier2_closed_after_five(spark):
    moves = [(30 + k, 20 + k) for k in range(5)]  # five moves of 10
    daily = _tier_fixture(spark, moves, [("numbuzin", 21, 20)])
    lines = R.highlights(daily).collect()
    assert len(lines) == 5 and all(r["tier"] == 1 for r in lines)


def test_tier3_admits_watch_brand_in_top10(spark):
    moves = [(30 + k, 20 + k) for k in range(5)]
    daily = _tier_fixture(spark, moves, [("numbuzin", 9, 8)])
    lines = R.highlights(daily).collect()
    assert len(lines) == 6 and [r for r in lines if r["brand"] == "numbuzin"][0]["tier"] == 3


def test_tier2_skips_unmoved_new(spark):
    daily = _tier_fixture(spark, [], [("numbuzin", None, 20)])
    assert R.highlights(daily).count() == 0


def test_weekly_status_without_and_with_baseline(spark):
    d1, d8 = T(2024, 1, 1), T(2024, 1, 8)
    rows = [(1, 1, "a", "x", d1, "c", d1), (2, 1, "a", "y", d8, "c", d8)]
    w = C.by_offset(snap(spark, rows)).weekly()
    got = {r["captured_at"]: r["status_week"] for r in w.collect()}
    assert got == {d1: "-", d8: "신규"}


def test_invariants_on_feed(spark, sf_dir):
    cs = C.by_offset(feeds.feed_day(spark, sf_dir))
    daily = cs.daily()
    assert daily.count() == cs.current.count()  # keys unique in this feed
    counts = R.movement_counts(daily).agg(F.sum(F.col("up_count") + F.col("down_count") + F.col("new_count")
                                                 + F.col("keep_count")).alias("s")).collect()[0]["s"]
    assert counts == daily.filter("rank <= 50").count()
    co = cs.chart_outs()
    assert co.join(cs.current, C.ROW_KEY, "left_semi").count() == 0
    hl = R.highlights(daily, ReportParams())
    per = hl.groupBy(*C.REPORT_KEY).agg(F.count("*").alias("n"), F.countDistinct("brand", "product").alias("u"))
    assert per.filter("n > 7 OR n <> u").count() == 0


def test_a_report_takes_one_exchange_of_the_rows(spark, sf_dir):
    """Comparison, cut, counts, highlights, chart-outs and digest: the rows are shuffled once, by report."""
    from rankdelta.session import staged
    cs = C.by_offset(staged(feeds.feed_day(spark, sf_dir), "rows"))
    built = {"daily": cs.daily(), "weekly": cs.weekly(), "chart_outs": cs.chart_outs(), "digest": R.digest(cs.compared()),
             "top": R.top_n(cs.weekly()), "counts": R.movement_counts(cs.daily()), "highlights": R.highlights(cs.daily()),
             "gone": R.chart_out_counts(cs.chart_outs()), "best gone": R.chart_out_top(cs.chart_outs())}
    for name, df in built.items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan, name


def test_rows_that_cannot_be_compared_prove_their_report(spark):
    """A snapshot of unreadable rows only is a report: all of its baseline left the chart."""
    a, b = T(2024, 1, 1), T(2024, 1, 2)
    rows = [(1, 1, "a", "x", a, "c", a), (2, None, "a", "x", b, "c", b), (3, 2, "a", None, b, "c", b), (4, 5, "a", "y", None, "c", None)]
    cs = C.by_offset(snap(spark, rows))
    assert [(r.captured_at, r.prev_rank_day) for r in cs.chart_outs().collect()] == [(b, 1)]
    assert sorted((r.id, r.status_day, r.status_week) for r in cs.weekly().collect()) == [(1, "신규", "-"), (4, "신규", "-")]
    text = {r.captured_at: r.digest for r in R.digest(cs.compared()).collect()}
    assert text[b].split("\n")[3:] == ["차트 아웃 1개", "  #1 a - x"] and "[c]" in text[a]
    assert sorted(str(r.captured_at) for r in cs.reports.collect()) == sorted(map(str, (a, b, None)))


def test_every_user_is_in_a_small_channel_of_the_resolved_reports(spark):
    """The large channel does not swallow the snapshots of most users, of which only a day's last would be a report."""
    from rankdelta.plans import queries as Q
    from rankdelta.session import scratch_path
    d = scratch_path(spark, "events")
    ev = [(i, T(2024, 1, 20 - day, hour), user, "click", 1.0 + user, None)
          for i, (user, day, hour) in enumerate((u, day, h) for u in range(20) for day in (0, 1) for h in (1, 9))]
    spark.createDataFrame(ev, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{d}/events.parquet")
    part = [(u, f"n{u}", "b", "t", 1, 2.0) for u in range(20)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{d}/part.parquet")
    got = sorted((r.channel, r.day.day, r.n_rows) for r in Q.latest_snapshot(spark, d).collect())
    assert got == [(f"click-{c}", day, 5) for c in range(4) for day in (19, 20)] + [("main", day, 18) for day in (19, 20)]
    assert Q.report_top_n(spark, d).count() == Q.report_roundtrip(spark, d).count() == 76
    assert Q.report_at(spark, d).filter("prev_rank_day = rank").count() == 38


def test_a_charted_digest_equals_the_digest_of_all_rows(spark, sf_dir):
    """F16: rows meet by match key; only charts are gathered by report.  Duplicates, unreadable rows and NULLs included."""
    odd = [(i, r, b, p, T(2024, 1, 1 + day), ch, T(2024, 1, 1 + day)) for i, (r, b, p, day, ch) in enumerate(
        [(k + 1, f"b{(k * (3 + day)) % 70}", f"p{(k * 7) % 60}", day, ch) for k in range(80) for day in (0, 1, 7, 8) for ch in ("c", None)]
        + [(None, "a", "x", 2, "c"), (3, "a", None, 15, "d"), (60, "far", "off", 3, "e"), (70, "far", "off", 4, "e"), (2, "z", "q", 4, "f")])]
    nowhere = [(999, 5, "a", "y", None, "c", None)]
    for cs in (C.by_offset(snap(spark, odd + nowhere)), C.by_offset(feeds.feed_half(spark, sf_dir))):
        whole = sorted(map(str, R.digest(cs.compared()).collect()))
        assert whole == sorted(map(str, R.digest(cs.charted(50)).collect())) and len(whole) > 3
    plan = C.by_offset(feeds.feed_half(spark, sf_dir)).charted(50)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in plan.split("\n") if " Window [" in line and "day_ranks" in line]
    assert windows and all("product_key" in line.split("day_ranks")[1] for line in windows)
