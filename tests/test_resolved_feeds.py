"""Findings of round 3 on the resolved reports and on the stored table, query by query."""

import datetime as dt
import glob

import pytest

from rankdelta.plans import queries as Q
from rankdelta.plans.registry import load_all
from rankdelta.session import scratch_path

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
PART = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def tables(spark, visits):
    """Events (user, type, day, hour) of January 2024 and a part per user, as parquet tables."""
    d = scratch_path(spark, "tables")
    ev = [(i, dt.datetime(2024, 1, day, hour), user, kind, 1.0 + user, None) for i, (user, kind, day, hour) in enumerate(visits)]
    spark.createDataFrame(ev, EVENTS).write.parquet(f"{d}/events.parquet")
    part = [(u, f"n{u}", "b", "t", 1, 2.0) for u in sorted({v[0] for v in visits})]
    spark.createDataFrame(part, PART).write.parquet(f"{d}/part.parquet")
    return d


# rows of each small channel and of the large one: 20 users, two days; every fifth is gone on the second day
WHOLE = {
    "baseline_nearest": (1, 1),
    "baseline_asof": (4, 4),
    "baseline_resolve": (4, 4),
    "rank_report": (9, 32),
    "report_at": (4, 14),
    "rank_report_chart_out": (1, 4),
    "report_top_n": (9, 32),
    "baseline_labels": (4, 4),
}


@pytest.fixture(scope="module")
def two_days(spark):
    return tables(spark, [(u, "click", day, hour) for u in range(20) for day in (19, 20) for hour in (1, 9) if day == 19 or u % 5 != 4])


@pytest.mark.parametrize("name", WHOLE)
def test_small_channels_and_the_large_one_are_whole(spark, two_days, name):
    rows = load_all()[name].fn(spark, two_days)
    small, large = WHOLE[name]
    assert {r["channel"]: r["count"] for r in rows.groupBy("channel").count().collect()} == {f"click-{c}": small for c in range(4)} | {"main": large}


STORED = ("point_read", "report_from_table", "report_from_table_at")


@pytest.mark.parametrize("name", STORED)
def test_a_stored_feed_has_few_files_however_many_channels(spark, monkeypatch, name):
    paths = []
    monkeypatch.setattr(Q, "scratch_path", lambda *a: paths.append(scratch_path(*a)) or paths[-1])
    d = tables(spark, [(u, f"type{k}", day, 9) for u in (0, 3) for k in range(60) for day in (19, 20)])
    rows = load_all()[name].fn(spark, d)
    assert {r["channel"] for r in rows.select("channel").distinct().collect()} >= {"main"}
    files = [f for p in paths for f in glob.glob(f"{p.removeprefix('file:')}/data/**/*.parquet", recursive=True)]
    assert 0 < len(files) <= 2 * 8  # two days, eight tasks at most
