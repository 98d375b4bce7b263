"""Listing pages, the snapshot table, report files and plan shapes."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from rankdelta.operators import baseline as B
from rankdelta.operators import changes as C
from rankdelta.operators import clean as K
from rankdelta.operators.ordinal import numbered
from rankdelta.plans import feeds
from rankdelta.schema import SNAPSHOT_SCHEMA
from rankdelta.session import scratch_path
from rankdelta.sources import listing as L
from rankdelta.sources import report_sink as RS
from rankdelta.sources import snapshots as SN

T = dt.datetime
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def pages(spark, *rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_every_card_of_a_page_is_read(spark):
    html = "".join(f'<li class="c" id="{i}"><a href="/p{i}">B{i} - P{i}</a></li>' for i in range(30)) + "<li>broken</li><li><a> </a></li><link>"
    p = pages(spark, (1, "https://shop.example/en/1", html), (2, "https://other.example/en/2", "<li><a>X - Y</a></li>"), (3, "no url", None))
    assert L.listing_items(p).count() == 33
    named = L.rank_nonblank(p).orderBy("listing", "rank").collect()
    assert [r.rank for r in named if r.listing == "shop.example/en"] == list(range(1, 32))
    marks = [r for r in L.with_sentinels(p).collect() if r.sentinel]
    assert [(r.rank, r.brand, r.product) for r in marks] == [(31, "N/A", "N/A")]
    assert "Join" not in plan(L.listing_items(p)) and "Join" not in plan(L.rank_listing(p))


def test_listing_limit_is_a_parameter(spark):
    p = pages(spark, (1, "https://a/en/", "<li><a>x</a></li>" * 7))
    assert L.rank_nonblank(p, limit=3).count() == 3


def snapshot(spark, rows):
    return spark.createDataFrame(rows, SNAPSHOT_SCHEMA)


def row(i, channel, at, rank=1, product="p", brand="b"):
    return (i, rank, brand, product, "1", "1", at, channel, at)


def test_purge_stays_within_a_channel(spark):
    path = scratch_path(spark, "t")
    SN.ensure_snapshot_table(spark, path)
    a, b = T(2024, 1, 1, 9), T(2024, 1, 2, 9)
    df = snapshot(spark, [row(1, "x", a), row(2, "y", a), row(3, "x", a, rank=4), row(4, "x", b), row(5, None, b), row(6, None, b)])
    df.withColumn("capture_date", F.to_date("captured_at")).write.mode("append").partitionBy(*SN.PARTITION_COLS).parquet(path)
    for _ in range(2):
        SN.purge_table(spark, path)
        assert sorted(r.id for r in SN.read_snapshots(spark, path).collect()) == [1, 2, 4, 5]


def test_append_can_be_disabled_and_ids_continue(spark):
    path = scratch_path(spark, "t")
    df = snapshot(spark, [row(9, "x", T(2024, 1, 1), rank=r) for r in (3, 1, 2)])
    assert SN.append_snapshot(spark, df, path, T(2024, 1, 5), enabled=False) is None
    assert SN.append_snapshot(spark, df, path, T(2024, 1, 5)) == 1
    assert SN.append_snapshot(spark, df, path, T(2024, 1, 6)) == 4
    got = sorted((r.id, r.rank, r.created_at) for r in SN.read_snapshots(spark, path).collect())
    assert [(i, r) for i, r, _ in got] == [(1, 1), (2, 2), (3, 3), (4, 1), (5, 2), (6, 3)]
    assert {c for _, _, c in got} == {T(2024, 1, 5), T(2024, 1, 6)}
    scan = SN.scan(SN.read_snapshots(spark, path), "x", T(2024, 1, 1), T(2024, 1, 2))
    assert "PartitionFilters: [isnotnull(channel" in plan(scan) and scan.count() == 6


def test_numbering_has_no_single_task(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    got = numbered(df, ["k", "id"])
    assert "SinglePartition" not in plan(got)
    rows = sorted((r.k, r.id, r.row_no) for r in got.collect())
    assert [r[2] for r in rows] == list(range(1, 1001))
    assert numbered(df.limit(0), ["k", "id"]).count() == 0


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_report_round_trip_keeps_every_value(spark, fmt):
    rows = [("c/1", T(2024, 1, 1, 1, 2, 3, 456789), 1, 1, "", 'say "hi",\nnow', None, "-", None, ""), ("c/1", T(2024, 1, 1, 1, 2, 3, 456789), 2, 2, None, "\\N?", "$1", "▲2", "-", "x")]
    cols = "channel string, captured_at timestamp_ntz, pos int, rank int, brand string, product string, price string, status_day string, status_week string, remark string"
    path = scratch_path(spark, "report")
    RS.write_report(spark.createDataFrame(rows, cols), path, fmt)
    got = sorted(tuple(r) for r in RS.read_report(spark, path, fmt).select("channel", "captured_at", "pos", *RS.HEADER_MAP.values()).collect())
    assert got == rows


def test_missing_columns_and_names(spark):
    """PRJ-7: match keys of absent columns are empty; PRJ-2: drifting names."""
    only = K.with_match_keys(spark.createDataFrame([(" A b ",)], "product string")).first()
    assert (only.brand_key, only.product_key != "") == ("", True)
    assert K.with_match_keys(spark.createDataFrame([("B",)], "brand string")).first().product_key == ""
    drift = spark.createDataFrame([(1, "a", "b")], "Ranking int, Old_Price string, DateTime string")
    assert K.canonicalise(drift).columns == ["rank", "old_price", "captured_at"]
    both = spark.createDataFrame([("a", "b")], "captured_at string, Datetime string")
    assert K.canonicalise(both).columns == ["captured_at", "Datetime"]


def test_asof_reaches_over_months(spark):
    rows = [row(1, "x", T(2023, 10, 5, 7)), row(2, "x", T(2024, 3, 1, 12)), row(3, "y", T(2024, 3, 1, 12)), row(4, "x", T(2024, 3, 2, 12))]
    cat = B.catalogue(snapshot(spark, rows))
    reqs = B.requests(B.latest_per_day(cat), (1, 7))
    got = {(r.channel, r.captured_at, r.offset_days): (r.base_created_at, r.how) for r in B.resolve(reqs, cat).collect()}
    assert got[("x", T(2024, 3, 1, 12), 7)] == (T(2023, 10, 5, 7), "asof")
    assert got[("x", T(2024, 3, 2, 12), 1)] == (T(2024, 3, 1, 12), "nearest")
    assert got[("y", T(2024, 3, 1, 12), 1)] == (None, None)


def test_duplicate_keys_multiply_unless_deduplicated(spark):
    a, b = T(2024, 1, 1, 8), T(2024, 1, 2, 8)
    df = snapshot(spark, [row(1, "x", a, 1), row(2, "x", a, 2), row(3, "x", b, 1), row(4, "x", b, 5)])
    assert sorted(r.prev_rank_day for r in C.by_offset(df).daily().collect() if r.captured_at == b) == [1, 1, 2, 2]
    assert [(r.rank, r.prev_rank_day) for r in C.by_offset(df, dedup=True).daily().collect() if r.captured_at == b] == [(1, 1)]


def test_run_time_differs_from_capture_time(spark):
    a, b = T(2024, 1, 1, 20), T(2024, 1, 2, 6)
    df = snapshot(spark, [row(1, "x", a, 3), row(2, "x", b, 1), row(3, "y", b, 1)])
    early = C.by_resolution(df, run_at=T(2024, 1, 2, 7))[0].weekly().collect()
    assert sorted((r.channel, r.delta_day, r.status_week) for r in early) == [("x", 2, "-"), ("y", None, "-")]
    assert C.by_resolution(df, run_at=T(2024, 1, 9))[0].weekly().count() == 0


def test_a_failing_channel_stops_no_other(spark):
    done = []

    def build(name):
        if name == "bad":
            raise RuntimeError("no page")
        return name

    failed = C.report_channels(["a", "bad", "b"], build, lambda name, out: done.append(out))
    assert done == ["a", "b"] and list(failed) == ["bad"] and "no page" in failed["bad"]


def test_queries_leave_nothing_cached(spark, sf_dir):
    C.by_resolution(feeds.feed_slot(spark, sf_dir))[0].weekly().count()
    assert "InMemoryTableScan" not in plan(feeds.feed_slot(spark, sf_dir))
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_results_do_not_depend_on_the_host_zone(sf_dir):
    code = ("import sys; sys.path[:0] = [%r, %r]\n"
            "from oracle_check import compare, duck\nfrom rankdelta.session import build_session\nfrom rankdelta.plans.registry import load_all\n"
            "s = build_session(cores=4, shuffle_partitions=4); con = duck(%r); q = load_all()\n"
            "for n in ('batch_ids', 'scan_day_range', 'snapshot_roundtrip', 'report_at', 'seoul_time'):\n"
            "    r = compare(s, con, %r, n, q[n].fn, q[n].oracle); assert r['ok'], r\nprint('fine')\n") % (ROOT, os.path.join(ROOT, "tools"), sf_dir, sf_dir)
    out = subprocess.run([sys.executable, "-c", code], env=os.environ | {"TZ": "Asia/Seoul"}, capture_output=True, text=True, timeout=600)
    assert out.stdout.strip().endswith("fine"), out.stdout[-500:] + out.stderr[-1500:]


def test_price_chain_and_collected_rows(spark):
    html = ('<li><a>(5ML) Aa - Bb</a><b data-price="$ 5.00"></b><span class="price">9</span></li><li><a>Cc - Dd</a><i class="price x">US$ 7</i><s class="old-price">€8</s></li>'
            "<li><a>only 3 left</a></li><li>unreadable</li>")
    p = pages(spark, (1, "https://a/en/", html))
    got = [(r.price_source, r.price) for r in L.priced_cards(p).orderBy("position").collect()]
    assert got == [("attr", "$ 5.00"), ("inner", "$ 7"), (None, "N/A"), (None, "N/A")]
    rows = L.collect_pages(p, SN.ntz(T(2024, 1, 1))).orderBy("rank").collect()
    assert [(r.rank, r.old_price, r.price) for r in rows][:2] == [(1, "$ 5.00", "$ 5.00"), (2, "€8", "$ 7")]
    assert {r.channel for r in rows} == {"a/en"} and rows[0].brand == "Aa"


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_report_files_do_not_grow_with_the_channels(spark, fmt):
    """900 channels share the folders of their groups, and one channel is read from its own."""
    rows = spark.range(1800).select(
        F.when(F.col("id") >= 2, F.concat(F.lit("c/é-"), (F.col("id") % 900).cast("string"))).alias("channel"), F.lit(T(2024, 1, 1)).cast("timestamp_ntz").alias("captured_at"),
        (F.col("id") / 900 + 1).cast("int").alias("pos"), F.lit(1).alias("rank"), *[F.lit("x").alias(c) for c in ("brand", "product", "price", "status_day", "status_week", "remark")])
    path = scratch_path(spark, "report")
    RS.write_report(rows, path, fmt)
    files = [n for _, _, names in os.walk(path.replace("file:", "")) for n in names if n.endswith(fmt)]
    assert 1 < len(files) <= RS.GROUPS + 1 + 8
    assert RS.read_report(spark, path, fmt).count() == 1800 and RS.read_report(spark, path, fmt).filter("channel is null").count() == 2
    assert [r.pos for r in RS.read_report(spark, path, fmt, "c/é-7").collect()] == [1, 2]
