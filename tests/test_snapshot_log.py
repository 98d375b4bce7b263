"""The append log, and reads, reports and purges that it makes cheap."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from rankdelta.operators import changes as C
from rankdelta.operators import stored
from rankdelta.schema import SNAPSHOT_SCHEMA
from rankdelta.session import scratch_path, staging
from rankdelta.sources import snapshot_log as LOG
from rankdelta.sources import snapshots as SN

T = dt.datetime


def local(path):
    return re.sub("^file:/*", "/", path)


def snapshot(spark, rows):
    return spark.createDataFrame(rows, SNAPSHOT_SCHEMA)


def row(i, channel, at, rank=1, product="p", brand="b", created=None):
    return (i, rank, brand, product, "1", "1", at, channel, created or at)


@pytest.fixture
def path(spark):
    return scratch_path(spark, "log")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_named_batch_is_stored_once(spark, path):
    df = snapshot(spark, [row(0, "x", T(2024, 1, 1), rank=r) for r in (3, 1, 2)])
    first = LOG.append_batch(spark, df, path, "a", T(2024, 1, 5))
    assert (first.first_id, first.last_id, first.rows) == (1, 3, 3)
    assert LOG.append_batch(spark, df, path, "a", T(2024, 1, 6)) == first
    assert LOG.append_batch(spark, df, path, "b", T(2024, 1, 6)).first_id == 4
    assert LOG.append_batch(spark, df, path, "c", enabled=False) is None
    assert LOG.append_batch(spark, df.limit(0), path, "d") is None
    assert ids(LOG.read_table(spark, path)) == [1, 2, 3, 4, 5, 6]
    assert [(r.rank, r.created_at) for r in LOG.read_table(spark, path, ["a"]).orderBy("id").collect()] == [(k, T(2024, 1, 5)) for k in (1, 2, 3)]
    assert sum(r.n_rows for r in LOG.read_catalogue(spark, path).collect()) == 6


def test_a_lost_attempt_leaves_nothing(spark, path, monkeypatch):
    df = snapshot(spark, [row(0, "x", T(2024, 1, 1)), row(0, None, None)])
    LOG.append_batch(spark, df, path, "a")

    def lost(*_):
        raise OSError("gone")
    with monkeypatch.context() as m:
        m.setattr(LOG, "_commit", lost)
        with pytest.raises(OSError):
            LOG.append_batch(spark, df, path, "b")
    assert ids(LOG.read_table(spark, path)) == [1, 2]
    assert LOG.append_batch(spark, df, path, "b").first_id == 3
    assert ids(LOG.read_table(spark, path)) == [1, 2, 3, 4]
    assert len(LOG.vacuum(spark, path)) == 1 and LOG.vacuum(spark, path) == []
    assert ids(LOG.read_table(spark, path)) == [1, 2, 3, 4]


def test_of_two_writers_the_later_takes_new_ids(spark, path, monkeypatch):
    df = snapshot(spark, [row(0, "x", T(2024, 1, 1)), row(0, "x", T(2024, 1, 1), rank=2)])
    LOG.create_table(spark, path)
    commit, raced = LOG._commit, []

    def race(spark, path, entry):
        if not raced:
            raced.append(1)
            assert LOG.append_batch(spark, df, path, "quick").first_id == 1
        return commit(spark, path, entry)
    monkeypatch.setattr(LOG, "_commit", race)
    assert LOG.append_batch(spark, df, path, "slow").first_id == 3
    assert ids(LOG.read_table(spark, path)) == [1, 2, 3, 4] and LOG.vacuum(spark, path) == []


def test_ids_come_from_the_log_alone(spark, path):
    LOG.append_batch(spark, snapshot(spark, [row(0, "x", T(2024, 1, 1))]), path, "a")
    for top, _, names in os.walk(local(f"{path}/data")):
        for n in names:
            with open(os.path.join(top, n), "w"):  # data files that cannot be read
                pass
    assert LOG.next_id(spark, path) == 2 and LOG.read_catalogue(spark, path).count() == 1
    with open(local(f"{path}/log/{9:010d}.json"), "w"):  # a writer died while it wrote its entry
        pass
    assert LOG.append_batch(spark, snapshot(spark, [row(0, "x", T(2024, 1, 2))]), path, "b").version == 10


def test_purge_of_a_batch_equals_the_whole_purge(spark, path):
    day = [T(2024, 1, d, 9) for d in (1, 2, 3)]
    batches = {"a": [row(0, "x", day[0]), row(0, "y", day[0]), row(0, "x", day[0], rank=4), row(0, None, day[1])],
               "b": [row(0, "x", day[0]), row(0, "x", day[1]), row(0, None, day[1]), row(0, "x", None), row(0, "x", None)],
               "c": [row(0, "x", day[2]), row(0, "y", day[2]), row(0, "y", day[0]), row(0, "x", None)]}
    for name, rows in batches.items():
        LOG.append_batch(spark, snapshot(spark, rows), path, name)
    whole = ids(SN.purge_duplicates(LOG.read_table(spark, path)))
    first = LOG.purge_table(spark, path)
    assert [e.name for e in first] == ["a", "b", "c"]
    assert ids(LOG.read_table(spark, path)) == whole
    assert LOG.purge_table(spark, path) == []
    kept = {e.name: e.folder for e in LOG.committed(LOG.entries(spark, path)).values()}
    LOG.append_batch(spark, snapshot(spark, batches["b"]), path, "d")
    assert [e.rows for e in LOG.purge_table(spark, path)] == [0]
    assert ids(LOG.read_table(spark, path)) == whole
    assert {n: e.folder for n, e in LOG.committed(LOG.entries(spark, path)).items() if n in kept} == kept
    assert LOG.next_id(spark, path) == 19


def scan_metric(spark, df, name):
    """Sum of a metric over the file scans of a plan that has run."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    return sum(x.metrics().apply(name).value() for x in found if x.nodeName().startswith("Scan parquet"))


@pytest.fixture
def history(spark, path):
    rows = [row(0, c, T(2024, 1, d, 9), rank=k, product=f"{c}{k}") for d in range(1, 29) for c in ("x", "y") for k in range(1, 6)]
    LOG.append_batch(spark, snapshot(spark, rows), path, "history", keep_stamps=True)
    return path


def test_reports_open_only_the_folders_they_use(spark, history):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = stored.report_from_table(spark, history, T(2024, 1, 20, 10)).weekly()
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in re.search(r"PartitionFilters: \[.*", plan)[0]
        got = rows.collect()
        # two channels, three days, one file each; and the picks
        assert scan_metric(spark, rows, "numFiles") <= 6 + 4
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted((r.channel, r.rank, r.prev_rank_day, r.status_week) for r in got) == [(c, k, k, "-") for c in "xy" for k in range(1, 6)]
    whole = C.by_resolution(LOG.read_table(spark, history).drop("batch", "capture_date"), run_at=T(2024, 1, 20, 10))[0].weekly()
    assert sorted(map(str, whole.select(*rows.columns).collect())) == sorted(map(str, got))


def test_point_read_skips_row_groups(spark, path):
    rows = spark.range(200_000).select(
        "id", (F.col("id") % 1000 + 1).cast("int").alias("rank"), F.lit("b").alias("brand"), F.sha2(F.col("id").cast("string"), 256).alias("product"),
        F.lit("1").alias("old_price"), F.lit("1").alias("price"), F.lit(T(2024, 1, 1)).cast("timestamp_ntz").alias("captured_at"), F.lit("x").alias("channel"),
        (F.lit(T(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(mins=(F.col("id") / 1000).cast("int"))).alias("created_at"))
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", str(1 << 18))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        LOG.append_batch(spark, rows, path, "a", keep_stamps=True)
        got = LOG.snapshot_at(spark, path, "x", T(2024, 1, 1, 1, 40), ["rank", "product"], limit=3)
        assert [(r.rank, len(r.product)) for r in got.collect()] == [(1, 64), (2, 64), (3, 64)]
        assert 1000 <= scan_metric(spark, got, "numOutputRows") < 40_000  # of 200,000
        assert LOG.snapshot_at(spark, path, "x", T(2025, 1, 1)).count() == 0
    finally:
        hadoop.unset("parquet.block.size")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_staged_tables_can_be_released(spark, history):
    folder = os.path.dirname(local(scratch_path(spark, "probe")))
    before = set(os.listdir(folder))
    with staging():
        stored.report_from_table(spark, history).weekly().count()
        assert any("stored-picks" in n for n in set(os.listdir(folder)) - before)
    assert set(os.listdir(folder)) == before
    assert LOG.read_table(spark, history).count() == 280


def test_files_do_not_grow_with_the_channels(spark, path):
    """Days are folders; 600 channels of a day share its files, and '' stays apart from NULL."""
    rows = spark.range(2400).select(
        "id", F.lit(1).alias("rank"), F.lit("b").alias("brand"), F.lit("p").alias("product"), F.lit("1").alias("old_price"), F.lit("1").alias("price"),
        (F.lit(T(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("id") % 4).cast("int"))).alias("captured_at"),
        F.when(F.col("id") == 8, "").when(F.col("id") != 9, F.concat(F.lit("c/"), (F.col("id") / 4).cast("int").cast("string"))).alias("channel"))
    LOG.append_batch(spark, rows.withColumn("created_at", F.col("captured_at")), path, "a", keep_stamps=True)
    files = [n for _, _, names in os.walk(local(f"{path}/data")) for n in names if n.endswith(".parquet")]
    assert len(files) <= 4 + 8  # a file per day, and one more per task
    back = LOG.read_table(spark, path)
    assert back.filter("channel = ''").count() == 1 and back.filter("channel is null").count() == 1
    assert back.select("channel").distinct().count() == 602 and back.count() == 2400
    assert [r.captured_at for r in LOG.snapshot_at(spark, path, "c/7", T(2024, 1, 3)).collect()] == [T(2024, 1, 3)]
