"""Channels that fail alone, and comparisons with a bucketed table."""

import datetime as dt

from rankdelta.operators import changes as C
from rankdelta.operators import isolate as IS
from rankdelta.schema import SNAPSHOT_SCHEMA
from rankdelta.session import scratch_path
from rankdelta.sources import bucket_table as BT

T = dt.datetime
TEXT = "id string, rank string, brand string, product string, old_price string, price string, captured_at string, channel string, created_at string"


def text_row(i, channel, at, rank="1", product="p"):
    return (str(i), rank, "b", product, "1", "1", at, channel, at)


def test_one_bad_and_one_empty_channel(spark):
    raw = spark.createDataFrame([
        text_row(1, "good", "2024-01-01 09:00:00"), text_row(2, " good ", "2024-01-02 09:00:00", rank="x"), text_row(3, "good", None),
        text_row(4, "bad", "2024-01-01 09:00:00"), text_row("five", "bad", "yesterday"), text_row(6, "bad", "soon"), text_row(7, None, "2024-01-01")], TEXT)
    read = IS.read_rows(raw)
    expected = spark.createDataFrame([("good",), ("empty",), ("bad",)], "channel string")
    got = {r.channel: (r.n_rows, r.n_bad, r.error) for r in IS.channel_states(read, expected).collect()}
    assert got == {"good": (3, 0, None), "bad": (3, 2, "captured_at: soon"), "empty": (0, 0, "no rows"), "": (1, 0, None)}
    assert sorted(r.id for r in IS.good_rows(read).collect()) == [1, 2, 3, 7]
    rows = C.by_offset(IS.good_rows(read)).daily().collect()
    assert sorted((r.channel, r.id) for r in rows) == [("", 7), ("good", 1), ("good", 3)]


def test_a_missing_column_is_an_error_of_the_channel(spark):
    raw = spark.createDataFrame([("1", "x", "extra")], "id string, channel string, more string")
    read = IS.read_rows(raw)
    assert IS.channel_states(read).first().error == "rank: missing"
    assert "more" not in read.columns and IS.good_rows(read).count() == 0
    assert IS.channel_states(IS.read_rows(raw.limit(0))).count() == 0


def test_the_stored_side_of_a_comparison_is_not_exchanged(spark):
    path = scratch_path(spark, "buckets")
    name = "bucket_test"
    rows = [(k, k, "b", f"p{k % 40}", "1", "1", T(2024, 1, d), "c", T(2024, 1, d)) for d in (1, 2) for k in range(1, 60)] + [
        (99, 1, "b", "p", "1", "1", None, "c", None), (98, None, "b", "p", "1", "1", T(2024, 1, 1), "c", None)]
    df = spark.createDataFrame(rows, SNAPSHOT_SCHEMA)
    for _ in range(2):
        BT.define(spark, name, path, buckets=8)
    try:
        assert BT.definition(spark, name) == {"Num Buckets": "8", "Bucket Columns": "[`channel`, `captured_at`, `brand_key`, `product_key`]",
                                              "Sort Columns": "[`channel`, `captured_at`, `brand_key`, `product_key`]"}
        BT.store(spark, name, df)
        new = BT.against_stored(spark, name, df)
        plan = new._jdf.queryExecution().executedPlan().toString()
        # the only exchange is that of the new rows, which come from memory
        stored = plan[plan.rindex("\n", 0, plan.index("FileScan parquet")):]
        assert "Bucketed: true" in stored and plan.count("Exchange hashpartitioning") == 1 and "Exchange" not in stored
        want = sorted((r.id, r.captured_at, r.prev_rank_day, r.status_day) for r in C.by_offset(df).daily().collect() if r.captured_at)
        assert sorted((r.id, r.captured_at, r.prev_rank, r.status) for r in new.collect() if r.captured_at) == want
        BT.store(spark, name, df.limit(0))
        assert spark.table(name).count() == len(rows) - 1
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
