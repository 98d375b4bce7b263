"""Golden edge rows (FIXTURES.md section 3) through the column expressions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rankdelta.functions import price as P
from rankdelta.functions import status as ST
from rankdelta.functions import text as X
from rankdelta.operators import clean as K

NB = " "


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(expr(F.col("v")).alias("o")).collect()[0]["o"]


@pytest.mark.parametrize("raw, want", [
    (" (50ml)  Sun  Cream ", "Sun Cream"),
    ("(50 ml) Sun", "(50 ml) Sun"),
    ("(2EA) (50ML) Sun", "(50ML) Sun"),
    (f"A{NB}{NB}B", "A B"),
    (f"(50ML){NB}Sun", "Sun"),
    ("(3patches)　Mask", "Mask"),
    (None, ""),
])
def test_title_a(spark, raw, want):
    assert one(spark, X.clean_title, raw) == want


def test_title_b_keeps_prefix(spark):
    assert one(spark, X.clean_title_plain, "(50ML)  Sun") == "(50ML) Sun"


@pytest.mark.parametrize("raw, want", [(f"Sun Cream{NB}X", "SunCreamX"), (None, ""), ("\tA b\n", "Ab")])
def test_match_key(spark, raw, want):
    assert one(spark, X.match_key, raw) == want


@pytest.mark.parametrize("raw, brand, product", [
    ("Acme - Sun - Gel", "Acme", "Sun - Gel"),
    ("-Sun", "N/A", "Sun"),
    ("Sun", "N/A", "Sun"),
    ("Acme - (50ML) Gel", "Acme", "Gel"),
])
def test_split(spark, raw, brand, product):
    df = spark.createDataFrame([(raw,)], "v string")
    b, p = X.split_brand_product("v")
    row = df.select(b.alias("b"), p.alias("p")).collect()[0]
    assert (row["b"], row["p"]) == (brand, product)


@pytest.mark.parametrize("raw, want", [
    ("US$ 1,234.50", "$ 1,234.50"), ("2 for €9", "€9"), (f"€{NB}9", f"€{NB}9"),
    ("$  12", "$ 12"), ("12.5", "12.5"), ("free", "free"), ("", "N/A"), (None, "N/A"),
])
def test_price_with_symbol(spark, raw, want):
    assert one(spark, P.price_with_symbol, raw) == want


@pytest.mark.parametrize("raw, want", [("$ 32.40", "32.40"), ("N/A", "N/A"), ("Rs. 500", "."), (None, "N/A")])
def test_price_amount(spark, raw, want):
    assert one(spark, P.price_amount, raw) == want


@pytest.mark.parametrize("raw, want", [("USD 1,234.50", "1"), ("no digits", ""), ("9.99", "9.99")])
def test_price_first_number(spark, raw, want):
    assert one(spark, P.price_first_number, raw) == want


def test_price_pair_is_blank_unless_both_can_be_read(spark):
    df = spark.createDataFrame([("$5.50", "was 7"), ("5", "sold out"), (None, "7"), ("", "")], "a string, b string")
    got = [tuple(r) for r in df.select(*[c.alias(n) for n, c in P.price_pair("a", "b").items()]).collect()]
    assert got == [("5.50", "7", False), ("", "", True), ("", "", True), ("", "", True)]


def test_default_old_price(spark):
    rows = [(1, None, "9"), (2, "", "9"), (3, " ", "9"), (4, "N/A", "9"), (5, "12", "9")]
    df = spark.createDataFrame(rows, "id int, old_price string, price string")
    got = {r["id"]: r["old_price"] for r in K.default_old_price(df).collect()}
    assert got == {1: "9", 2: "9", 3: "9", 4: "9", 5: "12"}


def test_clean_rank(spark):
    rows = [(1, "1.7"), (2, " 3 "), (3, "1e2"), (4, "1,000"), (5, "1d"), (6, "x"), (7, None), (8, "inf")]
    df = spark.createDataFrame(rows, "id int, rank string")
    got = {r["id"]: r["rank"] for r in K.clean_rank(df).collect()}
    assert got == {1: 1, 2: 3, 3: 100}


@pytest.mark.parametrize("delta, want", [(None, "신규"), (3, "▲3"), (-4, "▼4"), (0, "-")])
def test_status(spark, delta, want):
    assert one(spark, ST.movement_status, delta, "int") == want


def test_trend(spark):
    assert one(spark, ST.trend_class, "▲3") == "up"
    assert one(spark, ST.trend_class, "▼1") == "down"
    assert one(spark, ST.trend_class, "-") == ""


def test_snapshot_label(spark):
    assert one(spark, ST.snapshot_label, dt.datetime(2024, 1, 2, 6, 0), "timestamp_ntz") == "2024-01-02 06:00:00"
    assert one(spark, ST.snapshot_label, dt.datetime(2024, 1, 2, 6, 0, 0, 120000), "timestamp_ntz") == \
        "2024-01-02 06:00:00.120000"
