"""Snapshot-shaped feeds derived from the driver tables (FIXTURES.md section 4).

Every feed is a plain DataFrame plan over the given parquet tables, so its
work grows with them.  The DuckDB twins live in ``plans/sqlfrag.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankdelta.functions.status import day_start, plus_hours
from rankdelta.session import table  # noqa: F401  (re-exported for queries)


# ``feed_slot``: most users share one channel, whose snapshots grow with the data; a tenth
# of them is spread over small channels, where whole days go by without a snapshot.
SPARSE_SHARE, USERS_PER_CHANNEL = 10, 5
MAIN_CHANNEL = "main"


def _dec_text(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


def _few_users(users: int) -> Column:
    return F.concat("event_type", F.lit("-"), F.floor(F.col("user_id") / users).cast("string"))


def _ranked_events(spark: SparkSession, sf_dir: str, capture: Column, *,
                   created_from_slot: bool = False, channel: Column | None = None,
                   unique_names: bool = True) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    channel = F.col("event_type") if channel is None else channel
    grouped = ev.groupBy(
        channel.alias("channel"), capture.alias("captured_at"), "user_id"
    ).agg(
        F.min("event_id").alias("id"),
        F.sum(F.col("value").cast("decimal(18,2)")).alias("score"),
        F.max("ts").alias("last_ts"),
    )
    snap = Window.partitionBy("channel", "captured_at")
    ranked = grouped.withColumn(
        "rank",
        F.row_number().over(snap.orderBy(F.desc_nulls_last("score"), F.asc_nulls_first("user_id"))).cast("int"),
    )
    if created_from_slot:
        ranked = ranked.withColumn("created_at", F.max("last_ts").over(snap))
    else:
        ranked = ranked.withColumn("created_at", F.col("captured_at"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    joined = ranked.join(part, ranked["user_id"] == part["p_partkey"], "left")
    product = (F.concat(F.col("p_name"), F.lit(" #"), F.col("p_partkey").cast("string"))
               if unique_names else F.col("p_name"))
    return joined.select(
        F.col("id"),
        F.col("rank"),
        F.col("p_brand").alias("brand"),
        product.alias("product"),
        _dec_text("p_retailprice").alias("old_price"),
        F.col("score").cast("string").alias("price"),
        F.col("captured_at"),
        F.col("channel"),
        F.col("created_at"),
    )


def feed_day(spark: SparkSession, sf_dir: str, unique_names: bool = True) -> DataFrame:
    """One snapshot per (event_type, day): users ranked by summed value."""
    return _ranked_events(spark, sf_dir, day_start("ts"), unique_names=unique_names)


def _slot() -> Column:
    return plus_hours(day_start("ts"), F.floor(F.hour("ts") / 6) * 6)


def feed_slot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four 6-hour snapshots a day, created_at = last event of the slot: one large
    channel, and small ones of a few users each.  Many slots and days of a small
    channel hold no event, so baselines must fall back."""
    few = _few_users(SPARSE_SHARE * USERS_PER_CHANNEL)
    channel = F.when(F.col("user_id") % SPARSE_SHARE == 0, few).otherwise(F.lit(MAIN_CHANNEL))
    return _ranked_events(spark, sf_dir, _slot(), created_from_slot=True, channel=channel)


def feed_small(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same slots with every user in a small channel, beside the large channel: snapshots,
    days and reports grow in number with the data, and those of the large one in size."""
    small = _ranked_events(spark, sf_dir, _slot(), created_from_slot=True, channel=_few_users(USERS_PER_CHANNEL))
    return small.unionByName(feed_slot(spark, sf_dir).filter(F.col("channel") == MAIN_CHANNEL))


def feed_half(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two 12-hour snapshots a day, compared with the same half a day earlier."""
    capture = plus_hours(day_start("ts"), F.floor(F.hour("ts") / 12) * 12)
    return _ranked_events(spark, sf_dir, capture)


def feed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``feed_day`` as it may be collected: text columns, and a channel ("error") with unreadable capture times."""
    f = feed_day(spark, sf_dir)
    at = F.date_format("captured_at", "yyyy-MM-dd HH:mm:ss")
    broken = (F.col("channel") == "error") & (F.col("id") % 50 == 0)
    return f.withColumns({"captured_at": F.when(broken, F.concat(F.lit("at "), at)).otherwise(at),
                          "rank": F.col("rank").cast("string"), "id": F.col("id").cast("string")})


def watch_brands_even() -> tuple[str, ...]:
    """Watch-list for ``feed_half``: brands with an even number, lower-cased.

    A parameter built from a rule (Brand#2, Brand#4, ...), not from the data.
    """
    return tuple(f"brand#{n}" for n in range(2, 101, 2))


def feed_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event with text ranks, blank/N/A old prices and NULL brands."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    eid = F.col("event_id")
    rank_text = (F.when(eid % 7 == 0, F.lit("1.7"))
                 .when(eid % 7 == 1, F.lit(" 3 "))
                 .when(eid % 7 == 2, F.lit("1e2"))
                 .when(eid % 7 == 3, F.lit("1,000"))
                 .when(eid % 7 == 4, F.lit("x"))
                 .when(eid % 7 == 5, F.col("user_id").cast("string")))
    price = _dec_text("value")
    old_price = (F.when(eid % 5 == 1, F.lit(""))
                 .when(eid % 5 == 2, F.lit("N/A"))
                 .when(eid % 5 == 3, F.lit(" "))
                 .when(eid % 5 == 4, price))
    brand = F.when(eid % 4 != 0, F.concat(F.lit(" Brand\u00a0 "), (F.col("user_id") % 10).cast("string"), F.lit(" ")))
    product = F.when(eid % 9 != 0, F.concat(
        F.lit("("), (F.col("user_id") % 7 + 1).cast("string"), F.lit("ML)  "),
        F.col("event_type"), F.lit("\u00a0item "), F.col("user_id").cast("string")))
    channel = F.when(eid % 13 != 0, F.concat(F.lit(" "), F.col("event_type")))
    return ev.select(
        eid.alias("id"),
        rank_text.alias("rank"),
        brand.alias("brand"),
        product.alias("product"),
        old_price.alias("old_price"),
        price.alias("price"),
        F.col("ts").alias("captured_at"),
        channel.alias("channel"),
        F.col("ts").alias("created_at"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listing titles from ``part``: "(<size>ML) <brand>  - <NBSP><name>"."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    title = F.concat(F.lit("("), F.col("p_size").cast("string"), F.lit("ML) "), F.col("p_brand"),
                     F.lit("  - \u00a0"), F.col("p_name"))
    return p.select(
        F.col("p_partkey").alias("item_id"),
        (F.col("p_partkey") + 1).cast("int").alias("rank"),
        title.alias("raw_title"),
        F.concat(F.lit("US$ "), _dec_text("p_retailprice")).alias("raw_price"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw price texts in six shapes keyed by ``p_partkey % 6``."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", "p_retailprice")
    k = F.col("p_partkey") % 6
    size = F.col("p_size").cast("string")
    text = (F.when(k == 0, F.concat(F.lit("US$ "), _dec_text("p_retailprice")))
            .when(k == 1, F.concat(F.lit("2 for €"), size))
            .when(k == 2, F.concat(F.lit("$  "), size))
            .when(k == 3, _dec_text("p_retailprice"))
            .when(k == 4, F.lit("free"))
            .otherwise(F.lit("")))
    return p.select(F.col("p_partkey").alias("item_id"), text.alias("price_text"))


def feed_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly charts: channel = part type, item = part brand, measure = revenue."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                 "l_extendedprice", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    month = F.trunc(F.col("l_shipdate").cast("date"), "month").cast("timestamp_ntz")
    g = (li.join(part, li["l_partkey"] == part["p_partkey"])
         .groupBy(F.col("p_type").alias("channel"), month.alias("captured_at"), F.col("p_brand").alias("item"))
         .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("score"),
              F.min(F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id")))
    ranked = g.withColumn("rank", F.row_number().over(
        Window.partitionBy("channel", "captured_at").orderBy(F.desc_nulls_last("score"), F.asc_nulls_first("item"))
    ).cast("int"))
    return ranked.select(
        F.col("id"), F.col("rank"), F.col("item").alias("brand"), F.col("item").alias("product"),
        F.lit("").alias("old_price"), F.col("score").cast("string").alias("price"),
        F.col("captured_at"), F.col("channel"), F.col("captured_at").alias("created_at"),
    )


def purge_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows with natural duplicates on the purge key, many of them alike in several channels."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return ev.select(
        F.col("event_id").alias("id"),
        (F.col("event_id") % 100 + 1).cast("int").alias("rank"),
        F.concat(F.lit("Brand"), (F.col("user_id") % 10).cast("string")).alias("brand"),
        F.col("user_id").cast("string").alias("product"),
        F.floor(F.hour("ts") / 6).cast("string").alias("old_price"),
        F.floor(F.col("value") / 50).cast("string").alias("price"),
        day_start("ts").alias("captured_at"),
        F.col("event_type").alias("channel"),
        F.col("ts").alias("created_at"),
    )



# Markup of a listing card, by part key modulo their number.  Names are escaped
# ({title}, {brand}, {name}), {price} and {key} are plain.  The expected fields of
# each are spelled out on the oracle side, not read from the markup.
CARD_MARKUP = (
    """<li><a href="/p/{key}">{title}</a><b data-price="$ {price}"></b></li>""",
    """<LI CLASS="card"><A HREF='/p/{key}'>{title}</A><SPAN CLASS="big price">US$ {price}</SPAN></LI>""",
    """<li><ul><li>new</li><li><b>sale</b></li></ul><a href=/p/{key}>{title}</a><i class='price'>€{price}</i></li>""",
    """<li data-x="a > b <li>"><a title="{title} > x" href="/p/{key}">{title}</a><b data-price='{price}'>n/a</b></li>""",
    """<li><a href="/p/{key}">{title}</a><span class="price">{price}</span>""",
    """<li><a href="/p/{key}"></a><span class="price"></span><b data-price="">only {price}</b></li>""",
    """<li><em>sold out</em></li>""",
    """<li><a href="/p/{key}"><em>{brand}</em> - <u>{name}</u></a><p class="price"><span>$</span><span>{price}</span></p></li>""",
    """<li><!-- <li><a>ghost</a></li> --><a href="/p/{key}">{brand} - it&#39;s {name}</a><span class="x price">&euro;{price} &#x20AC;</span></li>""",
    """<li><a href="/p/{key}">{title}</a><span class="pricey">{price}</span></li>""",
    """<li><b title="" data-price={price}></b><a href=/p/{key}?a=1&amp;b=2>{title}</a><s class="old-price">9{price}</s></li>""",
    """<li><a href="/p/{key}">(50ML) {title} only 3 left</a><ol><li>1</li></ol></li>""",
)
CARDS_PER_PAGE = 20


def card_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages made of parts, twenty cards each, in every markup that a card reader meets."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")
    title = F.concat("p_brand", F.lit(" - "), "p_name", F.lit(" &amp; "), F.col("p_partkey").cast("string"))
    card = None
    for k, markup in enumerate(CARD_MARKUP):
        this = F.lit(markup)
        for name, value in (("{title}", title), ("{brand}", F.col("p_brand")), ("{name}", F.col("p_name")),
                            ("{price}", _dec_text("p_retailprice")), ("{key}", F.col("p_partkey").cast("string"))):
            this = F.replace(this, F.lit(name), value)
        when = F.col("p_partkey") % len(CARD_MARKUP) == k
        card = F.when(when, this) if card is None else card.when(when, this)
    page = F.floor(F.col("p_partkey") / CARDS_PER_PAGE)
    per = p.select(page.alias("page_id"), "p_partkey", card.alias("card")).groupBy("page_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "card"))), lambda c: c["card"]), "\n").alias("cards"))
    url = F.concat(F.lit("https://shop"), (F.col("page_id") % 3).cast("string"), F.lit(".example.com/en/list?page="), F.col("page_id").cast("string"))
    html = F.concat(F.lit("<!DOCTYPE html><html><script>var t='<li>';</script><body><nav><ul></ul></nav><ul class=list>"), "cards", F.lit("</ul><p>end</p></body></html>"))
    return per.select("page_id", url.alias("url"), html.alias("html"))
