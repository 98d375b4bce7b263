"""Stored listing pages -> ordered cards -> ranked rows (SRC-1..4, PRJ-8, W1, FLT-4).

A *listing* is the host and language segment of a page URL
(``blog.example.com/en``); its pages are ordered by the ``page=`` parameter,
then page id, and cards by position.  Every card that a page holds is read.
Ranks are running numbers across pages, capped at ``limit``; the cap is a
``row_number() <= n`` filter that Spark plans as a WindowGroupLimit, so each
map task forwards at most ``n`` cards per listing to the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankdelta.functions import html as H
from rankdelta.functions.price import price_with_symbol
from rankdelta.functions.text import clean_title, clean_title_plain, first_non_blank, split_brand_product
from rankdelta.operators.clean import collector_clean
from rankdelta.schema import CRAWL_LIMIT, DIGIT

CARD, LISTS = "li", ("ul", "ol")
PRICE_ATTRIBUTE, PRICE_CLASS, OLD_PRICE_CLASS = "data-price", "price", "old-price"


def _sequenced(pages: DataFrame, *more: str) -> DataFrame:
    url = F.col("url")
    page_param = F.nullif(F.regexp_extract(url, rf"[?&]page=({DIGIT}+)", 1), F.lit("")).try_cast("int")
    return pages.select(
        "page_id", "url",
        F.substring_index(F.substring_index(url, "?", 1), "#", 1).alias("base_url"),
        F.regexp_extract(url, r"^[A-Za-z]+://([^/]+/[a-z]{2})/", 1).alias("listing"),
        page_param.alias("page_param"),
        F.coalesce(page_param, F.lit(1)).alias("page_no"),
        *more,
    )


def page_sequence(pages: DataFrame) -> DataFrame:
    """SRC-4: base URL, listing key and page number of each stored page."""
    return _sequenced(pages)


def _cards(pages: DataFrame) -> DataFrame:
    """Every card of every page as its tokens, from one scan of the pages."""
    items = F.when(F.lower("html").contains(f"<{CARD}"), F.expr(H.outermost("html", CARD, LISTS)))
    found = _sequenced(pages, "html").select("page_id", "listing", "page_no", F.posexplode(items).alias("pos", "item"))
    return found.select("page_id", "listing", "page_no", (F.col("pos") + 1).cast("int").alias("position"),
                        F.expr(H.tokens("item")).alias("toks"))


def _with_fields(cards: DataFrame, attributes: dict[str, str], nodes: dict[str, Callable[[str], str]]) -> DataFrame:
    """Adds the first non-empty value of each attribute and the text of the first tag for which each test holds."""
    keep = [c for c in cards.columns if c != "toks"]
    found = cards.select("toks", *keep, *[F.expr(H.first_attribute("toks", a)).alias(n) for n, a in attributes.items()],
                         *[F.expr(H.position("toks", test)).alias(f"_{n}") for n, test in nodes.items()])
    return found.select(*keep, *attributes, *[F.expr(H.content("toks", f"_{n}")).alias(n) for n in nodes],
                        *[(F.col(f"_{n}") > 0).alias(f"has_{n}") for n in nodes])


def _is(name: str) -> Callable[[str], str]:
    return lambda token: rf"{token} RLIKE r'(?i)^<{name}[\s/>]'"


LINK = {"raw_title": _is("a")}


def listing_items(pages: DataFrame) -> DataFrame:
    """SRC-1: every card of every page with its 1-based position.

    Cards are the outermost list items: nested lists belong to their card, and a
    card without end tag ends where the next one or the list's end begins.
    """
    cards = _with_fields(_cards(pages), {"href": "href", "title_attr": "title"}, {"inner_text": _is("b")} | LINK)
    return cards.select("page_id", "listing", "page_no", "position", "href", "title_attr", "inner_text", "raw_title")


def with_fallback_name(items: DataFrame) -> DataFrame:
    """SRC-2: name from the title attribute, else an inner node, else the link
    text, else the href's last path segment; records which one answered."""
    href_name = F.regexp_extract("href", r"([^/?#]*)$", 1)
    sources = [("attr", F.col("title_attr")), ("inner", F.col("inner_text")),
               ("text", F.col("raw_title")), ("href", href_name)]
    name = first_non_blank(*[c for _, c in sources])
    source = F.coalesce(*[F.when(F.coalesce(c, F.lit("")) != "", F.lit(n)) for n, c in sources])
    return items.withColumns({"name": name, "name_source": source})


def priced_cards(pages: DataFrame) -> DataFrame:
    """Every card with its price text: the attribute, else the inner price node, else
    the text of the price element, else "N/A"; never the title.  ``price`` is what
    the symbol reader makes of it and ``price_source`` tells which one answered."""
    cards = _with_fields(_cards(pages), {"price_attr": PRICE_ATTRIBUTE}, {
        "price_node": lambda t: H.has_class(t, PRICE_CLASS), "old_node": lambda t: H.has_class(t, OLD_PRICE_CLASS),
        "price_own": lambda t: f"{t} ILIKE '<%{PRICE_ATTRIBUTE}%' AND {H.has_attribute(t, PRICE_ATTRIBUTE)}"} | LINK)
    cards = cards.select("page_id", "listing", "page_no", "position", "price_attr", "price_node", "price_own", "old_node", "raw_title")
    sources = [("attr", "price_attr"), ("inner", "price_node"), ("text", "price_own")]
    text = first_non_blank(*[F.col(c) for _, c in sources])
    source = F.coalesce(*[F.when(F.col(c) != "", F.lit(n)) for n, c in sources])
    return (cards.withColumns({"price_text": text, "price_source": source})
            .withColumn("price", price_with_symbol("price_text")))


def collect_pages(pages: DataFrame, captured_at: Column, limit: int = CRAWL_LIMIT) -> DataFrame:
    """Stored pages to snapshot rows: cards ranked per listing, titles split, prices
    read, old price defaulted to the price, one capture time; ready to be appended.

    The channel is the listing; ids are given by the append.
    """
    ranked = rank_cards(priced_cards(pages), limit)
    brand, product = split_brand_product("raw_title", clean_title)
    old = price_with_symbol("old_node")
    rows = ranked.select(F.lit(None).cast("long").alias("id"), "rank", brand.alias("brand"), product.alias("product"),
                         old.alias("old_price"), "price", captured_at.alias("captured_at"), F.col("listing").alias("channel"),
                         F.lit(None).cast("timestamp_ntz").alias("created_at"))
    return collector_clean(rows)


def rank_cards(items: DataFrame, limit: int = CRAWL_LIMIT, group: str = "listing",
               order: tuple[str, ...] = ("page_no", "page_id", "position")) -> DataFrame:
    """Running rank across the ordered pages of a listing, <= limit."""
    w = Window.partitionBy(group).orderBy(*order)
    return items.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= limit)


def rank_listing(pages: DataFrame, limit: int = CRAWL_LIMIT) -> DataFrame:
    """Ranked cards with titles cleaned and split into brand and product."""
    ranked = rank_cards(_with_fields(_cards(pages), {}, LINK), limit)
    brand, product = split_brand_product("raw_title", clean_title)
    return ranked.select("listing", "rank", "page_id", "position", "raw_title",
                         brand.alias("brand"), product.alias("product"))


def named_cards(pages: DataFrame) -> DataFrame:
    """Cards with their link text; ``found`` is false where a card has no link to read."""
    cards = _with_fields(_cards(pages), {}, {"name": _is("a")})
    return cards.select("page_id", "listing", "page_no", "position", F.col("has_name").alias("found"), "name")


def rank_nonblank(pages: DataFrame, limit: int = CRAWL_LIMIT) -> DataFrame:
    """FLT-4: blank names are skipped *before* ranks are given."""
    return rank_cards(named_cards(pages).filter(F.col("name") != ""), limit) \
        .select("listing", "rank", "page_id", "position", "name")


def with_sentinels(pages: DataFrame, marker: str = "N/A", limit: int = CRAWL_LIMIT) -> DataFrame:
    """PRJ-8: a card that cannot be read still takes a rank, as a marker row."""
    cards = rank_cards(named_cards(pages), limit)
    brand, product = split_brand_product(F.col("name"), clean_title_plain)
    failed = ~F.col("found")
    return cards.select(
        "listing", "rank", "page_id", "position",
        F.when(failed, F.lit(marker)).otherwise(brand).alias("brand"),
        F.when(failed, F.lit(marker)).otherwise(product).alias("product"),
        failed.alias("sentinel"),
    )


def item_ids(pages: DataFrame, limit: int = CRAWL_LIMIT) -> DataFrame:
    """SRC-3: numeric id from an attribute; items without one are skipped;
    the first ``limit`` per listing in page order are kept."""
    seq = page_sequence(pages).withColumn("item_id", F.regexp_extract("url", f"{DIGIT}+", 0))
    kept = seq.filter(F.col("item_id") != "")
    w = Window.partitionBy("listing").orderBy("page_no", "page_id")
    return (kept.withColumn("seq", F.row_number().over(w).cast("int")).filter(F.col("seq") <= limit)
            .select("listing", "seq", "page_id", "item_id"))
