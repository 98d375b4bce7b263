"""Benchmark decontamination: which words of a document belong to a benchmark passage.

A window is ``SPAN`` consecutive words of an item (a shorter item is one
window).  An exact occurrence needs every word of the window, so one necessary
word is enough to find candidates: the rarest in the documents, whose counts
come from one pass over all of them.  Windows of an item that share the same
rarest position ``q`` are one prefix row: its word, and the words around it
that those windows can reach.  A document position with that word is joined
once per prefix row; the neighbouring words and the distances to both ends of
item and document (positional and length bounds) rule out most candidates, and
the rest are verified exactly, window by window.

Only DataFrame functions are used.  Documents are not shuffled: the prefix
table is broadcast when its counted size is small, and beyond that candidate
positions are found by a shuffled join and brought back to their documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankdelta.llm.common import ascii_lower, fitting, row_key, written

SPAN = 10
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BROADCAST_ROWS = 400_000  # prefix rows of at most 19 words: under 100 MB


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD, -1), "")


def _small(table: DataFrame, rows: int) -> DataFrame:
    """``table`` for a join: broadcast only if its counted rows are within the bound."""
    return F.broadcast(table) if rows <= BROADCAST_ROWS else table


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("th"),
                       words(F.col("text")).alias("words"))


def prefixes(benchmark: DataFrame, docs: DataFrame, span: int = SPAN) -> DataFrame:
    """(token, item, q, around, at, len): the rarest position of each window, with its reach.

    ``around[at]`` is the token (0-based); windows of ``len`` words that hold
    it lie inside ``around``.
    """
    items = (benchmark.filter("item_id is not null and text is not null")
             .select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("iw")).distinct()
             .filter(F.size("iw") > 0).withColumn("len", F.least(F.lit(span), F.size("iw"))))
    items = written(items.withColumn("ikey", F.xxhash64("item", "iw")), "dc-items")
    vocabulary = items.select(F.explode("iw").alias("token")).distinct()
    vocabulary = written(vocabulary, "dc-words")
    # the outer form adds no filter that would split each text a second time
    found = keyed(docs).select(F.explode_outer("words").alias("token"))
    counts = found.join(_small(vocabulary, vocabulary.count()), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    counts = vocabulary.join(counts, "token", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    # a window's words with their positions in the item; the rarest one is its prefix
    starts = items.select("ikey", "item", "iw", "len", F.explode(F.sequence(F.lit(0), F.size("iw") - F.col("len"))).alias("o"))
    spots = starts.select("ikey", "o", F.posexplode(F.slice("iw", F.col("o") + 1, F.col("len"))).alias("i", "token"))
    rare = (spots.join(counts, "token").groupBy("ikey", "o")
            .agg(F.min(F.struct("n", "token", (F.col("o") + F.col("i")).alias("q"))).alias("best"))
            .select("ikey", F.col("best.token").alias("token"), F.col("best.q").alias("q")).distinct())
    low = F.greatest(F.lit(0), F.col("q") - F.col("len") + 1)
    return (rare.join(items, "ikey")
            .select("token", "item", "q", (F.col("q") - low).alias("at"), "len",
                    F.slice("iw", low + 1, F.col("len") + F.col("q") - low).alias("around")))


def _near(ws: Column, p: Column, around: Column, at: Column, length: Column) -> Column:
    """A word beside the position agrees too (or the window is that word alone)."""
    left = (at > 0) & (p > 0) & (F.get(ws, p - 1) == F.get(around, at - 1))
    right = F.get(ws, p + 1) == F.get(around, at + 1)
    return (length == 1) | F.coalesce(left, F.lit(False)) | F.coalesce(right, F.lit(False))


def _runs(rows: DataFrame) -> DataFrame:
    """(doc_id, th, item, hits): starts in the document of the windows that occur around a candidate."""
    # offsets j of windows in ``around`` that hold the token and lie inside the document
    first = F.greatest(F.lit(0), F.col("at") - F.col("len") + 1, F.col("at") - F.col("p"))
    last = F.least(F.col("at"), F.size("around") - F.col("len"), F.size("words") - F.col("p") + F.col("at") - F.col("len"))
    rows = rows.withColumn("first", first).withColumn("last", last).filter("first <= last")

    def occurs(j):
        return F.slice("around", j + 1, F.col("len")) == F.slice("words", F.col("p") - F.col("at") + j + 1, F.col("len"))
    # a generated column keeps this costly test out of the join's condition, behind the cheap ones
    hits = F.explode_outer(F.array(F.filter(F.sequence("first", "last"), occurs)))
    rows = rows.withColumn("hits", hits).filter(F.size("hits") > 0)
    starts = F.transform("hits", lambda j: F.struct((F.col("p") - F.col("at") + j).alias("s"), (F.col("p") - F.col("at") + j + F.col("len")).alias("e")))
    return rows.select("doc_id", "th", "item", starts.alias("spans"))


def occurrences(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, th, item, spans): word spans [s, e) of ``docs`` where windows of an item occur."""
    table = written(prefixes(benchmark, docs, span), "dc-prefixes")
    n = table.count()
    texts = keyed(docs)
    if n <= BROADCAST_ROWS:
        spots = texts.select("doc_id", "th", "words", F.posexplode_outer("words").alias("p", "token"))
        return _runs(spots.join(F.broadcast(table), "token").filter(
            _near(F.col("words"), F.col("p"), F.col("around"), F.col("at"), F.col("len"))))
    spots = texts.select("doc_id", "th", F.posexplode_outer("words").alias("p", "token"))
    found = spots.join(table, "token").select("doc_id", "th", "p", "item", "q", "at", "len", "around")
    back = texts.dropDuplicates(["doc_id", "th"])
    found = found.withColumnsRenamed({"doc_id": "_d", "th": "_t"})
    rows = back.join(found, (back["th"] == found["_t"]) & back["doc_id"].eqNullSafe(found["_d"]))
    return _runs(rows.filter(_near(F.col("words"), F.col("p"), F.col("around"), F.col("at"), F.col("len"))))


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """(doc_id, th, n_words, n_hit, n_items, items_sha256, contaminated), one row per row of ``docs``.

    ``th`` is the key of (doc_id, text).  Documents without text or words have
    n_words 0 and no hit.  Benchmark rows without item_id, text or words take no
    part; rows that repeat an item_id are one item.  Repeated documents get
    equal rows.  With an empty benchmark nothing is hit; an empty table of
    documents gives no rows.  Other columns are not read.
    """
    per = occurrences(docs, benchmark, span).groupBy("doc_id", "th").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"),
        F.sort_array(F.collect_set("item")).alias("items"))
    # union of the spans, in order of their starts
    union = F.aggregate(
        "spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("e")),
        lambda acc, x: F.struct((acc["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(acc["e"], x["s"]))).alias("n"),
                                F.greatest(acc["e"], x["e"]).alias("e")))["n"]
    per = per.select(F.col("doc_id").alias("_d"), F.col("th").alias("_t"), union.cast("long").alias("n_hit"),
                     F.size("items").cast("long").alias("n_items"),
                     F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"))
    base = keyed(docs).select("doc_id", "th", F.size("words").cast("long").alias("n_words"))
    out = base.join(per, (base["th"] == per["_t"]) & base["doc_id"].eqNullSafe(per["_d"]), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select("doc_id", "th", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
                      F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
                      (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """``docs`` without the rows in which a benchmark window occurs.

    All columns pass through, whatever their names; repeated rows go or stay
    together; null and empty texts, and all rows beside an empty benchmark, stay;
    a null doc_id is a value like others.
    """
    bad = occurrences(docs, benchmark, span).select(F.col("doc_id").alias("id"), "th").distinct()
    bad = fitting(bad, 2_000_000, "dc-bad")  # ids only
    key = row_key(docs["doc_id"], docs["text"])
    return docs.join(bad, (key == bad["th"]) & docs["doc_id"].cast("long").eqNullSafe(bad["id"]), "left_anti")
