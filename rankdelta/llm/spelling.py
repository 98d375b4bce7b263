"""Spelling variants: words of a corpus that differ by one code point, and the form each belongs to.

Words are counted over all texts.  Two words at one error agree in one half:
split the shorter one (or either, at equal length) in the middle, and the
error is in one half only.  So a search scheme of two searches is whole: match
the first half exactly and extend to the right allowing one error, and match
the second half exactly and extend to the left.  Both run on a bidirectional
FM-index (``fmindex``) over the delimited vocabulary.

The vocabulary is dealt to blocks by the half that has to match and the length
of the shorter word, so every search needs one block only; a half that very
many words share is dealt to a grid of blocks.  No block grows with the corpus.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankdelta.llm.common import release, slices, utf8, written
from rankdelta.llm.fmindex import WordIndex
from rankdelta.llm.wordscan import letter_runs

MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5  # a form occurs at least so many times as often as its variant
GARBLE = 199  # occurrences whose crc32 it divides lose a code point
BLOCK = 32_768  # words of a block, about
HOT = BLOCK // 8  # words that share a half before they get blocks of their own
HELD = 200_000  # words that a task counts before it passes them on


def _garbled(run: bytes, h: int) -> bytes:
    text = run.decode("utf-8")
    at = h % len(text)
    return (text[:at] + text[at + 1:]).encode("utf-8")


def _counted(min_chars: int):
    def out(total):
        return pa.RecordBatch.from_arrays([pa.array([w.decode("utf-8") for w in total], pa.string()),
                                           pa.array(list(total.values()), pa.int64())], ["word", "n"])

    def run(batches):
        scan, total, crc = letter_runs(), {}, zlib.crc32
        for b in slices(batches, "_text"):
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("_text").to_pylist(), strict=True):
                start = crc(f"{'' if doc is None else doc}:".encode())
                for found in scan.pieces(text):
                    for w, k in Counter(found).items():
                        if len(w) < min_chars:
                            continue
                        h = crc(w, start)
                        if h % GARBLE == 0:
                            w = _garbled(w, h)
                        if w.isascii():
                            if len(w) < min_chars:
                                continue
                        elif len(w.decode("utf-8")) < min_chars:
                            continue
                        total[w] = total.get(w, 0) + k
                    if len(total) >= HELD:
                        yield out(total)
                        total = {}
        if total:
            yield out(total)
    return run


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the distinct words of at least ``min_chars`` code points and ``min_count`` occurrences.

    Counts are summed inside a task before the shuffle, so that a frequent word is a few rows.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), utf8(F.col("text")).alias("_text"))
    counted = rows.mapInArrow(_counted(min_chars), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def dealt(words: DataFrame, blocks: int, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """(gid, word, n, ask): each word in the blocks where it can be found (ask 0) and where it asks (1 forward, 2 backward).

    A word of length m is found by words of length m and m - 1, and asks for
    words of length m and m + 1; the length in the key is that of the asker.
    """
    m = F.char_length("word")

    def key(length, forward):
        half = F.floor(length / 2).cast("int")
        part = F.left("word", half) if forward else F.right("word", (length - half).cast("int"))
        return F.xxhash64(F.lit(forward), length, part)

    found = [F.struct(key(m - d, f).alias("key"), F.lit(0).alias("ask")) for d in (0, 1) for f in (True, False)]
    asks = [F.struct(key(m, f).alias("key"), F.lit(1 if f else 2).alias("ask")) for f in (True, False)]
    rows = words.select("word", "n", F.explode(F.array(*found, *asks)).alias("r")).select("word", "n", "r.key", "r.ask")
    # a half shared by more than ``hot`` words gets a grid of parts x parts blocks
    crowd = (rows.filter("ask = 0").groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > hot)
             .select("key", F.ceil(F.col("c") / block).cast("int").alias("parts")))
    rows = rows.join(crowd, "key", "left")
    plain = rows.filter("parts is null").select(F.pmod("key", F.lit(blocks)).alias("gid"), "word", "n", "ask")
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("long")
    grid = rows.filter("parts is not null").select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j"))
    cell = F.when(F.col("ask") == 0, F.struct(F.col("j").cast("long").alias("a"), F.col("own").alias("b"))) \
        .otherwise(F.struct(F.col("own").alias("a"), F.col("j").cast("long").alias("b")))
    return plain.unionByName(grid.select((-1 - F.abs(F.xxhash64("key", cell)) % (1 << 62)).alias("gid"), "word", "n", "ask"))


def _pairs(table: pa.Table) -> pa.Table:
    """Words of one block that the asking ones find in it."""
    words, ns, ask = (table.column(c).to_pylist() for c in ("word", "n", "ask"))
    index = sorted({w for w, a in zip(words, ask, strict=True) if a == 0})
    count = dict(zip(words, ns, strict=True))
    left, right = [], []
    if index:
        built = WordIndex(index)
        for code in (1, 2):
            asked = sorted({w for w, a in zip(words, ask, strict=True) if a == code})
            if asked:
                i, j = built.near(asked, forward=code == 1)
                left += [asked[x] for x in i]
                right += [index[x] for x in j]
    return pa.table({"word": pa.array(left, pa.string()), "n": pa.array([count[w] for w in left], pa.int64()),
                     "near": pa.array(right, pa.string()), "near_n": pa.array([count[w] for w in right], pa.int64())})


def near_words(words: DataFrame, *, block: int = BLOCK, hot: int = HOT) -> DataFrame:
    """(word, n, near, near_n): every pair of ``words`` at exactly one inserted, deleted or replaced
    code point, in both directions, once each.  ``words`` is a written table of distinct words."""
    blocks = max(1, -(-4 * words.count() // block))
    # as many parts as blocks: an explicit count is not merged, for a block is little data but much work
    found = dealt(words, blocks, hot, block).repartition(blocks, "gid").groupBy("gid").applyInArrow(_pairs, "word string, n long, near string, near_n long")
    both = F.explode(F.array(F.struct("word", "n", "near", "near_n"),
                             F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"),
                                      F.col("word").alias("near"), F.col("n").alias("near_n"))))
    return found.select(both.alias("r")).select("r.*").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form: forms are followed to the last by doubling the way.

    A form is at least ``RATIO`` times as frequent, so ways are short and have no rings.
    """
    way = written(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "sp-way")
    while True:
        onward = way.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        step = way.join(onward, way["root"] == onward["_w"], "left").select(
            "word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("moved"))
        step = written(step, "sp-way")
        if step.filter("moved").isEmpty():
            release(way)
            return step.drop("moved")
        release(way)
        way = step


def spelling_groups(docs: DataFrame, *, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO,
                    block: int = BLOCK, hot: int = HOT) -> DataFrame:
    """(word, form, root, n, n_near, form_n): the words of ``docs`` and the spelling each belongs to.

    Words are maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` of whole texts with only
    A-Z lower-cased; an occurrence loses a code point where ``GARBLE`` divides
    the crc32 of ``<doc_id>:<run>``.  Those of at least ``min_chars`` code points
    and ``min_count`` occurrences (n) count.  ``form``: the near word of largest
    n (ties: smallest in code-point order) if that is at least ``ratio`` times
    the word's n, else null; ``root``: the last form on the way, or the word.

    A null text has no words and a null doc_id is written as an empty text;
    repeated rows count again; an empty table gives no rows.  A run of any
    length is one word.  Other columns are not read.
    """
    words = written(vocabulary(docs, min_chars, min_count), "sp-words")
    best = (near_words(words, block=block, hot=hot).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    best = best.withColumnsRenamed({"word": "_w"})
    taken = -F.col("best.less") >= ratio * F.col("n")
    table = words.join(best, words["word"] == best["_w"], "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, F.col("best.near")).alias("form"), F.when(taken, -F.col("best.less")).alias("form_n"))
    table = written(table, "sp-forms")
    roots = _roots(table.filter("form is not null"))
    roots = roots.withColumnRenamed("word", "_w")
    return table.join(roots, table["word"] == roots["_w"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
