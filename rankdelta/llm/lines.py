"""Line dedup: lines that many documents share go, except in one document.

Lines are exploded to (key hash, document, positions), distinct documents are
counted per hash, and the positions of dropped lines go back to their document,
whose other lines are put together again in order.  Only hashes and positions
are shuffled for the count; each text moves once, to meet its positions.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankdelta.llm.common import row_key, utf8

MIN_CHARS = 40
MIN_DOCS = 5
SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"


def line_key(line: bytes) -> bytes:
    """The line without ``[\\x20\\x09-\\x0D]`` at its ends, A-Z lower-cased."""
    return line.strip(SPACE).lower()  # bytes.lower() is ASCII only


def _keys(min_chars: int):
    def run(batches):
        digest = xxhash.xxh3_128_digest
        for b in batches:
            docs, ths, hs, ps = [], [], [], []
            for doc, th, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "th", "_text")), strict=True):
                seen: dict[bytes, list[int]] = {}
                for i, line in enumerate(text.split(b"\n")):
                    if len(line) < min_chars:
                        continue
                    key = line_key(line)
                    n = len(key)
                    if n >= min_chars and (n >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars):
                        seen.setdefault(digest(key), []).append(i)
                docs += [doc] * len(seen)
                ths += [th] * len(seen)
                hs += seen.keys()
                ps += seen.values()
                if len(hs) >= 20_000:
                    yield _batch(docs, ths, hs, ps)
                    docs, ths, hs, ps = [], [], [], []
            if hs:
                yield _batch(docs, ths, hs, ps)
    return run


def _batch(docs, ths, hs, ps):
    return pa.RecordBatch.from_arrays(
        [pa.array(docs, pa.int64()), pa.array(ths, pa.int64()), pa.array(hs, pa.binary()),
         pa.array(ps, pa.list_(pa.int32()))], ["doc_id", "th", "h", "pos"])


def dropped_positions(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc_id, th, drop): positions of the lines that a document loses; other documents have no row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       row_key(F.col("doc_id"), F.col("text")).alias("th"), utf8(F.col("text")).alias("_text"))
    keys = rows.mapInArrow(_keys(min_chars), "doc_id long, th long, h binary, pos array<int>")
    # equal rows count once; a hash that a third of all documents hold is summed before it is shuffled
    shared = (keys.groupBy("h").agg(F.countDistinct("doc_id").alias("n"), F.max("doc_id").alias("keeper"))
              .filter(F.col("n") >= min_docs).select("h", "keeper"))
    lost = keys.join(shared, "h").filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    return (lost.groupBy("doc_id", "th")
            .agg(F.array_distinct(F.flatten(F.collect_list("pos"))).alias("drop")))


def drop_shared_lines(docs: DataFrame, *, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``text`` replaced by what stays, plus ``n_lines`` and ``n_dropped``.

    A text is split at ``\\n`` (null or empty: one empty line).  Lines whose key
    (see ``line_key``) has at least ``min_chars`` code points and occurs in at
    least ``min_docs`` distinct doc_ids go, except in the largest doc_id that
    holds it, which keeps all of them.  Rows without doc_id count for no key
    and lose shared lines; repeated rows count once and are treated alike.
    A text without a dropped line is returned unchanged (null stays null).
    Other columns pass through; names starting with ``_ld_`` are ours.
    """
    drop = dropped_positions(docs, min_chars, min_docs).select(
        F.col("doc_id").alias("_ld_id"), F.col("th").alias("_ld_th"), F.col("drop").alias("_ld_drop"))
    base = docs.withColumn("_ld_key", row_key(F.col("doc_id"), F.col("text")))
    both = base.join(drop, (F.col("_ld_key") == F.col("_ld_th"))
                     & F.col("doc_id").cast("long").eqNullSafe(F.col("_ld_id")), "left")
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    both = both.withColumn("_ld_lines", lines).withColumn("n_lines", F.array_size("_ld_lines").cast("long"))
    stay = F.array_except(F.sequence(F.lit(0), F.array_size("_ld_lines") - 1), F.col("_ld_drop"))
    kept = F.array_join(F.transform(stay, lambda i: F.get(F.col("_ld_lines"), i)), "\n")
    return (both.withColumn("n_dropped", F.coalesce(F.array_size("_ld_drop"), F.lit(0)).cast("long"))
            .withColumn("text", F.when(F.col("_ld_drop").isNull(), F.col("text")).otherwise(kept))
            .drop("_ld_id", "_ld_th", "_ld_drop", "_ld_key", "_ld_lines"))
