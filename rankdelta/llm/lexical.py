"""Ranked lexical search with bit-sliced Bloom signatures.

Every document gets a Bloom signature of its terms.  Documents with about as
many terms form blocks, and a block is stored by slices: for each signature bit
a bitmap over its documents.  A term that occurs often is also entered under
its count steps (2, 3, 4, 6, 8, ...), so the intersection of a step's slices is
a bitmap of documents that may hold the term that often.  It never misses a
document; it may name too many.

A query's upper bound for all documents of a block is a weighted sum of those
bitmaps: each step adds what the score can gain by it at the document's
length.  The documents with the best bounds are scored exactly first; the
score of the last one wanted is then a threshold, and every document whose
bound reaches it, that is all that are not provably excluded, is scored exactly
from its text.  The result is exact, whatever the signatures look like.

Queries are taken in chunks of bounded size; documents, signatures and
candidates stay in tables.
"""

from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankdelta.llm.common import fitting, row_key, slices, utf8, written
from rankdelta.llm.wordscan import plain_words

TOP = 10
BITS = 12  # signature bits for each entry
HASHES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)  # odd multipliers, a slice each
STEPS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 512, 1024, 4096, 16384)
BLOCK = 1024  # documents of a block; fewer where signatures are long
CELLS = 1 << 26  # signature bits of a block
CHUNK_ITEMS, CHUNK_TERMS = 1024, 100_000  # queries that are taken at once
SLICE_TERMS = 2048  # terms whose bitmaps are held at once
PROBES = 32  # documents scored first for each query


def gain(tf, m):
    """What ``tf`` occurrences are worth in a document with length factor ``m``, in millionths."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def length_factor(n, docs: int, terms: int):
    return 100 - 90 + (90 * n * docs) // terms


def _mix(h: np.ndarray, step: int) -> np.ndarray:
    """32-bit keys of terms (crc32) at a count step."""
    x = h.astype(np.uint64) + np.uint64(0x9E3779B9 * step)
    x = (x ^ (x >> np.uint64(15))) * np.uint64(0x2C1B3C6D) & np.uint64(0xFFFFFFFF)
    x = (x ^ (x >> np.uint64(13))) * np.uint64(0x297A2D39) & np.uint64(0xFFFFFFFF)
    return x ^ (x >> np.uint64(16))


def _bits(key: np.ndarray, size: int) -> list[np.ndarray]:
    """Slices of each key in signatures of ``size`` bits."""
    return [(((key * np.uint64(a)) & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)).astype(np.int64) for a in HASHES]


def _entries(scan, text: bytes) -> tuple[int, np.ndarray]:
    """(number of terms, keys of a text's entries)."""
    counts: Counter = Counter()
    for ws in scan.pieces(text):
        counts.update(ws)
    h = np.fromiter(map(zlib.crc32, counts), np.uint32, len(counts))
    tf = np.fromiter(counts.values(), np.int64, len(counts))
    keys = [_mix(h, 0)] if len(h) else []
    for j, step in enumerate(STEPS[1:], 1):
        often = tf >= step
        if not often.any():
            break
        keys.append(_mix(h[often], j))
    return int(tf.sum()), np.concatenate(keys).astype(np.uint32) if keys else np.zeros(0, np.uint32)


def _slices_of(keys: list[np.ndarray], size: int) -> bytes:
    """Bit-sliced signatures: for each of ``size`` bits a bitmap over the documents."""
    cells = np.zeros((size, -(-len(keys) // 8) * 8), bool)
    for d, key in enumerate(keys):
        for at in _bits(key.astype(np.uint64), size):
            cells[at, d] = True
    return np.packbits(cells, axis=1).tobytes()


BLOCKS = "size int, doc_ids array<long>, ths array<long>, ns array<long>, slices binary"


def _blocks(bits: int, block: int, cells: int):
    def out(size, rows):
        ids, ths, ns, keys = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([size], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([ths], pa.list_(pa.int64())),
             pa.array([ns], pa.list_(pa.int64())), pa.array([_slices_of(keys, size)], pa.binary())],
            ["size", "doc_ids", "ths", "ns", "slices"])

    def run(batches):
        scan, waiting = plain_words(), {}
        for b in slices(batches, "_text"):
            for doc, th, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "th", "_text")), strict=True):
                n, keys = _entries(scan, text)
                if not n:
                    continue
                # sizes of 64 * sqrt(2)^k bits, so that documents of about the same length share a block
                k = max(0, math.ceil(2 * math.log2(max(1, len(keys) * bits / 64))))
                size = int(64 * 2 ** (k / 2))
                rows = waiting.setdefault(size, [])
                rows.append((doc, th, n, keys))
                if len(rows) >= min(block, max(8, cells // size)):
                    yield out(size, waiting.pop(size))
        for size, rows in waiting.items():
            yield out(size, rows)
    return run


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("th"),
                       utf8(F.col("text")).alias("_text"))


def signatures(docs: DataFrame, *, bits: int = BITS, block: int = BLOCK, cells: int = CELLS) -> DataFrame:
    """Bit-sliced signature blocks of all rows of ``docs`` that have a term; no shuffle."""
    return _keyed(docs).mapInArrow(_blocks(bits, block, cells), BLOCKS)


def _counted(vocab: dict[bytes, int]):
    def run(batches):
        scan, df, rows, terms = plain_words(), [0] * len(vocab), 0, 0
        for b in slices(batches, "_text"):
            for text in b.column("_text").to_pylist():
                n, seen = 0, set()
                for ws in scan.pieces(text):
                    n += len(ws)
                    seen |= vocab.keys() & set(ws)
                rows += n > 0
                terms += n
                for w in seen:
                    df[vocab[w]] += 1
        yield pa.RecordBatch.from_arrays([pa.array(range(-2, len(df)), pa.int32()), pa.array([rows, terms, *df], pa.int64())], ["term", "n"])
    return run


class Queries:
    """One chunk of queries: their terms with weights, each query a set of term numbers."""

    def __init__(self, items: list[tuple], docs: DataFrame):
        self.ids = [i for i, _ in items]
        self.vocab = {w: k for k, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        self.terms = [np.array(sorted(self.vocab[w] for w in ws), np.int64) for _, ws in items]
        counts = _keyed(docs).select("_text").mapInArrow(_counted(self.vocab), "term int, n long")
        n = {r["term"]: r["n"] for r in counts.groupBy("term").agg(F.sum("n").alias("n")).collect()}  # a row per asked term
        self.docs, self.total = n.get(-2, 0), n.get(-1, 0)
        self.weight = np.array([math.floor(1000 * math.log((2 * self.docs + 2) / (2 * n.get(k, 0) + 1)))
                                for k in range(len(self.vocab))], np.int64)
        self.hash = np.fromiter(map(zlib.crc32, self.vocab), np.uint32, len(self.vocab))


def _bounds(q: Queries, size: int, ns: np.ndarray, data) -> np.ndarray:
    """Upper bounds, a row per query and a column per document of a block."""
    table = np.frombuffer(data, np.uint8).reshape(size, -1)
    m = length_factor(ns, q.docs, q.total)
    worth = [gain(step - 1, m) for step in STEPS[1:]] + [np.full(len(ns), 1_000_000)]  # at most, below the next step
    bound = np.zeros((len(q.terms), len(ns)), np.int64)
    for low in range(0, len(q.vocab), SLICE_TERMS):
        high = min(low + SLICE_TERMS, len(q.vocab))
        part = np.zeros((high - low, len(ns)), np.int64)
        alive, held = np.arange(high - low), np.full((high - low, table.shape[1]), 255, np.uint8)
        for j in range(len(STEPS)):
            for at in _bits(_mix(q.hash[low + alive], j), size):
                held &= table[at]
            some = held.any(axis=1)
            alive, held = alive[some], held[some]
            if not len(alive):
                break
            more = worth[j] - worth[j - 1] if j else worth[0]
            part[alive] += np.unpackbits(held, axis=1, count=len(ns)) * more
        part *= q.weight[low:high, None]
        for i, terms in enumerate(q.terms):
            mine = terms[(terms >= low) & (terms < high)] - low
            if len(mine):
                bound[i] += part[mine].sum(axis=0)
    return bound


def _read_blocks(batches) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, object]]:
    for b in batches:
        for i in range(b.num_rows):
            ids = np.array(b.column("doc_ids")[i].as_py(), object)  # some may be null
            yield (b.column("size")[i].as_py(), ids, b.column("ths")[i].values.to_numpy(),
                   b.column("ns")[i].values.to_numpy(), b.column("slices")[i].as_buffer())


FOUND = "q int, bound long, doc_id long, th long"


def _found(q, bound, ids, ths):
    return pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(bound, pa.int64()), pa.array(list(ids), pa.int64()),
                                       pa.array(ths, pa.int64())], ["q", "bound", "doc_id", "th"])


def _probe(q: Queries, most: int):
    """The documents with the best bounds that a task has seen, for each query."""
    def run(batches):
        best = [(np.zeros(0, np.int64), np.zeros(0, object), np.zeros(0, np.int64)) for _ in q.terms]
        for size, ids, ths, ns, data in _read_blocks(batches):
            bound = _bounds(q, size, ns, data)
            for i, (b0, d0, t0) in enumerate(best):
                some = np.flatnonzero(bound[i] > (b0.min() if len(b0) >= most else 0))
                if len(some):
                    b, d, t = np.concatenate([b0, bound[i][some]]), np.concatenate([d0, ids[some]]), np.concatenate([t0, ths[some]])
                    top = np.argsort(-b, kind="stable")[:most]
                    best[i] = b[top], d[top], t[top]
        for i, (b, d, t) in enumerate(best):
            if len(b):
                yield _found(np.full(len(b), i), b, d, t)
    return run


def _candidates(q: Queries, least: np.ndarray):
    """Every document whose bound reaches the query's threshold."""
    def run(batches):
        for size, ids, ths, ns, data in _read_blocks(batches):
            bound = _bounds(q, size, ns, data)
            i, d = np.nonzero(bound >= least[:, None])
            if len(i):
                yield _found(i, bound[i, d], ids[d], ths[d])
    return run


def _scores(q: Queries):
    """Exact scores of (document, queries) rows."""
    def run(batches):
        scan = plain_words()
        for b in slices(batches, "_text"):
            cols = (b.column(c).to_pylist() for c in ("doc_id", "_text", "qs"))
            qs, docs, scores = [], [], []
            for doc, text, asked in zip(*cols, strict=True):
                n, tf = 0, Counter()
                for ws in scan.pieces(text):
                    n += len(ws)
                    tf.update(w for w in ws if w in q.vocab)
                m = length_factor(n, q.docs, q.total)
                worth = {k: int(q.weight[k]) * gain(c, m) for w, c in tf.items() for k in (q.vocab[w],)}
                for i in asked:
                    score = sum(worth.get(k, 0) for k in q.terms[i].tolist())
                    if score > 0:
                        qs.append(i)
                        docs.append(doc)
                        scores.append(score)
            yield pa.RecordBatch.from_arrays([pa.array(qs, pa.int32()), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())],
                                             ["q", "doc_id", "score"])
    return run


CANDIDATE_ROWS = 200_000  # (document, queries) rows of a broadcast


def _rescored(docs: DataFrame, found: DataFrame, q: Queries) -> DataFrame:
    """(q, doc_id, score): exact scores of the (q, doc_id, th) rows of ``found``, from the texts."""
    asked = found.groupBy("doc_id", "th").agg(F.collect_set("q").alias("qs"))
    asked = fitting(asked.withColumnsRenamed({"doc_id": "_d", "th": "_t"}), CANDIDATE_ROWS, "lx-asked")
    base = _keyed(docs)
    both = base.join(asked, (base["th"] == asked["_t"]) & base["doc_id"].eqNullSafe(asked["_d"])).select("doc_id", "_text", "qs")
    return both.mapInArrow(_scores(q), "q int, doc_id long, score long")


def _best(scored: DataFrame, top: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(w).cast("int")).filter(F.col("rank") <= top)


def _chunks(items: DataFrame) -> Iterator[list[tuple]]:
    """Queries in chunks of bounded size: [(item_id, terms)]."""
    scan, chunk, held = plain_words(), [], 0
    rows = items.filter("item_id is not null and text is not null").select("item_id", "text").distinct().orderBy("item_id", "text")
    for item, group in itertools.groupby(rows.toLocalIterator(), key=lambda r: r["item_id"]):
        terms = sorted({w for r in group for ws in scan.pieces(r["text"].encode()) for w in ws})
        if not terms:
            continue
        if chunk and (len(chunk) >= CHUNK_ITEMS or held + len(terms) > CHUNK_TERMS):
            yield chunk
            chunk, held = [], 0
        chunk.append((item, terms))
        held += len(terms)
    if chunk:
        yield chunk


def search(docs: DataFrame, items: DataFrame, *, top: int = TOP, bits: int = BITS, block: int = BLOCK, probes: int = PROBES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` rows of ``docs`` with the highest score above 0 for each item.

    Terms are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with only A-Z lower-cased.
    Ties go to the smaller doc_id; a null doc_id comes last.  Rows of ``items``
    that repeat an item_id are one query of all their terms; those without
    item_id, text or terms have no result.  Null and empty texts of ``docs``
    have no term; repeated rows are documents of their own.  Empty tables give
    no rows.  Other columns are not read.
    """
    spark: SparkSession = docs.sparkSession
    schema = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
    out, blocks = None, None
    for chunk in _chunks(items):
        if blocks is None:
            blocks = written(signatures(docs, bits=bits, block=block), "lx-blocks")
        q = Queries(chunk, docs)
        w = Window.partitionBy("q").orderBy(F.desc("bound"), "th")
        probed = (blocks.mapInArrow(_probe(q, probes), FOUND).withColumn("k", F.row_number().over(w))
                  .filter(F.col("k") <= max(probes, top)))
        least = np.ones(len(q.ids), np.int64)
        last = _best(_rescored(docs, probed, q), top).filter(F.col("rank") == top)
        for r in last.select("q", "score").collect():  # a row per query of the chunk
            least[r["q"]] = r["score"]
        found = blocks.mapInArrow(_candidates(q, least), FOUND)
        best = written(_best(_rescored(docs, found, q), top), "lx-best")
        names = F.broadcast(spark.createDataFrame(list(enumerate(q.ids)), f"q int, {schema.split(',')[0]}"))  # one chunk
        best = best.join(names, "q").select("item_id", "rank", "doc_id", "score")
        out = best if out is None else out.unionByName(best)
    return spark.createDataFrame([], schema) if out is None else out
