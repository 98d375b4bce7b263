"""Mixing sources to target weights by the cube method.

Every source gets a target number of words.  A document of a source with ratio
``r = target / source size`` is taken ``floor(r)`` times for certain and once
more with probability ``frac(r)``.  Which documents get the extra copy is drawn
by the cube method: the vector of fractional probabilities moves at random
through the null space of the balancing constraints (sum of words, number of
documents), so both totals stay exactly where they are while coordinates
become 0 or 1.  The flight runs in blocks of bounded size; the at most two
units that each block leaves undecided fly on together in the next round.  One
block of each source waits meanwhile, so that a source of any size comes down to
one block with enough units to land on, in the round in which its rows fit.  A
small landing problem rounds what is then left (nearest to both totals, words
first).

Only (key, source, size) rows move; texts are read once and stay where they are.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankdelta.llm.common import row_key, utf8, written

WEIGHTS = (5.0, 2.0, 1.0)
CAP = 3.0
BLOCK = 4096
EPS = 1e-9

SIZED = "doc_id long, source string, th long, size long"


def _count_words(batches):
    for b in batches:
        sizes = [len(t.split()) for t in b.column("_text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("source"), b.column("th"), pa.array(sizes, pa.int64())],
            ["doc_id", "source", "th", "size"])


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, th, size): words ``[^\\x20\\x09-\\x0D]+`` of the whole text (null: 0)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       row_key(F.col("doc_id"), F.col("text")).alias("th"), utf8(F.col("text")).alias("_text"))
    return rows.mapInArrow(_count_words, SIZED)


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """(source, source_size, n_docs, target): shares of all words by weight, capped.

    Sources in code-point order, null last, take ``weights`` in turn.  A target
    stops at ``cap`` times its source's size and the excess is shared again
    among the rest by weight, until none is above; each round is one small
    aggregate over the table of sources (three sums reach the driver).
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    # one row per source; hex of UTF-8 sorts by code point
    order = Window.orderBy(F.col("source").isNull(), F.hex(F.col("source").cast("binary")))
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    sources = written(sources.withColumn("weight", pick), "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:
        at_cap = F.lit(level) * F.col("weight") > F.lit(float(cap)) * F.col("source_size")
        capped, open_weight, n_open = sources.agg(
            F.coalesce(F.sum(F.when(at_cap, F.lit(float(cap)) * F.col("source_size"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~at_cap, F.col("weight"))), F.lit(0.0)), F.count(F.when(~at_cap, 1))).first()
        new = (total - capped) / open_weight if n_open else level
        if new <= level * (1 + 1e-12):
            break
        level = new
    target = F.least(F.lit(level) * F.col("weight"), F.lit(float(cap)) * F.col("source_size"))
    return sources.select("source", "source_size", "n_docs", target.alias("target"))


def flight(pi: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move ``pi`` through the null space of (sizes, ones) until at most two units are fractional."""
    pi = pi.astype(float).copy()
    draws = rng.random(len(pi) + 3)
    act: list[int] = []
    steps = 0
    for nxt in range(len(pi)):
        if not EPS < pi[nxt] < 1 - EPS:
            continue
        act.append(nxt)
        if len(act) < 3:
            continue
        a, b, c = act
        s0, s1, s2 = float(size[a]), float(size[b]), float(size[c])
        u = (s1 - s2, s2 - s0, s0 - s1)
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = down = np.inf
        for i, v in zip(act, u, strict=True):
            p = pi[i]
            if v > 0:
                up, down = min(up, (1 - p) / v), min(down, p / v)
            elif v < 0:
                up, down = min(up, -p / v), min(down, (p - 1) / v)
        step = up if draws[steps] * (up + down) < down else -down
        steps += 1
        for i, v in zip(act, u, strict=True):
            p = pi[i] + step * v
            pi[i] = 0.0 if p <= EPS else 1.0 if p >= 1 - EPS else p
        act = [i for i in act if 0.0 < pi[i] < 1.0]
    return pi


def land(pi: np.ndarray, size: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Round the last fractional units, words nearest their total first, then documents.

    One very large unit can be left, whose rounding alone would miss the total
    by its size; units of the block that started fractional (``start``) are then
    turned over, the best one at a time, as long as the total comes nearer.
    """
    pi = pi.copy()
    left = np.flatnonzero((pi > EPS) & (pi < 1 - EPS))
    pi[(pi <= EPS)], pi[(pi >= 1 - EPS)] = 0.0, 1.0
    want_s, want_n = float(pi[left] @ size[left]), float(pi[left].sum())
    best = min(itertools.product((0.0, 1.0), repeat=len(left)),
               key=lambda c: (abs(float(np.dot(c, size[left])) - want_s), abs(sum(c) - want_n), c))
    pi[left] = best
    free = np.flatnonzero((start > EPS) & (start < 1 - EPS) & (size > 0))
    error = float(start @ size) - float(pi @ size)  # words still missing
    for _ in range(len(free)):
        after = error - np.where(pi[free] > 0, -size[free], size[free])
        i = int(np.argmin(np.abs(after))) if len(free) else -1
        if i < 0 or abs(after[i]) >= abs(error):
            break
        error = float(after[i])
        pi[free[i]] = 1.0 - pi[free[i]]
    return pi


def _fly(pdf: pd.DataFrame) -> pd.DataFrame:
    """One block of a source; the only one of its source lands, the first of several waits for the next round."""
    single, block = int(pdf["blocks"].iloc[0]) == 1, int(pdf["block"].iloc[0])
    pdf = pdf.drop(columns=["block", "blocks"])
    if not single and block == 0:
        return pdf
    # large documents are decided first, so that small ones are left to land
    pdf = pdf.sort_values(["size", "h", "doc_id", "th", "copy"], ascending=[False, True, True, True, True],
                          kind="mergesort", na_position="first")
    size, pi = pdf["size"].to_numpy(np.int64), pdf["pi"].to_numpy(float)
    seed = np.array([int(pdf["h"].iloc[0]) & 0x7FFFFFFFFFFFFFFF, len(pdf)], dtype=np.uint64)
    flown = flight(pi, size, np.random.default_rng(seed))
    return pdf.assign(pi=land(flown, size, pi) if single else flown)


def mix(docs: DataFrame, *, weights=WEIGHTS, cap: float = CAP, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """(doc_id, size, source, source_size, target, n_copies, taken), one row per row of ``docs``.

    Null text: size 0, taken 0.  Null source: a source of its own, last in
    order.  Null doc_id and repeated rows are documents like others (equal rows
    are drawn one by one).  Empty table: no rows.  Other columns are not read.
    The draw depends on the documents and ``seed`` alone, so reruns agree.
    """
    sizes = written(sized(docs), "mix-sizes")
    targets = source_targets(sizes, weights, cap)
    keys = ["doc_id", "source", "th", "size"]
    rows = sizes.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"))
    t = targets.select(F.col("source").alias("_s"), "source_size", "n_docs", "target")
    rows = rows.join(t, rows["source"].eqNullSafe(t["_s"])).drop("_s")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sure = F.floor(F.least(ratio, F.lit(float(cap))) + F.lit(1e-12))
    rows = (rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_m")))).drop("_m")
            .withColumn("sure", sure).withColumn("pi", F.greatest(F.lit(0.0), ratio - F.col("sure")))
            .withColumn("h", F.xxhash64("doc_id", "th", "copy", F.lit(seed))).drop("n_docs"))
    current, done = rows, []
    n = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    while True:
        # a source gets blocks by its own number of rows; those of the block that waits are dealt anew each round
        per = (current.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
               .withColumnRenamed("source", "_s"))
        cut = (current.join(per, current["source"].eqNullSafe(per["_s"])).drop("_s")
               .withColumn("block", F.pmod(F.xxhash64("h", F.lit(len(done))), F.col("blocks"))))
        moved = written(cut.groupBy("source", "block").applyInPandas(_fly, current.schema), "mix-round")
        if n <= block:  # every source has landed
            done.append(moved)
            break
        open_ = (F.col("pi") > EPS) & (F.col("pi") < 1 - EPS)
        done.append(moved.filter(~open_))
        current = moved.filter(open_)
        n = current.groupBy("source").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    copies = F.col("sure") + F.round("pi").cast("long")
    return out.select("doc_id", "size", "source", "source_size", "target", copies.alias("n_copies"),
                      (F.col("size") * copies).cast("long").alias("taken"))
