"""Toxicity scores from a factorization machine over hashed terms.

A text's terms are its distinct words (letters only, A-Z lower-cased) and their
first four, five and six bytes, so that unseen forms of a known stem count
too; each is hashed to one of ``BUCKETS``.  The machine scores

    w0 + sum w[i] + 1/2 sum_f ((sum v[i,f])^2 - sum v[i,f]^2)

over the terms present: besides the weight of each term it learns a vector per
term, and terms whose vectors agree raise the score together.  An insult next to
the mention of a group counts for more than both alone, which additive weights
cannot say.

Training (numpy, Adagrad on the logistic loss) runs in one task over at most
``TRAIN_ROWS`` labelled texts; scoring runs over all texts where they are.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankdelta.llm.common import slices, utf8, written

BUCKETS = 1 << 18
FACTORS = 8
TRAIN_ROWS = 20_000
FOLDS = 5
MIN_TEXTS = 3          # a term in fewer training texts has no weight,
MIN_EVIDENCE = 3.0     # nor, alone, has one whose share differs less between the labels (standard errors)
# Terms that are neutral alone take part in the pairs if some pair of them is not
# neutral; all pairs of the most frequent ones are tested.
PAIR_TERMS = 2048
PAIR_EVIDENCE = 8.0    # of two million pairs of chance, none gets near
STEPS, BATCH = 2500, 128
RATE, DECAY = 0.3, 3e-5
POSITIVE = 2.0         # weight of a text with label 1, the rarer one

#: all bytes but letters, digits and those of characters beyond ASCII become spaces
_KEEP = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


class Terms(dict):
    """Word -> the buckets of its terms, computed once per distinct word of a batch."""

    def __missing__(self, word: bytes):
        forms = {word} | {b"^" + word[:n] for n in (4, 5, 6) if len(word) >= n}
        value = self[word] = tuple(xxhash.xxh3_64_intdigest(x) % BUCKETS for x in forms)
        return value


def terms(text: bytes, memo: Terms) -> np.ndarray:
    """Sorted distinct buckets of a text."""
    found: set[int] = set()
    for ids in map(memo.__getitem__, set(text.translate(_KEEP).split())):
        found.update(ids)
    return np.sort(np.fromiter(found, np.int32, len(found)))


class Machine:
    """Factorization machine over binary features.

    A text's features are scaled for the pairs by the root of their number, so
    that long texts do not score by length.  Terms without weights do not count.
    """

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.w0 = np.zeros(1)
        self.w = np.zeros(BUCKETS)
        self.v = rng.standard_normal((BUCKETS, FACTORS)) * 0.05
        self.known = np.zeros(BUCKETS, bool)

    def raw(self, texts: list[np.ndarray]) -> np.ndarray:
        """Scores before the logistic function."""
        texts = [t[self.known[t]] for t in texts]
        return self.parts(texts)[0]

    def parts(self, texts: list[np.ndarray]):
        """(scores, features, text of each, sums of vectors per text, 1 / number of features)."""
        n = np.array([len(t) for t in texts])
        ids = np.concatenate(texts).astype(np.int64) if n.sum() else np.empty(0, np.int64)
        text = np.repeat(np.arange(len(texts)), n)
        scale = 1 / np.maximum(n, 1)
        v = self.v[ids]
        sums = np.stack([np.bincount(text, v[:, f], len(texts)) for f in range(FACTORS)], axis=1)
        linear = np.bincount(text, self.w[ids], len(texts))
        squares = np.bincount(text, (v * v).sum(axis=1), len(texts))
        return self.w0[0] + linear + 0.5 * scale * ((sums * sums).sum(axis=1) - squares), ids, text, sums, scale


def evidence(texts: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Standard errors between a term's share of texts with and without the label."""
    count = [np.bincount(np.concatenate([t for t, y in zip(texts, labels, strict=True) if y == k] or [np.empty(0, np.int32)]),
                         minlength=BUCKETS) for k in (0, 1)]
    n0, n1 = max((labels == 0).sum(), 1), max((labels == 1).sum(), 1)
    p = (count[0] + count[1]) / (n0 + n1)
    error = np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n0 + 1 / n1))
    return np.where(count[0] + count[1] >= MIN_TEXTS, np.abs(count[1] / n1 - count[0] / n0) / error, 0.0)


def paired(texts: list[np.ndarray], labels: np.ndarray, single: np.ndarray) -> np.ndarray:
    """Terms without evidence alone that have some in a pair: the share of texts that hold both differs
    between the labels by more than ``PAIR_EVIDENCE`` standard errors.

    The co-occurrence counts of all pairs of the ``PAIR_TERMS`` most frequent
    such terms are two matrix products, summed over blocks of texts.
    """
    count = np.bincount(np.concatenate(texts or [np.empty(0, np.int32)]), minlength=BUCKETS)
    count[single] = 0
    own = np.sort(np.argsort(-count, kind="stable")[:PAIR_TERMS])
    own = own[count[own] >= MIN_TEXTS]
    known = np.zeros(BUCKETS, bool)
    if len(own) < 2:
        return known
    place = np.full(BUCKETS, -1)
    place[own] = np.arange(len(own))
    both = np.zeros((2, len(own), len(own)), np.float32)  # counts of at most some thousand texts are exact
    for k in (0, 1):
        mine = [t for t, y in zip(texts, labels, strict=True) if y == k]
        for i in range(0, len(mine), 1024):
            block = np.zeros((len(mine[i: i + 1024]), len(own)), np.float32)
            for row, t in zip(block, mine[i: i + 1024], strict=True):
                at = place[t]
                row[at[at >= 0]] = 1
            both[k] += block.T @ block
    n0, n1 = max((labels == 0).sum(), 1), max((labels == 1).sum(), 1)
    for i in range(len(own)):  # a row of pairs at a time
        p = (both[0, i] + both[1, i]) / (n0 + n1)
        error = np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n0 + 1 / n1))
        z = np.abs(both[1, i] / n1 - both[0, i] / n0) / error
        z[i] = 0
        known[own[i]] = (z >= PAIR_EVIDENCE).any()
    return known


def fit(texts: list[np.ndarray], labels: np.ndarray, seed: int = 3) -> Machine:
    m, rng = Machine(seed), np.random.default_rng(seed)
    if not len(texts):
        return m
    alone = evidence(texts, labels) >= MIN_EVIDENCE
    m.known = alone | paired(texts, labels, alone)
    texts = [t[m.known[t]] for t in texts]
    p = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    m.w0[0] = np.log(p / (1 - p))
    gw0, gw, gv = 1.0, np.ones(BUCKETS), np.ones((BUCKETS, FACTORS))
    for _ in range(-(-STEPS * BATCH // len(texts))):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            at = order[i: i + BATCH]
            score, ids, text, sums, scale = m.parts([texts[j] for j in at])
            error = labels[at] - 1 / (1 + np.exp(-np.clip(score, -30, 30)))
            error = np.where(labels[at] == 1, POSITIVE * error, error)
            gw0 += error.sum() ** 2
            m.w0 += RATE * error.sum() / np.sqrt(gw0)
            if not len(ids):
                continue
            own, back = np.unique(ids, return_inverse=True)
            dw = np.bincount(back, error[text], len(own)) - DECAY * m.w[own] * len(at)
            g = (error * scale)[text][:, None] * (sums[text] - m.v[ids])
            dv = np.stack([np.bincount(back, g[:, f], len(own)) for f in range(FACTORS)], axis=1) - DECAY * m.v[own] * len(at)
            gw[own] += dw * dw
            gv[own] += dv * dv
            m.w[own] += RATE * dw / np.sqrt(gw[own])
            m.v[own] += RATE * dv / np.sqrt(gv[own])
    return m


# --- Spark side -----------------------------------------------------------------

_EXAMPLES = pa.schema([("_id", pa.int64()), ("order", pa.int64()), ("label", pa.int32()), ("terms", pa.list_(pa.int32()))])


def _featurise(batches):
    memo = Terms()
    for b in slices(batches, "_text"):
        found = [terms(t, memo) for t in b.column("_text").to_pylist()]
        if len(memo) > 150_000:
            memo.clear()
        yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("order"), b.column("label"), pa.array(found, pa.list_(pa.int32()))], schema=_EXAMPLES)


_MODEL = pa.schema([("bucket", pa.int32()), ("w", pa.float64()), ("v", pa.list_(pa.float64()))])


def _fit(batches):
    texts, labels = [], []
    for b in batches:
        found = b.column("terms")
        ids, ends = found.flatten().to_numpy().astype(np.int32), np.cumsum(found.value_lengths().to_numpy())
        texts += np.split(ids, ends[:-1]) if len(ends) else []
        labels += b.column("label").to_pylist()
    m = fit(texts, np.array(labels, float))
    known = np.flatnonzero(m.known)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate(([-1], known)).astype(np.int32)), pa.array(np.concatenate((m.w0, m.w[known]))),
         pa.array([[0.0] * FACTORS, *m.v[known].tolist()], pa.list_(pa.float64()))], schema=_MODEL)


def train(docs: DataFrame, labels: DataFrame, *, rows: int = TRAIN_ROWS, folds: int = FOLDS) -> list[tuple]:
    """(bucket, weight, vector) of each term with weights; bucket -1 holds the bias.

    Learns from at most ``rows`` labelled documents, chosen by a hash of their
    ids, among those whose crc32(doc_id as text) mod ``folds`` is not 0.  A
    doc_id labelled twice is toxic if one label says so; null labels are left out.
    Rows that repeat a doc_id are one example, with one of their texts.
    """
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    marked = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("toxic").cast("int").alias("label"), fold.alias("fold"))
              .filter("label is not null and fold <> 0").groupBy("_id").agg(F.max("label").alias("label")))
    chosen = written(marked.withColumn("order", F.xxhash64("_id")).orderBy("order", "_id").limit(rows), "tx-sample")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("_text"))
    picked = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))  # at most ``rows`` ids
    examples = picked.select("_id", "order", "label", "_text").mapInArrow(_featurise, "_id long, order long, label int, terms array<int>")
    # rows that repeat an id are one example, so that ``rows`` bounds what the one task gets
    one = F.min(F.struct(F.xxhash64("terms").alias("h"), "terms")).alias("t")
    examples = examples.groupBy("_id", "order", "label").agg(one).select("order", "label", "t.terms")
    model = (examples.repartition(1).sortWithinPartitions("order", "label", F.hash("terms"))
             .mapInArrow(_fit, "bucket int, w double, v array<double>"))
    return [tuple(r) for r in model.collect()]


_machines: dict[str, Machine] = {}  # the last one that this worker used


def _machine(name: str, rows: list[tuple]) -> Machine:
    if name not in _machines:
        _machines.clear()
        m = Machine()
        for bucket, w, v in rows:
            if bucket < 0:
                m.w0[0] = w
            else:
                m.known[bucket], m.w[bucket], m.v[bucket] = True, w, v
        _machines[name] = m
    return _machines[name]


def _score(model, column: str):
    def run(batches):
        m, memo = _machine(*model.value), Terms()
        for b in slices(batches, "text"):
            found = [terms((t or "").encode("utf-8", "surrogatepass"), memo) for t in b.column("text").to_pylist()]
            if len(memo) > 150_000:
                memo.clear()
            s = 1 / (1 + np.exp(-np.clip(m.raw(found), -30, 30)))
            names = b.schema.names
            kept = [n for n in names if n != column]
            yield pa.RecordBatch.from_arrays([b.column(n) for n in kept] + [pa.array(s)], names=kept + [column])
    return run


def with_scores(docs: DataFrame, labels: DataFrame, *, column: str = "toxicity", rows: int = TRAIN_ROWS, folds: int = FOLDS) -> DataFrame:
    """``docs`` plus ``column``: a score from 0 to 1, higher if label 1 is likelier.

    Whole texts are scored; a null or empty text has no terms and gets the
    bias's score.  Without any label every score is 0.5.  Repeated rows get
    equal scores; other columns pass through, but for an existing ``column``,
    which is replaced.
    """
    found = train(docs, labels, rows=rows, folds=folds)
    model = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, found))  # BUCKETS rows at most
    docs = docs.drop(column)
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])
    return docs.mapInArrow(_score(model, column), schema)
