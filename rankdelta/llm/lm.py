"""Language-model scores: a log-bilinear model trained with noise-contrastive estimation.

Tokens are words and one end per text.  The ``CLASSES`` - 2 most frequent words
and the end are outcomes of their own; all other words share one outcome and
are told apart by their smoothed frequency, so the model is a proper
distribution over all words, unseen ones included.

The context is the two classes before.  Each has a vector per position, their
sum predicts the next class: s(h, w) = (r1[h1] + r2[h2]) . q[w] + b[w].
Training (numpy, in Spark tasks) never normalises: it tells each token from
noise drawn by frequency, one shared set of noise classes per batch.  Every task
trains on all training texts of its partition from the same start; Spark
averages the parameters, weighted by tokens, and the next round starts there.

For scoring the normaliser of every context comes from one matrix product:
sum_w exp(a1[h1, w]) exp(a2[h2, w] + b[w]) with a1 = r1 q', a2 = r2 q'.  A token
then costs three table look-ups.

Word counts are a Spark aggregate over all training texts.  Counts of the
``HEAD`` most frequent words are broadcast (a fixed number of rows); the rest of
the vocabulary grows with the corpus and is joined.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankdelta.llm.common import row_key, slices, utf8, written

CLASSES = 2048
HEAD = 65_536
DIM = 32
ROUNDS = 1
BATCH = 2048
CHUNK = 1 << 19        # tokens that a task trains on at a time
NOISE, RATIO = 128, 16.0
RATE = 0.1
ADD = 0.1
RARE, EDGE = 0, 1      # class of all other words; the end, and what stands before a text
END = b""              # no word is empty


# --- the model ---------------------------------------------------------------

def initial(log_p: np.ndarray, seed: int = 7) -> list[np.ndarray]:
    """r1, r2, q, b; the biases start at the log frequencies."""
    rng = np.random.default_rng(seed)
    k = len(log_p)
    return [(rng.standard_normal((k, DIM)) * 0.1).astype(np.float32) for _ in range(3)] + [log_p.astype(np.float32)[:, None].copy()]


def _by_row(index: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the rows of each distinct index."""
    order = np.argsort(index, kind="stable")
    ids = index[order]
    first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    return ids[first], np.add.reduceat(rows[order], first, axis=0)


class Trainer:
    """Adagrad on the NCE objective, batch by batch."""

    def __init__(self, params: list[np.ndarray], p: np.ndarray, rate: float, seed: int):
        self.params = [x.copy() for x in params]
        self.power = [np.full_like(x, 1.0) for x in params]
        self.rate, self.rng = rate, np.random.default_rng(seed)
        self.cum = np.cumsum(p) / p.sum()
        self.shift = np.log(RATIO * p / p.sum()).astype(np.float32)

    def _move(self, which: int, index: np.ndarray, rows: np.ndarray) -> None:
        at, g = _by_row(index, rows)
        self.power[which][at] += g * g
        self.params[which][at] += self.rate * g / np.sqrt(self.power[which][at])

    def step(self, h1: np.ndarray, h2: np.ndarray, w: np.ndarray, n: np.ndarray) -> None:
        """One batch of distinct (h1, h2, w), each seen ``n`` times."""
        r1, r2, q, b = self.params
        noise = np.searchsorted(self.cum, self.rng.random(NOISE), side="right").clip(max=len(q) - 1)
        r, qw, qn = r1[h1] + r2[h2], q[w], q[noise]
        real = np.einsum("ij,ij->i", r, qw) + b[w, 0] - self.shift[w]
        fake = r @ qn.T + (b[noise, 0] - self.shift[noise])
        g = n / (1 + np.exp(np.minimum(real, 60)))                      # 1 - sigmoid
        f = (np.float32(-RATIO / NOISE) * n)[:, None] / (1 + np.exp(np.minimum(-fake, 60)))
        dr = g[:, None] * qw + f @ qn
        rows = np.concatenate((w, noise))
        self._move(2, rows, np.concatenate((g[:, None] * r, f.T @ r)))
        self._move(3, rows, np.concatenate((g, f.sum(axis=0)))[:, None])
        self._move(0, h1, dr)
        self._move(1, h2, dr)

    def fit(self, h1: np.ndarray, h2: np.ndarray, w: np.ndarray) -> None:
        """All tokens once; those that agree in context and class are one example with a weight."""
        k = len(self.shift)
        key, n = np.unique((h1.astype(np.int64) * k + h2) * k + w, return_counts=True)
        order = self.rng.permutation(len(key))
        key, n = key[order], n[order].astype(np.float32)
        for i in range(0, len(key), BATCH):
            x = key[i: i + BATCH]
            self.step(x // (k * k), x // k % k, x % k, n[i: i + BATCH])


class Tables:
    """Log10 probabilities of classes for all contexts."""

    def __init__(self, params: list[np.ndarray]):
        r1, r2, q, b = params
        self.a1, self.a2 = r1 @ q.T, r2 @ q.T + b[:, 0]
        m1, m2 = self.a1.max(axis=1, keepdims=True), self.a2.max(axis=1, keepdims=True)
        right = np.exp(self.a2 - m2).T
        self.z = np.empty((len(r1), len(r1)), np.float32)
        for i in range(0, len(r1), 256):  # a block of contexts at a time
            total = np.exp(self.a1[i: i + 256] - m1[i: i + 256]) @ right
            self.z[i: i + 256] = np.log(total) + m1[i: i + 256] + m2.T
        for x in (self.a1, self.a2, self.z):
            x /= np.float32(math.log(10))

    def log10(self, h1: np.ndarray, h2: np.ndarray, w: np.ndarray) -> np.ndarray:
        return self.a1[h1, w].astype(np.float64) + self.a2[h2, w] - self.z[h1, h2]


# --- tokens -------------------------------------------------------------------

def tokens(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then the end."""
    found = text.lower().split()
    found.append(END)
    return found


def classed(texts: list[list[bytes]], classes: dict[bytes, int]):
    """(h1, h2, w, starts) of all tokens of the texts, one after the other."""
    lengths = np.array([len(t) for t in texts])
    starts = np.concatenate(([0], np.cumsum(lengths)))
    w = np.fromiter(map(classes.get, itertools.chain.from_iterable(texts), itertools.repeat(RARE)), np.int32, int(starts[-1]))
    h1 = np.empty_like(w)
    h1[1:] = w[:-1]
    h1[starts[:-1]] = EDGE
    h2 = np.empty_like(w)
    h2[2:] = w[:-2]
    h2[starts[:-1]] = EDGE
    second = starts[:-1][lengths > 1] + 1
    h2[second] = EDGE
    return h1, h2, w, starts


# --- Spark side -----------------------------------------------------------------

def keyed(docs: DataFrame, folds: int) -> DataFrame:
    """(doc_id, th, held_out, _text); a row without doc_id is never learned from."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("th"),
                       F.coalesce(fold == 0, F.lit(True)).alias("held_out"), utf8(F.col("text")).alias("_text"))


def _count(batches):
    held: Counter = Counter()

    def emit():
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for b in slices(batches, "_text"):
        for text in b.column("_text").to_pylist():
            held.update(text.lower().split())
        held[END] += b.num_rows
        if len(held) > 250_000:
            yield emit()
            held = Counter()
    if held:
        yield emit()


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c) over all training texts; the end is the empty word."""
    found = rows.filter("not held_out").select("_text").mapInArrow(_count, "word binary, n long")
    return written(found.groupBy("word").agg(F.sum("n").alias("c")), "lm-counts")


PARAMS = pa.schema([("part", pa.int32()), ("row", pa.int32()), ("weight", pa.float64()), ("v", pa.list_(pa.float32()))])


def _train(shared, rate: float, seed: int):
    def run(batches):
        classes, p, params = shared.value
        trainer, seen, held, size = Trainer(params, p, rate, seed), 0, [], 0
        for b in slices(batches, "_text"):
            for text in b.column("_text").to_pylist():
                held.append(tokens(text))
                size += len(held[-1])
                if size >= CHUNK:
                    trainer.fit(*classed(held, classes)[:3])
                    seen, held, size = seen + size, [], 0
        if held:
            trainer.fit(*classed(held, classes)[:3])
            seen += size
        if seen:
            for part, values in enumerate(trainer.params):
                rows = len(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(rows, part, np.int32)), pa.array(np.arange(rows, dtype=np.int32)), pa.array(np.full(rows, float(seen))),
                     pa.array(list(values), pa.list_(pa.float32()))], schema=PARAMS)
    return run


def train(rows: DataFrame, classes: dict[bytes, int], p: np.ndarray, rounds: int = ROUNDS, rate: float = RATE) -> list[np.ndarray]:
    """Parameters after ``rounds`` passes over all training texts; CLASSES rows reach the driver."""
    sc = rows.sparkSession.sparkContext
    params = initial(np.log(np.maximum(p, 1e-12) / max(p.sum(), 1e-12)))
    for r in range(rounds):
        shared = sc.broadcast((classes, p, params))
        found = rows.filter("not held_out").select("_text").mapInArrow(
            _train(shared, rate / (r + 1), r), "part int, row int, weight double, v array<float>")
        mean = [(F.sum(F.col("weight") * F.get("v", F.lit(i))) / F.sum("weight")).alias(f"v{i}") for i in range(DIM)]
        for x in found.groupBy("part", "row").agg(*mean).collect():
            width = params[x["part"]].shape[1]
            params[x["part"]][x["row"]] = x[2: 2 + width]
        shared.unpersist()
    return params


def _rare_words(shared):
    """(word, doc_id, th, n): words beyond the broadcast ones, once per text.

    Rows that repeat share their key, so each text also gives one row with n -1
    under a word that no text holds; their number tells how often it repeats.
    """
    def run(batches):
        head = shared.value
        for b in slices(batches, "_text"):
            words, docs, ths, ns = [], [], [], []
            for doc, th, text in zip(*(b.column(c).to_pylist() for c in ("doc_id", "th", "_text")), strict=True):
                n = Counter(text.lower().split())
                rest = [w for w in n if w not in head]
                if not rest:
                    continue
                words += rest
                words.append(b"\n%d" % th)
                ns += map(n.__getitem__, rest)
                ns.append(-1)
                docs += [doc] * (len(rest) + 1)
                ths += [th] * (len(rest) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(docs, pa.int64()), pa.array(ths, pa.int64()),
                                              pa.array(ns, pa.int64())], ["word", "doc_id", "th", "n"])
    return run


_tables: dict[str, Tables] = {}  # of the last model that this worker used

SCORES = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                    ("known", pa.int64()), ("base", pa.float64()), ("model", pa.float64())])
SCORES_DDL = "doc_id long, th long, held_out boolean, n_tokens long, known long, base double, model double"


def _score(model, head, n_train: float, n_words: float, rare_mass: float):
    """Sums over the tokens whose counts are broadcast; rare tokens count their class only."""
    def run(batches):
        classes, name, params = model.value
        if name not in _tables:
            _tables.clear()
            _tables[name] = Tables(params)
        table, counts = _tables[name], head.value
        logs = {w: math.log10((c + ADD) / (n_train + ADD * (n_words + 1))) for w, c in counts.items()}
        log_mass = math.log10(rare_mass) if rare_mass > 0 else 0.0
        for b in slices(batches, "_text", 2 << 20):
            texts = [tokens(t) for t in b.column("_text").to_pylist()]
            h1, h2, w, starts = classed(texts, classes)
            total = int(starts[-1])
            flat = list(itertools.chain.from_iterable(texts))
            base = np.fromiter(map(logs.get, flat, itertools.repeat(math.nan)), np.float64, total)
            known = ~np.isnan(base)
            base[~known] = 0.0
            seen = known.copy()
            if counts.get(END) == 0:
                seen[starts[1:] - 1] = False
            # a rare word is its class and its share of the class
            model_log = table.log10(h1, h2, w) + np.where(w == RARE, base - log_mass, 0.0)
            cut = starts[:-1]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("th"), b.column("held_out"), pa.array(np.diff(starts)),
                 pa.array(np.add.reduceat(seen.astype(np.int64), cut)), pa.array(np.add.reduceat(base, cut)),
                 pa.array(np.add.reduceat(model_log, cut))], schema=SCORES)
    return run


def scores(docs: DataFrame, *, folds: int = 10, classes: int = CLASSES, head: int = HEAD, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    Learned from texts whose crc32(doc_id as text) mod ``folds`` is not 0; rows
    without doc_id are held out.  A null or empty text is its end alone.
    Repeated rows are texts like others.  If nothing is learned from, every
    token is unknown and the model is uniform over its classes.  Other columns
    are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = keyed(docs, folds)
    counts = word_counts(rows)
    n_train, n_words = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    # a fixed number of rows, the most frequent words first
    top = {bytes(r["word"]): r["c"] for r in counts.orderBy(F.desc("c"), "word").limit(head).collect()}
    ends = counts.filter(F.col("word") == F.lit(END)).select("c").first()
    top[END] = ends["c"] if ends else 0
    order = sorted((w for w in top if w != END), key=lambda w: (-top[w], w))[: classes - 2]
    index = {END: EDGE} | {w: i + 2 for i, w in enumerate(order)}
    p = np.zeros(classes)
    for w, i in index.items():
        p[i] = top[w]
    p[RARE] = n_train - p.sum()
    p = p[: len(index) + 1]  # a small vocabulary has fewer classes
    p = np.maximum(p, 0.5)
    params = train(rows, index, p, rounds)

    whole = n_train + ADD * (n_words + 1)
    shortlist_mass = sum((top[w] + ADD) / whole for w in index)
    rare_mass = max(1.0 - shortlist_mass, ADD / whole)
    sc = spark.sparkContext
    model, heads = sc.broadcast((index, uuid.uuid4().hex, params)), sc.broadcast(top)
    one = rows.mapInArrow(_score(model, heads, n_train, n_words, rare_mass), SCORES_DDL)

    tail = rows.select("doc_id", "th", "_text").mapInArrow(_rare_words(heads), "word binary, doc_id long, th long, n long")
    c = F.coalesce("c", F.lit(0))
    share = F.log10((c + F.lit(ADD)) / F.lit(whole))
    n = F.greatest(F.col("n"), F.lit(0))
    times = F.sum((F.col("n") < 0).cast("long"))
    tails = (tail.join(counts, "word", "left")
             .groupBy("doc_id", "th").agg((F.sum(n * (c > 0).cast("long")) / times).cast("long").alias("tail_known"),
                                          (F.sum(n * share) / times).alias("tail_base"))
             .withColumnsRenamed({"doc_id": "_d", "th": "_t"}))
    both = one.join(tails, (F.col("th") == F.col("_t")) & F.col("doc_id").eqNullSafe(F.col("_d")), "left")
    more = F.coalesce("tail_base", F.lit(0.0))
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"), (F.col("base") + more).alias("base_score"),
        (F.col("model") + more).alias("score"))
