"""Near-duplicate documents by MinHash.

A document is the set of its distinct five-word shingles.  ``HASHES`` universal
hash functions give each set its minima; bands of ``ROWS`` minima are bucket
keys, and documents that share a bucket are candidates: at similarity 0.75 a
pair shares none of the 64 buckets with probability 4e-6.

All pairs of a bucket are never listed.  Each bucket first links its members
to its smallest one; these pairs are verified (minima first, then the full
sets) and connected components are formed.  Only buckets whose members are
still in different components need more: there members of different components
compare their minima inside a task, which tells the components that can be
linked at all; the members of those are then compared on their full sets, again
inside tasks of bounded size.  Both steps give a forest over components, never
the pairs.  So a group of near copies costs one pair per member, and no link
between candidates is lost.

A large bucket of many components (documents made from one template, say) would
make all its members meet.  There a second index takes its place: a set's
shingles in order of rarity, of which two linked sets must share one among the
first quarter (prefix filter).  A shingle's place bounds the overlap from there
on, so rows that cannot reach similarity 0.75 with the shortest set beside them
are dropped before any two documents meet, which needs no link to be lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankdelta.llm.common import fitting, release, utf8, written
from rankdelta.llm.components import components

WORDS = 5
BANDS, ROWS = 64, 6
HASHES = BANDS * ROWS
SKETCH = 192            # minima kept, as one byte each, to verify signatures
PASS = 0.57             # estimate that a pair must reach: 5.8 standard errors under 0.75
BLOCK = 2048            # members of a bucket that are compared at a time
CROWDED = 256           # members of a mixed bucket from which on rare shingles take its place
BROADCAST_ROWS = 2_000_000
MIX1, MIX2, POLY = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word -> 64-bit hash, looked up once per distinct word of a batch."""

    def __missing__(self, word):
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes, words: WordHashes, k: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    found = text.lower().split()
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(words.__getitem__, found), np.uint64, n)
    size = min(n, k)
    h = np.full(n - size + 1, size, np.uint64)  # a shorter sequence never equals a full shingle
    for i in range(size):
        h = h * POLY + w[i: n - size + 1 + i]
    return np.unique(_mixed(h))


def hash_functions(seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)), rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def minima(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(documents, HASHES) minima of a*x+b mod 2^32 over each set; sets are not empty."""
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    out, buf = np.empty((HASHES, len(sets)), np.uint32), np.empty_like(x)
    for i in range(HASHES):
        np.multiply(x, a[i], out=buf)
        np.add(buf, b[i], out=buf)
        np.minimum.reduceat(buf, starts, out=out[i])
    return out.T


def band_keys(m: np.ndarray) -> np.ndarray:
    rows = m.reshape(len(m), BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for i in range(ROWS):
        h = h * POLY + rows[:, :, i] + np.uint64(1)
    return _mixed(h).view(np.int64)


def sketches(m: np.ndarray) -> np.ndarray:
    return ((m[:, ::2][:, :SKETCH] * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8)


SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()),
                    ("sketch", pa.binary()), ("bands", pa.list_(pa.int64()))])
SIGNED_DDL = "doc_id long, n_shingles long, set_key binary, sketch binary, bands array<long>"
CHUNK = 1 << 15  # shingles hashed at a time: they stay in the processor's cache


def _sign(batches):
    a, b = hash_functions()
    words, seen = WordHashes(), set()

    def signed(rows):
        """Rows with a doc_id whose set is new to this task get minima, others only their key."""
        fresh, held = [], set()
        for doc, s, key in rows:
            if doc is not None and len(s) and key not in seen and key not in held:
                fresh.append((s, key))
                held.add(key)
        sketch = bands = {}
        if fresh:
            m = minima([s for s, _ in fresh], a, b)
            sketch = {k: x.tobytes() for (_, k), x in zip(fresh, sketches(m), strict=True)}
            bands = {k: x for (_, k), x in zip(fresh, band_keys(m), strict=True)}
            seen.update(held)
        out = []
        for doc, s, key in rows:
            out.append({"doc_id": doc, "n_shingles": len(s), "set_key": key if len(s) else None,
                        "sketch": sketch.pop(key, None) if len(s) and doc is not None else None,
                        "bands": bands.pop(key, None) if len(s) and doc is not None else None})
        return out

    for batch in batches:
        rows, held, out = [], 0, []
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("_text"), strict=True):
            s = shingles(text.as_py(), words)
            rows.append((doc, s, xxhash.xxh3_128_digest(s.tobytes())))
            held += len(s)
            if held >= CHUNK:
                out += signed(rows)
                rows, held = [], 0
            if len(words) > 300_000:
                words.clear()
        out += signed(rows)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=SIGNED)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, sketch, bands); a task gives minima once per distinct set."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text")).alias("_text"))
    return rows.mapInArrow(_sign, SIGNED_DDL)


def _alike(batches):
    for b in batches:
        if not b.num_rows:
            continue
        x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, SKETCH) for c in ("sketch_a", "sketch_b"))
        same = (x == y).mean(axis=1)
        keep = (same - 1 / 256) / (1 - 1 / 256) >= PASS
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(same)], ["a", "b", "same"]).filter(pa.array(keep))


def _sets(batches):
    words = WordHashes()
    for batch in batches:
        out = []
        for text in batch.column("_text"):
            s = shingles(text.as_py(), words)
            # 48 bits tell the shingles of two documents apart
            out.append(np.unique(s >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes())
            if len(words) > 300_000:
                words.clear()
        yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.binary())], ["node", "shingles"])


def _set(raw: bytes) -> np.ndarray:
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return wide.view(np.uint64).ravel()


def _linked(batches):
    for b in batches:
        keep = []
        for x, y in zip(b.column("set_a"), b.column("set_b"), strict=True):
            x, y = _set(x.as_py()), _set(y.as_py())
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= 75 * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def full_sets(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, shingles): the full sets of the given documents, made from their texts."""
    nodes = fitting(nodes.distinct(), BROADCAST_ROWS, "nd-nodes")  # ids only
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), utf8(F.col("text")).alias("_text"))
    return written(texts.join(nodes, "node", "left_semi").mapInArrow(_sets, "node long, shingles binary"), "nd-sets")


def verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full shingle sets are linked."""
    sets = full_sets(pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))), docs)
    one = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    two = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    return pairs.select("a", "b").join(one, "b").join(two, "a").mapInArrow(_linked, "a long, b long").distinct()


class _Sets:
    """Union-find over component ids."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = x = self.up.get(y, y)
        return x

    def union(self, x: int, y: int) -> None:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


def _compare(full: bool):
    """Within each (grp, cell): pairs of different components whose sketches agree enough.

    Emits a forest only, in ids of components: a pair whose components already
    hang together through earlier pairs of the cell says nothing new.  ``full``:
    pairs must be linked on their full sets, not only agree on sketches.
    """
    def forest(rows):
        comp = [r[1] for r in rows]
        size = np.array([r[2] for r in rows], np.int64)
        sk = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(-1, SKETCH)
        sets = [_set(r[4]) for r in rows] if full else []
        joined, out = _Sets(), []
        for i in range(len(rows) - 1):
            roots = np.array([joined.find(c) for c in comp[i:]], np.int64)
            j = np.flatnonzero((roots != roots[0]) & (4 * size[i:] >= 3 * size[i]) & (4 * size[i] >= 3 * size[i:])) + i
            if not len(j):
                continue
            same = (sk[j] == sk[i]).mean(axis=1)
            j = j[(same - 1 / 256) / (1 - 1 / 256) >= PASS]
            if full and len(j):
                lengths = np.array([len(sets[k]) for k in j])
                flat = np.concatenate([sets[k] for k in j])
                at = np.searchsorted(sets[i], flat).clip(max=len(sets[i]) - 1)
                both = np.add.reduceat((sets[i][at] == flat).astype(np.int64), np.concatenate(([0], np.cumsum(lengths)[:-1])))
                j = j[100 * both >= 75 * (len(sets[i]) + lengths - both)]
            for k in j.tolist():
                if joined.find(comp[i]) != joined.find(comp[k]):
                    joined.union(comp[i], comp[k])
                    out.append((comp[i], comp[k]))
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])

    columns = ["grp", "cell", "node", "component", "n_shingles", "sketch", *(["shingles"] if full else [])]

    def run(batches):
        key, rows = None, []
        for batch in batches:
            for g, cell, *row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if key != (g, cell):
                    if len(rows) > 1:
                        yield forest(rows)
                    key, rows = (g, cell), []
                rows.append(row)
        if len(rows) > 1:
            yield forest(rows)
    return run


def _cells(rows: DataFrame, block: int) -> DataFrame:
    """Members of a group dealt into cells of about ``block``, so that each pair to compare meets in one.

    The members of the group's largest component need not meet each other: only
    the others (usually few) are paired with all.
    """
    half = block // 2
    per = rows.groupBy("grp", "component").agg(F.count(F.lit(1)).alias("n"))
    top = (per.groupBy("grp").agg(F.max(F.struct("n", "component")).alias("_top"), F.sum("n").alias("_all"))
           .filter("_all > _top.n").select("grp", F.col("_top.component").alias("_big"), "_all",
                                           F.ceil(F.col("_top.n") / half).alias("_kb"), F.ceil((F.col("_all") - F.col("_top.n")) / half).alias("_ks")))
    rows = rows.join(top, "grp")
    h = F.abs(F.xxhash64("node") % F.lit(1 << 40))
    small, q = h % F.col("_ks"), h % F.col("_kb")
    others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_ks") - 1),
                         lambda x: F.least(x, small) * F.col("_ks") + F.greatest(x, small))
    base = F.col("_ks") * F.col("_ks")
    with_big = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_kb") - 1), lambda x: base + small * F.col("_kb") + x)
    of_big = F.transform(F.sequence(F.lit(0).cast("long"), F.col("_ks") - 1), lambda x: base + x * F.col("_kb") + q)
    cell = (F.when(F.col("_all") <= block, F.array(F.lit(0).cast("long")))
            .when(F.col("component") == F.col("_big"), of_big).otherwise(F.concat(others, with_big)))
    return rows.withColumn("cell", F.explode(cell)).drop("_big", "_all", "_kb", "_ks")


def _exploded(batches):
    for b in batches:
        sets = [_set(x.as_py()) for x in b.column("shingles")]
        for i in range(0, len(sets), 256):
            part = sets[i: i + 256]
            n = [len(s) for s in part]
            node, key = (np.repeat(np.array(b.column(c).slice(i, len(part))), n) for c in ("node", "set"))
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(key), pa.array(np.repeat(n, n)), pa.array(np.concatenate(part).view(np.int64))],
                                             ["node", "set", "n", "token"])


def rare_groups(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(grp, node, component): groups in which the linked sets of ``nodes`` (node, component) meet.

    Sets at similarity 0.75 overlap in at least three quarters of each, so they
    share one of the first ``n - ceil(3n/4) + 1`` shingles in any common order;
    here it is the order of rarity among ``nodes``.  If x has that shingle at place
    i of n, the overlap is at most u = n - i, and 7 * min(ux, uy) >= 3 * (nx + ny)
    has to hold: a row for which no length in its group is short enough goes.
    Shingles of one node are counted, not moved.
    """
    # a doc_id may have several texts, each a set of its own
    sets = full_sets(nodes.select("node"), docs).distinct().withColumn("set", F.xxhash64("shingles"))
    tokens = written(sets.mapInArrow(_exploded, "node long, set long, n long, token long"), "nd-tokens")
    df = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    shared = tokens.join(df.filter("df > 1"), "token")
    per = shared.groupBy("node", "set", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("order"))
    alone = F.col("n") - F.size("order")  # they come first
    prefix = F.floor(F.col("n") / 4).cast("long") + 1
    first = F.slice("order", 1, F.greatest(prefix - alone, F.lit(0)).cast("int"))
    rows = per.select("node", "n", alone.alias("alone"), F.posexplode(first).alias("i", "t"))
    rows = rows.select("node", "n", (F.col("n") - F.col("alone") - F.col("i")).alias("u"), F.col("t.token").alias("grp"))
    rows = written(rows.join(nodes, "node"), "nd-prefixes")
    group = rows.groupBy("grp").agg(F.min("n").alias("least"), F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    kept = rows.join(group.select("grp", "least"), "grp").filter("7 * u >= 3 * (n + least)")
    return kept.select("grp", "node", "component")


def _dealt(cells: DataFrame) -> DataFrame:
    return cells.repartition("grp", "cell").sortWithinPartitions("grp", "cell", "node")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text with A-Z lower-cased; a
    text of fewer than five words is one shingle.  A text without words (null,
    empty) is linked with nothing.  Rows that share a doc_id are one document,
    whatever their texts.  Rows without doc_id take no part: component_id is
    null and they are kept.  Other columns are not read; an empty table gives
    no rows.
    """
    signed = written(signatures(docs), "nd-signatures")
    some = signed.filter("doc_id is not null and n_shingles > 0")
    # copies: every holder of a set is linked to the set's smallest doc_id
    low = some.groupBy("set_key").agg(F.min("doc_id").alias("low"))
    copies = some.select("set_key", "doc_id").join(low, "set_key").filter("doc_id <> low")
    links = written(copies.select(F.col("doc_id").alias("a"), F.col("low").alias("b")).distinct(), "nd-links")

    have = some.filter("sketch is not null")
    members = have.select(F.explode("bands").alias("bucket"), F.col("doc_id").alias("node"))
    stars = members.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("top")).filter("leader < top")
    # only buckets of several documents go on
    shared = written(members.join(stars.drop("top"), "bucket"), "nd-buckets")
    # copies lie in stars already: their smallest holder is their component so far
    marks = links.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    star = shared.filter("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct()
    star = _apart(star, marks)
    one = have.select("doc_id", "sketch", "n_shingles").distinct()
    passed = written(
        star.join(one.select(F.col("doc_id").alias("a"), F.col("sketch").alias("sketch_a")), "a")
        .join(one.select(F.col("doc_id").alias("b"), F.col("sketch").alias("sketch_b")), "b")
        .mapInArrow(_alike, "a long, b long, same double"), "nd-passed")
    # first the likeliest leader of each document: that joins nearly all groups
    first = passed.groupBy("b").agg(F.max_by("a", F.struct("same", -F.col("a"))).alias("a")).select("a", "b")
    linked = written(links.union(verified(first, docs)), "nd-links")
    release(links, passed)
    links = linked
    marks = components(links)

    # buckets that still hold several components: which components can be linked at all?
    labelled = shared.select(F.col("bucket").alias("grp"), "node").join(marks, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (labelled.groupBy("grp").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("size"))
             .filter("lo < hi").select("grp", "size"))
    open_ = written(labelled.join(mixed, "grp"), "nd-open")
    crowd = open_.filter(F.col("size") > CROWDED).select("node", "component").distinct()
    open_ = open_.filter(F.col("size") <= CROWDED).select("grp", "node", "component")
    if crowd.take(1):
        open_ = written(open_.unionByName(rare_groups(written(crowd, "nd-crowd"), docs)), "nd-open")
    some_open = open_.select("node").distinct().join(one.withColumnRenamed("doc_id", "node"), "node")
    likely = (_dealt(_cells(open_.join(some_open, "node"), BLOCK)).mapInArrow(_compare(False), "a long, b long"))
    clusters = components(likely)
    # their members meet in cells of their cluster and are compared on the full sets
    members = (open_.select("node", "component").distinct()
               .join(clusters.select(F.col("node").alias("component"), F.col("component").alias("grp")), "component"))
    members = written(members, "nd-members")
    if members.take(1):
        full = members.join(some_open, "node").join(full_sets(members.select("node"), docs), "node")
        more = written(_dealt(_cells(full, BLOCK // 2)).mapInArrow(_compare(True), "a long, b long"), "nd-more")
        if more.take(1):
            marks = components(links.union(more))
        release(more)
    release(shared, open_, members, links)

    out = signed.select("doc_id", "n_shingles").join(
        marks.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
                      F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"))


def _apart(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """Pairs (a, b) that are not in one component."""
    ca = marks.select(F.col("node").alias("a"), F.col("component").alias("_ca"))
    cb = marks.select(F.col("node").alias("b"), F.col("component").alias("_cb"))
    both = pairs.join(ca, "a", "left").join(cb, "b", "left")
    return both.filter(F.coalesce("_ca", "a") != F.coalesce("_cb", "b")).select("a", "b")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group of near duplicates (the smallest doc_id).

    Rows that repeat a doc_id go or stay together; rows without doc_id, and texts
    without words, stay; an empty table gives no rows.  All columns pass through,
    whatever their names.
    """
    gone = near_duplicates(docs).filter(~F.col("kept")).select(F.col("doc_id").alias("id")).distinct()
    gone = fitting(gone, BROADCAST_ROWS, "nd-gone")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["id"], "left_anti")
