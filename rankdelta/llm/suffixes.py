"""Removal of long repeated substrings by a hash-compared suffix sort.

Two equal strings of ``LENGTH`` bytes hold the same smallest ``GRAM``-byte
fingerprint at the same distance from their starts, so every string of that
length (a window) belongs to exactly one anchor: the position of its smallest
fingerprint.  Only anchors with equal fingerprints can have equal windows, and
a window start is a distance ``d`` to the left of its anchor.

1. Each task finds its documents' anchors with prefix polynomial hashes.
2. Anchors with equal fingerprint *and* equal surroundings (all their windows)
   are copies; all their windows repeat.  Counting them needs no text.
3. What is left, one of each distinct surroundings, is sorted per fingerprint:
   the suffixes to the right and the reversed prefixes to the left, by a
   mergesort that compares two suffixes in logarithmic time (binary search over
   prefix hashes finds their common extension).  The common lengths of
   neighbours are verified on the bytes; a hash collision sends the batch to a
   plain byte sort.  Windows at ``d`` are equal if the left parts agree for d
   bytes and the right parts for LENGTH - d, which the sorted orders answer
   for all d.
4. Covered bytes are cut out where the documents are.

A fingerprint with more than ``CROWD`` distinct surroundings is not sorted in
one task: its windows are counted by hash, spread over all tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankdelta.llm.common import row_key, slices, utf8, written

LENGTH, GRAM = 400, 100
SEGMENT = 1 << 20
CROWD = 20_000
SORTED_AT_ONCE = 8_000
BROADCAST_ROWS = 1_000_000
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
MIX = np.uint64(0xD6E8FEB86659FD93)
LOW = np.uint64((1 << 24) - 1)


# --- anchors ---------------------------------------------------------------

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^j and BASE^-j mod 2^64 for j < n."""
    if len(_powers.get("up", ())) < n:
        inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
        for name, b in (("up", BASE), ("down", inverse)):
            p = np.full(n, b, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"][:n], _powers["down"][:n]


def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values, in linear time."""
    n = len(v) - width + 1
    padded = np.full(-(-len(v) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(v)] = v
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1: width - 1 + n])


def anchors(data: np.ndarray, ends: np.ndarray, length: int, gram: int):
    """(anchor, first window start, last window start, fingerprint) over documents laid end to end.

    ``ends[k]``: where document k ends; windows do not cross it.
    """
    found = []
    for s in range(0, max(len(data) - length + 1, 0), SEGMENT):
        part = data[s: s + SEGMENT + length - 1]
        n = len(part) - length + 1  # window starts of this segment
        up, down = powers(SEGMENT + length)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        prints = (sums[gram:] - sums[:-gram]) * down[: len(part) - gram + 1]
        order = prints ^ (prints >> np.uint64(29))
        order *= MIX
        order ^= order >> np.uint64(32)
        order = (order & ~LOW) | np.arange(len(order), dtype=np.uint64)
        at = (sliding_min(order, length - gram + 1) & LOW).astype(np.int64)
        starts = np.arange(n)
        end = ends[np.searchsorted(ends, s + starts, side="right")]
        ok = s + starts + length <= end
        run = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | ~ok[:-1] | ~ok[1:])))
        last = np.append(run[1:], n) - 1
        keep = ok[run]
        run, last = run[keep], last[keep]
        found.append(np.stack([s + at[run], s + run, s + last, prints[at[run]].view(np.int64)]))
    return np.concatenate(found, axis=1) if found else np.empty((4, 0), np.int64)


ANCHORS = pa.schema([("fp", pa.int64()), ("ctx", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()),
                     ("a", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32())])
ANCHORS_DDL = "fp long, ctx long, doc_id long, th long, a int, lo int, hi int"


def _find(length: int, gram: int):
    def run(batches):
        for b in slices(batches, "_text", SEGMENT):
            texts = b.column("_text").to_pylist()
            ends = np.cumsum([len(t) for t in texts])
            raw = b"".join(texts)
            a, lo, hi, fp = anchors(np.frombuffer(raw, np.uint8), ends, length, gram)
            if not len(a):
                continue
            doc = np.searchsorted(ends, lo, side="right")
            base = ends[doc] - np.array([len(t) for t in texts])[doc]
            ctx = np.fromiter((xxhash.xxh3_64_intdigest(raw[x: y + length], seed=z - x) for x, y, z in
                               zip(lo.tolist(), hi.tolist(), a.tolist(), strict=True)), np.uint64, len(a)).view(np.int64)
            index = pa.array(doc)
            yield pa.RecordBatch.from_arrays(
                [pa.array(fp), pa.array(ctx), b.column("doc_id").take(index), b.column("th").take(index),
                 *(pa.array((x - base).astype(np.int32)) for x in (a, lo, hi))], schema=ANCHORS)
    return run


# --- suffix sort -------------------------------------------------------------

class Strings:
    """Strings of bounded length with the hashes of all their prefixes."""

    def __init__(self, parts: list[bytes], width: int):
        self.size = np.array([len(p) for p in parts], np.int64)
        self.data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(len(parts), width)
        up, _ = powers(SEGMENT + LENGTH)
        self.hash = np.zeros((len(parts), width + 1), np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:width], axis=1, out=self.hash[:, 1:])

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common prefix, by binary search over prefix hashes."""
        lo, hi = np.zeros(len(x), np.int64), np.minimum(self.size[x], self.size[y])
        while (live := lo < hi).any():
            mid = (lo + hi + 1) >> 1
            same = self.hash[x, mid] == self.hash[y, mid]
            lo = np.where(live & same, mid, lo)
            hi = np.where(live & ~same, mid - 1, hi)
        return lo

    def before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """x < y (a proper prefix comes first; equal strings are not before each other)."""
        n = self.common(x, y)
        ended = (n == self.size[x]) | (n == self.size[y])
        at = np.minimum(n, self.data.shape[1] - 1)
        return np.where(ended, self.size[x] < self.size[y], self.data[x, at] < self.data[y, at])


def merge_sort(strings: Strings, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Order of the strings within each group; all groups' merges run side by side.

    start, size: of the group of each position; groups are contiguous.
    """
    n = len(start)
    order, rank = np.arange(n), np.arange(n) - start
    width = 1
    while n and width < size.max():
        spot = np.flatnonzero(size > width)
        r, st, sz = rank[spot], start[spot], size[spot]
        pair = r // (2 * width) * (2 * width)
        left = r < pair + width
        lo = np.where(left, np.minimum(pair + width, sz), pair)
        hi = np.where(left, np.minimum(pair + 2 * width, sz), pair + width)
        first = lo.copy()
        own = order[spot]
        while len(live := np.flatnonzero(lo < hi)):
            mid = (lo[live] + hi[live]) >> 1
            other, mine = order[st[live] + mid], own[live]
            # from the left run: those strictly before; from the right run: those not after
            ahead = np.empty(len(live), bool)
            lf = left[live]
            ahead[lf] = strings.before(other[lf], mine[lf])
            ahead[~lf] = ~strings.before(mine[~lf], other[~lf])
            lo[live] = np.where(ahead, mid + 1, lo[live])
            hi[live] = np.where(ahead, hi[live], mid)
        new = st + pair + (r - np.where(left, pair, pair + width)) + (lo - first)
        order[new] = own
        width *= 2
    return order


def sorted_strings(parts: list[bytes], width: int, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common): order by (group, string); common[i]: common prefix with the one before, -1 at a group's start."""
    strings = Strings(parts, width)
    start = np.searchsorted(group, group, side="left")
    size = np.searchsorted(group, group, side="right") - start
    order = merge_sort(strings, start, size)
    common = np.full(len(parts), -1, np.int64)
    inside = np.flatnonzero(group[order][1:] == group[order][:-1]) + 1
    x, y = order[inside - 1], order[inside]
    common[inside] = strings.common(x, y)
    column = np.arange(width)
    n = common[inside][:, None]
    differ = strings.data[x] != strings.data[y]
    wrong = (differ & (column < n)).any(axis=1)
    bounded = np.minimum(strings.size[x], strings.size[y])
    stop = np.minimum(n[:, 0], width - 1)
    wrong |= (n[:, 0] < bounded) & ~differ[np.arange(len(x)), stop]
    wrong |= (n[:, 0] < bounded) & (strings.data[x, stop] > strings.data[y, stop])
    if wrong.any():  # a hash collision: sort the bytes themselves
        order = np.array(sorted(range(len(parts)), key=lambda i: (group[i], parts[i])), np.int64)
        for i in inside:
            p, q = parts[order[i - 1]], parts[order[i]]
            m = min(len(p), len(q))
            d = np.flatnonzero(np.frombuffer(p, np.uint8, m) != np.frombuffer(q, np.uint8, m))
            common[i] = d[0] if len(d) else m
    return order, common


def repeated(left: list[bytes], right: list[bytes], group: np.ndarray, length: int, gram: int) -> np.ndarray:
    """(strings, length - gram + 1) flags: the window that starts d bytes left of the anchor repeats.

    left: the reversed bytes before each anchor; right: those from it on;
    together they hold exactly the windows that belong to the anchor.
    """
    m, reach = len(group), length - gram
    lo, lc = sorted_strings(left, max(reach, 1), group)
    ro, rc = sorted_strings(right, length, group)
    ls, rs = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    out = np.zeros((m, reach + 1), bool)
    lclass, rclass = np.empty(m, np.int64), np.empty(m, np.int64)
    for d in range(reach + 1):
        have = np.flatnonzero((ls >= d) & (rs >= length - d))
        if len(have) < 2:
            continue
        lclass[lo] = np.cumsum(lc < d)
        rclass[ro] = np.cumsum(rc < length - d)
        key = lclass[have] * (m + 1) + rclass[have]
        at = np.argsort(key, kind="stable")
        same = key[at][1:] == key[at][:-1]
        out[have[at[1:][same]], d] = True
        out[have[at[:-1][same]], d] = True
    return out


# --- Spark side ---------------------------------------------------------------

def _surroundings(length: int):
    schema = pa.schema([("fp", pa.int64()), ("n", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()),
                        ("a", pa.int32()), ("lo", pa.int32()), ("left", pa.binary()), ("right", pa.binary())])

    def run(batches):
        for b in slices(batches, "_text", 1 << 20):
            rows = []
            for r in b.to_pylist():
                text = r["_text"]
                for w in r["wants"]:
                    rows.append({"fp": w["fp"], "n": w["n"], "doc_id": r["doc_id"], "th": r["th"], "a": w["a"], "lo": w["lo"],
                                 "left": text[w["lo"]: w["a"]][::-1], "right": text[w["a"]: w["hi"] + length]})
                    if len(rows) >= 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


MARKS = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("s", pa.int32()), ("e", pa.int32())])
MARKS_DDL = "doc_id long, th long, s int, e int"


def _sort_groups(length: int, gram: int):
    def marks(rows):
        group = np.unique(np.array([r["fp"] for r in rows], np.int64), return_inverse=True)[1]
        order = np.argsort(group, kind="stable")
        rows, group = [rows[i] for i in order], group[order]
        flags = repeated([r["left"] for r in rows], [r["right"] for r in rows], group, length, gram)
        flags[[r["n"] > 1 for r in rows]] = False  # their copies' windows all count already
        edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        i, first = np.nonzero(edge == 1)
        last = np.nonzero(edge == -1)[1] - 1
        out = [{"doc_id": rows[k]["doc_id"], "th": rows[k]["th"], "s": rows[k]["a"] - int(q), "e": rows[k]["a"] - int(p)}
               for k, p, q in zip(i.tolist(), first, last, strict=True)]
        return pa.RecordBatch.from_pylist(out, schema=MARKS)

    def run(batches):
        held, key = [], None
        for b in batches:
            for r in b.to_pylist():
                if r["fp"] != key:
                    if len(held) >= SORTED_AT_ONCE:
                        yield marks(held)
                        held = []
                    key = r["fp"]
                held.append(r)
        if held:
            yield marks(held)
    return run


def _windows(length: int):
    schema = pa.schema([("fp", pa.int64()), ("d", pa.int32()), ("w", pa.binary()), ("n", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()), ("s", pa.int32())])

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                text, mid, rows = r["left"][::-1] + r["right"], len(r["left"]), []
                for i in range(len(text) - length + 1):
                    rows.append({"fp": r["fp"], "d": mid - i, "w": xxhash.xxh3_128_digest(text[i: i + length]), "n": r["n"],
                                 "doc_id": r["doc_id"], "th": r["th"], "s": r["lo"] + i})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
    return run


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, th, s, e): every window that starts at s..e of the document starts somewhere else too."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("th"),
                        utf8(F.col("text")).alias("_text"))
    long_enough = texts.filter(F.octet_length("_text") >= length)
    found = written(long_enough.mapInArrow(_find(length, gram), ANCHORS_DDL), "sx-anchors")
    one = F.struct("doc_id", "th", "a", "lo", "hi")
    classes = written(found.groupBy("fp", "ctx").agg(F.count(F.lit(1)).alias("n"), F.min(one).alias("one"))
                      .withColumn("many", F.col("n") > 1), "sx-classes")
    copies = found.join(classes.filter("many").select("fp", "ctx"), ["fp", "ctx"])
    copied = copies.select("doc_id", "th", F.col("lo").alias("s"), F.col("hi").alias("e"))

    groups = classes.groupBy("fp").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    wanted = classes.join(groups, "fp").select("c", "fp", "n", "one.*")
    lists = written(wanted.groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("fp", "n", "a", "lo", "hi", "c")).alias("wants")), "sx-wanted")
    size = lists.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("wants")), F.lit(0))).first()
    lists = lists.withColumnsRenamed({"doc_id": "_d", "th": "_t"})
    if sum(size) <= BROADCAST_ROWS:  # positions only, counted
        lists = F.broadcast(lists)
    asked = long_enough.join(lists, (F.col("th") == F.col("_t")) & F.col("doc_id").eqNullSafe(F.col("_d"))).drop("_d", "_t")
    shape = "fp long, n long, doc_id long, th long, a int, lo int, left binary, right binary"
    few = asked.withColumn("wants", F.filter("wants", lambda w: w["c"] <= CROWD)).filter(F.size("wants") > 0)
    parts = few.mapInArrow(_surroundings(length), shape)
    sorted_ = parts.repartition("fp").sortWithinPartitions("fp").mapInArrow(_sort_groups(length, gram), MARKS_DDL)
    out = copied.unionByName(sorted_)
    if groups.filter(F.col("c") > CROWD).take(1):
        crowd = asked.withColumn("wants", F.filter("wants", lambda w: w["c"] > CROWD)).filter(F.size("wants") > 0)
        windows = written(crowd.mapInArrow(_surroundings(length), shape).mapInArrow(
            _windows(length), "fp long, d int, w binary, n long, doc_id long, th long, s int"), "sx-windows")
        twice = windows.groupBy("fp", "d", "w").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").drop("k")
        more = windows.filter("n = 1").join(twice, ["fp", "d", "w"]).select("doc_id", "th", "s", F.col("s").alias("e"))
        out = out.unionByName(more)
    return out


def _cut(length: int, schema: pa.Schema):
    def run(batches):
        for b in slices(batches, "_text"):
            kept, removed, spans = [], [], []
            for text, marks in zip(b.column("_text").to_pylist(), b.column("_marks").to_pylist(), strict=True):
                if not marks:
                    kept.append(text)
                    removed.append(0)
                    spans.append(0)
                    continue
                merged: list[list[int]] = []
                for m in sorted((m["s"], m["e"] + length) for m in marks):
                    if merged and m[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], m[1])
                    else:
                        merged.append(list(m))
                at, parts = 0, []
                for s, e in merged:
                    parts.append(text[at: s])
                    at = e
                parts.append(text[at:])
                kept.append(b"".join(parts))
                removed.append(sum(e - s for s, e in merged))
                spans.append(len(merged))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(t) for t in b.column("_text").to_pylist()], pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], schema=schema)
    return run


def cut_repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept), one row per row of ``docs``.

    Texts are UTF-8 bytes (null: empty).  Each byte covered by a ``length``-byte
    string that also starts anywhere else, in this or another document, goes;
    strings are judged on the input.  ``kept`` is binary, since a cut can fall
    inside a character.  Rows without doc_id and repeated rows are documents
    like others: a row that repeats is a copy.  Texts shorter than ``length``
    stay whole.  Other columns are not read; an empty table gives no rows.
    """
    marks = repeats(docs, length, gram)
    per = marks.groupBy("doc_id", "th").agg(F.collect_set(F.struct("s", "e")).alias("_marks")).withColumnsRenamed({"doc_id": "_d", "th": "_t"})
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("th"),
                        utf8(F.col("text")).alias("_text"))
    both = texts.join(per, (F.col("th") == F.col("_t")) & F.col("doc_id").eqNullSafe(F.col("_d")), "left")
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])
    return both.select("doc_id", "_text", "_marks").mapInArrow(
        _cut(length, schema), "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")
