"""Line dedup, near duplicates, decontamination and repeated substrings on odd and small inputs."""

import hashlib
import itertools
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankdelta.llm import components, decontam, lines, neardup, suffixes

from .helpers import DOCS, documents, words

LONG = "This line is long enough to be counted as shared, é!"


# --- lines ---------------------------------------------------------------------

def test_lines_keep_only_the_largest_holder(spark):
    rows = [(i, f"own {i}\n  {LONG.upper() if i == 2 else LONG}\t\nend") for i in range(5)] + [(4, f"again\n{LONG}")]
    got = {(r.doc_id, r.text): r for r in lines.drop_shared_lines(documents(spark, rows)).collect()}
    # É is not é: only A-Z are folded, so document 2 holds another key and four are too few
    assert all(r.n_dropped == 0 for r in got.values())
    rows.append((7, LONG))
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in lines.drop_shared_lines(documents(spark, rows)).collect())
    assert got[0] == (0, "own 0\nend", 3, 1)
    assert (2, f"own 2\n  {LONG.upper()}\t\nend", 3, 0) in got
    assert (4, "again", 2, 1) in got and (7, LONG, 1, 0) in got


def test_lines_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, f"{LONG}\nx"), (3, "\n\n"), (4, LONG), (4, LONG), (5, LONG), (6, LONG), (8, LONG), (9, LONG)]
    docs = documents(spark, rows).withColumn("n_lines", F.lit("clash")).withColumn("drop", F.lit(1))
    got = lines.drop_shared_lines(docs)
    assert "drop" in got.columns
    out = sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()), key=str)
    assert (1, None, 1, 0) in out and (2, "", 1, 0) in out and (3, "\n\n", 3, 0) in out
    assert (None, "x", 2, 1) in out                      # a row without id is never the holder
    assert out.count((4, "", 1, 1)) == 2                 # repeated rows are treated alike
    assert (9, LONG, 1, 0) in out
    assert lines.drop_shared_lines(spark.createDataFrame([], DOCS)).count() == 0


# --- near duplicates --------------------------------------------------------------

def brute_components(rows):
    def sh(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c < "\x80" else c for c in t or ""))
        return {tuple(w[i: i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()
    sets = [(i, sh(t)) for i, t in rows]
    up = {i: i for i, _ in rows}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if a == b or x and y and 100 * len(x & y) >= 75 * len(x | y):
            ra, rb = find(a), find(b)
            up[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i, _ in rows}, [(i, len(s)) for i, s in sets]


@pytest.fixture(scope="module")
def family():
    """A base text, copies with more and more changed words, exact copies and bystanders."""
    base, rows = words(1, 80), []
    for i in range(60):
        w = list(base)
        for j, new in enumerate(words(100 + i, i % 6)):
            w[(i * 7 + j * 13) % 80] = new
        rows.append((500 - i, " ".join(w)))
    rows += [(600 + i, " ".join(words(300 + i, 60))) for i in range(20)]
    rows += [(700 + i, rows[i][1]) for i in range(10)]
    rows += [(800, ""), (801, None), (802, "  \n\t "), (803, "one two"), (804, "ONE\ttwo"), (805, "one two three"), (806, "É x"), (807, "é x")]
    return rows


@pytest.mark.parametrize("block", [neardup.BLOCK, 8])
def test_near_duplicates_match_brute_force(spark, family, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    want, sizes = brute_components(family)
    got = neardup.near_duplicates(documents(spark, family)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert sorted((r.doc_id, r.n_shingles) for r in got) == sorted(sizes)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_odd_rows(spark, family):
    rows = [family[0], family[0], (None, family[0][1]), (900, "z"), (900, family[1][1])]
    got = neardup.near_duplicates(documents(spark, rows).withColumn("component_id", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert neardup.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
    kept = neardup.keep_one(documents(spark, family))
    want, _ = brute_components(family)
    assert sorted(r.doc_id for r in kept.collect()) == sorted({v for v in want.values()})


def test_near_duplicates_null_id_chunks_before_its_copy(spark, family):
    """A row without doc_id must not take the minima from a copy that comes in a later chunk of the task."""
    filler = " ".join(f"w{i}" for i in range(neardup.CHUNK + 10))
    rows = [(None, family[0][1]), (1, filler), (10, family[0][1]), (20, family[1][1])]
    got = neardup.near_duplicates(documents(spark, rows).coalesce(1)).collect()
    assert {r.doc_id: r.component_id for r in got} == {None: None, 1: 1, 10: 10, 20: 10}


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 7), (200, 201), (201, 202), (202, 200), (5, 5)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 31)}, 100: 1, 200: 200, 201: 200, 202: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- decontamination ----------------------------------------------------------------

def brute_hits(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def ws(t):
        return word.findall("".join(c.lower() if c < "\x80" else c for c in t))
    out = []
    for doc, text in docs:
        w, hit, ids = ws(text or ""), set(), set()
        for item, t in items:
            iw = ws(t) if item is not None and t is not None else []
            k = min(10, len(iw))
            wins = {tuple(iw[i: i + k]) for i in range(len(iw) - k + 1)} if iw else set()
            for s in range(len(w) - k + 1):
                if wins and tuple(w[s: s + k]) in wins:
                    hit.update(range(s, s + k))
                    ids.add(str(item))
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("bound", [decontam.BROADCAST_ROWS, 0])
def test_decontamination_matches_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", bound)
    w = words(5, 40)
    items = [(1, " ".join(w[:25])), (2, "Solo"), (3, "two words"), (10, " ".join(w[:25])), (4, None), (None, "ghost words"), (5, ""), (6, "a a a a a a a a a a a a"),
             (7, "x " * 9 + "y")]
    docs = [(1, "!!" + " ".join(w[3:20]).upper() + "??"), (2, " ".join(w[:9])), (3, "say SOLO, two-words"), (4, None), (5, ""), (6, "a " * 15),
            (7, " ".join(w)), (7, " ".join(w)), (None, "two words"), (8, "ghost words"), (9, "é solo É"), (11, "x " * 12 + "y x"), (12, "two"), (13, "soló sölo")]
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("len", F.lit("clash"))
    d = documents(spark, docs).withColumn("words", F.lit("clash"))
    got = decontam.contamination(d, b)
    assert sorted((tuple(r)[:1] + tuple(r)[2:] for r in got.collect()), key=str) == brute_hits(docs, items)
    kept = decontam.drop_contaminated(d, b)
    assert kept.columns == d.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((x[0] for x in brute_hits(docs, items) if not x[5]), key=str)


def test_decontamination_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontam.contamination(documents(spark, [(1, "a b")]), none).collect()] == [0]
    assert decontam.contamination(spark.createDataFrame([], DOCS), none).count() == 0


# --- repeated substrings -----------------------------------------------------------

def brute_cut(rows, n):
    seen = defaultdict(list)
    texts = [(t or "").encode() for _, t in rows]
    for k, t in enumerate(texts):
        for i in range(len(t) - n + 1):
            seen[t[i: i + n]].append((k, i))
    gone = [set() for _ in rows]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                gone[k].update(range(i, i + n))
    out = []
    for (doc, _), t, g in zip(rows, texts, gone, strict=True):
        spans = sum(1 for i in g if i - 1 not in g)
        out.append((doc, len(t), len(g), spans, bytes(c for i, c in enumerate(t) if i not in g)))
    return sorted(out, key=str)


@pytest.mark.parametrize("crowd", [suffixes.CROWD, 2])
def test_cut_repeats_matches_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(suffixes, "CROWD", crowd)
    monkeypatch.setattr(suffixes, "SEGMENT", 300)
    p, q = " ".join(words(1, 12)), " ".join(words(2, 30))
    rows = [(i, " ".join(words(50 + i, i)) + p + " ".join(words(80 + i, 3))) for i in range(6)]
    rows += [(10, q), (10, q), (11, q[:90] + "#" + q[91:]), (12, q[40:] + q[:60]), (13, "ab" * 60), (14, "x" * 39), (15, "é" * 33), (16, None), (17, ""), (None, p + q)]
    got = suffixes.cut_repeats(documents(spark, rows).withColumn("th", F.lit("clash")), length=40, gram=10).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got), key=str) == brute_cut(rows, 40)
    assert suffixes.cut_repeats(spark.createDataFrame([], DOCS)).count() == 0


def test_suffix_sort_survives_collisions(monkeypatch):
    parts = [w.encode() for w in words(3, 40)] + [b"abc", b"abcd", b"abc", b""]
    group = np.array([0] * 20 + [1] * 24)
    for broken in (False, True):
        if broken:  # every prefix hash collides
            monkeypatch.setattr(suffixes, "powers", lambda n: (np.zeros(n, np.uint64), np.zeros(n, np.uint64)))
        order, common = suffixes.sorted_strings(parts, 12, group)
        assert [(group[i], parts[i]) for i in order] == sorted((g, x) for g, x in zip(group, parts, strict=True))
        for i in range(1, len(parts)):
            x, y = parts[order[i - 1]], parts[order[i]]
            n = next((k for k, (a, b) in enumerate(zip(x, y, strict=False)) if a != b), min(len(x), len(y)))
            assert common[i] == (n if group[order[i - 1]] == group[order[i]] else -1)


# --- documents made from one template ----------------------------------------------

def template_rows(n, shared=72, own=28, seed=8, fields=None):
    """Documents of ``shared`` common words with ``own`` words of their own at fixed places."""
    import random
    r = random.Random(seed)
    base, places = words(seed, shared + own), sorted(r.sample(range(shared + own), own))
    out = []
    for i in range(n):
        w = list(base)
        for p in (places if fields is None else places[:fields(i)]):
            w[p] = f"own{i}x{p}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("crowded", [4, 10_000])
def test_templates_lose_no_link(spark, monkeypatch, crowded):
    """Families around the limit: some members are linked, most are not."""
    monkeypatch.setattr(neardup, "CROWDED", crowded)
    rows = template_rows(60, own=10, fields=lambda i: i % 7 + 1) + [(100 + i, t) for i, t in template_rows(40, seed=9, own=6)]
    rows += [(200 + i, t) for i, t in template_rows(60, seed=10)] + [(300, rows[3][1]), (301, rows[3][1] + " tail"), (301, "other words " * 9)]
    got = neardup.near_duplicates(documents(spark, rows)).collect()
    want, _ = brute_components([r for r in rows if r[0] != 301])
    assert {r.doc_id: r.component_id for r in got if r.doc_id < 301} == want
    assert len(set(want.values())) > 60


def test_rare_groups_are_few_for_a_template(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CROWDED", 16)
    rows = template_rows(300)
    docs = documents(spark, rows)
    nodes = docs.select(F.col("doc_id").alias("node"), F.col("doc_id").alias("component"))
    assert neardup.rare_groups(nodes, docs).count() == 0  # similarity 0.5: no two of them meet
    close = documents(spark, template_rows(300, shared=200, own=1))
    assert neardup.rare_groups(nodes, close).select("node").distinct().count() == 300
