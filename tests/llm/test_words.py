"""Spelling groups, licence scan and ranked search against brute force."""

import math
import random
import re
import zlib
from collections import Counter

import pytest

from rankdelta.llm import lexical, licenses, spelling, wordscan
from rankdelta.llm.common import written
from rankdelta.llm.fmindex import WordIndex

from .helpers import documents, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def cut(w):
    return {(i, w[:i] + w[i + 1:]) for i in range(len(w))}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(v == short for _, v in cut(long))


def family(seed, n, alphabet="abéÿ", low=6, high=9):
    r = random.Random(seed)
    return sorted({"".join(r.choice(alphabet) for _ in range(r.randint(low, high))) for _ in range(n)})


# -- spelling ---------------------------------------------------------------

@pytest.mark.parametrize("seed", range(4))
def test_index_finds_every_word_at_one_error(seed):
    ws = family(seed, 150) + ["zzzzzzz", "zzzzzzzz", "z" * 300, "z" * 301]
    index = WordIndex(sorted(ws))
    found = {frozenset((index.words[i], index.words[j])) for f in (True, False) for i, j in zip(*index.near(index.words, f), strict=True)}
    assert found == {frozenset((a, b)) for a in ws for b in ws if a < b and one_apart(a, b)}


@pytest.mark.parametrize("block,hot", [(100_000, 100_000), (64, 8), (16, 1)])
def test_near_words_in_blocks(spark, block, hot):
    ws = family(9, 250) + ["aaaaaa" + x for x in family(3, 60, "abc", 1, 4)]  # many words share a half
    table = written(spark.createDataFrame([(w, i + 1) for i, w in enumerate(sorted(set(ws)))], "word string, n long"), "t")
    got = sorted((r.word, r.near) for r in spelling.near_words(table, block=block, hot=hot).collect())
    assert got == sorted((a, b) for a in set(ws) for b in set(ws) if a != b and one_apart(a, b))


def brute_spelling(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = ascii_lower(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 199 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            n[w] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    out = {}
    for w in n:
        near = [x for x in n if x != w and abs(len(x) - len(w)) < 2 and one_apart(x, w)]
        best = min(near, key=lambda x: (-n[x], x), default=None)
        out[w] = (best if best and n[best] >= 5 * n[w] else None, n[w], len(near))

    def root(w):
        return root(out[w][0]) if out[w][0] else w
    return {w: (f, root(w), k, near, n[f] if f else None) for w, (f, k, near) in out.items()}


def test_spelling_groups(spark):
    r = random.Random(5)
    base = ["tion" + w for w in words(1, 12)] + ["Éclairée", "éclairé", "étéÿÿà"]
    rows = []
    for i in range(400):
        line = []
        for _ in range(60):
            w = r.choice(base[:4] if r.random() < 0.8 else base)
            if r.random() < 0.1:
                p = r.randrange(len(w))
                w = w[:p] + r.choice(["", "x", w[p] * 2]) + w[p + 1:]
            line.append(w.upper() if r.random() < 0.1 else w)
        rows.append((i, r.choice([" ", "\n", "7", "-", "×"]).join(line)))
    rows += [(None, "nullified nullified " * 4), (7, None), (8, ""), (400, rows[0][1]), (400, rows[0][1]),
             (401, "longword " + "y" * 2000 + " filler" * 400_000 + " " + "y" * 2000)] + [(500 + i, "y" * 2000) for i in range(5)]
    rows += [(600, "chainword " * 250 + "chainwords " * 30 + "chainwordsy " * 5)]
    got = {x.word: (x.form, x.root, x.n, x.n_near, x.form_n) for x in spelling.spelling_groups(documents(spark, rows)).collect()}
    want = brute_spelling(rows)
    assert got == want
    assert any(f and root != f for f, root, *_ in want.values())  # a form that has a form


def test_spelling_of_nothing(spark):
    assert spelling.spelling_groups(documents(spark, [])).collect() == []
    assert spelling.spelling_groups(documents(spark, [(1, None), (2, "short words")])).collect() == []


# -- licences ---------------------------------------------------------------

def brute_licences(rows, templates=(*licenses.BASE, *licenses.NOTICES), slack=licenses.SLACK, least=licenses.MIN_SHARE):
    texts = [WORD.findall(ascii_lower(t or "")) for _, t in rows]
    df = Counter(w for ws in texts for w in set(ws))
    idf = {w: max(1, math.floor(1000 * math.log((2 * len(rows) + 2) / (2 * df[w] + 1)))) for t in templates for w in t.words}
    out = []
    for ws in texts:
        found = []
        for t in templates:
            places = [[i - a for i in range(len(ws) - n + 1) if tuple(ws[i:i + n]) == t.words[a:a + n]] for a, n in t.spans]
            for d in places[0]:
                if t.base:
                    found.append((t.label, d, d + len(t.words), 1.0, True))
                elif all(any(abs(x - d) <= slack for x in p) for p in places):
                    got = sum(idf[w] for j, w in enumerate(t.words) if w in ws[max(0, d + j - slack):max(0, d + j + slack + 1)])
                    share = got / sum(idf[w] for w in t.words)
                    if share >= least:
                        found.append((t.label, max(0, d), min(len(ws), d + len(t.words)), share, False))
        out.append((len(ws), sorted(found)))
    return out


def test_license_scan(spark):
    filler = words(3, 40)
    full = {t.label: t.text for t in licenses.NOTICES}
    rows = [
        (1, "Released under the MIT License."), (2, "LICENSED under CC-BY-NC 4.0; under the mit license, under the MIT\nlicense"),
        (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "gnu general public license, " + " ".join(filler[:7]) + " version 2"), (5, "gnu general public license " + " ".join(filler) + " version 2"),
        (6, full["mit"]), (7, " ".join(filler) + " " + full["apache-2"] + " " + full["isc"]), (8, full["bsd"].replace("source", "its source")),
        (9, None), (10, ""), (11, "the license of the software"), (None, "Apache License, Version 2.0"), (1, "Released under the MIT License."),
        (12, "version 3 gnu general public license"), (13, "under the under the mit license license version 2 apache license version 2"),
        (14, "word " * 300_000 + "cc by nc " + "x" * 3_000_000 + " under the mit license"), (15, "éunder the mit license under the mit licenseé"),
    ] + [(100 + i, " ".join(filler)) for i in range(30)]
    docs = documents(spark, rows).withColumnRenamed("lang", "matches")
    got = licenses.find_licenses(docs).collect()
    want = brute_licences(rows)
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted([(r.doc_id, r.n_words, sorted(tuple(m) for m in r.matches)) for r in got], key=key) == \
        sorted([(d, n, m) for (d, _), (n, m) in zip(rows, want, strict=True)], key=key)
    by = {r.doc_id: r for r in licenses.summary(licenses.find_licenses(docs)).collect()}
    assert (by[2].n_base, by[2].first_word, by[2].last_word, by[2].base_labels) == (3, 2, 11, "cc-by-nc,mit")
    assert (by[3].n_base, by[3].base_labels, by[3].labels) == (0, "", "gpl-3")
    assert by[7].labels == "apache-2,isc" and by[6].labels == "mit" and by[6].n_base == 0
    assert (by[9].n_words, by[9].first_word, by[9].labels, by[9].score) == (0, None, "", 0.0)
    assert by[4].labels == "gpl-2" and by[5].labels == ""
    assert licenses.find_licenses(documents(spark, [])).collect() == []


# -- ranked search ----------------------------------------------------------

def brute_search(rows, items, top):
    texts = [(d, Counter(WORD.findall(ascii_lower(t or "")))) for d, t in rows]
    held = [(d, c) for d, c in texts if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    asked = {}
    for item, text in items:
        if item is not None and text is not None:
            asked.setdefault(item, set()).update(WORD.findall(ascii_lower(text)))
    out = []
    for item, terms in asked.items():
        scored = []
        for d, c in held:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m)) for w in terms if c[w])
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(item, k, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=lambda x: x[:2])


@pytest.mark.parametrize("seed,bits,block,probes", [(1, 12, 1024, 32), (2, 2, 8, 3), (3, 1, 5, 1)])
def test_ranked_search(spark, seed, bits, block, probes):
    r = random.Random(seed)
    pool = words(seed, 120) + ["É", "ü7", "99"]
    rows = [(i, " ".join(r.choice(pool[:r.choice([5, 30, 123])]).capitalize() for _ in range(r.choice([1, 4, 30, 300, 2000])))) for i in range(160)]
    rows += [(3, rows[3][1]), (3, rows[3][1]), (3, "other text " + pool[0]), (None, rows[5][1]), (200, None), (201, ""), (202, "--- !"),
             (203, (pool[0] + " ") * 40_000), (204, " ".join(f"w{k}" for k in range(60_000)))]
    items = [(i, " ".join(r.choice(pool) for _ in range(r.choice([1, 3, 30])))) for i in range(25)]
    items += [(4, pool[7].upper()), (50, "nowhere to find"), (51, None), (52, ""), (None, pool[0]), (53, pool[0]), (53, pool[0])]
    docs = documents(spark, rows).withColumnRenamed("lang", "q").withColumnRenamed("source", "bound")
    got = lexical.search(docs, spark.createDataFrame(items, "item_id long, text string"), bits=bits, block=block, probes=probes, top=10)
    assert sorted(((x.item_id, x.rank, x.doc_id, x.score) for x in got.collect()), key=lambda x: x[:2]) == brute_search(rows, items, 10)


def test_search_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(lexical, "CHUNK_ITEMS", 3)
    monkeypatch.setattr(lexical, "SLICE_TERMS", 7)
    rows = [(i, " ".join(words(i, 20 + i))) for i in range(40)]
    items = [(i, " ".join(words(i, 12))) for i in range(8)]
    got = lexical.search(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted(((x.item_id, x.rank, x.doc_id, x.score) for x in got.collect()), key=lambda x: x[:2]) == brute_search(rows, items, 10)


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert lexical.search(documents(spark, [(1, "a")]), none).collect() == []
    assert lexical.search(documents(spark, []), spark.createDataFrame([(1, "a")], "item_id long, text string")).collect() == []


def test_pieces_cut_between_words():
    scan = wordscan.plain_words()
    text = ("Some wörds, 12 and more; " * 50 + "x" * 500 + " End").encode()
    assert [w for p in scan.pieces(text, 40) for w in p] == [w.encode() for w in WORD.findall(ascii_lower(text.decode()))]
