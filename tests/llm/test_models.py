"""Archives, chat masks, language model, toxicity, mixing and neighbours on odd and small inputs."""

import gzip
import hashlib
import io
import itertools
import math
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankdelta.llm import chat, lm, mixing, neighbours, toxicity, warc

from .helpers import DOCS, documents, words


# --- archives --------------------------------------------------------------------

def reader(raw: bytes):
    return lambda at, n: raw[at: at + n]


@pytest.mark.parametrize("zip64", [False, True])
def test_directory_of_foreign_archives(zip64):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, data in (("a.txt", b"first"), ("ä/b", b"second" * 50)):
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=zip64) as f:
                f.write(data)
        z.comment = b"PK comment"
    raw = out.getvalue()
    members = warc.directory(reader(raw), len(raw))
    assert [m.name for m in members] == ["a.txt", "ä/b"]
    for m, want in zip(members, (b"first", b"second" * 50), strict=True):
        at = warc.data_start(reader(raw), m)
        assert raw[at: at + m.size] == want and m.method == 0


def test_directory_reads_zip64_records():
    """Counts and offsets only in the ZIP64 records, the 32-bit fields all marked."""
    import struct
    name, data = b"x", b"payload"
    local = struct.pack("<4sHHHHHIIIHH", b"PK\3\4", 45, 0, 0, 0, 0, 0, len(data), len(data), 1, 0) + name + data
    extra = struct.pack("<HHQQQ", 1, 24, len(data), len(data), 0)
    central = struct.pack("<4sHHHHHHIIIHHHHHII", b"PK\1\2", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + name + extra
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\6\6", 44, 45, 45, 0, 0, 1, 1, len(central), len(local))
    locator = struct.pack("<4sIQI", b"PK\6\7", 0, len(local) + len(central), 1)
    end = struct.pack("<4sHHHHIIH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    raw = local + central + end64 + locator + end
    m, = warc.directory(reader(raw), len(raw))
    at = warc.data_start(reader(raw), m)
    assert (m.name, raw[at: at + m.size]) == ("x", data)
    with pytest.raises(ValueError):
        warc.directory(reader(b"no archive"), 10)


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 2000)
    big = "é" * 600
    pages = [(1, "http://a/ü?x=1 2", big), (2, None, big), (3, "u\r\nX-Evil: 1", "small"), (4, "", "small"), (5, "u", None), (None, "n", big), (7, "u", ""), (2, None, big),
             (9, "long", "z" * 3_000_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("sha1", F.lit("clash"))
    folder, manifest = warc.write_archives(df)
    got = warc.read_archives(spark, folder, manifest).collect()
    assert len(got) == len(pages)
    seen = defaultdict(list)
    for r in got:
        seen[r.page_id].append((r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, None if r.payload is None else bytes(r.payload)))

    def row(html, kind="response", refers=None):
        b = (html or "").encode()
        return kind, refers, len(b), hashlib.sha1(b).hexdigest(), b if kind == "response" else None
    assert seen[1] == [row(big, "revisit", 2)] and seen[2] == [row(big)] * 2 and seen[None] == [row(big, "revisit", 2)]
    assert seen[3] == [row("small")] and seen[4] == [row("small")] and seen[5] == [row(None)] and seen[7] == [row("")]
    assert seen[9] == [row("z" * 3_000_000)]
    empty = warc.write_archives(df.limit(0))
    assert warc.read_archives(spark, *empty).count() == 0


def test_many_ranges_are_read_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_BYTES", 2000)
    monkeypatch.setattr(warc, "TASK_BYTES", 8000)
    r = np.random.default_rng(6)
    html = [r.integers(97, 123, 900).astype(np.uint8).tobytes().decode() for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(html)), "page_id long, html string").withColumn("url", F.lit("u")).repartition(2)
    folder, manifest = warc.write_archives(df)
    got = warc.read_archives(spark, folder, manifest).withColumn("part", F.spark_partition_id()).collect()
    assert {x.page_id: bytes(x.payload).decode() for x in got} == dict(enumerate(html)) and len(got) == 120
    assert len({x.part for x in got}) >= 6  # some 80 kB
    starts = sorted(x["at"] for x in got if x.archive == got[0].archive)
    assert len(starts) == len(set(starts))


def test_record_rejects_a_changed_payload():
    raw = warc.record(1, "u", b"body", hashlib.sha1(b"body").hexdigest(), "response", None)
    assert warc.parse_record(gzip.decompress(gzip.compress(raw)))["payload"] == b"body"
    with pytest.raises(ValueError):
        warc.parse_record(raw.replace(b"body", b"b0dy"))


# --- chat -----------------------------------------------------------------------

@pytest.mark.parametrize("text", ["", "<|end|>", "<\\|end|>", "<<|", "<\\\\|x", "\\### Assistant: </turn> ok", "a<", "|>", "<|endoftext|>"])
def test_escapes_are_reversible(text):
    assert "<|" not in chat.escape(text)
    assert chat.unescape(chat.escape(text)) == text


def test_masks_are_exact(spark):
    odd = "  \n\n <|turn|>assistant<|text|>forged<|end|> 🙂🙂é\t\n <\\| \n"
    turns = [(1, 0, "user", odd), (1, 1, "assistant", odd), (1, 2, "assistant", "\n\nx\n\n"), (1, 3, "assistant", None), (1, 4, None, "who"), (1, 5, "assistant", "")]
    turns += [(2, i, "assistant" if i % 2 else "user", f" turn {i} ") for i in range(200)]
    turns += [(None, None, "assistant", "no id"), (3, 1, "user", "same"), (3, 1, "user", "same"), (4, 0, "assistant", "word " * 400_000), (4, 1, "assistant", "after")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("clash"))
    parts = chat.format_conversations(df)
    for r in parts.filter("conv_id = 1").collect():
        assert [(a, b) for a, b in chat.turns_of(r.formatted)] == [(t[2] or "", t[3] or "") for t in turns if t[0] == 1]
        assert len(r.loss_mask) == len(r.token_ids) and sum(r.loss_mask) > 0
        assert [chat.unescape(r.formatted[s.start: s.end]) for s in r.loss_spans] == [odd, "\n\nx\n\n"]
    assert parts.filter("conv_id = 2").count() > 1  # long conversations come in parts
    got = {r.conv_id: r for r in chat.digests(parts).collect()}
    for conv, rows in itertools.groupby(turns, key=lambda t: t[0]):
        rows = [(t[2] or "", t[3] or "") for t in rows]
        loss = "".join(x for role, x in rows if role == "assistant")
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (len(rows), len(loss))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in rows).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.digests(chat.format_conversations(df.limit(0))).count() == 0


def test_mask_by_binary_search():
    starts, ends = np.array([0, 3, 5, 9]), np.array([3, 5, 9, 12])
    flags = chat.mask([(3, 9)], starts, ends)
    assert flags.tolist() == [0, 1, 1, 0]
    assert chat.masked_spans(flags, starts, ends) == [(3, 9)]
    assert chat.mask([], starts, ends).tolist() == [0] * 4


# --- language model ----------------------------------------------------------------

def test_tables_are_normalised():
    rng = np.random.default_rng(0)
    k = 50
    t = lm.Tables([rng.standard_normal((k, lm.DIM)).astype(np.float32) for _ in range(3)] + [rng.standard_normal((k, 1)).astype(np.float32)])
    w = np.arange(k)
    for i, j in ((0, 0), (3, 49), (20, 7)):
        assert abs((10 ** t.log10(np.full(k, i), np.full(k, j), w)).sum() - 1) < 1e-5


def test_contexts_do_not_cross_texts():
    h1, h2, w, starts = lm.classed([lm.tokens(b"a b"), lm.tokens(b""), lm.tokens(b"B")], {lm.END: 1, b"a": 2, b"b": 3})
    assert w.tolist() == [2, 3, 1, 1, 3, 1] and starts.tolist() == [0, 3, 4, 6]
    assert h1.tolist() == [1, 2, 3, 1, 1, 3] and h2.tolist() == [1, 1, 2, 1, 1, 1]


def test_scores(spark):
    base = words(9, 30)
    rows = [(i, " ".join(base[(i * 7 + j) % 10] + ("" if j % 3 else "x") for j in range(60))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "UNSEEN Wörter \x0b here"), (102, "UNSEEN Wörter \x0b here"), (None, rows[0][1])]
    got = lm.scores(documents(spark, rows).withColumn("base", F.lit("clash")), head=5).collect()
    toks = [(i, (t or "").encode().lower().split() + [b""]) for i, t in rows]
    train = [(i, t) for i, t in toks if i is not None and zlib.crc32(str(i).encode()) % 10]
    c = Counter(x for _, t in train for x in t)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), len(t), sum(x in c for x in t), round(sum(math.log10((c[x] + .1) / (n + .1 * (v + 1))) for x in t), 6)) for i, t in toks)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {n}
    assert all(r.held_out for r in got if r.doc_id is None)
    held = [r for r in got if r.held_out and (r.doc_id or 0) < 80 and r.doc_id is not None]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)  # the order of words is learned
    assert lm.scores(spark.createDataFrame([], DOCS)).count() == 0


# --- toxicity -----------------------------------------------------------------------

def test_pairs_are_learned():
    """Two terms are harmful together only: additive weights cannot tell, the machine does."""
    rng = np.random.default_rng(1)
    texts, labels = [], []
    for i in range(1600):
        a, b = i % 2, i // 2 % 2
        texts.append(np.unique(np.concatenate(([1] * a + [2] * b, rng.integers(100, 160, 3)))).astype(np.int32))
        labels.append(float(a and b))
    m = toxicity.fit(texts, np.array(labels))
    right = (m.raw(texts) >= 0) == (np.array(labels) == 1)
    assert right.mean() > 0.98


def test_pairs_of_terms_that_are_neutral_alone():
    """Labels are the exclusive-or of two terms, among others that mean nothing."""
    r = np.random.default_rng(4)
    memo, texts, labels = toxicity.Terms(), [], []
    for _ in range(1500):
        a, b = r.random() < 0.5, r.random() < 0.5
        noise = [f"noise{k}" for k in r.choice(200, 12)]
        texts.append(toxicity.terms(" ".join(noise + ["aaa"] * a + ["bbb"] * b).encode(), memo))
        labels.append(int(a != b))
    m = toxicity.fit(texts[:1000], np.array(labels[:1000]))
    right = np.mean((m.raw(texts[1000:]) >= 0) == np.array(labels[1000:], bool))
    assert right >= 0.95, right


def test_machine_equals_the_plain_double_sum():
    r = np.random.default_rng(5)
    m = toxicity.Machine()
    m.w0[0], m.w = 0.3, r.standard_normal(toxicity.BUCKETS)
    m.v, m.known = r.standard_normal((toxicity.BUCKETS, toxicity.FACTORS)), r.random(toxicity.BUCKETS) < 0.7
    texts = [np.sort(r.choice(toxicity.BUCKETS, n, replace=False)).astype(np.int32) for n in (0, 1, 2, 17, 60)]
    for t, got in zip(texts, m.raw(texts), strict=True):
        own = [i for i in t if m.known[i]]
        pairs = sum(float(m.v[i] @ m.v[j]) for k, i in enumerate(own) for j in own[k + 1:])
        want = m.w0[0] + sum(m.w[i] for i in own) + pairs / max(len(own), 1)
        assert abs(got - want) < 1e-8


def test_rows_that_repeat_an_id_are_one_example(spark, monkeypatch):
    rows = [(1, f"vile text {k}") for k in range(50)] + [(k, f"kind text {k}") for k in range(2, 30)]
    labels = spark.createDataFrame([(k, int(k == 1)) for k in range(1, 30)], "doc_id long, toxic int")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array([], pa.int32()), pa.array([], pa.float64()), pa.array([], pa.list_(pa.float64()))], ["bucket", "w", "v"])
    monkeypatch.setattr(toxicity, "_fit", count)
    toxicity.train(documents(spark, rows), labels, folds=1_000_003)
    assert 20 <= seen.value <= 29


def test_toxicity_scores(spark):
    vocabulary = words(4, 60)
    rows, marks = [], []
    for i in range(400):
        w = [vocabulary[(i * 13 + j * 7) % 60] for j in range(30)]
        if i % 4 == 0:
            w[i % 30] = f"zzvile{i % 9}"  # forms of one stem
        rows.append((i, " ".join(w)))
        marks.append((i, int(i % 4 == 0)))
    rows += [(900, None), (901, ""), (902, "Zzvile77 " + vocabulary[0]), (None, vocabulary[1]), (903, "zzvile77!" + " pad" * 20000)]
    marks += [(5, None), (None, 1), (1, 0), (1, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    docs = documents(spark, rows).withColumn("toxicity", F.lit("clash")).withColumn("w", F.lit(1))
    out = toxicity.with_scores(docs, labels)
    assert out.columns == [c for c in docs.columns if c != "toxicity"] + ["toxicity"]
    got = out.collect()
    assert len(got) == len(rows) and all(0 <= r.toxicity <= 1 for r in got)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert all((r.toxicity >= 0.5) == (r.doc_id % 4 == 0) for r in held)
    by = {r.doc_id: r.toxicity for r in got}
    assert by[902] >= 0.5 and by[900] == by[901] < 0.5
    none = toxicity.with_scores(documents(spark, [(1, "a")]), labels.limit(0)).collect()
    assert [r.toxicity for r in none] == [0.5]
    assert toxicity.with_scores(spark.createDataFrame([], DOCS), labels).count() == 0


# --- mixing -------------------------------------------------------------------------

def brute_targets(sizes: dict, weights=(5, 2, 1), cap=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}
        if len(fixed) == len(order):
            return fixed


@pytest.mark.parametrize("block", [mixing.BLOCK, 16])
def test_mix_reaches_its_targets(spark, block):
    rows = [(i, " ".join(["w"] * (1 + i * 37 % 50 + (900 if i == 11 else 0))), f"s{i % 7}") for i in range(700)]
    rows += [(2000 + i, "a b c", None) for i in range(40)] + [(3000, "tiny", "aa"), (3001, None, "zero"), (3002, "", "zero"), (None, "x y", "s1"), (5, "same row", "s0"), (5, "same row", "s0")]
    df = documents(spark, rows).withColumn("size", F.lit("clash"))
    got = mixing.mix(df, block=block).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, *s in rows:
        sizes[s[0]] += len((t or "").split())
    want = brute_targets(dict(sizes))
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9)
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * r.n_copies
        taken[r.source] += r.taken
    # in tiny blocks few units are left to land on, so a miss can be as large as a document
    most = {s: max(len((t or "").split()) for _, t, *x in rows if x[0] == s) for s in sizes}
    assert all(abs(taken[s] - want[s]) <= max(3, 0.02 * want[s], most[s] * (block < 100)) for s in sizes)
    again = mixing.mix(df.repartition(5), block=block).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert mixing.mix(spark.createDataFrame([], DOCS)).count() == 0


def test_mix_lands_each_source_at_its_size(spark):
    """One huge document in a source of one block and in one of two, beside each other."""
    rows = [(i, " ".join(["w"] * (1 + i * 37 % 50 + (1500 if i in (150, 450) else 0))), "s0" if i < 100 else "s1" if i < 400 else "s2") for i in range(1000)]
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(t.split())
    want = brute_targets(dict(sizes))
    for seed in range(3):
        taken = Counter()
        for r in mixing.mix(documents(spark, rows), block=320, seed=seed).collect():
            taken[r.source] += r.taken
        assert {s: taken[s] - want[s] for s in sizes if abs(taken[s] - want[s]) > 3} == {}


def test_flight_keeps_both_totals():
    rng = np.random.default_rng(2)
    pi, size = rng.random(500), rng.integers(0, 1000, 500)
    out = mixing.flight(pi, size, rng)
    assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2
    assert math.isclose(out @ size, pi @ size, rel_tol=1e-9) and math.isclose(out.sum(), pi.sum(), rel_tol=1e-9)


# --- neighbours -----------------------------------------------------------------------

def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((900, 16)).astype(np.float32)
    x[300:700] = x[0]                       # one vector a great many times
    x[701] = 2 * x[702]                     # equal direction, other length
    rows = [(i, [float(v) for v in x[i]]) for i in range(900)]
    rows += [(1000, None), (1050, [0.0] * 16), (1100, [float("nan")] * 16), (1150, [None] + [1.0] * 15), (1200, [float("inf")] + [1.0] * 15), (1250, [1.0]), (1300, []), (None, rows[1][1]), (50, rows[50][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("node", F.lit("clash"))
    got = defaultdict(list)
    for r in neighbours.nearest(df, lambda i: i % 50 == 0).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    d = x.astype(np.float64)
    norm = np.sqrt((d * d).sum(axis=1))
    hit = 0
    assert sorted(got) == list(range(0, 900, 50))
    for q, found in got.items():
        s = d @ d[q] / (norm * norm[q])
        s[q] = -9
        best = sorted(range(900), key=lambda i: (-round(float(s[i]), 12), i))[:5]
        found.sort()
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5]
        assert all(abs(s[i] - v) < 1e-12 for _, i, v in found)
        hit += len({i for _, i, _ in found} & set(best))
    assert hit >= 0.9 * 5 * len(got)
    assert [i for _, i, _ in got[300]] == [0, 301, 302, 303, 304]
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.rank, r.vec_id) for r in neighbours.nearest(few, lambda i: i == 0).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2)]
    assert neighbours.nearest(few.limit(0), lambda i: i == 0).count() == 0


def test_offers_leave_out_what_is_listed():
    """Members that know their nearest already are offered the next ones, however many they know."""
    angle = np.arange(12) * 0.05
    x = np.stack([np.cos(angle), np.sin(angle)], axis=1).astype(np.float32)
    have = [[j for j in range(12) if j != i and abs(j - i) <= 4] for i in range(12)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([99] * 12), pa.array(range(12)), pa.array([-9.0] * 12, pa.float32()), pa.array(have, pa.list_(pa.int64())),
         pa.array([r.tobytes() for r in x])], ["u", "node", "worst", "have", "unit"])
    got = defaultdict(set)
    for b in neighbours._join_around([batch]):
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True):
            got[u].add(v)
    for i in range(12):
        new = sorted((j for j in range(12) if j != i and j not in have[i]), key=lambda j: abs(j - i))
        assert got[i] == set(new[: neighbours.OFFERS])


def test_graph_rounds_go_on_until_settled(spark):
    """Uniform vectors in many dimensions: the lists of the settled graph hold nearly all true neighbours."""
    x = np.random.default_rng(8).standard_normal((3000, 24)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    units = spark.createDataFrame([(i, bytearray(r.tobytes())) for i, r in enumerate(x)], "node long, unit binary")
    near = defaultdict(set)
    for r in neighbours.neighbour_graph(units).collect():
        near[r.u].add(r.v)
    m = x @ x.T
    np.fill_diagonal(m, -9)
    best = np.argpartition(-m, 9, axis=1)[:, :10]
    assert np.mean([len(near[i] & set(b.tolist())) / 10 for i, b in enumerate(best)]) > 0.97


def test_neighbours_closer_than_single_precision(spark):
    """Sixty directions that single precision cannot tell apart are ranked in double precision."""
    rng = np.random.default_rng(5)
    ids = rng.permutation(300).tolist()
    x = rng.standard_normal((300, 4))
    step = np.array([0.0, 1.0, 0.0, 0.0])
    x[:60] = [(1 + k % 7) * (np.array([1.0, 0.0, 0.0, 0.0]) + k * 1e-5 * step) for k in range(60)]
    df = spark.createDataFrame([(ids[i], x[i].tolist()) for i in range(300)], "vec_id long, embedding array<double>")
    query = ids[0]
    got = neighbours.nearest(df, lambda i: i == query).orderBy("rank").collect()
    assert [r.vec_id for r in got] == ids[1:6]
