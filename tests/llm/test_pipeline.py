"""The pipeline's stages against brute force, on a small corpus with odd rows."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rankdelta.llm.common import scratch_path, written

from .helpers import DOCS, words
from .test_models import brute_targets
from .test_texts import brute_components, brute_hits

SHARED = "This very line stands in a great many documents of the corpus"


@pytest.fixture(scope="module")
def corpus(spark):
    vocabulary, rows, marks = words(21, 400), [], []
    passage = words(22, 30)
    for i in range(240):
        w = [vocabulary[(i * 31 + j * (7 + i % 5)) % 400] for j in range(40)]
        if i % 6 == 0:
            w[i % 40] = f"vilewrd{i % 4}"
        elif i % 10 == 1:
            w[5:20] = passage[4:19]
        text = " ".join(w)
        if i % 4 == 2:
            text += f"\n  {SHARED} \nlast {i}"
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
        marks.append((i, 1, int(i % 6 == 0)))
    rows += [(1000 + i, rows[7 + 10 * i][1] + " more", "en", "s1", 0) for i in range(5)]  # near copies
    rows += [(2000, None, None, None, None), (2001, "", "en", "s2", 0), (None, "no id here at all", "en", "s3", 17), (2002, "same", "en", "s3", 4), (2002, "same", "en", "s3", 4),
             (2003, "\n\n", "en", "s0", 2), (2004, "long " * 30000, "en", "s0", 150000)]
    path = scratch_path(spark, "corpus").removeprefix("file://")
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(marks + [(7, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(passage)), (2, None)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def plain(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = plain(docs)
        docs = written(stage(spark, docs, corpus), "t")
        seen[name] = (before, docs)
        if name != "mix":
            assert docs.columns == columns

    before, out = seen["toxicity"]
    assert sorted(map(str, plain(out))) == sorted(str(r) for r in before if "vilewrd" not in (r[1] or ""))

    before, out = seen["line_dedup"]
    keeper = max(i for i, t in before if t and SHARED in t)
    want = [(i, "\n".join(x for x in t.split("\n") if SHARED not in x) if t and i != keeper else t) for i, t in before]
    assert sorted(map(str, plain(out))) == sorted(map(str, want))
    assert out.filter((F.col("doc_id") < 240) & (F.col("n_chars") != F.length("text"))).count() == 0

    before, out = seen["near_dedup"]
    groups, _ = brute_components([r for r in before if r[0] is not None])
    assert sorted(map(str, plain(out))) == sorted(str(r) for r in before if r[0] is None or groups[r[0]] == r[0])
    assert not [i for i, _ in plain(out) if i is not None and 1000 <= i < 1005]

    before, out = seen["decontaminate"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect()]
    clean = Counter(str(r) for r, hit in ((r, brute_hits([r], items)[0][5]) for r in before) if not hit)
    assert Counter(map(str, plain(out))) == clean

    before, out = seen["mix"]
    rows = out.collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in before)
    sizes, taken = defaultdict(int), Counter()
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
    want = brute_targets(dict(sizes))
    for r in rows:
        assert r.target == pytest.approx(want[r.source]) and r.taken <= 3 * r.size
    assert all(abs(taken[s] - want[s]) <= max(5, 0.05 * want[s]) for s in sizes if s != "s0")  # s0 has one text of 30000 words


def test_run_and_empty_documents(spark, corpus):
    out = corpus_pipeline.run(spark, corpus)
    assert out.count() > 100 and "taken" in out.columns
    empty = spark.createDataFrame([], DOCS)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, corpus).count() == 0


def test_columns_of_the_stages_own_names_pass_through(spark, sf_dir):
    """No stage but the last changes a column that it does not mean to."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    names = ("n_lines", "n_dropped", "toxicity_score", "_toxicity", "_dc_key", "id", "th", "own_n_lines", "component_id", "kept")
    for i, c in enumerate(names):
        docs = docs.withColumn(c, F.col("doc_id") * 10 + i)
    docs = written(docs, "clash")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        for r in out.collect():
            assert [r[c] for c in names] == [r.doc_id * 10 + i for i in range(len(names))], name
