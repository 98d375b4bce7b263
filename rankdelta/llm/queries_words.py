"""Queries over the words of documents: spelling groups, licence scan, ranked search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from rankdelta.llm import lexical, licenses, spelling
from rankdelta.llm.registry import query


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


SPELLING_SQL = r"""
WITH RECURSIVE tab AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
           lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents WHERE text IS NOT NULL),
g AS (SELECT w, count(*) AS k, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w AS s FROM runs WHERE length(w) >= 6 GROUP BY doc_id, w),
h AS (SELECT w, k, xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(s, ''),
               lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [195, ord(c) - 64] END))),
             lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]))) AS h FROM g, tab),
x AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, k FROM h),
v AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM x WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
d AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
      FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (SELECT a.word AS word, b.word AS near FROM d a JOIN d b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
         UNION SELECT d.word, v.word FROM d JOIN v ON d.cut = v.word
         UNION SELECT v.word, d.word FROM d JOIN v ON d.cut = v.word),
b AS (SELECT near.word, near.near, v.n AS near_n, count(*) OVER (PARTITION BY near.word) AS n_near,
             row_number() OVER (PARTITION BY near.word ORDER BY v.n DESC, near.near) AS place
      FROM near JOIN v ON v.word = near.near),
f AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * v.n THEN near END AS form,
             CASE WHEN near_n >= 5 * v.n THEN near_n END AS form_n
      FROM v LEFT JOIN b ON b.word = v.word AND b.place = 1),
way(word, stop) AS (SELECT word, word FROM f UNION ALL SELECT way.word, f.form FROM way JOIN f ON f.word = way.stop WHERE f.form IS NOT NULL)
SELECT f.word, f.form, way.stop AS root, f.n, f.n_near, f.form_n
FROM f JOIN way ON way.word = f.word JOIN f last ON last.word = way.stop WHERE last.form IS NULL
"""


@query("op11_spelling_groups", SPELLING_SQL)
def op11(spark, sf_dir):
    return spelling.spelling_groups(read(spark, sf_dir, "documents").select("doc_id", "text"))


def licence_sql(templates: Sequence[licenses.Template] = (*licenses.BASE, *licenses.NOTICES),
                slack: int = licenses.SLACK, share: float = licenses.MIN_SHARE) -> str:
    """The licence scan in SQL, over the same templates."""
    t = ", ".join(f"({i}, '{t.label}', {t.base})" for i, t in enumerate(templates))
    w = ", ".join(f"({i}, {j}, '{x}')" for i, t in enumerate(templates) for j, x in enumerate(t.words))
    p = ", ".join(f"({i}, {k}, {a}, {n}, '{t.words[a]}', '{' '.join(t.words[a:a + n])}')"
                  for i, t in enumerate(templates) for k, (a, n) in enumerate(t.spans))
    return rf"""
WITH t(tid, label, base) AS (VALUES {t}), tw(tid, j, tok) AS (VALUES {w}), tp(tid, k, a, n, tok, phrase) AS (VALUES {p}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
o AS (SELECT r, p, tok FROM (SELECT r, unnest(ws) AS tok, unnest(range(len(ws))) AS p FROM d)
      WHERE tok IN (SELECT tok FROM tw)),
df AS (SELECT tok, count(DISTINCT r) AS df FROM o GROUP BY tok),
wt AS (SELECT tid, j, tok, greatest(1, CAST(floor(1000 * ln((2 * (SELECT count(*) FROM d) + 2) / (2 * coalesce(df, 0) + 1))) AS BIGINT)) AS w
       FROM tw LEFT JOIN df USING (tok)),
pl AS (SELECT o.r, tp.tid, tp.k, o.p AS s, o.p - tp.a AS diagonal FROM o JOIN tp USING (tok) JOIN d USING (r)
       WHERE array_to_string(d.ws[o.p + 1:o.p + tp.n], ' ') = tp.phrase),
al AS (SELECT a.r, a.tid, a.diagonal FROM pl a JOIN t USING (tid) WHERE a.k = 0 AND NOT t.base
       AND (SELECT count(DISTINCT b.k) FROM pl b WHERE b.r = a.r AND b.tid = a.tid
              AND b.diagonal BETWEEN a.diagonal - {slack} AND a.diagonal + {slack}) = (SELECT count(*) FROM tp x WHERE x.tid = a.tid)),
sh AS (SELECT r, tid, diagonal, sum(w) AS got FROM (
         SELECT DISTINCT al.r, al.tid, al.diagonal, wt.j, wt.w FROM al JOIN wt USING (tid)
         JOIN o ON o.r = al.r AND o.tok = wt.tok AND o.p BETWEEN al.diagonal + wt.j - {slack} AND al.diagonal + wt.j + {slack}) GROUP BY ALL),
tot AS (SELECT tid, sum(w) AS w FROM wt GROUP BY tid),
m AS (SELECT r, label, s, 1.0::DOUBLE AS share, true AS base FROM pl JOIN t USING (tid) WHERE t.base
      UNION ALL SELECT r, label, NULL, got / tot.w, false FROM sh JOIN tot USING (tid) JOIN t USING (tid) WHERE got / tot.w >= {share}),
e AS (SELECT r, count(*) FILTER (base) AS n_base, min(s) FILTER (base) AS first_word, max(s) FILTER (base) AS last_word,
             string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
             string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM m GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN e USING (r)
"""


@query("op12_license_scan", licence_sql())
def op12(spark, sf_dir):
    return licenses.summary(licenses.find_licenses(read(spark, sf_dir, "documents").select("doc_id", "text")))


SEARCH_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS tok FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
tf AS (SELECT r, tok, count(*) AS tf FROM (SELECT r, unnest(ws) AS tok FROM d) GROUP BY r, tok),
a AS (SELECT count(*) AS docs, CAST(sum(len(ws)) AS BIGINT) AS total FROM d WHERE len(ws) > 0),
w AS (SELECT tok, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT tok, count(*) AS df FROM tf GROUP BY tok), a),
m AS (SELECT r, doc_id, 100 - 90 + (90 * CAST(len(ws) AS BIGINT) * docs) // total AS m FROM d, a WHERE len(ws) > 0),
s AS (SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (tok) JOIN tf USING (tok) JOIN m USING (r) GROUP BY item_id, r, doc_id),
p AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
      FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM p WHERE rank <= 10
"""


@query("op13_ranked_search", SEARCH_SQL)
def op13(spark, sf_dir):
    return lexical.search(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
