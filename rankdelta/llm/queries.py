"""One query per operator, over its whole table, plus the DuckDB SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankdelta.llm import queries_words  # noqa: F401  (registers its queries)
from rankdelta.llm import chat, decontam, lines, lm, mixing, neardup, neighbours, suffixes, toxicity, warc
from rankdelta.llm.registry import ORACLES, QUERIES, query  # noqa: F401


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


LINES_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT r, doc_id, u.i AS i, u.line AS line,
             translate(regexp_replace(u.line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM (SELECT r, doc_id, unnest(list_transform(string_split(t, chr(10)), lambda x, i: {'i': i, 'line': x})) AS u FROM d)),
s AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.*, s.k IS NOT NULL AND l.doc_id IS DISTINCT FROM s.keeper AS gone FROM l LEFT JOIN s USING (k))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT h, max(page_id) AS top FROM p WHERE strlen(h) >= 1000 GROUP BY h HAVING count(*) > 1)
SELECT page_id, CAST(strlen(p.h) AS BIGINT) AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN g.top IS NOT NULL AND page_id IS DISTINCT FROM g.top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM g.top THEN g.top END AS refers_to
FROM p LEFT JOIN g ON p.h = g.h
"""


@query("op3_line_dedup", LINES_SQL)
def op3(spark, sf_dir):
    out = lines.drop_shared_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query("op4_warc", WARC_SQL)
def op4(spark, sf_dir):
    folder, manifest = warc.write_archives(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc.read_archives(spark, folder, manifest, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ODD = "\\### Assistant: </turn> ok"
CHAT_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') AS et, regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g') AS er FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(er) + length(et) + 23) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op6_chat_format", CHAT_SQL)
def op6(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", ODD), (-7, 1, "assistant", ODD)],
                                  "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(rows.unionByName(extra)))


@query("op10_mix_sources")
def op10(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "n_copies")


NEARDUP_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, hash(array_to_string(ws[i:i + 4], ' '), least(len(ws), 5)) AS h
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS inter FROM s x JOIN s y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * inter >= 75 * (na.n + nb.n - inter)),
e2 AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e2.b FROM r JOIN e2 ON r.b = e2.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.low AS component_id, d.doc_id = c.low AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS low FROM r GROUP BY a) c ON c.a = d.doc_id
"""


@query("op1_near_duplicates", NEARDUP_SQL)
def op1(spark, sf_dir):
    return neardup.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"))


DECONTAM_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
bw AS (SELECT DISTINCT item_id, least(len(ws), 10) AS k, array_to_string(ws[o:o + least(len(ws), 10) - 1], ' ') AS win
       FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS o FROM b WHERE len(ws) > 0)),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT r, o, k, array_to_string(ws[o:o + k - 1], ' ') AS win
       FROM (SELECT r, ws, k, unnest(range(1, len(ws) - k + 2)) AS o FROM d, ks WHERE len(ws) >= k)),
h AS (SELECT r, o, k, item_id FROM dw JOIN bw USING (k, win)),
hw AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(o, o + k)) AS p FROM h) GROUP BY r),
hi AS (SELECT r, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
       FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS i FROM h) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (r) LEFT JOIN hi USING (r)
"""


@query("op8_decontaminate", DECONTAM_SQL)
def op8(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.contamination(docs, read(spark, sf_dir, "benchmark").select("item_id", "text")).drop("th")


REPEATS_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS t FROM documents),
w AS (SELECT r, i, hash(hex(t[i:i + 399])) AS h FROM (SELECT r, t, unnest(range(1, octet_length(t) - 398)) AS i FROM d WHERE octet_length(t) >= 400)),
x AS (SELECT r, i FROM w WHERE h IN (SELECT h FROM w GROUP BY h HAVING count(*) > 1)),
o AS (SELECT r, i, max(i) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM x),
g AS (SELECT r, i, sum(CASE WHEN before IS NULL OR i > before + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i ROWS UNBOUNDED PRECEDING) AS k FROM o),
s AS (SELECT r, k, min(i) AS a, max(i) + 400 AS b FROM g GROUP BY r, k),
p AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 1) AS prev,
             row_number() OVER (PARTITION BY r ORDER BY a DESC) = 1 AS last FROM s),
c AS (SELECT p.r, count(*) AS n_spans, sum(b - a) AS n_removed,
             string_agg(coalesce(hex(t[prev:a - 1]), '') || CASE WHEN last THEN coalesce(hex(t[b:octet_length(t)]), '') ELSE '' END, '' ORDER BY a) AS kept
      FROM p JOIN d ON d.r = p.r GROUP BY p.r)
SELECT doc_id, CAST(octet_length(t) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(CASE WHEN n_spans IS NULL THEN t ELSE unhex(kept) END) AS kept_sha256
FROM d LEFT JOIN c USING (r)
"""


@query("op9_suffix_dedup", REPEATS_SQL)
def op9(spark, sf_dir):
    out = suffixes.cut_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_lm_score")
def op5(spark, sf_dir):
    return lm.scores(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_toxicity")
def op7(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.with_scores(docs, read(spark, sf_dir, "labels").select("doc_id", "toxic"), column="score")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % toxicity.FOLDS
    return out.select("doc_id", F.coalesce(fold == 0, F.lit(True)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op2_nearest_neighbours")
def op2(spark, sf_dir):
    return neighbours.nearest(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), lambda i: i % 50 == 0)
