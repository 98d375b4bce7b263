"""Every registered query: a Spark plan over the driver tables and its DuckDB twin.

Column names and types are aligned on both sides: ranks INTEGER, counts
BIGINT, texts VARCHAR, capture times TIMESTAMP (timestamp_ntz in Spark).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from rankdelta.operators import baseline as B
from rankdelta.operators import changes as C
from rankdelta.operators import report as R
from rankdelta.plans import feeds
from rankdelta.plans import sqlfrag as S
from rankdelta.plans.registry import query
from rankdelta.schema import ReportParams, STATUS_SAME
from rankdelta.session import staged

SNAP = "id, rank, brand, product, old_price, price, captured_at, channel, created_at"
ANN_DAY = f"{SNAP}, brand_key, product_key, prev_rank_day, delta_day, status_day"
ANN_WEEK = f"{ANN_DAY}, prev_rank_week, delta_week, status_week"
CO_COLS = "channel, captured_at, brand, product, brand_key, product_key, prev_rank_day, status_day"

# Report parameters for the event-derived feeds: "$" prices on two channels,
# even-numbered brands as the watch-list of the half-day feed.
EVENT_PARAMS = ReportParams(dollar_channels=("click-0", "main"))
SMALL_PARAMS = ReportParams(dollar_channels=("click-0", "purchase-1", "main"))
HALF_PARAMS = ReportParams(watch_brands=feeds.watch_brands_even(), dollar_channels=("click", "purchase"))


def _with(chain: str, body: str) -> str:
    return f"WITH {chain}\n{body}"


def _sql_list(values) -> str:
    return ", ".join(S.q(v) for v in values)


# ---------------------------------------------------------------------------
# J1 / J2 / J3 on the one-snapshot-a-day feed (exact offsets)
# ---------------------------------------------------------------------------
DAY_CHAIN = S.offset_chain(S.FEED_DAY)


@query("rank_change_daily", oracle=_with(DAY_CHAIN, f"SELECT {ANN_DAY} FROM ad2"),
       ids=("J1", "MTH-1", "FMT-1", "STR-6", "PRJ-2"))
def rank_change_daily(spark, d):
    return C.by_offset(feeds.feed_day(spark, d)).daily()


@query("chart_out", oracle=_with(DAY_CHAIN, f"SELECT {CO_COLS} FROM co"), ids=("J2", "SET-2"))
def chart_out(spark, d):
    return C.by_offset(feeds.feed_day(spark, d)).chart_outs()


@query("rank_change_weekly", oracle=_with(DAY_CHAIN, f"SELECT {ANN_WEEK} FROM aw"), ids=("J3", "FMT-2"))
def rank_change_weekly(spark, d):
    return C.by_offset(feeds.feed_day(spark, d)).weekly()


_COUNTS_SQL = f"""
SELECT channel, captured_at,
       count(CASE WHEN delta_day > 0 THEN 1 END) AS up_count, count(CASE WHEN delta_day < 0 THEN 1 END) AS down_count,
       count(CASE WHEN status_day = '신규' THEN 1 END) AS new_count,
       count(CASE WHEN status_day = '{STATUS_SAME}' THEN 1 END) AS keep_count
FROM ad2 WHERE rank <= 50 GROUP BY channel, captured_at"""


@query("movement_counts", oracle=_with(DAY_CHAIN, _COUNTS_SQL), ids=("A2", "FLT-2"))
def movement_counts(spark, d):
    return R.movement_counts(C.by_offset(feeds.feed_day(spark, d)).daily())


@query("chart_out_counts", oracle=_with(DAY_CHAIN, """
SELECT channel, captured_at, count(*) AS chart_out_count
FROM co WHERE prev_rank_day IS NOT NULL AND prev_rank_day <= 50 GROUP BY channel, captured_at"""), ids=("A4",))
def chart_out_counts(spark, d):
    return R.chart_out_counts(C.by_offset(feeds.feed_day(spark, d)).chart_outs())


@query("chart_out_top5", oracle=_with(DAY_CHAIN, f"""
SELECT * FROM (
  SELECT {CO_COLS}, CAST(row_number() OVER (PARTITION BY channel, captured_at
                         ORDER BY prev_rank_day, brand_key, product_key) AS INTEGER) AS pos
  FROM co WHERE prev_rank_day IS NOT NULL AND prev_rank_day <= 50) t
WHERE pos <= 5"""), ids=("W3",))
def chart_out_top5(spark, d):
    return R.chart_out_top(C.by_offset(feeds.feed_day(spark, d)).chart_outs())


@query("distinct_channels", oracle=_with(DAY_CHAIN, "SELECT DISTINCT channel FROM ad2 WHERE channel IS NOT NULL"),
       ids=("A5",))
def distinct_channels(spark, d):
    return R.distinct_channels(C.by_offset(feeds.feed_day(spark, d)).daily())


@query("movement_status", oracle=_with(DAY_CHAIN, """
SELECT delta_day, status_day, count(*) AS n FROM ad2 GROUP BY delta_day, status_day"""), ids=("FMT-1",))
def movement_status(spark, d):
    daily = C.by_offset(feeds.feed_day(spark, d)).daily()
    return daily.groupBy("delta_day", "status_day").agg(F.count(F.lit(1)).alias("n"))


@query("no_baseline_status", oracle=_with(DAY_CHAIN, f"""
SELECT channel, captured_at,
       EXISTS (SELECT 1 FROM bd WHERE bd.channel = aw.channel AND bd.captured_at = aw.captured_at) AS has_day_baseline,
       EXISTS (SELECT 1 FROM hw WHERE hw.channel = aw.channel AND hw.captured_at = aw.captured_at) AS has_week_baseline,
       status_day, status_week, count(*) AS n
FROM aw GROUP BY ALL"""), ids=("FMT-2",))
def no_baseline_status(spark, d):
    cs = C.by_offset(feeds.feed_day(spark, d))
    day_has = C.baseline_present(cs.base_day).withColumnRenamed("has_baseline", "has_day_baseline")
    week_has = C.baseline_present(cs.base_week).withColumnRenamed("has_baseline", "has_week_baseline")
    w = (cs.weekly().join(day_has, C.REPORT_KEY, "left").join(week_has, C.REPORT_KEY, "left")
         .fillna(False, subset=["has_day_baseline", "has_week_baseline"]))
    return w.groupBy("channel", "captured_at", "has_day_baseline", "has_week_baseline",
                     "status_day", "status_week").agg(F.count(F.lit(1)).alias("n"))


DUP_CHAIN = S.offset_chain(S.FEED_DAY_DUP)
ONE_CHAIN = S.offset_chain(S.FEED_DAY_DUP, dedup=True)


@query("rank_change_daily_dup", oracle=_with(DUP_CHAIN, f"SELECT {ANN_DAY} FROM ad2"), ids=("J1", "J3"))
def rank_change_daily_dup(spark, d):
    """Names repeat within a snapshot: equal keys multiply rows."""
    return C.by_offset(feeds.feed_day(spark, d, unique_names=False)).daily()


@query("rank_change_daily_dedup", oracle=_with(ONE_CHAIN, f"SELECT {ANN_DAY} FROM ad2"), ids=("J1", "A6"))
def rank_change_daily_dedup(spark, d):
    return C.by_offset(feeds.feed_day(spark, d, unique_names=False), dedup=True).daily()


@query("canonical_columns", oracle=f"SELECT {SNAP} FROM {S.FEED_DAY} f", ids=("PRJ-2",))
def canonical_columns(spark, d):
    drifted = feeds.feed_day(spark, d).withColumnsRenamed(
        {"captured_at": "DateTime", "old_price": "Old_Price", "rank": "Ranking", "created_at": "Created_At"})
    return K.canonicalise(drifted)


# ---------------------------------------------------------------------------
# J4 - J8 on the four-slots-a-day feed of small channels and the large one (resolved baselines)
# ---------------------------------------------------------------------------
SLOT_CHAIN = S.resolve_chain(S.FEED_SLOT)
SMALL_CHAIN = S.resolve_chain(S.FEED_SMALL)


@query("latest_snapshot", oracle=_with(SMALL_CHAIN, """
SELECT l.channel, l.day, l.captured_at, (SELECT count(*) FROM cur WHERE cur.channel = l.channel
       AND cur.captured_at = l.captured_at) AS n_rows
FROM latest l"""), ids=("J7", "A1", "FLT-3"))
def latest_snapshot(spark, d):
    rows = feeds.feed_small(spark, d)
    latest = B.latest_per_day(B.catalogue(rows))
    cur = C.by_resolution(rows)[0].current
    n = cur.groupBy(*C.REPORT_KEY).agg(F.count(F.lit(1)).alias("n_rows"))
    return latest.join(n, C.REPORT_KEY, "left").fillna(0, subset=["n_rows"])


def _requests(rows):
    cat = staged(B.catalogue(rows), "catalogue")
    return B.requests(B.latest_per_day(cat), (1, 7)), cat


@query("baseline_nearest", oracle=_with(SMALL_CHAIN, "SELECT channel, captured_at, offset_days, nearest_created_at FROM near"),
       ids=("J4", "DT-2", "DT-3"))
def baseline_nearest(spark, d):
    return B.nearest_pick(*_requests(feeds.feed_small(spark, d)))


@query("baseline_asof", oracle=_with(SMALL_CHAIN, "SELECT channel, captured_at, offset_days, asof_created_at FROM asofp"),
       ids=("J5",))
def baseline_asof(spark, d):
    return B.asof_pick(*_requests(feeds.feed_small(spark, d))).drop("target_at")


@query("baseline_resolve", oracle=_with(SMALL_CHAIN, "SELECT channel, captured_at, offset_days, target_at, base_created_at, how FROM pick"),
       ids=("J6",))
def baseline_resolve(spark, d):
    return B.resolve(*_requests(feeds.feed_small(spark, d)))


@query("rank_report", oracle=_with(SMALL_CHAIN, f"SELECT {ANN_WEEK} FROM aw"), ids=("J8", "SRC-12"))
def rank_report(spark, d):
    return C.by_resolution(feeds.feed_small(spark, d))[0].weekly()


RUN_AT = _dt.datetime(2024, 1, 20, 13, 30)
_AT_CHAIN = S.resolve_chain(S.FEED_SLOT, run_at="TIMESTAMP '2024-01-20 13:30:00'")
_SMALL_AT_CHAIN = S.resolve_chain(S.FEED_SMALL, run_at="TIMESTAMP '2024-01-20 13:30:00'")


@query("report_at", oracle=_with(_SMALL_AT_CHAIN, f"SELECT {ANN_WEEK} FROM aw"), ids=("J8", "DT-2"))
def report_at(spark, d):
    """The report of one run time, which differs from the snapshots' capture times."""
    return C.by_resolution(feeds.feed_small(spark, d), run_at=RUN_AT)[0].weekly()


@query("rank_report_chart_out", oracle=_with(SMALL_CHAIN, f"SELECT {CO_COLS} FROM co"), ids=("J2", "J8"))
def rank_report_chart_out(spark, d):
    return C.by_resolution(feeds.feed_small(spark, d))[0].chart_outs()


def _top_sql(params: ReportParams) -> str:
    return f"""
SELECT channel, captured_at, pos, rank, brand, product,
       CASE WHEN channel IN ({_sql_list(params.dollar_channels)}) AND price IS NOT NULL THEN '$' || price ELSE price END AS price,
       coalesce(status_day, '-') AS status_day, coalesce(status_week, '-') AS status_week, '' AS remark
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY channel, captured_at
             ORDER BY rank, brand_key, product_key, prev_rank_day NULLS FIRST, prev_rank_week NULLS FIRST) AS INTEGER) AS pos
      FROM aw WHERE rank IS NOT NULL) t
WHERE pos <= 50"""


_TOP_SQL, _SMALL_TOP_SQL = _top_sql(EVENT_PARAMS), _top_sql(SMALL_PARAMS)


@query("report_top_n", oracle=_with(SMALL_CHAIN, _SMALL_TOP_SQL), ids=("W4", "PRJ-3", "PRC-4", "FMT-3", "ORD-1"))
def report_top_n(spark, d):
    return R.top_n(C.by_resolution(feeds.feed_small(spark, d))[0].weekly(), SMALL_PARAMS)


@query("trend_class", oracle=_with(SLOT_CHAIN, f"""
SELECT *, CASE WHEN starts_with(status_day, '▲') THEN 'up' WHEN starts_with(status_day, '▼') THEN 'down' ELSE '' END AS trend_day,
          CASE WHEN starts_with(status_week, '▲') THEN 'up' WHEN starts_with(status_week, '▼') THEN 'down' ELSE '' END AS trend_week
FROM ({_TOP_SQL}) x"""), ids=("FMT-4",))
def trend_class(spark, d):
    return R.with_trend(R.top_n(C.by_resolution(feeds.feed_slot(spark, d))[0].weekly(), EVENT_PARAMS))


@query("baseline_labels", oracle=_with(SMALL_CHAIN, """
, lab AS (
  SELECT channel, captured_at, 1 AS offset_days, arg_min(base_captured_at, (rank, brand_key, product_key)) AS base_captured_at FROM bd GROUP BY 1, 2
  UNION ALL
  SELECT channel, captured_at, 7, arg_min(base_captured_at, (rank, brand_key, product_key)) FROM bw GROUP BY 1, 2)
SELECT p.channel, p.captured_at, p.offset_days, p.base_created_at,
       strftime(p.base_created_at, '%Y-%m-%d %H:%M') AS pick_label, l.base_captured_at,
       CASE WHEN l.base_captured_at IS NULL THEN NULL
            WHEN microsecond(l.base_captured_at) % 1000000 = 0 THEN strftime(l.base_captured_at, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(l.base_captured_at, '%Y-%m-%d %H:%M:%S.%f') END AS label
FROM pick p LEFT JOIN lab l ON l.channel = p.channel AND l.captured_at = p.captured_at AND l.offset_days = p.offset_days
""".replace("\n, lab AS", ",\nlab AS", 1)), ids=("A7", "DT-4"))
def baseline_labels(spark, d):
    cs, day_pairs, week_pairs = C.by_resolution(feeds.feed_small(spark, d))
    out = []
    for k, pairs, base in ((1, day_pairs, cs.base_day), (7, week_pairs, cs.base_week)):
        labels = R.baseline_labels(base)
        out.append(R.pick_labels(pairs).join(labels, C.REPORT_KEY, "left").select(
            "channel", "captured_at", F.lit(k).alias("offset_days"), "base_created_at", "pick_label",
            "base_captured_at", "label"))
    return out[0].unionByName(out[1])


# ---------------------------------------------------------------------------
# W2 / FMT-5 on the half-day feed
# ---------------------------------------------------------------------------
HALF_CHAIN = S.offset_chain(S.FEED_HALF)
_WATCH = _sql_list(HALF_PARAMS.watch_brands)

_HL_SQL = f"""
, a AS (SELECT *, abs(delta_day) AS abs_delta FROM ad2
        WHERE rank <= 50 AND status_day IS NOT NULL AND status_day NOT IN ('', '-')),
cand AS (
  SELECT *, 1 AS tier, -abs_delta AS o1, rank AS o2 FROM a WHERE abs_delta >= 2
  UNION ALL
  SELECT *, 2, -abs_delta, rank FROM a
   WHERE lower(brand) IN ({_WATCH}) AND coalesce(abs_delta, 0) > CASE WHEN status_day = '신규' THEN 1 ELSE 0 END
  UNION ALL
  SELECT *, 3, rank, 0 FROM a WHERE rank <= 10),
t1 AS (SELECT channel, captured_at, count(DISTINCT (brand, product)) AS n1 FROM cand WHERE tier = 1 GROUP BY 1, 2),
gated AS (
  SELECT cand.* FROM cand LEFT JOIN t1 USING (channel, captured_at)
  WHERE tier <> 2 OR least(coalesce(n1, 0), 7) < 5),
firsts AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY channel, captured_at, brand, product
                                 ORDER BY tier, o1, o2, delta_day DESC NULLS LAST, brand_key, product_key) AS k
    FROM gated) x WHERE k = 1),
hl AS (
  SELECT * FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY channel, captured_at
                   ORDER BY tier, o1, o2, delta_day DESC NULLS LAST, brand_key, product_key) AS INTEGER) AS line_no
    FROM firsts) y WHERE line_no <= 7)"""


@query("highlights", oracle=_with(HALF_CHAIN, _HL_SQL.replace("\n, a AS", ",\na AS", 1) + """
SELECT channel, captured_at, line_no, CAST(tier AS INTEGER) AS tier, brand, product, rank, status_day,
       '  ' || status_day || ': ' || brand || ' - ' || product || '(#' || CAST(rank AS VARCHAR) || ')' AS line
FROM hl"""), ids=("W2", "FLT-5", "FLT-6", "MTH-2", "ORD-2"))
def highlights(spark, d):
    return R.highlights(C.by_offset(feeds.feed_half(spark, d)).daily(), HALF_PARAMS)


_DIGEST_SQL = _HL_SQL.replace("\n, a AS", ",\na AS", 1) + f""",
labd AS (SELECT channel, captured_at, arg_min(base_captured_at, (rank, brand_key, product_key)) AS b FROM bd GROUP BY 1, 2),
labw AS (SELECT channel, captured_at, arg_min(base_captured_at, (rank, brand_key, product_key)) AS b FROM bw GROUP BY 1, 2),
cnt AS ({_COUNTS_SQL}),
pres AS (SELECT DISTINCT channel, captured_at FROM ad2),
cof AS (SELECT * FROM co WHERE prev_rank_day IS NOT NULL AND prev_rank_day <= 50),
cotop AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY channel, captured_at
                         ORDER BY prev_rank_day, brand_key, product_key) AS pos FROM cof) z WHERE pos <= 5),
lines AS (
  SELECT r.channel, r.captured_at, 1 AS line_no,
         '전일 기준: ' || coalesce(strftime(d.b, '%Y-%m-%d %H:%M:%S'), '참고 가능한 데이터 없음') AS line
  FROM rep r LEFT JOIN labd d USING (channel, captured_at)
  UNION ALL
  SELECT r.channel, r.captured_at, 2,
         '전주 기준: ' || coalesce(strftime(w.b, '%Y-%m-%d %H:%M:%S'), '참고 가능한 데이터 없음')
  FROM rep r LEFT JOIN labw w USING (channel, captured_at)
  UNION ALL SELECT channel, captured_at, 3, '' FROM rep
  UNION ALL
  SELECT p.channel, p.captured_at, 4,
         '[' || p.channel || '] ▲ ' || coalesce(up_count, 0) || ' / ▼ ' || coalesce(down_count, 0)
         || ' / 신규 ' || coalesce(new_count, 0) || ' / 유지 ' || coalesce(keep_count, 0)
  FROM pres p LEFT JOIN cnt USING (channel, captured_at)
  UNION ALL
  SELECT channel, captured_at, line_no + 10,
         '  ' || status_day || ': ' || brand || ' - ' || product || '(#' || CAST(rank AS VARCHAR) || ')' FROM hl
  UNION ALL SELECT DISTINCT channel, captured_at, 30, '' FROM hl
  UNION ALL SELECT channel, captured_at, 40, '차트 아웃 ' || count(*) || '개' FROM cof GROUP BY 1, 2
  UNION ALL
  SELECT channel, captured_at, 40 + pos, '  #' || CAST(prev_rank_day AS VARCHAR) || ' ' || brand || ' - ' || product
  FROM cotop)
SELECT channel, captured_at, string_agg(line, chr(10) ORDER BY line_no) AS digest, count(*) AS n_lines
FROM lines WHERE EXISTS (SELECT 1 FROM rep WHERE rep.channel = lines.channel AND rep.captured_at = lines.captured_at)
GROUP BY channel, captured_at"""


@query("digest_text", oracle=_with(HALF_CHAIN, _DIGEST_SQL), ids=("FMT-5", "A2", "A4", "W2", "W3", "A7"))
def digest_text(spark, d):
    return R.digest(C.by_offset(feeds.feed_half(spark, d)).charted(HALF_PARAMS.report_limit), HALF_PARAMS)


# ---------------------------------------------------------------------------
# Cleaning steps on the dirty feed (PRJ-4..6, FLT-1, STR-5/6)
# ---------------------------------------------------------------------------
from rankdelta.operators import clean as K  # noqa: E402

DIRTY = S.FEED_DIRTY


@query("clean_rank", oracle=f"""
SELECT id, rank FROM (SELECT id, {S.rank_int('rank', True)} AS rank FROM {DIRTY} f) t WHERE rank IS NOT NULL""",
       ids=("PRJ-4",))
def clean_rank(spark, d):
    return K.clean_rank(feeds.feed_dirty(spark, d)).select("id", "rank")


@query("fill_blank", oracle=f"""
SELECT id, coalesce(brand, '') AS brand, coalesce(price, '') AS price, coalesce(old_price, '') AS old_price,
       coalesce(channel, '') AS channel FROM {DIRTY} f""", ids=("PRJ-5",))
def fill_blank(spark, d):
    return K.fill_blank(feeds.feed_dirty(spark, d)).select("id", "brand", "price", "old_price", "channel")


@query("default_old_price", oracle=f"""
SELECT id, price, CASE WHEN old_price IS NULL OR {S.strip('old_price')} IN ('', 'N/A') THEN price ELSE old_price END AS old_price
FROM {DIRTY} f""", ids=("PRJ-6",))
def default_old_price(spark, d):
    return K.default_old_price(feeds.feed_dirty(spark, d)).select("id", "price", "old_price")


@query("require_cols", oracle=f"SELECT id, rank, product FROM {DIRTY} f WHERE rank IS NOT NULL AND product IS NOT NULL",
       ids=("FLT-1",))
def require_cols(spark, d):
    return K.require(feeds.feed_dirty(spark, d)).select("id", "rank", "product")


@query("preprocess_ranks", oracle=f"""
SELECT id, rank, brand, product, channel, brand_key, product_key FROM {S.preprocess(DIRTY, rank_is_text=True)} p""",
       ids=("STR-6", "STR-5", "PRJ-7"))
def preprocess_ranks(spark, d):
    return K.preprocess(feeds.feed_dirty(spark, d)).select(
        "id", "rank", "brand", "product", "channel", "brand_key", "product_key")


@query("collector_rows", oracle=f"""
SELECT id, rank, coalesce(brand, '') AS brand, product,
       CASE WHEN old_price IS NULL OR {S.strip('old_price')} IN ('', 'N/A') THEN coalesce(price, '') ELSE old_price END AS old_price,
       coalesce(price, '') AS price, coalesce(channel, '') AS channel
FROM (SELECT id, {S.rank_int('rank', True)} AS rank, brand, product, old_price, price, channel
      FROM {DIRTY} f WHERE rank IS NOT NULL AND product IS NOT NULL) t
WHERE rank IS NOT NULL""", ids=("PRJ-4", "PRJ-5", "PRJ-6", "FLT-1"))
def collector_rows(spark, d):
    return K.collector_clean(feeds.feed_dirty(spark, d)).select(
        "id", "rank", "brand", "product", "old_price", "price", "channel")


# ---------------------------------------------------------------------------
# Titles and keys (STR-1..4, A6) on part-derived titles
# ---------------------------------------------------------------------------
from rankdelta.functions import text as X  # noqa: E402


def _split_sql(title_expr: str) -> tuple[str, str]:
    parts_brand = S.strip(f"split_part({title_expr}, '-', 1)")
    rest = f"substr({title_expr}, strpos({title_expr}, '-') + 1)"
    return parts_brand, rest


def _split_cols_sql(cleaner) -> tuple[str, str]:
    name = cleaner("raw_title")
    b, rest = _split_sql(name)
    brand = f"CASE WHEN strpos({name}, '-') = 0 OR {b} = '' THEN 'N/A' ELSE {b} END"
    product = f"CASE WHEN strpos({name}, '-') > 0 THEN {cleaner(rest)} ELSE {name} END"
    return brand, product


_BA, _PA = _split_cols_sql(S.clean_title)
_BB, _PB = _split_cols_sql(S.clean_plain)


@query("clean_titles", oracle=f"SELECT item_id, raw_title, {S.clean_title('raw_title')} AS title FROM {S.TITLES} t",
       ids=("STR-1",))
def clean_titles(spark, d):
    t = feeds.titles(spark, d)
    return t.select("item_id", "raw_title", X.clean_title("raw_title").alias("title"))


@query("clean_titles_plain", oracle=f"SELECT item_id, raw_title, {S.clean_plain('raw_title')} AS title FROM {S.TITLES} t",
       ids=("STR-2",))
def clean_titles_plain(spark, d):
    t = feeds.titles(spark, d)
    return t.select("item_id", "raw_title", X.clean_title_plain("raw_title").alias("title"))


@query("split_brand", oracle=f"""
SELECT item_id, {_BA} AS brand_a, {_PA} AS product_a, {_BB} AS brand_b, {_PB} AS product_b FROM {S.TITLES} t""",
       ids=("STR-4",))
def split_brand(spark, d):
    t = feeds.titles(spark, d)
    ba, pa = X.split_brand_product("raw_title", X.clean_title)
    bb, pb = X.split_brand_product("raw_title", X.clean_title_plain)
    return t.select("item_id", ba.alias("brand_a"), pa.alias("product_a"), bb.alias("brand_b"), pb.alias("product_b"))


_KEYS_SQL = f"""
SELECT item_id, rank, brand, product, {S.match_key('brand')} AS brand_key, {S.match_key('product')} AS product_key
FROM (SELECT item_id, rank, {_BA} AS brand, {_PA} AS product FROM {S.TITLES} t) s"""


@query("match_keys", oracle=_KEYS_SQL, ids=("STR-3",))
def match_keys(spark, d):
    t = feeds.titles(spark, d)
    brand, product = X.split_brand_product("raw_title", X.clean_title)
    return K.with_match_keys(t.select("item_id", "rank", brand.alias("brand"), product.alias("product")))


@query("dedup_match_keys", oracle=f"""
SELECT item_id, rank, brand, product, brand_key, product_key FROM (
  SELECT *, row_number() OVER (PARTITION BY brand_key, product_key ORDER BY rank, item_id) AS k FROM ({_KEYS_SQL}) x) y
WHERE k = 1""", ids=("A6",))
def dedup_match_keys(spark, d):
    return C.dedup_keys(match_keys(spark, d), [], ("rank", "item_id"))


# ---------------------------------------------------------------------------
# Price readers (PRC-1..3) on part-derived price texts
# ---------------------------------------------------------------------------
from rankdelta.functions import price as P  # noqa: E402

_SYM = f"[{S.CURRENCY_SYMBOLS}]"
_SYM_NUM = f"{_SYM}{S.WS}?{S.NUM_RE}"
_PFX_NUM = f"(?s)^(.*?)({S.NUM_RE})"


_READ_SYMBOL = f"""CASE WHEN price_text IS NULL OR price_text = '' THEN 'N/A'
       WHEN regexp_matches(price_text, {S.q(_SYM_NUM)}) THEN regexp_extract(price_text, {S.q(_SYM_NUM)}, 0)
       WHEN regexp_matches(price_text, {S.q(S.NUM_RE)}) THEN
         CASE WHEN regexp_matches(regexp_extract(price_text, {S.q(_PFX_NUM)}, 1), {S.q(_SYM + S.WS + '*' + chr(92) + 'z')})
              THEN regexp_extract(regexp_extract(price_text, {S.q(_PFX_NUM)}, 1), {S.q('(' + _SYM + ')' + S.WS + '*' + chr(92) + 'z')}, 1)
                   || ' ' || regexp_extract(price_text, {S.q(S.NUM_RE)}, 0)
              ELSE regexp_extract(price_text, {S.q(S.NUM_RE)}, 0) END
       ELSE {S.strip('price_text')} END"""


@query("price_with_symbol", oracle=f"SELECT item_id, price_text, {_READ_SYMBOL} AS price FROM {S.PRICES} p", ids=("PRC-1",))
def price_with_symbol(spark, d):
    p = feeds.prices(spark, d)
    return p.select("item_id", "price_text", P.price_with_symbol("price_text").alias("price"))


@query("price_amount", oracle=f"""
SELECT item_id, price_text,
  CASE WHEN price_text IS NULL OR regexp_extract(price_text, '[\\p{{Nd}},.]+', 0) = '' THEN 'N/A'
       ELSE regexp_extract(price_text, '[\\p{{Nd}},.]+', 0) END AS price
FROM {S.PRICES} p""", ids=("PRC-2",))
def price_amount(spark, d):
    p = feeds.prices(spark, d)
    return p.select("item_id", "price_text", P.price_amount("price_text").alias("price"))


@query("price_first_number", oracle=f"""
SELECT item_id, CASE WHEN sale = '' OR orig = '' THEN '' ELSE sale END AS price,
       CASE WHEN sale = '' OR orig = '' THEN '' ELSE orig END AS old_price,
       (sale = '' OR orig = '') AS blanked
FROM (SELECT item_id, regexp_extract(price_text, '\\p{{Nd}}+(?:\\.\\p{{Nd}}+)?', 0) AS sale,
             regexp_extract(old_price_text, '\\p{{Nd}}+(?:\\.\\p{{Nd}}+)?', 0) AS orig
      FROM (SELECT item_id, price_text,
              CASE item_id % 4 WHEN 0 THEN 'USD 1,' || CAST(item_id AS VARCHAR) || '.50' WHEN 1 THEN 'was ' || CAST(item_id % 50 AS VARCHAR)
                               WHEN 2 THEN 'sold out' ELSE CAST(item_id AS VARCHAR) || '.5' END AS old_price_text
            FROM {S.PRICES} p0) p) t""", ids=("PRC-3",))
def price_first_number(spark, d):
    p = feeds.prices(spark, d)
    k = F.col("item_id") % 4
    iid = F.col("item_id").cast("string")
    old_text = (F.when(k == 0, F.concat(F.lit("USD 1,"), iid, F.lit(".50")))
                .when(k == 1, F.concat(F.lit("was "), (F.col("item_id") % 50).cast("string")))
                .when(k == 2, F.lit("sold out"))
                .otherwise(F.concat(iid, F.lit(".5"))))
    return p.select("item_id", *[c.alias(n) for n, c in P.price_pair("price_text", old_text).items()])


# ---------------------------------------------------------------------------
# Listing pages (SRC-1..4, PRJ-8, W1, W5, FLT-4)
# ---------------------------------------------------------------------------
from rankdelta.sources import listing as L  # noqa: E402

_SEQ_SQL = f"""
SELECT page_id, url, split_part(split_part(url, '?', 1), '#', 1) AS base_url,
       regexp_extract(url, '^[A-Za-z]+://([^/]+/[a-z]{{2}})/', 1) AS listing,
       TRY_CAST(nullif(regexp_extract(url, '[?&]page=(\\p{{Nd}}+)', 1), '') AS INTEGER) AS page_param,
       coalesce(TRY_CAST(nullif(regexp_extract(url, '[?&]page=(\\p{{Nd}}+)', 1), '') AS INTEGER), 1) AS page_no
FROM pages"""
_CARDS_SQL = f"""
SELECT page_id, listing, page_no, unnest(l) AS item, unnest(range(1, len(l) + 1)) AS position
FROM (SELECT s.*, regexp_extract_all(p.html, '(?s)<li(?:\\s[^>]*)?>(.*?)</li>', 1) AS l
      FROM ({_SEQ_SQL}) s JOIN pages p ON s.page_id = p.page_id) t"""
_ITEMS_SQL = f"""
SELECT page_id, listing, page_no, CAST(position AS INTEGER) AS position,
       regexp_extract(item, 'href="([^"]*)"', 1) AS href,
       regexp_extract(item, 'title="([^"]*)"', 1) AS title_attr,
       regexp_extract(item, '(?s)<b>([^<]*)</b>', 1) AS inner_text,
       regexp_extract(item, '(?s)>([^<>]*)</a>', 1) AS raw_title
FROM ({_CARDS_SQL}) t"""
_NAMED_SQL = f"""
SELECT page_id, listing, page_no, CAST(position AS INTEGER) AS position, regexp_matches(item, '(?s)>[^<>]*</a>') AS found,
       regexp_extract(item, '(?s)>([^<>]*)</a>', 1) AS name
FROM ({_CARDS_SQL}) t"""


def _ranked_sql(src: str, limit: int = 100, order: str = "page_no, page_id, position") -> str:
    return f"""(SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY listing ORDER BY {order}) AS INTEGER) AS rank
              FROM ({src}) a) b WHERE rank <= {limit})"""


@query("page_sequence", oracle=_SEQ_SQL, ids=("SRC-4",))
def page_sequence(spark, d):
    return L.page_sequence(feeds.table(spark, d, "pages"))


@query("listing_items", oracle=_ITEMS_SQL, ids=("SRC-1",))
def listing_items(spark, d):
    return L.listing_items(feeds.table(spark, d, "pages"))


@query("listing_attr_fallback", oracle=f"""
SELECT page_id, position,
       coalesce(nullif(title_attr, ''), nullif(inner_text, ''), nullif(raw_title, ''), nullif(href_name, '')) AS name,
       CASE WHEN title_attr <> '' THEN 'attr' WHEN inner_text <> '' THEN 'inner' WHEN raw_title <> '' THEN 'text'
            WHEN href_name <> '' THEN 'href' END AS name_source
FROM (SELECT *, regexp_extract(href, '([^/?#]*)$', 1) AS href_name FROM ({_ITEMS_SQL}) i) t""", ids=("SRC-2",))
def listing_attr_fallback(spark, d):
    return L.with_fallback_name(L.listing_items(feeds.table(spark, d, "pages"))) \
        .select("page_id", "position", "name", "name_source")


@query("listing_item_ids", oracle=f"""
SELECT listing, seq, page_id, item_id FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY listing ORDER BY page_no, page_id) AS INTEGER) AS seq
  FROM (SELECT *, regexp_extract(url, '\\p{{Nd}}+', 0) AS item_id FROM ({_SEQ_SQL}) s) a WHERE item_id <> '') b
WHERE seq <= 100""", ids=("SRC-3",))
def listing_item_ids(spark, d):
    return L.item_ids(feeds.table(spark, d, "pages"))


def _split_named(cleaner, col: str) -> tuple[str, str]:
    b, p = _split_cols_sql(cleaner)
    return b.replace("raw_title", col), p.replace("raw_title", col)


_LB, _LP = _split_named(S.clean_title, "raw_title")


@query("rank_listing", oracle=f"""
SELECT listing, rank, page_id, position, raw_title, {_LB} AS brand, {_LP} AS product FROM {_ranked_sql(_ITEMS_SQL)} r""",
       ids=("W1", "W5"))
def rank_listing(spark, d):
    return L.rank_listing(feeds.table(spark, d, "pages"))


@query("rank_listing_nonblank", oracle=f"""
SELECT listing, rank, page_id, position, name FROM {_ranked_sql(f"SELECT * FROM ({_NAMED_SQL}) z WHERE name <> ''")} r""",
       ids=("FLT-4",))
def rank_listing_nonblank(spark, d):
    return L.rank_nonblank(feeds.table(spark, d, "pages"))


_SB, _SP = _split_named(S.clean_plain, "name")


_PRICED_SQL = f"""
SELECT *, coalesce(nullif(price_attr, ''), nullif(price_node, '')) AS price_text,
       CASE WHEN price_attr <> '' THEN 'attr' WHEN price_node <> '' THEN 'inner' END AS price_source
FROM (SELECT page_id, listing, page_no, CAST(position AS INTEGER) AS position, regexp_extract(item, 'data-price="([^"]*)"', 1) AS price_attr,
             regexp_extract(item, '(?s)class="price"[^>]*>([^<]*)<', 1) AS price_node,
             regexp_extract(item, '(?s)>([^<>]*)</a>', 1) AS raw_title FROM ({_CARDS_SQL}) t) t"""


@query("listing_price_fallback", oracle=f"""
SELECT page_id, position, price_text, price_source, {_READ_SYMBOL} AS price FROM ({_PRICED_SQL}) p""", ids=("SRC-2", "PRC-1"))
def listing_price_fallback(spark, d):
    return L.priced_cards(feeds.table(spark, d, "pages")).select("page_id", "position", "price_text", "price_source", "price")


@query("collect_pages", oracle=f"""
SELECT row_number() OVER (ORDER BY channel, rank) AS id, rank, brand, product, price AS old_price, price,
       TIMESTAMP '2024-02-01 07:30:00' AS captured_at, channel, TIMESTAMP '2024-02-01 08:00:00' AS created_at
FROM (SELECT rank, {_LB} AS brand, {_LP} AS product, listing AS channel, {_READ_SYMBOL} AS price FROM {_ranked_sql(_PRICED_SQL)} r) t
WHERE product IS NOT NULL""", ids=("SRC-1", "SRC-8", "PRJ-1", "PRJ-6", "W1"))
def collect_pages(spark, d):
    """Stored pages to appended snapshot rows, read back from the table."""
    path = scratch_path(spark, "collected")
    rows = L.collect_pages(feeds.table(spark, d, "pages"), SN.ntz(_dt.datetime(2024, 2, 1, 7, 30)))
    LOG.append_batch(spark, rows, path, "crawl", BATCH_STAMP)
    return LOG.read_table(spark, path).drop("capture_date", "batch")


@query("sentinel_rows", oracle=f"""
SELECT listing, rank, page_id, position,
       CASE WHEN NOT found THEN 'N/A' ELSE {_SB} END AS brand,
       CASE WHEN NOT found THEN 'N/A' ELSE {_SP} END AS product,
       NOT found AS sentinel
FROM {_ranked_sql(_NAMED_SQL)} r""", ids=("PRJ-8",))
def sentinel_rows(spark, d):
    return L.with_sentinels(feeds.table(spark, d, "pages"))


# ---------------------------------------------------------------------------
# Cards in every markup (SRC-1, SRC-2, FLT-4, PRJ-8, W5): the expected fields are
# stated for each kind of card, from the part that it shows
# ---------------------------------------------------------------------------
_CARD_FIELDS_SQL = """
SELECT page_id, 'shop' || CAST(page_id % 3 AS VARCHAR) || '.example.com/en' AS listing, CAST(page_id AS INTEGER) AS page_no,
       CAST(row_number() OVER (PARTITION BY page_id ORDER BY p_partkey) AS INTEGER) AS position, p_partkey, k,
       CASE WHEN k = 6 THEN '' WHEN k = 10 THEN '/p/' || key || '?a=1&b=2' ELSE '/p/' || key END AS href,
       CASE WHEN k = 3 THEN title || ' > x' ELSE '' END AS title_attr,
       CASE k WHEN 2 THEN 'sale' WHEN 3 THEN 'n/a' WHEN 5 THEN 'only ' || price ELSE '' END AS inner_text,
       CASE WHEN k IN (5, 6) THEN '' WHEN k = 7 THEN p_brand || ' - ' || p_name WHEN k = 8 THEN p_brand || ' - it''s ' || p_name
            WHEN k = 11 THEN '(50ML) ' || title || ' only 3 left' ELSE title END AS raw_title,
       CASE k WHEN 0 THEN '$ ' || price WHEN 3 THEN price WHEN 10 THEN price
              WHEN 1 THEN 'US$ ' || price WHEN 2 THEN chr(8364) || price WHEN 4 THEN price WHEN 7 THEN '$' || price
              WHEN 8 THEN chr(8364) || price || ' ' || chr(8364) WHEN 5 THEN 'only ' || price END AS price_text,
       CASE WHEN k IN (0, 3, 10) THEN 'attr' WHEN k IN (1, 2, 4, 7, 8) THEN 'inner' WHEN k = 5 THEN 'text' END AS price_source,
       CASE k WHEN 10 THEN '9' || price ELSE '' END AS old_node
FROM (SELECT p_partkey, p_partkey // 20 AS page_id, p_partkey % 12 AS k, CAST(p_partkey AS VARCHAR) AS key, p_brand, p_name,
             p_brand || ' - ' || p_name || ' & ' || CAST(p_partkey AS VARCHAR) AS title,
             CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS price FROM part) p"""


@query("card_items", oracle=f"""
SELECT page_id, listing, page_no, position, href, title_attr, inner_text, raw_title FROM ({_CARD_FIELDS_SQL}) c""", ids=("SRC-1",))
def card_items(spark, d):
    """Nested lists, upper-case tags, quoted ``>``, comments and unclosed cards."""
    return L.listing_items(feeds.card_pages(spark, d))


@query("card_names", oracle=f"""
SELECT page_id, position, coalesce(nullif(title_attr, ''), nullif(inner_text, ''), nullif(raw_title, ''), nullif(last, '')) AS name,
       CASE WHEN title_attr <> '' THEN 'attr' WHEN inner_text <> '' THEN 'inner' WHEN raw_title <> '' THEN 'text' WHEN last <> '' THEN 'href' END AS name_source
FROM (SELECT *, regexp_extract(href, '([^/?#]*)$', 1) AS last FROM ({_CARD_FIELDS_SQL}) f) c""", ids=("SRC-2",))
def card_names(spark, d):
    return L.with_fallback_name(L.listing_items(feeds.card_pages(spark, d))).select("page_id", "position", "name", "name_source")


@query("card_prices", oracle=f"""
SELECT page_id, position, price_text, price_source, {_READ_SYMBOL} AS price FROM ({_CARD_FIELDS_SQL}) p""", ids=("SRC-2", "PRC-1"))
def card_prices(spark, d):
    """Attribute, inner node, text of the price element; a card without one has none, whatever its title says."""
    return L.priced_cards(feeds.card_pages(spark, d)).select("page_id", "position", "price_text", "price_source", "price")


@query("card_ranks", oracle=f"""
SELECT listing, rank, page_id, position, raw_title, {_LB} AS brand, {_LP} AS product FROM {_ranked_sql(_CARD_FIELDS_SQL)} r""", ids=("W1", "W5"))
def card_ranks(spark, d):
    """Listings of more than a hundred cards: the rest is cut."""
    return L.rank_listing(feeds.card_pages(spark, d))


@query("card_ranks_nonblank", oracle=f"""
SELECT listing, rank, page_id, position, raw_title AS name
FROM {_ranked_sql(f"SELECT * FROM ({_CARD_FIELDS_SQL}) z WHERE raw_title <> ''")} r""", ids=("FLT-4",))
def card_ranks_nonblank(spark, d):
    return L.rank_nonblank(feeds.card_pages(spark, d))


@query("card_sentinels", oracle=f"""
SELECT listing, rank, page_id, position, CASE WHEN k = 6 THEN 'N/A' ELSE {_split_named(S.clean_plain, "raw_title")[0]} END AS brand,
       CASE WHEN k = 6 THEN 'N/A' ELSE {_split_named(S.clean_plain, "raw_title")[1]} END AS product, k = 6 AS sentinel
FROM {_ranked_sql(_CARD_FIELDS_SQL)} r""", ids=("PRJ-8",))
def card_sentinels(spark, d):
    """Every twelfth card cannot be read and still takes its rank."""
    return L.with_sentinels(feeds.card_pages(spark, d))


@query("collect_cards", oracle=f"""
SELECT row_number() OVER (ORDER BY channel, rank) AS id, rank, brand, product,
       CASE WHEN old_node = '' THEN price ELSE old_node END AS old_price, price, TIMESTAMP '2024-02-01 07:30:00' AS captured_at, channel,
       TIMESTAMP '2024-02-01 08:00:00' AS created_at
FROM (SELECT rank, {_LB} AS brand, {_LP} AS product, listing AS channel, old_node, {_READ_SYMBOL} AS price
      FROM {_ranked_sql(_CARD_FIELDS_SQL)} r) t""", ids=("SRC-1", "SRC-2", "SRC-8", "PRJ-6", "W5"))
def collect_cards(spark, d):
    """Cards to appended snapshot rows, with prices and old prices of every kind."""
    path = scratch_path(spark, "cards")
    LOG.append_batch(spark, L.collect_pages(feeds.card_pages(spark, d), SN.ntz(_dt.datetime(2024, 2, 1, 7, 30))), path, "cards", BATCH_STAMP)
    return LOG.read_table(spark, path).drop("capture_date", "batch")


# ---------------------------------------------------------------------------
# Snapshot scans, ids, purge, time text, union (SRC-5/6/9/10, DT-1, SET-1)
# ---------------------------------------------------------------------------
from rankdelta.functions import status as ST  # noqa: E402
from rankdelta.sources import snapshot_log as LOG  # noqa: E402
from rankdelta.sources import snapshots as SN  # noqa: E402

SCAN_CHANNEL, SCAN_START, SCAN_END = feeds.MAIN_CHANNEL, _dt.datetime(2024, 1, 8), _dt.datetime(2024, 1, 15)


@query("scan_day_range", oracle=f"""
SELECT {SNAP} FROM {S.FEED_SLOT} f
WHERE channel = 'main' AND captured_at >= TIMESTAMP '2024-01-08 00:00:00' AND captured_at < TIMESTAMP '2024-01-15 00:00:00'""",
       ids=("SRC-5", "FLT-3"))
def scan_day_range(spark, d):
    return SN.scan(feeds.feed_slot(spark, d), SCAN_CHANNEL, SCAN_START, SCAN_END)


@query("scan_snapshot_limit", oracle=f"""
SELECT rank, brand, product, old_price, price, captured_at, channel, created_at FROM (
  SELECT *, row_number() OVER (PARTITION BY channel, created_at ORDER BY rank, id) AS k FROM {S.FEED_DAY} f) t
WHERE k <= 10""", ids=("SRC-6", "LIM-1"))
def scan_snapshot_limit(spark, d):
    return SN.point_scan(feeds.feed_day(spark, d), 10).select(
        "rank", "brand", "product", "old_price", "price", "captured_at", "channel", "created_at")


BATCH_STAMP = _dt.datetime(2024, 2, 1, 8, 0, 0)


@query("batch_ids", oracle=f"""
SELECT row_number() OVER (ORDER BY channel, captured_at, rank, id) AS id, rank, brand, product, old_price, price,
       captured_at, channel, TIMESTAMP '2024-02-01 08:00:00' AS created_at,
       strftime(captured_at, '%Y-%m-%d %H:%M:%S') AS collected_at
FROM {S.FEED_DAY} f""", ids=("SRC-9", "PRJ-1"))
def batch_ids(spark, d):
    return SN.stamp_batch(feeds.feed_day(spark, d), 1, BATCH_STAMP)


@query("purge_duplicates", oracle=f"""
SELECT {SNAP} FROM {S.PURGE_INPUT} f
WHERE id IN (SELECT min(id) FROM {S.PURGE_INPUT} g GROUP BY channel, brand, product, old_price, price, captured_at)""",
       ids=("SRC-10", "A3"))
def purge_duplicates(spark, d):
    return SN.purge_duplicates(feeds.purge_input(spark, d))


@query("seoul_time", oracle="""
SELECT event_id, ts, local_ts, strftime(local_ts, '%Y-%m-%d %H:%M:%S') AS capture_text,
       CAST(CAST(local_ts AS DATE) AS TIMESTAMP) AS local_day, strftime(local_ts, '%y%m%d') AS file_stamp,
       strftime(local_ts, '%Y-%m-%d %H:%M') AS minute_label
FROM (SELECT event_id, ts, timezone('Asia/Seoul', timezone('UTC', ts)) AS local_ts FROM events) e""", ids=("DT-1", "DT-3", "DT-4"))
def seoul_time(spark, d):
    ev = feeds.table(spark, d, "events").select("event_id", "ts")
    local = ST.local_wall_time(F.col("ts"))
    return ev.select("event_id", "ts", local.alias("local_ts")).select(
        "event_id", "ts", "local_ts",
        F.date_format("local_ts", "yyyy-MM-dd HH:mm:ss").alias("capture_text"),
        ST.day_start("local_ts").alias("local_day"),
        ST.file_date_stamp("local_ts").alias("file_stamp"),
        ST.minute_label("local_ts").alias("minute_label"))


UNION_A = ("click", "view")


@query("union_channels", oracle=f"""
SELECT *, 'A' AS category FROM {S.FEED_DAY} f WHERE channel IN ('click', 'view')
UNION ALL BY NAME
SELECT * EXCLUDE (old_price), 'B' AS category FROM {S.FEED_DAY} g WHERE channel NOT IN ('click', 'view')""",
       ids=("SET-1",))
def union_channels(spark, d):
    f = feeds.feed_day(spark, d)
    a = f.filter(F.col("channel").isin(*UNION_A)).withColumn("category", F.lit("A"))
    b = f.filter(~F.col("channel").isin(*UNION_A)).drop("old_price").withColumn("category", F.lit("B"))
    return a.unionByName(b, allowMissingColumns=True)


# ---------------------------------------------------------------------------
# Month grain on lineitem (J1 with a one-month offset)
# ---------------------------------------------------------------------------
MONTH_CHAIN = S.offset_chain(S.FEED_MONTH).replace("INTERVAL 1 DAY", "INTERVAL 1 MONTH").replace(
    "INTERVAL 7 DAY", "INTERVAL 12 MONTH")


def _months(n: int):
    return lambda c: F.add_months(c.cast("date"), n).cast("timestamp_ntz")


@query("rank_change_monthly", oracle=_with(MONTH_CHAIN, f"SELECT {ANN_WEEK} FROM aw"), ids=("J1", "J3"))
def rank_change_monthly(spark, d):
    return C.by_offset(feeds.feed_month(spark, d), _months(1), _months(12)).weekly()


# ---------------------------------------------------------------------------
# Round trips through the snapshot table and the report files (SRC-7/8/11)
# ---------------------------------------------------------------------------
from rankdelta.session import scratch_path  # noqa: E402
from rankdelta.sources import report_sink as RS  # noqa: E402

STAMP_1, STAMP_2 = _dt.datetime(2024, 2, 1, 8, 0, 0), _dt.datetime(2024, 2, 2, 8, 0, 0)
_TWO_BATCHES_SQL = f"""
WITH n AS (SELECT *, row_number() OVER (ORDER BY channel, captured_at, rank, id) AS rn, count(*) OVER () AS total
           FROM {S.FEED_DAY} f)
SELECT rn AS id, rank, brand, product, old_price, price, captured_at, channel,
       TIMESTAMP '2024-02-01 08:00:00' AS created_at, CAST(captured_at AS DATE) AS capture_date FROM n
{{second}}"""


@query("snapshot_roundtrip", oracle=_TWO_BATCHES_SQL.format(second=f"""UNION ALL
SELECT rn + total, rank, brand, product, old_price, price, captured_at, channel,
       TIMESTAMP '2024-02-02 08:00:00', CAST(captured_at AS DATE) FROM n"""), ids=("SRC-7", "SRC-8", "SRC-9"))
def snapshot_roundtrip(spark, d):
    path = scratch_path(spark, "snapshots")
    LOG.create_table(spark, path)
    feed = feeds.feed_day(spark, d)
    for name, stamp in (("first", STAMP_1), ("second", STAMP_2), ("second", STAMP_2)):  # a batch sent twice is stored once
        LOG.append_batch(spark, feed, path, name, stamp)
    return LOG.read_table(spark, path).drop("batch")


@query("purge_roundtrip", oracle=_TWO_BATCHES_SQL.format(second=""), ids=("SRC-10", "SRC-8"))
def purge_roundtrip(spark, d):
    path = scratch_path(spark, "purge")
    feed = feeds.feed_day(spark, d)
    LOG.append_batch(spark, feed, path, "first", STAMP_1)
    LOG.append_batch(spark, feed, path, "second", STAMP_2)
    LOG.purge_table(spark, path)
    LOG.purge_table(spark, path)  # idempotent
    return LOG.read_table(spark, path).drop("batch")


@query("purge_table_plain", oracle=_TWO_BATCHES_SQL.format(second=""), ids=("SRC-10", "SRC-8"))
def purge_table_plain(spark, d):
    """The same over a partitioned folder without a log."""
    path = scratch_path(spark, "plain")
    feed = feeds.feed_day(spark, d)
    SN.append_snapshot(spark, feed, path, STAMP_1)
    SN.append_snapshot(spark, feed, path, STAMP_2)
    SN.purge_table(spark, path)
    return SN.read_snapshots(spark, path)


# ---------------------------------------------------------------------------
# Channels that fail alone (SRC-12); the bucketed table (SRC-7)
# ---------------------------------------------------------------------------
from rankdelta.operators import isolate as IS  # noqa: E402
from rankdelta.sources import bucket_table as BT  # noqa: E402

_STATES_SQL = f"""
SELECT n.channel, coalesce(n_rows, 0) AS n_rows, coalesce(n_bad, 0) AS n_bad, CASE WHEN n_rows IS NULL THEN 'no rows' ELSE error END AS error
FROM (SELECT DISTINCT event_type AS channel FROM events UNION SELECT 'nobody') n LEFT JOIN (
  SELECT channel, count(*) AS n_rows, count(*) FILTER (bad) AS n_bad,
         arg_min('captured_at: ' || captured_at, CAST(id AS BIGINT)) FILTER (bad) AS error
  FROM (SELECT *, starts_with(captured_at, 'at ') AS bad FROM {S.FEED_TEXT} t) r GROUP BY channel) s ON s.channel = n.channel"""


@query("channel_errors", oracle=_STATES_SQL, ids=("SRC-12",))
def channel_errors(spark, d):
    """One state per expected channel: read, failed with its first message, or without rows."""
    events = feeds.table(spark, d, "events").select(F.col("event_type").alias("channel"))
    expected = events.unionByName(spark.range(1).select(F.lit("nobody").alias("channel")))
    return IS.channel_states(IS.read_rows(feeds.feed_text(spark, d)), expected)


@query("isolated_changes", oracle=_with(S.offset_chain(f"""(SELECT * FROM {S.FEED_DAY} g WHERE channel NOT IN (
  SELECT channel FROM ({_STATES_SQL}) e WHERE error IS NOT NULL))"""), f"SELECT {ANN_DAY} FROM ad2"), ids=("SRC-12", "J1"))
def isolated_changes(spark, d):
    """The daily comparison of the channels that could be read, in the job that finds the others."""
    return C.by_offset(IS.good_rows(IS.read_rows(feeds.feed_text(spark, d)))).daily()


@query("stored_movement", oracle=_with(DAY_CHAIN, f"""
SELECT {SNAP}, brand_key, product_key, prev_rank_day AS prev_rank, delta_day AS delta, status_day AS status FROM ad2"""), ids=("SRC-7", "J1"))
def stored_movement(spark, d):
    """Movement against a bucketed table of stored rows."""
    path = scratch_path(spark, "buckets")
    name = "rankdelta_" + path.rsplit("-", 1)[1]
    rows = feeds.feed_day(spark, d)
    BT.define(spark, name, path, buckets=8)
    BT.store(spark, name, rows)
    out = BT.against_stored(spark, name, rows)
    out.schema  # resolved: the plan holds the files and their buckets
    spark.sql(f"DROP TABLE {name}")  # the definition only; the files lie in the shared folder
    return out


# ---------------------------------------------------------------------------
# Reports and reads over the stored table (J6, J8, SRC-5, SRC-6, FLT-3)
# ---------------------------------------------------------------------------
from rankdelta.operators import stored as ST8  # noqa: E402


def _stored(spark, d):
    """The slot feed as a stored table: odd and even days are imported as two batches."""
    path = scratch_path(spark, "history")
    rows = staged(feeds.feed_slot(spark, d), "slots")
    odd = F.day("captured_at") % 2 == 1
    LOG.append_batch(spark, rows.filter(odd), path, "odd", keep_stamps=True)
    LOG.append_batch(spark, rows.filter(~odd), path, "even", keep_stamps=True)
    return path


NO_ID = ", ".join(c for c in SNAP.split(", ") if c != "id")
ANN_WEEK_NO_ID = ANN_WEEK.replace("id, ", "", 1)


@query("report_from_table", oracle=_with(SLOT_CHAIN, f"SELECT {ANN_WEEK_NO_ID} FROM aw"), ids=("J8", "SRC-5"))
def report_from_table(spark, d):
    return ST8.report_from_table(spark, _stored(spark, d)).weekly().drop("id")


@query("report_from_table_at", oracle=_with(_AT_CHAIN, f"SELECT {ANN_WEEK_NO_ID} FROM aw"), ids=("J8", "SRC-5", "DT-2"))
def report_from_table_at(spark, d):
    """The report of one run time; only the folders of its snapshots and baselines are read."""
    return ST8.report_from_table(spark, _stored(spark, d), RUN_AT).weekly().drop("id")


@query("chart_out_from_table", oracle=_with(SLOT_CHAIN, f"SELECT {CO_COLS} FROM co"), ids=("J2", "J8"))
def chart_out_from_table(spark, d):
    return ST8.report_from_table(spark, _stored(spark, d)).chart_outs()


@query("stored_baselines", oracle=_with(SLOT_CHAIN, "SELECT channel, captured_at, offset_days, target_at, base_created_at, how FROM pick"),
       ids=("J6", "SRC-5"))
def stored_baselines(spark, d):
    return ST8.stored_baselines(spark, _stored(spark, d))


@query("scan_stored_range", oracle=f"""
SELECT {NO_ID} FROM {S.FEED_SLOT} f
WHERE channel = 'main' AND captured_at >= TIMESTAMP '2024-01-08 00:00:00' AND captured_at < TIMESTAMP '2024-01-15 00:00:00'""",
       ids=("SRC-5", "FLT-3"))
def scan_stored_range(spark, d):
    """The range scan over the partitioned table, whose folders it prunes."""
    table = LOG.read_table(spark, _stored(spark, d))
    return SN.scan(table, SCAN_CHANNEL, SCAN_START, SCAN_END, NO_ID.split(", "))


@query("point_read", oracle=f"""
WITH f AS (SELECT * FROM {S.FEED_SLOT} f), newest AS (SELECT max(created_at) AS t FROM f WHERE channel = 'main')
SELECT rank, brand, product, old_price, price, captured_at, channel, created_at FROM (
  SELECT f.*, row_number() OVER (ORDER BY rank, id) AS k FROM f, newest WHERE channel = 'main' AND created_at = newest.t) x WHERE k <= 20""",
       ids=("SRC-6", "LIM-1"))
def point_read(spark, d):
    """The newest snapshot of a channel by its stamp, first 20 ranks."""
    path = _stored(spark, d)
    newest = LOG.read_catalogue(spark, path).filter(F.col("channel") == feeds.MAIN_CHANNEL).agg(F.max("created_at")).first()[0]
    return LOG.snapshot_at(spark, path, feeds.MAIN_CHANNEL, newest, limit=20)


@query("report_roundtrip", oracle=_with(SMALL_CHAIN, f"""
SELECT captured_at, pos, rank AS "랭킹", brand AS "브랜드", product AS "제품명", price AS "가격",
       status_day AS "전일대비 증감", status_week AS "전주대비 증감", remark AS "비고", channel
FROM ({_SMALL_TOP_SQL}) x"""), ids=("SRC-11",))
def report_roundtrip(spark, d):
    path = scratch_path(spark, "report")
    RS.write_report(R.top_n(C.by_resolution(feeds.feed_small(spark, d))[0].weekly(), SMALL_PARAMS), path, "csv")
    return RS.read_report(spark, path, "csv")
