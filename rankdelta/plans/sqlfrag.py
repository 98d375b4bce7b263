"""DuckDB SQL fragments for the oracle side (same data rules, other engine).

These are SQL *text* builders: the expressions mirror the column functions in
``rankdelta.functions`` so each query's oracle reads as plain SQL.
"""

from __future__ import annotations

from rankdelta.schema import (
    CURRENCY_SYMBOLS, DIGIT, STATUS_DOWN, STATUS_NEW, STATUS_SAME, STATUS_UP, VOLUME_UNITS, WS, WS_CHARS,
)

STRIP_RE = rf"^{WS}+|{WS}+\z"
PREFIX_RE = rf"(?i)^\({DIGIT}+(?:{'|'.join(VOLUME_UNITS)})\){WS}*"
NUM_RE = rf"{DIGIT}[{DIGIT},]*(?:\.{DIGIT}+)?"
NUMERIC_TEXT_RE = rf"^{WS}*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?{WS}*\z"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


WS_SQL = "(" + " || ".join(f"chr({ord(ch)})" for ch in WS_CHARS) + ")"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(STRIP_RE)}, '', 'g')"


def collapse(x: str) -> str:
    return f"regexp_replace({x}, {q(WS + '+')}, ' ', 'g')"


def strip_fast(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


def clean_title(x: str) -> str:
    inner = strip(f"coalesce({x}, '')")
    return collapse(f"regexp_replace({inner}, {q(PREFIX_RE)}, '')")


def clean_plain(x: str) -> str:
    return strip(collapse(f"coalesce({x}, '')"))


def match_key(x: str) -> str:
    return f"regexp_replace(coalesce({x}, ''), {q(WS + '+')}, '', 'g')"


def match_key_fast(x: str) -> str:
    return f"translate(coalesce({x}, ''), {WS_SQL}, '')"


def status(delta: str) -> str:
    return (f"CASE WHEN {delta} IS NULL THEN {q(STATUS_NEW)} "
            f"WHEN {delta} > 0 THEN {q(STATUS_UP)} || CAST({delta} AS VARCHAR) "
            f"WHEN {delta} < 0 THEN {q(STATUS_DOWN)} || CAST(abs({delta}) AS VARCHAR) "
            f"ELSE {q(STATUS_SAME)} END")


def rank_int(x: str, text: bool) -> str:
    """PRJ-4 on the oracle side: DuckDB casts round, so truncate first."""
    if not text:
        return f"CAST({x} AS INTEGER)"
    return (f"CASE WHEN regexp_full_match({x}, {q(NUMERIC_TEXT_RE)}) "
            f"THEN TRY_CAST(trunc(TRY_CAST({strip(x)} AS DOUBLE)) AS INTEGER) END")


def day(x: str) -> str:
    return f"CAST(CAST({x} AS DATE) AS TIMESTAMP)"


# ---------------------------------------------------------------------------
# Feeds (FIXTURES.md section 4)
# ---------------------------------------------------------------------------

def _ranked_events(capture: str, *, slot_created: bool = False, channel: str = "event_type",
                   unique_names: bool = True) -> str:
    created = ("max(last_ts) OVER (PARTITION BY channel, captured_at)" if slot_created
               else "captured_at")
    product = ("p.p_name || ' #' || CAST(p.p_partkey AS VARCHAR)" if unique_names else "p.p_name")
    return f"""(
  WITH g AS (
    SELECT {channel} AS channel, {capture} AS captured_at, user_id,
           min(event_id) AS id, sum(CAST(value AS DECIMAL(18,2))) AS score, max(ts) AS last_ts
    FROM events
    GROUP BY 1, 2, 3),
  r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY channel, captured_at
                                      ORDER BY score DESC NULLS LAST, user_id ASC NULLS FIRST) AS INTEGER) AS rank,
           {created} AS created_at
    FROM g)
  SELECT r.id, r.rank, p.p_brand AS brand, {product} AS product,
         CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS old_price,
         CAST(r.score AS VARCHAR) AS price, r.captured_at, r.channel, r.created_at
  FROM r LEFT JOIN part p ON r.user_id = p.p_partkey)"""


FEED_DAY = _ranked_events(day("ts"))
FEED_TEXT = f"""(
  SELECT CAST(id AS VARCHAR) AS id, CAST(rank AS VARCHAR) AS rank, brand, product, old_price, price, channel, created_at,
         CASE WHEN channel = 'error' AND id % 50 = 0 THEN 'at ' ELSE '' END || strftime(captured_at, '%Y-%m-%d %H:%M:%S') AS captured_at
  FROM {FEED_DAY} f)"""
FEED_DAY_DUP = _ranked_events(day("ts"), unique_names=False)
_SLOT = f"{day('ts')} + INTERVAL 1 HOUR * (CAST(floor(hour(ts) / 6) AS INTEGER) * 6)"
FEED_SLOT = _ranked_events(_SLOT, slot_created=True,
                           channel="CASE WHEN user_id % 10 = 0 THEN event_type || '-' || CAST(user_id // 50 AS VARCHAR) ELSE 'main' END")
FEED_SMALL = f"""(
  SELECT * FROM {_ranked_events(_SLOT, slot_created=True, channel="event_type || '-' || CAST(user_id // 5 AS VARCHAR)")} a
  UNION ALL SELECT * FROM {FEED_SLOT} b WHERE channel = 'main')"""
FEED_HALF = _ranked_events(f"{day('ts')} + INTERVAL 1 HOUR * (CAST(floor(hour(ts) / 12) AS INTEGER) * 12)")

FEED_DIRTY = f"""(
  SELECT event_id AS id,
    CASE event_id % 7 WHEN 0 THEN '1.7' WHEN 1 THEN ' 3 ' WHEN 2 THEN '1e2' WHEN 3 THEN '1,000'
                      WHEN 4 THEN 'x' WHEN 5 THEN CAST(user_id AS VARCHAR) END AS rank,
    CASE WHEN event_id % 4 <> 0 THEN ' Brand' || chr(160) || ' ' || CAST(user_id % 10 AS VARCHAR) || ' ' END AS brand,
    CASE WHEN event_id % 9 <> 0 THEN '(' || CAST(user_id % 7 + 1 AS VARCHAR) || 'ML)  ' || event_type
         || chr(160) || 'item ' || CAST(user_id AS VARCHAR) END AS product,
    CASE event_id % 5 WHEN 1 THEN '' WHEN 2 THEN 'N/A' WHEN 3 THEN ' '
                      WHEN 4 THEN CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS old_price,
    CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS price,
    ts AS captured_at,
    CASE WHEN event_id % 13 <> 0 THEN ' ' || event_type END AS channel,
    ts AS created_at
  FROM events)"""

TITLES = f"""(
  SELECT p_partkey AS item_id, CAST(p_partkey + 1 AS INTEGER) AS rank,
         '(' || CAST(p_size AS VARCHAR) || 'ML) ' || p_brand || '  - ' || chr(160) || p_name AS raw_title,
         'US$ ' || CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS raw_price
  FROM part)"""

PRICES = """(
  SELECT p_partkey AS item_id,
    CASE p_partkey % 6
      WHEN 0 THEN 'US$ ' || CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR)
      WHEN 1 THEN '2 for €' || CAST(p_size AS VARCHAR)
      WHEN 2 THEN '$  ' || CAST(p_size AS VARCHAR)
      WHEN 3 THEN CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR)
      WHEN 4 THEN 'free'
      ELSE '' END AS price_text
  FROM part)"""

FEED_MONTH = """(
  WITH g AS (
    SELECT p.p_type AS channel, CAST(date_trunc('month', CAST(l.l_shipdate AS DATE)) AS TIMESTAMP) AS captured_at,
           p.p_brand AS item, sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS score,
           min(l.l_orderkey * 10 + l.l_linenumber) AS id
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    GROUP BY 1, 2, 3),
  r AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY channel, captured_at
                                      ORDER BY score DESC NULLS LAST, item ASC NULLS FIRST) AS INTEGER) AS rank
    FROM g)
  SELECT id, rank, item AS brand, item AS product, '' AS old_price, CAST(score AS VARCHAR) AS price,
         captured_at, channel, captured_at AS created_at
  FROM r)"""

PURGE_INPUT = f"""(
  SELECT event_id AS id, CAST(event_id % 100 + 1 AS INTEGER) AS rank, 'Brand' || CAST(user_id % 10 AS VARCHAR) AS brand,
         CAST(user_id AS VARCHAR) AS product, CAST(CAST(floor(hour(ts) / 6) AS BIGINT) AS VARCHAR) AS old_price,
         CAST(CAST(floor(value / 50) AS BIGINT) AS VARCHAR) AS price, {day('ts')} AS captured_at,
         event_type AS channel, ts AS created_at
  FROM events)"""


def preprocess(src: str, rank_is_text: bool = False) -> str:
    """STR-6 chain over a snapshot-shaped relation."""
    return f"""(
  SELECT id, rk AS rank, brand, product, old_price, price, captured_at, channel, created_at,
         {match_key('brand')} AS brand_key, {match_key('product')} AS product_key
  FROM (
    SELECT id, {rank_int('rank', rank_is_text)} AS rk, {clean_plain('brand')} AS brand,
           {clean_title('product')} AS product, old_price, price, captured_at,
           {clean_plain('channel')} AS channel, created_at
    FROM {src} s
    WHERE product IS NOT NULL) t
  WHERE rk IS NOT NULL)"""


# ---------------------------------------------------------------------------
# Comparison chains.  Each returns CTE text (no leading WITH) that defines:
#   c    cleaned rows              cur  current rows (reports' own rows)
#   rep  report keys               bd/bw baseline rows re-keyed to reports
#   ad   daily annotated           aw   daily+weekly annotated
#   co   chart-outs
# ---------------------------------------------------------------------------

def _annotate_tail() -> str:
    st_day = status("delta_day")
    st_week = status("delta_week")
    return f"""
ad AS (
  SELECT cur.*, bd.rank AS prev_rank_day, CAST(bd.rank - cur.rank AS INTEGER) AS delta_day
  FROM cur LEFT JOIN bd ON bd.channel = cur.channel AND bd.captured_at = cur.captured_at
       AND bd.brand_key = cur.brand_key AND bd.product_key = cur.product_key),
ad2 AS (SELECT *, {st_day} AS status_day FROM ad),
hw AS (SELECT DISTINCT channel, captured_at FROM bw),
aw0 AS (
  SELECT ad2.*, bw.rank AS prev_rank_week, CAST(bw.rank - ad2.rank AS INTEGER) AS delta_week,
         EXISTS (SELECT 1 FROM hw WHERE hw.channel = ad2.channel AND hw.captured_at = ad2.captured_at) AS has_week
  FROM ad2 LEFT JOIN bw ON bw.channel = ad2.channel AND bw.captured_at = ad2.captured_at
       AND bw.brand_key = ad2.brand_key AND bw.product_key = ad2.product_key),
aw AS (SELECT * EXCLUDE (has_week), CASE WHEN has_week THEN {st_week} ELSE '{STATUS_SAME}' END AS status_week FROM aw0),
co AS (
  SELECT channel, captured_at, brand, product, brand_key, product_key, rank AS prev_rank_day,
         '차트 아웃' AS status_day
  FROM bd
  WHERE EXISTS (SELECT 1 FROM rep WHERE rep.channel = bd.channel AND rep.captured_at = bd.captured_at)
    AND NOT EXISTS (SELECT 1 FROM cur WHERE cur.channel = bd.channel AND cur.captured_at = bd.captured_at
                    AND cur.brand_key = bd.brand_key AND cur.product_key = bd.product_key))"""


def offset_chain(feed: str, day_days: int = 1, week_days: int = 7, dedup: bool = False) -> str:
    clean = preprocess(feed)
    if dedup:
        clean = f"""(SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (
            PARTITION BY channel, captured_at, brand_key, product_key ORDER BY rank, id) AS k FROM {clean} p) q WHERE k = 1)"""
    return f"""
c AS {clean},
cur AS (SELECT * FROM c),
rep AS (SELECT DISTINCT {clean_plain('channel')} AS channel, captured_at FROM {feed} f),
bd AS (SELECT channel, captured_at + INTERVAL {day_days} DAY AS captured_at, captured_at AS base_captured_at,
              brand, product, brand_key, product_key, rank FROM c),
bw AS (SELECT channel, captured_at + INTERVAL {week_days} DAY AS captured_at, captured_at AS base_captured_at,
              brand, product, brand_key, product_key, rank FROM c),{_annotate_tail()}"""


def resolve_chain(feed: str, day_days: int = 1, week_days: int = 7, anchor_hour: int = 8, run_at: str | None = None) -> str:
    only = f"AND {day('captured_at')} = {day(run_at)}" if run_at else ""
    return f"""
raw AS (SELECT f.*, {clean_plain('f.channel')} AS ch FROM {feed} f),
latest AS (SELECT ch AS channel, {day('captured_at')} AS day, max(captured_at) AS captured_at
           FROM raw WHERE captured_at IS NOT NULL {only} GROUP BY 1, 2),
cat AS (SELECT DISTINCT ch AS channel, captured_at, created_at FROM raw),
c AS {preprocess(feed)},
cur AS (SELECT * FROM c WHERE EXISTS (SELECT 1 FROM latest l WHERE l.channel = c.channel AND l.captured_at = c.captured_at)),
rep AS (SELECT channel, captured_at FROM latest),
req AS (SELECT channel, captured_at, o.k AS offset_days, {run_at or 'captured_at'} - INTERVAL 1 DAY * o.k AS target_at
        FROM latest, (VALUES ({day_days}), ({week_days})) o(k)),
near AS (
  SELECT channel, captured_at, offset_days, created_at AS nearest_created_at FROM (
    SELECT r.channel, r.captured_at, r.offset_days, k.created_at,
           row_number() OVER (PARTITION BY r.channel, r.captured_at, r.offset_days
             ORDER BY abs(date_diff('microsecond', {day('r.target_at')} + INTERVAL {anchor_hour} HOUR, k.created_at)),
                      k.created_at DESC) AS rn
    FROM req r JOIN cat k ON k.channel = r.channel AND {day('k.captured_at')} = {day('r.target_at')}
    WHERE k.created_at IS NOT NULL) t
  WHERE rn = 1),
asofp AS (
  SELECT r.channel, r.captured_at, r.offset_days,
         (SELECT max(k.created_at) FROM cat k WHERE k.channel = r.channel AND k.created_at < r.target_at) AS asof_created_at
  FROM req r),
pick AS (
  SELECT r.channel, r.captured_at, r.offset_days, r.target_at,
         coalesce(n.nearest_created_at, a.asof_created_at) AS base_created_at,
         CASE WHEN n.nearest_created_at IS NOT NULL THEN 'nearest'
              WHEN a.asof_created_at IS NOT NULL THEN 'asof' END AS how
  FROM req r
  LEFT JOIN near n ON n.channel = r.channel AND n.captured_at = r.captured_at AND n.offset_days = r.offset_days
  LEFT JOIN asofp a ON a.channel = r.channel AND a.captured_at = r.captured_at AND a.offset_days = r.offset_days),
bd AS (SELECT p.channel, p.captured_at, c.captured_at AS base_captured_at, c.brand, c.product, c.brand_key,
              c.product_key, c.rank
       FROM pick p JOIN c ON c.channel = p.channel AND c.created_at = p.base_created_at WHERE p.offset_days = {day_days}),
bw AS (SELECT p.channel, p.captured_at, c.captured_at AS base_captured_at, c.brand, c.product, c.brand_key,
              c.product_key, c.rank
       FROM pick p JOIN c ON c.channel = p.channel AND c.created_at = p.base_created_at WHERE p.offset_days = {week_days}),{_annotate_tail()}"""
