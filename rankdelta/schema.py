"""Canonical schemas and the fixed values the results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the behaviour being reproduced; stated as text).
# ---------------------------------------------------------------------------
# Status labels: new entry, climbed, fell, unchanged, dropped out of the chart.
STATUS_NEW = "신규"
STATUS_UP = "▲"
STATUS_DOWN = "▼"
STATUS_SAME = "-"
STATUS_CHART_OUT = "차트 아웃"

# Digest text pieces.
DIGEST_DAY_BASE = "전일 기준: "
DIGEST_WEEK_BASE = "전주 기준: "
DIGEST_NO_DATA = "참고 가능한 데이터 없음"
DIGEST_COUNT_NEW = "신규"
DIGEST_COUNT_KEEP = "유지"
DIGEST_CHART_OUT_HEAD = "차트 아웃 {n}개"

# Report column headers, in report order, then the empty remark column.
REPORT_HEADERS = ("랭킹", "브랜드", "제품명", "가격", "전일대비 증감", "전주대비 증감", "비고")

# Volume units removed from a leading "(<digits><unit>)" title prefix.
VOLUME_UNITS = ("ML", "EA", "G", "PATCHES", "PCS", "PADS")
# Currency symbols recognised by the symbol-keeping price reader.
CURRENCY_SYMBOLS = "₩￦$€£¥"

# Watch-list brands (compared lower-case) for the second highlight tier.
WATCH_BRANDS = ("numbuzin", "fwee")
# Channels whose report price gets a "$" prefix.
DOLLAR_CHANNELS = ("jolse", "stylevana")

REPORT_LIMIT = 50          # report rows per channel and the cut-off for counts
HIGHLIGHT_MAX = 7          # highlight lines per channel
HIGHLIGHT_TIER2_GATE = 5   # tier 2 runs only while fewer lines than this
HIGHLIGHT_TOP_RANK = 10    # tier 3 looks at ranks up to this
HIGHLIGHT_MIN_MOVE = 2     # tier 1 needs |delta| >= this
CHART_OUT_TOP = 5          # chart-out lines in the digest
CRAWL_LIMIT = 100          # ranked items kept per listing
BASELINE_ANCHOR_HOUR = 8   # a day baseline prefers the snapshot nearest 08:00
DAY_OFFSET_DAYS = 1
WEEK_OFFSET_DAYS = 7
LOCAL_TZ = "Asia/Seoul"    # wall-clock zone of capture times

# Code-point ranges Python's str.isspace()/re "\s" treat as whitespace.  Java
# and RE2 "\s" are ASCII-only, so every pattern standing for "\s" uses this
# set: as a character string (for trim/translate) and as a regex class.
WS_RANGES = ((0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
             (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
             (0x3000, 0x3000))
WS_CHARS = "".join(chr(c) for lo, hi in WS_RANGES for c in range(lo, hi + 1))
WS = "[" + "".join(f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}"
                   for lo, hi in WS_RANGES) + "]"
# Python's "\d" on str is any Unicode decimal digit.
DIGIT = r"\p{Nd}"

# ---------------------------------------------------------------------------
# Canonical schemas
# ---------------------------------------------------------------------------
SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("brand", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("old_price", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("captured_at", T.TimestampNTZType()),
    T.StructField("channel", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
])
SNAPSHOT_COLUMNS = tuple(f.name for f in SNAPSHOT_SCHEMA.fields)

# Other names of the same columns in stored batches.
COLUMN_ALIASES = {"datetime": "captured_at", "ranking": "rank", "product_name": "product", "createdat": "created_at"}
# Columns of the duplicate purge within a channel (rank is not in it).
PURGE_KEYS = ("channel", "brand", "product", "old_price", "price", "captured_at")


@dataclass(frozen=True)
class ReportParams:
    """Knobs of the report; defaults are the fixed values above."""

    report_limit: int = REPORT_LIMIT
    watch_brands: tuple[str, ...] = WATCH_BRANDS
    dollar_channels: tuple[str, ...] = DOLLAR_CHANNELS
    highlight_max: int = HIGHLIGHT_MAX
    tier2_gate: int = HIGHLIGHT_TIER2_GATE
    top_rank: int = HIGHLIGHT_TOP_RANK
    min_move: int = HIGHLIGHT_MIN_MOVE
    chart_out_top: int = CHART_OUT_TOP
    # The watch-list tier, as written, never admits an unmoved new entry.
    tier2_include_new: bool = False
    offsets_days: tuple[int, int] = field(default=(DAY_OFFSET_DAYS, WEEK_OFFSET_DAYS))
