"""Row cleaning steps (PRJ-4..7, FLT-1, STR-5/6) as ``df.transform`` steps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankdelta.functions.text import clean_title, clean_title_plain, match_key, strip_ws
from rankdelta.schema import COLUMN_ALIASES, SNAPSHOT_COLUMNS, WS

# A number pandas' to_numeric would read: optional sign, digits with one
# optional dot, optional exponent, surrounding whitespace.  "inf"/"nan" are
# not accepted (pandas would keep inf and then fail the int conversion).
_NUMERIC_TEXT = rf"^{WS}*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?{WS}*\z"


def canonicalise(df: DataFrame, names: Iterable[str] = SNAPSHOT_COLUMNS, aliases: dict[str, str] | None = None) -> DataFrame:
    """PRJ-2: drifting column names (``Old_Price``, ``DateTime``) to the canonical ones.

    Names are compared without case and underscores; ``aliases`` adds others.
    A canonical name that is already there is left alone.
    """
    def plain(n: str) -> str:
        return n.replace("_", "").lower()
    known = {plain(n): n for n in names} | {plain(k): v for k, v in (COLUMN_ALIASES if aliases is None else aliases).items()}
    return df.withColumnsRenamed({c: known[plain(c)] for c in df.columns
                                  if c not in names and plain(c) in known and known[plain(c)] not in df.columns})


def numeric_rank(c: Column, dtype: T.DataType) -> Column:
    """Rank as int: text/float truncated toward zero, unreadable -> NULL."""
    if isinstance(dtype, (T.IntegerType, T.ShortType, T.ByteType)):
        return c.cast("int")
    if isinstance(dtype, T.LongType):
        return c.try_cast("int")
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        d = c.cast("double")
        return F.when(~F.isnan(d) & (F.abs(d) < F.lit(float("inf"))), d.try_cast("int"))
    text = c.cast("string")
    as_double = F.when(text.rlike(_NUMERIC_TEXT), strip_ws(text).try_cast("double"))
    return as_double.try_cast("int")


def clean_rank(df: DataFrame, col: str = "rank") -> DataFrame:
    """PRJ-4: coerce to a number, drop what is not one, truncate to int."""
    r = numeric_rank(F.col(col), df.schema[col].dataType)
    return df.withColumn(col, r).filter(F.col(col).isNotNull())


def fill_blank(df: DataFrame, cols: Iterable[str] = ("brand", "price", "old_price", "channel")) -> DataFrame:
    """PRJ-5: NULL -> "" for the given (present) columns."""
    present = [c for c in cols if c in df.columns]
    return df.fillna("", subset=present) if present else df


def default_old_price(df: DataFrame) -> DataFrame:
    """PRJ-6: old price falls back to price when NULL, blank or "N/A"."""
    old = F.col("old_price")
    missing = old.isNull() | strip_ws(old).isin("", "N/A")
    return df.withColumn("old_price", F.when(missing, F.col("price")).otherwise(old))


def require(df: DataFrame, cols: Iterable[str] = ("rank", "product")) -> DataFrame:
    """FLT-1: drop rows lacking any of ``cols``."""
    return df.dropna(subset=[c for c in cols if c in df.columns])


def with_match_keys(df: DataFrame) -> DataFrame:
    """PRJ-7 / STR-3: whitespace-free brand and product keys; absent column -> ""."""
    cols = set(df.columns)
    brand_key = match_key("brand") if "brand" in cols else F.lit("")
    product_key = match_key("product") if "product" in cols else F.lit("")
    return df.withColumns({"brand_key": brand_key, "product_key": product_key})


def normalise_names(df: DataFrame, cols: Iterable[str] = ("brand", "channel")) -> DataFrame:
    """STR-5: NULL -> "", whitespace runs -> one space, stripped."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: clean_title_plain(c) for c in present}) if present else df


def mark_comparable(df: DataFrame) -> DataFrame:
    """The chain of ``preprocess`` without its filters: ``comparable`` tells which rows pass them."""
    out, keep = df, F.lit(True)
    if "product" in out.columns:
        out = out.withColumn("_named", F.col("product").isNotNull()).withColumn("product", clean_title("product"))
        keep = F.col("_named")
    if "rank" in out.columns:
        out = out.withColumn("rank", numeric_rank(F.col("rank"), out.schema["rank"].dataType))
        keep = keep & F.col("rank").isNotNull()
    out = normalise_names(out.withColumn("comparable", keep).drop("_named"))
    return with_match_keys(out)


def preprocess(df: DataFrame) -> DataFrame:
    """STR-6: the chain every compared snapshot goes through.

    product present -> drop NULL products, clean titles (variant A);
    rank present -> PRJ-4; brand/channel -> STR-5; then match keys.
    """
    return mark_comparable(df).filter("comparable").drop("comparable")


def collector_clean(df: DataFrame) -> DataFrame:
    """What a collector does before inserting a batch (PRJ-4, FLT-1, PRJ-5, PRJ-6)."""
    out = require(df)
    out = clean_rank(out)
    out = fill_blank(out)
    if "old_price" in out.columns and "price" in out.columns:
        out = default_old_price(out)
    return out
