"""Title and key cleaning as native column expressions.

Whitespace follows Python's Unicode notion (``schema.WS``) so NBSP and
ideographic spaces are treated like ASCII blanks; see SURVEY 7.4 H1.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankdelta.schema import DIGIT, VOLUME_UNITS, WS, WS_CHARS

_VOLUME_PREFIX = rf"(?iu)^\({DIGIT}+(?:{'|'.join(VOLUME_UNITS)})\){WS}*"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()``: a character-set trim, no regex."""
    return F.btrim(_col(c), F.lit(WS_CHARS))


def collapse_ws(c) -> Column:
    """Every whitespace run becomes one space (no strip).

    Every whitespace character is first mapped to a space (translate), so
    the only regex left is the cheap "two or more spaces".
    """
    spaced = F.translate(_col(c), WS_CHARS, " " * len(WS_CHARS))
    return F.regexp_replace(spaced, "  +", " ")


def clean_title(c) -> Column:
    """Variant A: strip, drop one leading volume prefix, collapse whitespace.

    NULL becomes "".
    """
    stripped = strip_ws(F.coalesce(_col(c), F.lit("")))
    return collapse_ws(F.regexp_replace(stripped, _VOLUME_PREFIX, ""))


def clean_title_plain(c) -> Column:
    """Variant B: collapse whitespace, then strip. NULL becomes ""."""
    return strip_ws(collapse_ws(F.coalesce(_col(c), F.lit(""))))


def match_key(c) -> Column:
    """All whitespace removed, case kept; NULL becomes ""."""
    return F.translate(F.coalesce(_col(c), F.lit("")), WS_CHARS, "")


def split_brand_product(title, cleaner=clean_title) -> tuple[Column, Column]:
    """Split a cleaned title at its first hyphen into (brand, product).

    No hyphen: brand "N/A", the whole cleaned title is the product.
    Blank brand part: "N/A".  The product part is cleaned again.
    """
    name = cleaner(title)
    parts = F.split(name, "-", 2)
    has_hyphen = F.instr(name, "-") > 0
    brand_part = strip_ws(F.element_at(parts, 1))
    brand = F.when(~has_hyphen | (brand_part == ""), F.lit("N/A")).otherwise(brand_part)
    product = F.when(has_hyphen, cleaner(F.element_at(parts, 2))).otherwise(name)
    return brand, product


def first_non_blank(*cols) -> Column:
    """First argument that is neither NULL nor ""; NULL when none is."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in cols])
