"""The three price readers used by the collectors, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankdelta.functions.text import strip_ws
from rankdelta.schema import CURRENCY_SYMBOLS, DIGIT, WS

_NUMBER = rf"{DIGIT}[{DIGIT},]*(?:\.{DIGIT}+)?"
_SYM = f"[{CURRENCY_SYMBOLS}]"
# symbol, at most one whitespace, number
_SYM_NUMBER = rf"{_SYM}{WS}?{_NUMBER}"
# everything before the first digit, then the first number
_PREFIX_NUMBER = rf"(?s)^(.*?)({_NUMBER})"
_TRAILING_SYM = rf"({_SYM}){WS}*\z"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def price_with_symbol(c) -> Column:
    """Reader 1: keep the currency symbol.

    ``symbol + <=1 space + number`` anywhere wins; else the first bare number,
    prefixed by a symbol that ends the text before it; else the stripped text.
    NULL or "" gives "N/A".
    """
    t = _col(c)
    sym_number = F.regexp_extract(t, _SYM_NUMBER, 0)
    number = F.regexp_extract(t, _PREFIX_NUMBER, 2)
    prefix = F.regexp_extract(t, _PREFIX_NUMBER, 1)
    symbol = F.regexp_extract(prefix, _TRAILING_SYM, 1)
    bare = F.when(symbol == "", number).otherwise(F.concat(symbol, F.lit(" "), number))
    return (F.when(t.isNull() | (t == ""), F.lit("N/A"))
            .when(sym_number != "", sym_number)
            .when(number != "", bare)
            .otherwise(strip_ws(t)))


def price_amount(c) -> Column:
    """Reader 2: the first run of digits, commas and dots; else "N/A"."""
    t = _col(c)
    run = F.regexp_extract(t, rf"[{DIGIT},.]+", 0)
    return F.when(t.isNull() | (run == ""), F.lit("N/A")).otherwise(run)


def price_first_number(c) -> Column:
    """Reader 3: the first ``digits[.digits]``; "" when there is none."""
    return F.coalesce(F.regexp_extract(_col(c), rf"{DIGIT}+(?:\.{DIGIT}+)?", 0), F.lit(""))


def price_pair(sale, original) -> dict[str, Column]:
    """PRC-3 for a row: sale and original price by reader 3; unless both can be read, both are blank.

    Gives ``price``, ``old_price`` and ``blanked``.
    """
    a, b = price_first_number(sale), price_first_number(original)
    missing = (a == "") | (b == "")
    return {"price": F.when(missing, F.lit("")).otherwise(a), "old_price": F.when(missing, F.lit("")).otherwise(b), "blanked": missing}
