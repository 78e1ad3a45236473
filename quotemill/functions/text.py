"""Scalar string functions as native column expressions.

All functions take and return ``Column`` objects and compile to JVM expressions,
so they stay inside whole-stage codegen; no Python worker is involved.
"""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas
from .core import let

ColumnOrName = Column | str

# The 29 code points Python's str.strip() removes (str.isspace), as a Java class.
WS = r"[\t\n\x0B\f\r\x1C-\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"

# Python float() grammar (D13) once digits are ASCII and underscores gone: sign, digits
# with an optional point, optional exponent, or nan / inf / infinity.
NUMBER_RE = (r"(?i)^" + WS + r"*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?"
             r"|nan|inf|infinity)" + WS + r"*$")

# Every decimal digit of Unicode beyond ASCII, and the ASCII digit of its value.
_DIGITS = [c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.decimal(c, None) is not None]
_ASCII_DIGITS = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)

# First parenthesised group, non-greedy; '.' stops only at '\n' as in Python.
PAREN_RE = r"(?d)\((.*?)\)"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: ColumnOrName) -> Column:
    """Remove every Unicode whitespace character at both ends."""
    return F.regexp_replace(_c(c), f"^{WS}+|{WS}+$", "")


def strip_or_default(c: ColumnOrName, default: str = schemas.SENTINEL_COMPANY) -> Column:
    """Null or empty -> default; otherwise stripped (whitespace-only -> '')."""
    return let(c, lambda v: F.when(v.isNull() | (v == ""), F.lit(default)).otherwise(strip(v)))


def or_sentinel(c: ColumnOrName, sentinel: str) -> Column:
    """D3: missing value -> field sentinel."""
    return F.coalesce(_c(c), F.lit(sentinel))


def first_nonempty(first: ColumnOrName, fallback: ColumnOrName) -> Column:
    """``if not a: a = b`` -- fallback when the first is null or empty."""
    return let(first, lambda a: F.when(a.isNull() | (a == ""), _c(fallback)).otherwise(a))


def after_last(c: ColumnOrName, sep: str = schemas.DATE_MARKER) -> Column:
    """Text after the last ``sep`` (whole text when absent), stripped."""
    return strip(F.substring_index(_c(c), sep, -1))


def paren_group(c: ColumnOrName, default: str = schemas.SENTINEL_ABBREVIATION) -> Column:
    """Text inside the first parentheses; no match -> default; null/'' unchanged."""
    return let(c, lambda v: F.when(v.isNull() | (v == ""), v)
               .when(v.rlike(PAREN_RE), F.regexp_extract(v, PAREN_RE, 1))
               .otherwise(F.lit(default)))


def nth_or(arr: ColumnOrName, n: int, sentinel: str) -> Column:
    """Stripped element ``n`` (0-based) if the list is long enough, else sentinel."""
    return F.coalesce(strip(F.get(_c(arr), n)), F.lit(sentinel))


def number_text(c: ColumnOrName, sentinel: str, strip_percent: bool = False) -> Column:
    """sentinel/empty -> null, drop separators (and '%'), empty -> null."""
    def clean(v: Column) -> Column:
        t = F.replace(v, F.lit(","), F.lit(""))
        if strip_percent:
            t = F.replace(t, F.lit("%"), F.lit(""))
        t = F.when(v.isNull() | (v == "") | (v == sentinel), F.lit(None)).otherwise(t)
        return F.nullif(t, F.lit(""))
    return let(c, clean)


def plain_digits(c: ColumnOrName) -> Column:
    """Decimal digits of any script as ASCII, single underscores between digits dropped, as ``float`` reads them."""
    ascii_only = let(c, lambda t: F.when(
        t.rlike(r"[^\x00-\x7F]"), F.translate(t, "".join(_DIGITS), _ASCII_DIGITS)).otherwise(t))
    return let(ascii_only, lambda t: F.when(
        F.instr(t, "_") > 0, F.regexp_replace(t, "(?<=[0-9])_(?=[0-9])", "")).otherwise(t))


def to_number(c: ColumnOrName, sentinel: str, strip_percent: bool = False) -> Column:
    """D10-D13 + F7: ``struct<value: double, error: string>``.

    ``error`` is null for a usable value (including null and NaN), ``not_a_number``
    for text Python's ``float`` would refuse, ``not_finite`` for +-infinity, which
    the NUMERIC target column refuses.
    """
    def typed(t: Column) -> Column:
        return let(t.try_cast("double"), lambda value: let(
            F.when(t.isNull(), F.lit(None))
             .when(~t.rlike(NUMBER_RE) | value.isNull(), F.lit("not_a_number"))
             .when(F.abs(value) == F.lit(float("inf")), F.lit("not_finite")),
            lambda error: F.struct(F.when(error.isNull(), value).alias("value"),
                                   error.alias("error"))))
    return let(plain_digits(strip(number_text(c, sentinel, strip_percent))), typed)


def date_key(ds: ColumnOrName) -> Column:
    """Logical-date key ``yyyyMMdd``."""
    return F.date_format(_c(ds), "yyyyMMdd")


def run_stamp(ts: ColumnOrName) -> Column:
    """Run timestamp ``yyyyMMddHHmmss`` (timestamp passed in, not wall clock)."""
    return F.date_format(_c(ts), "yyyyMMddHHmmss")


def is_blank(c: ColumnOrName) -> Column:
    """``not s.strip()``."""
    return strip(c) == ""
