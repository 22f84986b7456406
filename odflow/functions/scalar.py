"""Scalar column functions with the cast and text rules the pipeline relies on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from odflow.schema import not_null


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_int(c: Column | str) -> Column:
    """Text -> INTEGER or NULL, accepting what a lenient SQL cast accepts.

    Plain integers (surrounding spaces, leading zeros) cast directly; text
    such as ``'12.7'`` or ``'1e3'`` is read as a number and rounded half
    away from zero.  'NA' and other non-numbers give NULL.
    """
    s = F.trim(_col(c))
    direct = s.try_cast("int")
    as_dec = s.try_cast("double")
    rounded = F.when(
        as_dec.isNotNull() & (F.abs(as_dec) < 2147483647.5),
        F.round(as_dec, 0).try_cast("int"),
    )
    return F.coalesce(direct, rounded)


def parse_int_strict(c: Column | str, what: str = "value") -> Column:
    """Text -> INTEGER; a non-NULL text that does not parse fails the task."""
    col = _col(c)
    parsed = try_int(col)
    return F.when(col.isNull(), F.lit(None).cast("int")).otherwise(
        not_null(parsed, T.IntegerType(), f"cannot cast {what} to INTEGER")
    )


def round_half_even_int(c: Column | str) -> Column:
    """DOUBLE -> INTEGER rounding half to even (12.5 -> 12, 13.5 -> 14).

    A plain Spark cast truncates; ``round`` rounds half up; ``rint`` is the
    IEEE rule a numeric engine applies when narrowing a double.
    """
    return F.rint(_col(c).cast("double")).cast("int")


def parse_date(c: Column | str, strict: bool = False) -> Column:
    """Text -> DATE from ``yyyy-MM-dd`` or ``yyyyMMdd``; NULL (or failure) otherwise."""
    s = F.trim(_col(c).cast("string"))
    d = F.coalesce(F.try_to_date(s, "yyyy-MM-dd"), F.try_to_date(s, "yyyyMMdd"))
    if strict:
        return F.when(s.isNull(), F.lit(None).cast("date")).otherwise(
            not_null(d, T.DateType(), "cannot cast value to DATE")
        )
    return d


def parse_bool(c: Column | str) -> Column:
    """Text -> BOOLEAN (true/false, t/f, yes/no, y/n, 1/0; case-insensitive)."""
    s = F.lower(F.trim(_col(c)))
    return (
        F.when(s.isin("true", "t", "yes", "y", "1"), F.lit(True))
        .when(s.isin("false", "f", "no", "n", "0"), F.lit(False))
    )


def has_digit(c: Column | str) -> Column:
    return _col(c).rlike("[0-9]")


def strip_thousands(c: Column | str) -> Column:
    return F.replace(_col(c), F.lit(","), F.lit(""))


def latin1_text(c: Column | str) -> Column:
    """Drop every character outside Latin-1 (U+0000..U+00FF)."""
    return F.regexp_replace(_col(c), "[^\\x{00}-\\x{FF}]", "")


def fixed_decimals(c: Column | str, digits: int) -> Column:
    """Number as text with ``digits`` decimals (``%.<digits>f``)."""
    return F.format_string(f"%.{digits}f", _col(c))


def safe_div(a: Column, b: Column) -> Column:
    """a / b, NULL when b is 0 or NULL (``a / NULLIF(b, 0)``)."""
    return F.try_divide(a, F.nullif(b, F.lit(0)))
