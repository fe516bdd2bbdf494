"""Expressions on single cells and rows: null handling, coercion, codes, ratios, dates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from casewright.contracts import ColumnContract

# Cell texts that mean "missing". The word "None" is a category.
NULL_TOKENS = ("", "NA", "N/A", "n/a", "NaN", "nan", "NULL", "null", "#N/A")

# Fixed value: the characters that count as white space (Unicode included).
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

DAY_SECONDS = 86400


def null_if_token(col: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(~col.isin(*tokens), col)


def nan_to_null(col: Column) -> Column:
    return F.nanvl(col, F.lit(None).cast("double"))


def number(col: Column) -> Column:
    """Numeric value of a cell of any type; what does not parse, and NaN, is null."""
    return nan_to_null(col.try_cast("double"))


def stripped(col: Column) -> Column:
    """Text without leading and trailing white space of any sort."""
    return F.btrim(col.cast("string"), F.lit(WHITE_SPACE))


def within(value: Column, contract: ColumnContract) -> Column:
    """True where ``value`` respects the bounds; a missing bound is open, null stays null."""
    low, high = contract.low, contract.high
    if low is not None and high is not None:
        return (value >= F.lit(float(low))) & (value <= F.lit(float(high)))
    if low is not None:
        return value >= F.lit(float(low))
    if high is not None:
        return value <= F.lit(float(high))
    return F.when(value.isNotNull(), True)


def clipped(value: Column, contract: ColumnContract) -> Column:
    out = value
    if contract.high is not None:
        out = F.least(out, F.lit(float(contract.high)))
    if contract.low is not None:
        out = F.greatest(out, F.lit(float(contract.low)))
    return F.when(value.isNotNull(), out)


def lookup(col: Column, values: Mapping[str, float]) -> Column:
    """Value of a text in a small literal map; other texts are null."""
    pairs = [F.lit(x) for label, value in values.items() for x in (label, float(value))]
    return F.create_map(*pairs)[col]


def level_code(col: Column, levels: Sequence[str]) -> Column:
    """Position of an ordered label, 0 first; labels outside ``levels`` are null."""
    return lookup(col, {label: i for i, label in enumerate(levels)})


def flag(col: Column) -> Column:
    return lookup(col, {"Yes": 1, "No": 0})


def differs(col: Column, label: str) -> Column:
    """1 where the text is not ``label``, 0 where it is, null where it is missing."""
    return (col != label).cast("double")


def null_skipping_sum(*cols: Column) -> Column:
    """Sum of the parts that are present; null only where all are missing."""
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cols[1:]), F.coalesce(cols[0], F.lit(0.0)))
    return F.when(F.coalesce(*cols).isNotNull(), total)


def log1p_floor(col: Column) -> Column:
    """``log(1 + max(x, 0))``; greatest() skips nulls, so the null is kept by hand."""
    return F.when(col.isNotNull(), F.log1p(F.greatest(col, F.lit(0.0))))


def safe_ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom)


def serial_to_timestamp(col: Column) -> Column:
    """Spreadsheet day number (day 0 is 1899-12-30) with its fraction, as a timestamp.

    Whole days are added as days and the fraction as microseconds, so the
    result does not lose digits to one large floating-point second count.
    """
    serial = number(col)
    days = F.floor(serial)
    micros = F.round((serial - days) * F.lit(DAY_SECONDS * 1_000_000)).cast("bigint")
    epoch = F.unix_micros(F.lit("1899-12-30").cast("timestamp"))
    return F.timestamp_micros(epoch + days.cast("bigint") * F.lit(DAY_SECONDS * 1_000_000) + micros)


def elapsed_days(col: Column, reference: str) -> Column:
    """Whole days from ``col`` to a fixed reference date (floor of the elapsed time)."""
    later = F.unix_micros(F.lit(reference).cast("timestamp"))
    gap = later - F.unix_micros(col.cast("timestamp"))
    return F.floor(gap / F.lit(DAY_SECONDS * 1_000_000)).cast("double")


DATE_PARTS = ("year", "month", "quarter", "dayofweek")


def date_part(col: Column, part: str) -> Column:
    """Year, month, quarter or day of the week with Monday as 0."""
    get = {"year": F.year, "month": F.month, "quarter": F.quarter, "dayofweek": F.weekday}
    return get[part](col).cast("double")
