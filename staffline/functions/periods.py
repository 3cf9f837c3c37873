"""Monthly period helpers. A period is an ``int`` ``yyyymm``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_to_period(d) -> Column:
    """Date/timestamp -> ``yyyymm`` int (same as formatting ``yyyy-MM`` and dropping the dash)."""
    d = _col(d)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def period_to_date(p) -> Column:
    """``yyyymm`` int -> first day of that month."""
    p = _col(p).cast("int")
    return F.make_date(F.floor(p / 100).cast("int"), (p % 100).cast("int"), F.lit(1))


def period_cast(c) -> Column:
    """Text period -> int, cut towards zero like ``'202404.0'`` -> 202404; other text becomes NULL."""
    s = F.regexp_replace(_col(c).cast("string"), r"^\s+|\s+$", "")
    return F.when(~s.rlike("[dDfF]$"), s.try_cast("double")).try_cast("int")


def month_sequence(first, last) -> Column:
    """Array of first-of-month dates from ``first`` to ``last`` inclusive."""
    return F.sequence(F.trunc(_col(first), "month"), F.trunc(_col(last), "month"), F.expr("INTERVAL 1 MONTH"))


def period_sequence(first_period, last_period) -> Column:
    """Array of ``yyyymm`` ints from ``first_period`` to ``last_period`` inclusive."""
    return F.transform(
        month_sequence(period_to_date(first_period), period_to_date(last_period)),
        lambda d: (F.year(d) * 100 + F.month(d)).cast("int"),
    )


def fiscal_period(fy_start_year, month_index) -> Column:
    """Period of fiscal month ``month_index`` (1 = April .. 12 = March)."""
    y, i = _col(fy_start_year).cast("int"), _col(month_index).cast("int")
    return F.when(i <= 9, y * 100 + i + 3).otherwise((y + 1) * 100 + i - 9).cast("int")


def fiscal_year_start(marker) -> Column:
    """Start year of a ``yy-yy`` fiscal-year marker (``'24-25'`` -> 2024; ``yy>=50`` -> 19yy)."""
    yy = F.regexp_extract(_col(marker), r"([0-9]{2})-[0-9]{2}", 1)
    yy = F.when(yy == "", None).otherwise(yy).cast("int")
    return F.when(yy >= 50, yy + 1900).otherwise(yy + 2000)
