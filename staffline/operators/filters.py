"""Row filters with explicit NULL behaviour.

``filter`` keeps only rows whose condition is TRUE (NULL and FALSE are dropped);
only the negated-membership filter deliberately keeps NULL values.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import HEADER_WORDS
from ..functions.semantics import not_in
from .projections import q


def valid_codes(df: DataFrame, column: str = "maincode", header_words: Iterable[str] = HEADER_WORDS) -> DataFrame:
    """Keep coded rows: code present and not a repeated header word."""
    return df.filter(q(column).isNotNull() & not_in(q(column), header_words))


def conjunction(df: DataFrame, **equals) -> DataFrame:
    """AND of column == value tests (NULL column values are dropped)."""
    cond = F.lit(True)
    for c, v in equals.items():
        cond = cond & (q(c) == F.lit(v))
    return df.filter(cond)


def equals_all(df: DataFrame, equals: dict) -> DataFrame:
    """Like ``conjunction`` for column names that are not Python identifiers."""
    return conjunction(df, **equals)


def is_in(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Membership; NULL values are dropped."""
    return df.filter(q(column).isin(list(values)))


def not_in_keep_null(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Negated membership where a NULL value counts as 'not in' and is kept."""
    return df.filter(not_in(q(column), values))


def not_equal(df: DataFrame, column: str, value) -> DataFrame:
    """``a != value``; NULL values are dropped."""
    return df.filter(q(column) != F.lit(value))


def cutoff(df: DataFrame, latest_month: int, column: str = "yearmonth") -> DataFrame:
    """Reporting cut-off on an int period; NULL periods are dropped."""
    return df.filter(q(column).cast("int") <= F.lit(int(latest_month)))


def split_in(df: DataFrame, column: str, values: Iterable) -> tuple[DataFrame, DataFrame]:
    """Two complementary outputs: rows ``in values`` and all others (NULL included)."""
    values = list(values)
    return is_in(df, column, values), not_in_keep_null(df, column, values)
