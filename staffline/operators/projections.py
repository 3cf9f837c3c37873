"""Projections: ordinal/named selection, renames, constants, load-date stamp."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def q(name: str):
    """Column reference that tolerates spaces/dots in the name."""
    return F.col(f"`{name}`")


def positional_names(df: DataFrame, positions: Sequence[int]) -> list[str]:
    """Names at 1-based ``positions`` (resolved once, on the schema only)."""
    cols = df.columns
    return [cols[i - 1] for i in positions]


def select_positions(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    """``select(6:17, 19)``-style selection by 1-based ordinal; metadata only."""
    return df.select(*[q(c) for c in positional_names(df, positions)])


def select_named(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[q(c) for c in names])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename ``{old: new}``; unknown names are an error (no silent no-op)."""
    missing = [k for k in mapping if k not in df.columns]
    if missing:
        raise KeyError(f"cannot rename missing columns {missing}; have {df.columns}")
    return df.withColumnsRenamed(dict(mapping))


def rename_positions(df: DataFrame, positions: Sequence[int], new_names: Sequence[str]) -> DataFrame:
    """Rename the columns at 1-based ``positions`` to ``new_names`` (``rename_with(.cols=1:12)``)."""
    if len(positions) != len(new_names):
        raise ValueError("positions and names differ in length")
    old = positional_names(df, positions)
    return df.withColumnsRenamed(dict(zip(old, [str(n) for n in new_names])))


def add_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add literal label columns (``mutate(Type = "...")``)."""
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def stamp_load_date(df: DataFrame, load_date: str | None = None, column: str = "load_date") -> DataFrame:
    """``Load_Date = Sys.Date()``; pass an ISO date to make runs reproducible."""
    value = F.current_date() if load_date is None else F.lit(load_date).cast("date")
    return df.withColumn(column, value)
