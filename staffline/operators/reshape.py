"""Wide -> long reshapes. ``DataFrame.unpivot`` is a narrow Expand (no shuffle)
and keeps NULL values, like ``pivot_longer(values_drop_na = FALSE)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .projections import q


def unpivot_keep_nulls(df: DataFrame, ids: Sequence[str], values: Sequence[str],
                       names_to: str, values_to: str) -> DataFrame:
    """Generic melt: one output row per (input row, value column), NULLs kept."""
    return df.unpivot([q(c) for c in ids], [q(c) for c in values], names_to, values_to)


def months_long(df: DataFrame, ids: Sequence[str], month_columns: Sequence[str],
                labels: Sequence[int] | None = None, names_to: str = "yearmonth",
                values_to: str = "value") -> DataFrame:
    """12 month columns -> ``(yearmonth int, value)``; the columns are first renamed
    by position to ``labels`` (or used as-is when they already are period labels).
    Month cells must share one type (land them as text)."""
    if labels is not None:
        if len(labels) != len(month_columns):
            raise ValueError("one label per month column is required")
        df = df.withColumnsRenamed({m: str(lab) for m, lab in zip(month_columns, labels)})
        month_columns = [str(lab) for lab in labels]
    long = unpivot_keep_nulls(df, ids, month_columns, names_to, values_to)
    return long.withColumn(names_to, F.col(names_to).try_cast("int"))


def providers_long(df: DataFrame, ids: Sequence[str], provider_columns: Sequence[str],
                   names_to: str = "provider", values_to: str = "value") -> DataFrame:
    """One column per provider -> ``(provider, value)``."""
    casted = df.select(*[q(c) for c in ids], *[q(c).cast("double").alias(c) for c in provider_columns])
    return unpivot_keep_nulls(casted, ids, provider_columns, names_to, values_to)


def measures_long(df: DataFrame, ids: Sequence[str], measure_columns: Sequence[str],
                  names_to: str = "metric", values_to: str = "value") -> DataFrame:
    """Measure columns -> ``(metric, value double)``."""
    casted = df.select(*[q(c) for c in ids], *[q(c).cast("double").alias(c) for c in measure_columns])
    return unpivot_keep_nulls(casted, ids, measure_columns, names_to, values_to)
