"""Aggregations. All are algebraic (sum/count), so Spark keeps a map-side
partial aggregate before the shuffle and a hot key never lands whole in one
task's hash map."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.semantics import strict_sum, sum_na_rm
from .projections import q


def group_strict_sum(df: DataFrame, keys: Sequence[str], value: str, alias: str | None = None) -> DataFrame:
    """``group_by(keys) %>% summarise(v = sum(v))``: one NULL makes the group NULL."""
    return df.groupBy(*[q(k) for k in keys]).agg(strict_sum(q(value)).alias(alias or value))


def group_sum_na_rm(df: DataFrame, keys: Sequence[str], value: str, alias: str | None = None) -> DataFrame:
    """``summarise(sum(v, na.rm = TRUE))``: NULL/NaN ignored, empty -> 0."""
    return df.groupBy(*[q(k) for k in keys]).agg(sum_na_rm(q(value)).alias(alias or value))


def system_total(df: DataFrame, value_columns: Sequence[str], label: str,
                 period: str = "yearmonth", provider: str = "provider") -> DataFrame:
    """Sum every value column over providers per period; tag the result as one
    extra provider ``label`` (strict sums). Columns: period, values..., provider."""
    agg = df.groupBy(q(period)).agg(*[strict_sum(q(v)).alias(v) for v in value_columns])
    return agg.withColumn(provider, F.lit(label))


def repeated(df: DataFrame, times: str) -> DataFrame:
    """Every row ``times`` times; the column ``times`` goes. Arrays stay short however large the number."""
    step = 10_000
    n = F.col(times)
    return (df.filter(n > 0)
            .withColumn("block_", F.explode(F.sequence(F.lit(0).cast("long"), ((n - 1) / step).cast("long"))))
            .withColumn("copy_", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(step), n - F.col("block_") * step))))
            .drop(times, "block_", "copy_"))


def with_totals(df: DataFrame, by: Sequence[str], member: str, value_columns: Sequence[str], label: str,
                flag: str | None = None) -> DataFrame:
    """All rows of ``df`` plus one row per ``by`` with the strict sums of the value columns and ``label`` as ``member``.

    One pass over the source with two grouping sets: all columns with their number
    of copies, which give the rows back, and ``by``. Columns that are neither are
    NULL in the totals; ``flag`` names a boolean column that tells them apart.
    """
    rest = [c for c in df.columns if c != member]
    sums = [strict_sum(q(v)).alias(f"sum_{k}_") for k, v in enumerate(value_columns)]
    grouped = (df.groupingSets([[q(c) for c in df.columns], [q(c) for c in by]], *[q(c) for c in df.columns])
               .agg(F.grouping(q(member)).alias("is_total_"), F.count(F.lit(1)).alias("copies_"), *sums))
    is_total = F.col("is_total_") == 1
    new = {member: F.when(is_total, F.lit(label)).otherwise(q(member)),
           **{v: F.when(is_total, F.col(f"sum_{k}_")).otherwise(q(v)) for k, v in enumerate(value_columns)}}
    out = grouped.select(*[new[c].alias(c) if c in new else q(c) for c in [*rest, member]],
                         *([is_total.alias(flag)] if flag else []),
                         F.when(is_total, F.lit(1)).otherwise(F.col("copies_")).alias("copies_"))
    return repeated(out, "copies_").select(*[q(c) for c in df.columns], *([flag] if flag else []))


def with_system_total(df: DataFrame, value_columns: Sequence[str], label: str,
                      period: str = "yearmonth", provider: str = "provider") -> DataFrame:
    """Provider rows plus the appended system-total member, from one evaluation of the rows."""
    return with_totals(df, [period], provider, value_columns, label)


def distinct_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations (``unique(t$col)`` per table)."""
    return df.select(*[q(c) for c in columns]).distinct()


def observe_rows(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row counter filled in by the next action on ``df`` (no extra job)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
