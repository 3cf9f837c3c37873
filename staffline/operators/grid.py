"""Dense Metric x Staff Group x System x Period grid.

Built by generators, not a cross join: every system row explodes a period
sequence and a literal array of (metric, staff group) pairs. The output size is
fixed by the configured dimensions, independent of the fact volume.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import period_sequence


def pair_array(pairs: Iterable[tuple[str, str]]):
    return F.array(*[
        F.struct(F.lit(m).alias("metric"), F.lit(g).alias("staff_group")) for m, g in pairs
    ])


def all_pairs(metrics: Sequence[str], staff_groups: Sequence[str]) -> list[tuple[str, str]]:
    return [(m, g) for m in metrics for g in staff_groups]


def dense_grid(systems: DataFrame, pairs: Sequence[tuple[str, str]], first_period: int,
               last_period: int, system_col: str = "system") -> DataFrame:
    """Rows ``(metric, staff_group, system, period)`` for every system in
    ``systems`` (one column ``system_col``), every pair and every month."""
    return (
        systems.select(F.col(system_col).alias("system"))
        .withColumn("period", F.explode(period_sequence(F.lit(first_period), F.lit(last_period))))
        .withColumn("pair", F.explode(pair_array(pairs)))
        .select("pair.metric", "pair.staff_group", "system", "period")
    )


def systems_frame(spark: SparkSession, systems: Sequence[str]) -> DataFrame:
    """Configured system list as a one-column frame."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(s) for s in systems])).alias("system"))
