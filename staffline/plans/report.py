"""What a run says about itself, published beside its tables.

One long table ``(check, subject, provider, yearmonth, rows)``:

* ``sheet profile``: rows of each code-list sheet and reference-sheet label after the lookup;
* ``rows of table``: rows of every published table, as observed while it was written;
* ``rejected provider``: metric rows of providers that are no grid system and so never reach the overview;
* ``vacancy fan-out``: months of a provider in which the vacancy join multiplies rows, with the exact
  number of rows it makes (key-count products, before the join).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RunConfig
from ..operators.aggregates import distinct_profile
from ..operators.joins import fan_out
from . import measures, overview

NAME = "Run_Report"
COLUMNS = ("check", "subject", "provider", "yearmonth", "rows")
SCHEMA = "check string, subject string, provider string, yearmonth int, rows long"


def _rows(df: DataFrame, check: str, subject, provider=None, yearmonth=None, rows="rows") -> DataFrame:
    none = F.lit(None)
    return df.select(F.lit(check).alias("check"), subject.cast("string").alias("subject"),
                     (none if provider is None else F.col(provider)).cast("string").alias("provider"),
                     (none if yearmonth is None else F.col(yearmonth)).cast("int").alias("yearmonth"),
                     F.col(rows).cast("long").alias("rows"))


def sheet_profile(looked: DataFrame) -> DataFrame:
    """Rows of every (sheet, reference sheet) that the lookup found."""
    counted = looked.groupBy("sheet", "reference_sheet").agg(F.count(F.lit(1)).alias("rows"))
    labels = distinct_profile(counted, ["sheet", "reference_sheet", "rows"])
    return _rows(labels, "sheet profile", F.concat_ws(": ", F.col("sheet").cast("string"), F.coalesce("reference_sheet", F.lit("(none)"))))


def vacancy_fan_out(overall: DataFrame, vacancy: DataFrame) -> DataFrame:
    """(provider, yearmonth, left_rows, right_rows, rows) of the vacancy join where a key is repeated."""
    sizes = fan_out(*measures.main_vacancy_parts(overall, vacancy), measures.KEYS)
    return sizes.where((F.col("left_rows") > 1) | (F.col("right_rows") > 1))


def run_report(spark: SparkSession, looked: DataFrame, out: Mapping[str, DataFrame], counts: Mapping[str, int | None],
               facts: DataFrame, cfg: RunConfig = RunConfig()) -> DataFrame:
    """The report of a run; ``counts``: observed rows by table, ``facts``: the overview's metric facts."""
    tables = spark.createDataFrame(sorted((t, n) for t, n in counts.items() if n is not None), "table string, rows long")
    rejected = overview.rejected_providers(facts, cfg)
    return (sheet_profile(looked)
            .unionByName(_rows(tables, "rows of table", F.col("table")))
            .unionByName(_rows(rejected, "rejected provider", F.col("metric"), "system"))
            .unionByName(_rows(vacancy_fan_out(out["Overall"], out["Vacancy"]), "vacancy fan-out",
                               F.concat_ws(" x ", F.col("left_rows").cast("string"), F.col("right_rows").cast("string")),
                               "provider", "yearmonth")))
