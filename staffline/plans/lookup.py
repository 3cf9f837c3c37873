"""Fact assembly and the code-list lookup.

The original joins the fact once per code-list sheet (12 joins). Here the code
list is one long table with a ``sheet`` column, so the fact is joined once; each
published table is a ``sheet`` filter of that result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.semantics import to_number
from ..operators.joins import inner_null_safe
from ..operators.unions import union_strict
from ..session import HASHED_SIDE, settings

#: sheets that a task writes side by side; rows of further ones are sorted by sheet first
OPEN_SHEETS = 16
FACT_COLUMNS = ("maincode", "yearmonth", "value", "provider")


def fact_union_historic(historic: DataFrame, current: DataFrame) -> DataFrame:
    """Historic fact (projected query) + current-year fact without its load date."""
    cur = current.drop("load_date") if "load_date" in current.columns else current
    return union_strict(historic.select(*FACT_COLUMNS), cur.select(*FACT_COLUMNS))


def lookup_all_sheets(fact: DataFrame, ref_long: DataFrame) -> DataFrame:
    """Inner join of the fact with every code-list sheet at once (many-to-many,
    NULL code matches NULL code); text values -> double with missing = 0, before
    the join gives a value to several sheets.

    The code list is small by nature (codes x sheets), so Spark's size-checked
    auto-broadcast or AQE's runtime re-plan keeps the fact unshuffled; a code
    list beyond the threshold is joined by shuffle, with hot codes split.
    """
    return inner_null_safe(fact.select(*FACT_COLUMNS).withColumn("value", to_number("value")), ref_long, ["maincode"])


def materialize_by_sheet(spark, looked_up: DataFrame, path: str) -> DataFrame:
    """Write the looked-up fact once, partitioned by sheet, and read it back.

    Every task writes its own rows of each sheet with all sheets' files open, so
    the looked-up rows, the largest frame of a run, are neither shuffled nor sorted for it.
    """
    with settings(spark, maxConcurrentOutputFileWriters=str(OPEN_SHEETS), adaptive_maxShuffledHashJoinLocalMapThreshold=HASHED_SIDE):
        looked_up.write.mode("overwrite").partitionBy("sheet").parquet(path)
    return spark.read.parquet(path).select(*looked_up.columns)


def passthrough_columns(looked_up: DataFrame) -> list[str]:
    """Code-list columns the model does not interpret (kept as landed)."""
    known = set(FACT_COLUMNS) | {"sheet"} | set(C.REF_ATTRIBUTE_COLUMNS)
    return [c for c in looked_up.columns if c not in known]


def sheet_table(looked_up: DataFrame, sheet: int, extra_columns=None) -> DataFrame:
    """One code-list sheet's lookup result with that sheet's own columns, plus
    any code-list columns the model does not know."""
    cols = list(C.SHEET_COLUMNS[sheet]) if extra_columns is None else list(extra_columns)
    if sheet != C.SHEET_KPI:
        # KPI rows are strictly row-bound with the supplied rates, which needs
        # exactly the KPI sheet's own columns
        cols += passthrough_columns(looked_up)
    out = looked_up.filter(F.col("sheet") == sheet).select(*FACT_COLUMNS, *[f"`{c}`" for c in cols])
    if sheet == C.SHEET_VACANCY:
        out = out.withColumn("value", F.abs("value"))  # vacancies are reported as positives
    return out


def bank_agency(looked_up: DataFrame) -> DataFrame:
    """Table 13: bank and agency rows (sheets 3 and 4 share their columns), one scan."""
    cols = list(C.SHEET_COLUMNS[C.SHEET_BANK]) + passthrough_columns(looked_up)
    assert C.SHEET_COLUMNS[C.SHEET_BANK] == C.SHEET_COLUMNS[C.SHEET_AGENCY]
    return looked_up.filter(F.col("sheet").isin(C.SHEET_BANK, C.SHEET_AGENCY)).select(
        *FACT_COLUMNS, *[f"`{c}`" for c in cols])


def published_lookup_tables(looked_up: DataFrame) -> dict[str, DataFrame]:
    """The 13 published lookup tables by name."""
    out = {name: sheet_table(looked_up, i + 1) for i, name in enumerate(C.PUBLISHED_LOOKUP_TABLES[:12])}
    out[C.PUBLISHED_LOOKUP_TABLES[12]] = bank_agency(looked_up)
    return out
