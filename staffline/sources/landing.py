"""Reading landed inputs under their original header names.

Workbook sheets and the historic table are landed as Parquet or CSV with the
headers they were written with; ``normalise_headers`` renames them once to the
model's column names (unknown columns pass through unchanged).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.periods import period_cast
from ..functions.text import trimmed

# Original header -> model column.
HEADER_MAP = {
    "Maincode": "maincode",
    "Yearmonth": "yearmonth",
    "Value": "value",
    "Provider": "provider",
    "Load_Date": "load_date",
    "Reference Sheet": "reference_sheet",
    "Summary Staff WTE Detail": "summary_detail",
    "Staff Group": "staff_group",
    "Staff Type": "staff_type",
    "Bank/Agency": "bank_agency",
    "Workforce KPI": "workforce_kpi",
    "Measure Detail": "measure_detail",
    "Date": "date",
    "Type": "type",
    "Plan": "plan",
}


def normalise_headers(df: DataFrame) -> DataFrame:
    mapping = {c: HEADER_MAP[c] for c in df.columns if c in HEADER_MAP}
    return df.withColumnsRenamed(mapping) if mapping else df


def read_landed(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A landed sheet/table. CSV is read as text with a header (types are
    applied by the caller where the model needs them)."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("nullValue", "NA")
    return normalise_headers(r.load(path))


def fact_table(df: DataFrame) -> DataFrame:
    """``(maincode, yearmonth int, value text, provider)`` plus anything else."""
    return df.withColumns({"yearmonth": period_cast("yearmonth"), "value": F.col("value").cast("string")})


def code_list(df: DataFrame) -> DataFrame:
    """Code list with an integer ``sheet`` column (landed partitioned by sheet); codes and labels are
    trimmed as the sheet reader does."""
    texts = [c for c, kind in df.dtypes if kind == "string" and c in HEADER_MAP.values()]
    return df.withColumns({c: trimmed(c) for c in texts}).withColumn("sheet", F.col("sheet").cast("int"))


def planned(df: DataFrame) -> DataFrame:
    out = df.withColumns({"yearmonth": period_cast("yearmonth"), "plan": F.col("plan").cast("double")})
    return out.withColumn("date", F.to_date("date")) if "date" in df.columns else out


def rates_wide(df: DataFrame) -> DataFrame:
    """``date`` + one rate column per provider (all cast to double)."""
    return df.select(F.to_date("date").alias("date"),
                     *[F.col(f"`{c}`").cast("double").alias(c) for c in df.columns if c != "date"])
