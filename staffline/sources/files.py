"""File sources: inbox scans, file-name metadata, sheet selection, CSV round trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from ..functions.text import base_name, decoded, provider_from_name

FACT_SCHEMA = StructType([
    StructField("maincode", StringType()),
    StructField("yearmonth", IntegerType()),
    StructField("value", StringType()),
    StructField("provider", StringType()),
    StructField("load_date", DateType()),
])


def scan_dir(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None,
             glob: str | None = None, **options) -> DataFrame:
    """Every file of a folder in one distributed scan (no per-file loop)."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def with_file_columns(df: DataFrame, marker: str = "24-25", marker_is_regex: bool = False,
                      folder_key: str | None = None) -> DataFrame:
    """Add ``file_name`` (decoded workbook name) and ``provider`` (text before
    the fiscal-year marker). With ``folder_key`` the workbook name is the value
    of the ``<folder_key>=<name>`` folder in the path (one folder per workbook);
    otherwise it is the file's base name."""
    path = decoded(F.col("_metadata.file_path"))
    if folder_key:
        name = F.regexp_extract(path, f"/{folder_key}=([^/]*)/", 1)
    else:
        name = base_name(path)
    return df.withColumns({"file_name": name, "provider": provider_from_name(name, marker, marker_is_regex)})


def sheets_between(df: DataFrame, lo: int, hi: int, column: str = "sheet_no") -> DataFrame:
    """Sheets ``lo..hi`` of every workbook; on the landing layout a partition filter."""
    return df.filter(F.col(column).between(lo, hi))


def named_sheet(df: DataFrame, sheet, column: str = "sheet") -> DataFrame:
    """One named (or numbered) sheet of a workbook landed partitioned by sheet."""
    return df.filter(F.col(column) == F.lit(sheet))


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrite a CSV dataset with a header; NULL written as ``NA``."""
    df.write.mode("overwrite").option("header", True).option("nullValue", "NA").csv(path)


def read_csv(spark: SparkSession, path: str, schema: StructType = FACT_SCHEMA) -> DataFrame:
    """Read a CSV dataset back with a declared schema (no inference)."""
    return (spark.read.schema(schema).option("header", True).option("nullValue", "NA")
            .option("mode", "PERMISSIVE").csv(path))
