"""Wide monthly submissions -> long fact, in batch or incrementally.

One transform (``submissions_long``) serves both paths:

* batch: ``spark.read.parquet(inbox)`` -> transform -> write
* incremental: ``readStream`` over the inbox with ``Trigger.AvailableNow``;
  each micro-batch is transformed and written with dynamic partition overwrite
  by fiscal year, so a fiscal year holds exactly the workbooks of the latest
  run that touched it (the inbox snapshot), and processed files are archived
  by the file source. Per-provider replacement is available as an option.

The landing layout is one folder per workbook and sheet:
``<inbox>/submission=<workbook name>/sheet_no=<n>/`` with Parquet or CSV files
(CSV with its banner line); the 19 columns of a sheet keep their positional
contract (months at 6-17, code at 19).
"""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from .. import config as C
from ..functions.periods import fiscal_period, fiscal_year_start
from ..functions.text import marker_in_name, provider_from_name, trimmed
from ..operators.filters import cutoff, valid_codes
from ..operators.projections import positional_names, stamp_load_date
from ..operators.reshape import unpivot_keep_nulls

#: columns that come from the path
LANDING_KEYS = ("submission", "sheet_no")
NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
LONG_SCHEMA = "maincode string, yearmonth int, value string, provider string, load_date date"
LONG_COLUMNS = ("maincode", "yearmonth", "value", "provider", "load_date")


def wide_schema(column_names) -> StructType:
    """Sheet cells are landed as text unless a schema says otherwise; the landing keys come from the path."""
    if isinstance(column_names, StructType):
        return column_names
    fields = [StructField(c, StringType()) for c in column_names]
    fields += [StructField("submission", StringType()), StructField("sheet_no", IntegerType())]
    return StructType(fields)


def submissions_long(wide: DataFrame, latest_month: int, marker: str = "24-25", marker_is_regex: bool = False,
                     month_labels=None, load_date: str | None = None, fallback_labels=None,
                     sheet_range: tuple[int, int] = C.SUBMISSION_SHEETS, keep_workbook: bool = False) -> DataFrame:
    """The per-sheet extract, for every workbook and sheet at once.

    Cells may be text or numbers; codes are trimmed as the sheet reader does, and
    a blank code is a missing one. ``keep_workbook`` adds the workbook's name.

    ``month_labels`` (12 periods) renames the month columns by position, as for
    an inbox holding one fiscal year. Without labels each workbook's periods
    follow from the ``yy-yy`` fiscal-year marker in its name (the configured
    marker first); a workbook without one takes ``fallback_labels``, and
    without those the run fails naming the workbook.
    """
    lo, hi = sheet_range
    w = wide.filter(F.col("sheet_no").between(lo, hi))  # partition pruning on the landing layout
    months = positional_names(w, C.WIDE_MONTH_POSITIONS)
    code = positional_names(w, [C.WIDE_CODE_POSITION])[0]
    provider = provider_from_name("submission", marker, regex=marker_is_regex)
    body = w.select(
        trimmed(F.col(f"`{code}`")).alias("maincode"),
        provider.alias("provider"),
        fiscal_year_start(marker_in_name("submission", None if marker_is_regex else marker)).alias("fy"),
        F.col("submission").alias("workbook"),
        *[F.col(f"`{m}`").cast("string").alias(str(i)) for i, m in enumerate(months, start=1)],
    )
    body = valid_codes(body, "maincode")
    month_idx = [str(i) for i in range(1, 13)]
    if month_labels:
        # months after the cut-off would only be generated to be filtered away
        month_idx = [i for i in month_idx if int(month_labels[int(i) - 1]) <= latest_month] or month_idx
    long = unpivot_keep_nulls(body, ["maincode", "provider", "fy", "workbook"], month_idx, "fiscal_month", "value")
    if month_labels:
        labels = F.array(*[F.lit(int(x)) for x in month_labels])
        ym = F.element_at(labels, F.col("fiscal_month").cast("int"))
    else:
        if fallback_labels:
            other = F.element_at(F.array(*[F.lit(int(x)) for x in fallback_labels]), F.col("fiscal_month").cast("int"))
        else:
            other = F.raise_error(F.concat(F.lit("no fiscal-year marker in the workbook name: "), F.col("workbook"))).cast("int")
        ym = F.when(F.col("fy").isNull(), other).otherwise(fiscal_period(F.col("fy"), F.col("fiscal_month")))
    out = long.select("maincode", ym.cast("int").alias("yearmonth"), "value", "provider", *["workbook"] * keep_workbook)
    return cutoff(stamp_load_date(out, load_date), latest_month)


def _header_rows(column_names) -> F.Column:
    """The line of sheet headers, which a file with a banner holds as its second line."""
    names = [c for c in wide_schema(column_names).names if c not in LANDING_KEYS]
    return reduce(lambda a, b: a & b, [F.coalesce(F.trim(F.col(f"`{c}`")) == c.strip(), F.lit(False)) for c in names])


def _load(reader, inbox: str, column_names, fmt: str, banner: bool) -> DataFrame:
    """Batch or streaming scan of the inbox.

    CSV sheets start with a banner line and then the headers. ``header`` makes
    Spark drop the first line of each file at file position 0, so the scan stays
    splittable; the header line is the row whose cells are the headers.
    """
    reader = reader.schema(wide_schema(column_names)).option("basePath", inbox)
    if fmt == "parquet":
        return reader.parquet(inbox)
    wide = reader.option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").csv(inbox)
    return wide.where(~_header_rows(column_names)) if banner else wide


def landed_columns(spark: SparkSession, inbox: str, fmt: str = "parquet", banner: bool = True) -> StructType | None:
    """Headers and cell types of the landed sheets; None when nothing is landed.

    Parquet keeps its cell types (numeric cells stay numbers until they are
    melted); CSV cells are text, named by the header line of one file.
    """
    try:
        if fmt == "parquet":
            found = spark.read.option("basePath", inbox).parquet(inbox).schema
            fields = [f for f in found.fields if f.name not in LANDING_KEYS]
            return StructType(fields + wide_schema([]).fields) if fields else None
        first = spark.read.text(inbox).select("value", "_metadata.file_path").limit(1 + banner).collect()
    except AnalysisException as e:
        if e.getCondition() not in NOTHING_THERE:
            raise
        return None
    if len(first) < 1 + banner:
        return None
    return wide_schema(next(csv.reader([first[-1]["value"]])))


def read_inbox(spark: SparkSession, inbox: str, column_names, fmt: str = "parquet", banner: bool = True) -> DataFrame:
    """Batch scan of every workbook in the inbox (one distributed scan, no loop).

    ``column_names``: the headers of a sheet, or its schema with cell types.
    """
    return _load(spark.read, inbox, column_names, fmt, banner)


def _with_fiscal_year(df: DataFrame) -> DataFrame:
    ym = F.col("yearmonth")
    return df.withColumn("fiscal_year", (F.floor(ym / 100) - F.when(ym % 100 < 4, 1).otherwise(0)).cast("int"))


OVERWRITE_SCOPES = {
    # each run's rows replace the whole fiscal year (snapshot of the inbox)
    "fiscal_year": ("fiscal_year",),
    # each run's rows replace only the providers present in it
    "provider": ("fiscal_year", "provider"),
}


def write_fact(df: DataFrame, out: str, scope: str = "fiscal_year") -> None:
    """Dynamic partition overwrite: only partitions present in ``df`` are
    replaced. With the default scope a fiscal year holds exactly the workbooks
    of the latest run that touched it; ``scope="provider"`` keeps providers that
    were not resubmitted."""
    (_with_fiscal_year(df).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*OVERWRITE_SCOPES[scope]).parquet(out))


def stream_inbox(spark: SparkSession, inbox: str, out: str, checkpoint: str, column_names,
                 latest_month: int, archive: str | None = None, marker: str = "24-25",
                 marker_is_regex: bool = False, month_labels=None, load_date: str | None = None,
                 max_files_per_trigger: int | None = None, scope: str = "fiscal_year", fallback_labels=None,
                 fmt: str = "parquet", banner: bool = True):
    """Incremental ingest of new workbooks; returns the finished ``StreamingQuery``.

    ``archive`` moves processed files there (the file source archives files of
    a batch once a later batch has committed). The checkpoint must be on shared
    storage; a resubmission needs a new file name, because the source tracks
    processed paths (``streaming.resubmission`` follows the content instead). With the fiscal-year snapshot scope all files of a run
    must fall in one micro-batch, so ``max_files_per_trigger`` is only
    allowed with ``scope="provider"`` (and then a workbook must not span
    batches).
    """
    if max_files_per_trigger and scope == "fiscal_year":
        raise ValueError("splitting a run into several batches breaks the fiscal-year snapshot")
    reader = spark.readStream
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    wide = _load(reader, inbox, column_names, fmt, banner)

    def sink(batch: DataFrame, _epoch: int) -> None:
        long = submissions_long(batch, latest_month, marker, marker_is_regex, month_labels, load_date,
                                fallback_labels)
        write_fact(long, out, scope)

    q = (wide.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q



def read_fact(spark: SparkSession, out: str) -> DataFrame:
    """The long fact; empty when no run has written it yet (an empty inbox is a no-op)."""
    try:
        fact = spark.read.parquet(out)
    except AnalysisException as e:
        # nothing written yet; any other failure is the caller's to see
        if e.getCondition() not in NOTHING_THERE:
            raise
        return spark.createDataFrame([], LONG_SCHEMA)
    return fact.select(*LONG_COLUMNS)
