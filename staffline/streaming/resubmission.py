"""Ingest that follows the content of workbooks instead of their paths.

The streaming file source remembers paths, so a workbook resent under its old
name never reaches it. Here each run fingerprints every workbook of the inbox
(an order-free multiset hash of its rows, one narrow scan and one aggregate by
workbook) and compares it with the ledger, the state kept beside the fact:

* an equal workbook does nothing, however often it is sent, under whatever file
  dates or in however many part files;
* a new or changed one is read again and its rows replace those of the version
  before, even when a fiscal year or sheet is gone from it.

Each version of a workbook lands in a folder of its own
(``workbook=<name>/version=<fingerprint>``); one appended ledger file then makes
all of a run's versions current at once. A run that fails before that leaves the
fact as it was, and running it again rewrites the same folders. Readers join the
version folders with the current ledger rows (partition pruning, no data read
from old versions). A workbook that is gone from the inbox keeps its last version.
"""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .inbox import LONG_COLUMNS, LONG_SCHEMA, NOTHING_THERE, submissions_long

LEDGER = "_ledger"
LEDGER_SCHEMA = "run string, workbook string, version string, cells long"


def fingerprints(wide: DataFrame) -> DataFrame:
    """(workbook, version, cells): two independent sums of row hashes and the number of rows.

    Sums do not depend on the order or split of the rows, and count repeated
    rows; a missing cell differs from an empty one and from its neighbour's.
    """
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in wide.columns if c != "submission"]
    total = lambda salt: F.sum(F.xxhash64(F.lit(salt), *cells).cast("decimal(38,0)"))
    return (wide.groupBy(F.col("submission").cast("string").alias("workbook"))
            .agg(F.count(F.lit(1)).alias("cells"), total(1).alias("one"), total(2).alias("two"))
            .select("workbook", F.substring(F.sha2(F.concat_ws(":", "cells", "one", "two"), 256), 1, 32).alias("version"),
                    "cells"))


def current_versions(spark: SparkSession, out: str) -> DataFrame:
    """(workbook, version) of the ledger: the entry of the latest run for each workbook."""
    try:
        ledger = spark.read.schema(LEDGER_SCHEMA).json(f"{out.rstrip('/')}/{LEDGER}")
    except AnalysisException as e:
        if e.getCondition() not in NOTHING_THERE:
            raise
        ledger = spark.createDataFrame([], LEDGER_SCHEMA)
    return ledger.groupBy("workbook").agg(F.max_by("version", "run").alias("version"))


def ingest_by_content(spark: SparkSession, wide: DataFrame, out: str, latest_month: int, **settings) -> list[str]:
    """Bring the fact under ``out`` up to the workbooks in ``wide``; names of the new and changed ones.

    ``wide``: the inbox (see ``inbox.read_inbox``); ``settings`` go to ``submissions_long``.
    """
    now = fingerprints(wide)
    # one row per workbook that changed; the inbox itself stays distributed
    changed = [(r["workbook"], r["version"], r["cells"]) for r in
               now.join(current_versions(spark, out), ["workbook", "version"], "left_anti").collect()]
    if not changed:
        return []
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    versions = spark.createDataFrame([(run, *c) for c in changed], LEDGER_SCHEMA).coalesce(1)
    names = [w for w, _, _ in changed]
    # a literal list reaches the scan as a partition filter on the landing layout
    rows = submissions_long(wide.where(F.col("submission").isin(names)), latest_month, keep_workbook=True, **settings)
    rows = rows.join(F.broadcast(versions.select("workbook", "version")), "workbook")  # as many rows as workbooks
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("workbook", "version").parquet(out))
    versions.write.mode("append").json(f"{out.rstrip('/')}/{LEDGER}")
    return sorted(names)


def read_fact_by_content(spark: SparkSession, out: str) -> DataFrame:
    """The long fact of the current version of every workbook; empty when no run has written it yet."""
    try:
        # workbook names and hex versions are text, whatever they look like
        schema = f"{LONG_SCHEMA}, workbook string, version string"
        fact = spark.read.schema(schema).option("basePath", out).parquet(out)
    except AnalysisException as e:
        if e.getCondition() not in NOTHING_THERE:
            raise
        return spark.createDataFrame([], LONG_SCHEMA)
    return fact.join(current_versions(spark, out), ["workbook", "version"], "left_semi").select(*LONG_COLUMNS)
