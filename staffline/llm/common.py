"""Helpers shared by the operators: reading tables, scratch tables, hash folds."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: bound of an Arrow batch sent to a Python worker: whole texts vary too much to count rows
BATCH_BYTES = 6 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package by name, and bound the batches they get by bytes.

    A smaller bound that the session sets already stays.
    """
    given = spark.conf.get(BATCH_CONF, str(64 << 20)).rstrip("b")
    if not given.isdigit() or int(given) > BATCH_BYTES:
        spark.conf.set(BATCH_CONF, str(BATCH_BYTES))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write a frame under the shared checkpoint folder and read it back.

    Cuts lineage: a lost executor re-reads files instead of recomputing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not tuple(partition_by) else spark.read.parquet(path)


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(modulus)


def documents(docs: DataFrame) -> DataFrame:
    """The id and the text alone: labels and extra columns never reach an operator."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
