"""Historic fact from a relational store over JDBC.

The projection ``SELECT maincode, yearmonth, value, provider`` is pushed to
the database. For large tables read in parallel slices: ``dbtable`` with
``partitionColumn``/``numPartitions`` (the ``query`` option cannot be combined
with partitioning). Connection options (url, driver, credentials) come from the
caller; nothing is hard-wired.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

HISTORIC_COLUMNS = ("maincode", "yearmonth", "value", "provider")


def read_historic(spark: SparkSession, url: str, table: str, options: dict | None = None,
                  partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                  num_partitions: int | None = None) -> DataFrame:
    r = spark.read.format("jdbc").options(**read_options(url, table, options, partition_column, lower, upper, num_partitions))
    return r.load().select(*HISTORIC_COLUMNS)


def read_options(url: str, table: str, options: dict | None = None, partition_column: str | None = None,
                 lower: int | None = None, upper: int | None = None, num_partitions: int | None = None) -> dict[str, str]:
    """Options of the read: a partitioned scan needs both bounds; without a
    partition column the projection is pushed as a query, read by one task."""
    out = {"url": url, **{k: str(v) for k, v in (options or {}).items()}}
    if partition_column:
        if lower is None or upper is None:
            raise ValueError("a partitioned read needs lower and upper bounds of the partition column")
        return out | {"dbtable": table, "partitionColumn": partition_column, "lowerBound": str(lower),
                      "upperBound": str(upper), "numPartitions": str(num_partitions or 8)}
    return out | {"query": f"SELECT {', '.join(HISTORIC_COLUMNS)} FROM {table}"}


def read_historic_table(spark: SparkSession, path: str) -> DataFrame:
    """The same projection over a Parquet copy of the historic table; only the
    four columns reach the scan (``ReadSchema``)."""
    return spark.read.parquet(path).select(*HISTORIC_COLUMNS)
