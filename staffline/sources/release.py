"""Publishing many tables as one release.

Every table of a run is written to a version folder of its own; readers do not
see them yet. ``commit`` then appends one small file to the manifest
(``<location>/_releases``) that names the version of every table. Spark's file
commit moves that file into place by one rename (one put on object stores), so a
reader finds all tables of a run or none of them, and a run that fails in
between leaves the release before it as it was. Only public DataFrame calls are
used, on Spark Connect as well.

A release carries over the tables that it does not write itself, so a release
of a few tables leaves the others as they were. One writer per location.
"""

from __future__ import annotations

import threading
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "_releases"
MANIFEST_SCHEMA = "release string, table string, version string, rows long"
NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def _manifest(spark: SparkSession, location: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST_SCHEMA).json(f"{location.rstrip('/')}/{MANIFEST}")
    except AnalysisException as e:
        if e.getCondition() not in NOTHING_THERE:
            raise
        return None


def releases(spark: SparkSession, location: str) -> list[str]:
    """Names of the committed releases, oldest first."""
    found = _manifest(spark, location)
    return [] if found is None else sorted(r["release"] for r in found.select("release").distinct().collect())


class Published:
    """The tables of one committed release, resolved once: later releases do not change what it reads."""

    def __init__(self, spark: SparkSession, location: str, versions: dict[str, str], rows: dict[str, int | None],
                 name: str | None, fmt: str = "parquet"):
        self.spark, self.location, self.versions, self.rows = spark, location.rstrip("/"), versions, rows
        self.name, self.fmt = name, fmt

    def table(self, name: str) -> DataFrame:
        if name not in self.versions:
            raise KeyError(f"no table {name!r} in release {self.name} of {self.location}")
        return self.spark.read.format(self.fmt).load(f"{self.location}/{name}/{self.versions[name]}")


def open_release(spark: SparkSession, location: str, name: str | None = None, fmt: str = "parquet") -> Published:
    """The newest committed release, or the one of that name; without any, a release of no tables."""
    found = _manifest(spark, location)
    if found is not None and name is None:
        name = found.agg(F.max("release")).first()[0]
    rows = [] if found is None else found.where(F.col("release") == F.lit(name)).collect()  # one row per table
    return Published(spark, location, {r["table"]: r["version"] for r in rows}, {r["table"]: r["rows"] for r in rows}, name, fmt)


class Release:
    """Tables written one by one (from several threads if need be) and committed together."""

    def __init__(self, spark: SparkSession, location: str, fmt: str = "parquet"):
        self.spark, self.location, self.fmt = spark, location.rstrip("/"), fmt
        self.name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        self.before = open_release(spark, location, fmt=fmt)
        self._written: dict[str, int | None] = {}
        self._lock = threading.Lock()

    def write(self, name: str, df: DataFrame, rows=None) -> DataFrame:
        """Write a table of this release and read it back. ``rows``: an Observation of its row count."""
        path = f"{self.location}/{name}/{self.name}"
        df.write.mode("overwrite").format(self.fmt).save(path)
        count = rows.get["rows"] if rows is not None else None
        with self._lock:
            self._written[name] = count
        return self.spark.read.format(self.fmt).load(path)

    def counts(self) -> dict[str, int | None]:
        """Observed rows of the tables written so far."""
        with self._lock:
            return dict(self._written)

    def commit(self) -> Published:
        """Make all tables written so far the current ones, by one file of the manifest."""
        versions = {**self.before.versions, **{t: self.name for t in self._written}}
        counts = {**self.before.rows, **self._written}
        entries = [(self.name, t, v, counts.get(t)) for t, v in sorted(versions.items())]
        (self.spark.createDataFrame(entries, MANIFEST_SCHEMA).coalesce(1)
         .write.mode("append").json(f"{self.location}/{MANIFEST}"))
        return Published(self.spark, self.location, versions, counts, self.name, self.fmt)
