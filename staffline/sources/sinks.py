"""Publishing a named table.

A path table keeps its rows in version folders; a small pointer file names the
current one and is replaced last, by one rename. Readers see the old version or
the new one, and a write that fails leaves the published table as it was.
Catalog tables use Spark's own overwrite, which is not atomic.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "_current"


def replace_table(df: DataFrame, name: str, location: str | None = None, fmt: str = "parquet") -> None:
    """Publish ``df`` as the new content of a table. With ``location`` the table is
    a path-based dataset; otherwise a catalog table. The version before the new
    one is kept for readers that have already resolved it."""
    if not location:
        df.write.mode("overwrite").format(fmt).saveAsTable(name)
        return
    root = f"{location.rstrip('/')}/{name}"
    version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    before = current_version(df.sparkSession, root)
    df.write.format(fmt).save(f"{root}/{version}")
    _switch(df.sparkSession, root, version, keep=(version, before))


def _hadoop(spark: SparkSession, path: str):
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    return jvm, target, target.getFileSystem(conf), conf


def _switch(spark: SparkSession, root: str, version: str, keep: tuple) -> None:
    """Point the table at ``version`` by one rename, then drop versions not kept."""
    jvm, folder, fs, conf = _hadoop(spark, root)
    path = jvm.org.apache.hadoop.fs.Path
    draft = path(folder, f"{POINTER}-{version}")
    out = fs.create(draft)
    out.write(bytearray(version.encode()))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark._sc._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    context.rename(fs.makeQualified(draft), fs.makeQualified(path(folder, POINTER)), how)
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in keep and name < version:
            fs.delete(status.getPath(), True)


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version folder a table points at; None when it was never published."""
    jvm, folder, fs, _ = _hadoop(spark, root)
    pointer = jvm.org.apache.hadoop.fs.Path(folder, POINTER)
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_jdbc_table(df: DataFrame, url: str, name: str, options: dict | None = None) -> None:
    w = df.write.format("jdbc").mode("overwrite").option("url", url).option("dbtable", name)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save()


def publish_session_view(df: DataFrame, name: str) -> None:
    """Session-scoped published name (``global_temp.<name>``)."""
    df.createOrReplaceGlobalTempView(name)


def read_published(spark: SparkSession, name: str, location: str, fmt: str = "parquet") -> DataFrame:
    root = f"{location.rstrip('/')}/{name}"
    version = current_version(spark, root)
    return spark.read.format(fmt).load(root if version is None else f"{root}/{version}")
