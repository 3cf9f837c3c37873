"""Spark session defaults and the shared scratch location.

Scratch data (round-trip files, published tables in tests, streaming
checkpoints) always lives under the directory the cluster names in
``spark.checkpoint.dir``. Only when that is unset (local tests) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Stand-in dimension tables (nation/region) are tiny; keep Spark's own
    # size-checked broadcast threshold at its default 10 MB.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "staffline", extra_conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**SESSION_DEFAULTS, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    memory = os.environ.get("STAFFLINE_DRIVER_MEMORY")
    if memory:  # else what the cluster or Spark's defaults say
        builder = builder.config("spark.driver.memory", memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory named by the session.

    A private folder is created only in local mode (tests, single machine); on
    a cluster a machine-local folder would not survive executor loss, so an
    unset ``spark.checkpoint.dir`` is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if not current:
        current = spark.conf.get("spark.checkpoint.dir", None)
        if not current:
            master = sc.master if sc is not None else spark.conf.get("spark.master", "")
            if not master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/object storage)")
            current = _LOCAL_ROOT.setdefault("dir", tempfile.mkdtemp(prefix="staffline-ckpt-"))
        if sc is not None:
            sc.setCheckpointDir(current)
            current = sc.getCheckpointDir() or current
    return current


_LOCAL_ROOT: dict[str, str] = {}


def session_key(spark: SparkSession) -> str:
    """Identifies the running application (for per-application caches)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # Spark Connect
        return str(getattr(spark, "session_id", id(spark)))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/staffline-scratch/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """SQL settings (``_`` for ``.`` in their names, behind ``spark.sql.``) for the jobs started inside."""
    keys = {f"spark.sql.{k.replace('_', '.')}": v for k, v in values.items()}
    former = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in former.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


#: a shuffled join side whose partitions all stay below this is hashed, so the other one need not be sorted
HASHED_SIDE = "64m"


def landed(df: DataFrame, name: str) -> DataFrame:
    """Evaluate a frame once: written under the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor re-reads files instead of recomputing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
