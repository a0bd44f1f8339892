"""Session construction and the shared scratch location.

Everything that is written mid-job (round-trip sources, checkpoints of small
intermediate tables) goes below the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (a local test
session) do we create one of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# scratch folders this process created, in order (kept ones are never removed)
_CREATED: list[str] = []
_KEPT: set[str] = set()

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def materialize(df, name: str = "stage", keep: bool = False):
    """Write ``df`` as parquet under the checkpoint folder and read it back.

    Cuts the lineage of iterative plans (each pass starts from stored data, so a
    lost executor only recomputes the current pass) and computes ``df`` once.
    ``keep`` marks tables that outlive a ``scratch_scope`` (e.g. ingested inputs).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if keep:
        _KEPT.add(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)   # known schema: no footer-reading job


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "epigrid", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "4g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = _own_folder(sc)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _own_folder(sc) -> str:
    """Where to store when ``spark.checkpoint.dir`` is unset: never a machine-local folder on a cluster."""
    if sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        return tempfile.mkdtemp(prefix="epigrid-ckpt-")
    home = sc._jvm.org.apache.hadoop.fs.FileSystem.get(sc._jsc.hadoopConfiguration()).getHomeDirectory().toString()
    if home.startswith("file:"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{home}/epigrid-checkpoints-{uuid.uuid4().hex}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, "epigrid-scratch", f"{name}-{uuid.uuid4().hex}")
    _CREATED.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Remove the scratch folders created inside the block when it ends.

    DataFrames read from those folders must not be used after the block.
    Deletion goes through Hadoop's FileSystem, so it works on cluster storage.
    """
    mark = len(_CREATED)
    try:
        yield
    finally:
        remove_scratch(spark, _CREATED[mark:])


def scratch_mark() -> int:
    """How many scratch folders there are; ``scratch_since`` lists those created after it."""
    return len(_CREATED)


def scratch_since(mark: int) -> list[str]:
    return [p for p in _CREATED[mark:] if p not in _KEPT]


def remove_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Remove scratch folders of this session, but for kept ones; nothing may read from them any more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in [p for p in paths if p not in _KEPT]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
        if path in _CREATED:
            _CREATED.remove(path)
