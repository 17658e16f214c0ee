"""Session settings and the shared folder used for staged data.

Jobs that need to cut lineage write a Parquet table into the folder the cluster
names in ``spark.checkpoint.dir``.  That folder outlives any executor, so a lost
executor costs a re-read and never a re-computation.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: Folders of local sessions without that setting, by application.
_LOCAL_FOLDERS: dict[str, str] = {}

#: Settings the jobs ask for; a cluster's own defaults may override any of them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(app_name: str = "barstream", **extra: str) -> SparkSession:
    """Get or create a session with the library's defaults."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def setting(spark: SparkSession, name: str, value) -> Iterator[None]:
    """A session setting while a block runs."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder for intermediate data.

    Where the setting is absent a local session gets a temporary folder; a
    cluster session is refused, because executors cannot see the driver's disk.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="barstream-")
    return _LOCAL_FOLDERS[application]


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/barstream/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder, in this application's own part of it."""
    return f"{_own_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Delete what this application staged.

    For the end of a job: DataFrames made from staged data cannot be read afterwards.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    Unlike caching this survives executor loss, and unlike a checkpoint it is
    columnar: a later pass over two columns reads only those two.
    """
    spark = df.sparkSession
    path = scratch(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
