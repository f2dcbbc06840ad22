"""Session defaults and the shared working folder."""

from __future__ import annotations

import contextvars
import gc
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession


def build_session(app: str = "haulage", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs assume; every one can be overridden through ``conf``."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster a missing setting is an error,
    because a machine-local folder is lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    folder = tempfile.mkdtemp(prefix="haulage-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{shared_folder(spark)}/haulage/{label}-{uuid.uuid4().hex}"


# Folders that the run in progress has written and that go when it is over.
_SCRATCH: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


def stored(df, label: str):
    """Write ``df`` to a fresh shared folder and read it back: cuts lineage and survives executor loss."""
    path = run_folder(df.sparkSession, label)
    _noted(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _noted(path: str) -> None:
    folders = _SCRATCH.get()
    if folders is not None:
        folders.append(path)


def settled(spark: SparkSession, label: str, make: Callable):
    """The frame that ``make()`` returns, stored, after which everything that was stored for it is removed."""
    folders: list[str] = []
    token = _SCRATCH.set(folders)
    try:
        df = make()
        path = run_folder(spark, label)
        df.write.parquet(path)
        schema = df.schema
    finally:
        _SCRATCH.reset(token)
        for folder in folders:
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    _noted(path)
    del df, make
    swept(spark)
    return spark.read.schema(schema).parquet(path)


def swept(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs now: Spark removes them when the driver collects its garbage, which a driver
    with little to do puts off."""
    gc.collect()
    spark._jvm.System.gc()


def spread(df):
    """Deal the rows of a plain scan out to all cores when the scan itself gives fewer tasks than there are cores.

    A file with one row group is one task, which is too few for rows that are costly to parse. A scan with enough
    tasks is left as it is, so nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt_by(df, column: str, tasks: int | None = None):
    """Rows that stand for files or parts, spread over the cluster by name; the number of bytes in them says nothing
    about the work behind them, so the task count is fixed and not left to coalescing."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks or cores, column)
