"""Session construction and lineage cutting."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "weftline", master: str | None = None, hive: bool = False, **conf: str) -> SparkSession:
    """A session with adaptive execution on and UTC as its time zone.

    Any keyword given in ``conf`` (dots written as double underscores) wins
    over the defaults below; a cluster's own settings are left alone.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, value in (defaults | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    if hive:
        builder = builder.enableHiveSupport()
    return builder.getOrCreate()


def _checkpoints(spark: SparkSession) -> str:
    """The folder of checkpoints, which all executors share, set if it is not yet."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local[") and context.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="weftline-checkpoint-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and drop its lineage.

    The folder is the session's ``spark.checkpoint.dir``. Only a local master
    may go without one; it then gets a temporary folder, which goes when the
    program ends.
    """
    _checkpoints(df.sparkSession)
    return df.checkpoint()


def released(spark: SparkSession) -> None:
    """Lets the driver find what nothing refers to any more, so that its shuffle files go; else they stay until the driver's memory fills."""
    gc.collect()
    spark.sparkContext._jvm.java.lang.System.gc()


def shared_folder(spark: SparkSession) -> str:
    """The path of a new folder in the shared checkpoint folder, for tables that a job writes and reads again."""
    return f"{_checkpoints(spark)}/written-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if it has fewer partitions than there are cores: a small input then, whose shuffle costs little. A large one stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
