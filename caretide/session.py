"""Session set-up and the tables written to the shared folder."""

from __future__ import annotations

import os
import pickle
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def build_session(cores: str = "*", app: str = "caretide", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": os.environ.get("CARETIDE_DRIVER_MEMORY", "8g"),
        # the JVM does not compile methods above this size, so wide projections
        # run faster as several small ones
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only where driver and executors are one process may a folder of its own stand
    in; anywhere else a machine-local folder would lose data with the machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_written: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, to be removed by :func:`clear_scratch`."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder, none if it does not exist."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(conf)
    if not system.exists(path):
        return []
    return sorted(entry.getPath().getName() for entry in system.listStatus(path))


def clear_scratch(spark: SparkSession, keep: int = 0) -> None:
    """Remove what this process wrote below the shared folder, but for the first ``keep``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while len(_written) > keep:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def scratch(spark: SparkSession):
    """Removes the tables written inside the block when it ends."""
    before = len(_written)
    try:
        yield
    finally:
        clear_scratch(spark, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Unlike a cached frame it survives the loss of executors, and later jobs
    read it with column pruning and filter pushdown. The caller owns it: it goes
    with :func:`clear_scratch` or the :func:`scratch` block around it.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession, value) -> Callable[[], object]:
    """Send a value to the tasks once; calling the result there gives it back.

    Objects of this package's classes go with their classes, so that workers need
    not have the package.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)
