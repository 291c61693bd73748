"""Session settings and the shared working folder."""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A checkpoint's files go when nothing refers to it any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Recording the Python line of every column call costs more than building the plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

_local_folders: dict[str, str] = {}


def build_session(app: str = "noticeloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators rely on; the cluster's own settings win elsewhere."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def few_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A frame of a few rows as a literal: unlike rows of ``createDataFrame`` it needs no Python on the executors."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def working_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own: on a cluster such a folder
    would be lost with its executor, so an unset value is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="noticeloom-")
    return _local_folders[app]


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new sub-folder path of the working folder; nothing is created or removed."""
    return os.path.join(working_folder(spark), f"{name}-{uuid.uuid4().hex}")


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder that :func:`fresh_folder` named."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def shared_copy(df: DataFrame, name: str, *by: str) -> Iterator[DataFrame]:
    """``df`` written once to the shared folder, in sub-folders of the columns ``by``, and removed at the end."""
    folder = fresh_folder(df.sparkSession, name)
    try:
        df.write.partitionBy(*by).parquet(folder)
        yield df.sparkSession.read.schema(df.schema).parquet(folder)
    finally:
        remove_folder(df.sparkSession, folder)


def pin(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: later passes read the same rows in the same partitions."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(working_folder(df.sparkSession))
    return df.checkpoint()
