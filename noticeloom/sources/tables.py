"""Loads into target tables: validity split, replace by key, column update, replay-safe batches."""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.operators.lookup import unknown

BASE = "000000_base"


def split_insertable(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every rule, and the others with the name of the first rule they break."""
    reason = F.coalesce(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    marked = df.withColumn("reason", reason)
    return marked.filter("reason IS NULL").drop("reason"), marked.filter("reason IS NOT NULL")


def replace_by_key(target: DataFrame, batch: DataFrame, key: list[str], keys: DataFrame | None = None) -> DataFrame:
    """Target without the batch's keys plus the batch; ``keys`` may name keys that only go."""
    gone = keys if keys is not None else batch
    return unknown(target, gone, key).unionByName(batch, allowMissingColumns=True)


def update_columns(target: DataFrame, updates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Given columns replaced where an update has a value; the last update of a key by ``order`` column."""
    newest = updates.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("order"))).alias(f"_new_{c}") for c in columns])
    joined = target.join(newest, key, "left")
    return joined.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in columns else F.col(c) for c in target.columns])


def run_of(checkpoint: str) -> str:
    """The id of a stream's runs: restarts from one checkpoint are the same run."""
    return hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def _run_folder(spark: SparkSession, folder: str, run: str) -> str:
    """``run=<number>_<run>``, the number one above all runs that were there when this one began."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in system.listStatus(path)] if system.exists(path) else []
    runs = dict(reversed(n.removeprefix("run=").split("_", 1)) for n in names if n.startswith("run="))
    number = runs.get(run) or f"{max(map(int, runs.values()), default=0) + 1:06d}"
    return f"{folder}/run={number}_{run}"


def append_batch(df: DataFrame, folder: str, batch_id: int, key: list[str] | None = None, keys: DataFrame | None = None, run: str = "load") -> None:
    """Write one batch of a run under its id; a replayed id of the same run overwrites its own folder only.

    ``run`` tells jobs apart whose batches are numbered on their own: give each job, or each stream's
    checkpoint (:func:`run_of`), its own. Later runs are newer, within a run later batches are.
    ``keys`` (with ``key``) names keys the batch replaces even when it brings no row for them.
    """
    rows = df.withColumn("_gone", F.lit(False))
    if keys is not None:
        marks = keys.select(*key).distinct().withColumn("_gone", F.lit(True))
        rows = rows.unionByName(marks, allowMissingColumns=True)
    rows.write.mode("overwrite").parquet(f"{_run_folder(df.sparkSession, folder, run)}/batch_id={batch_id}")


def read_latest(spark: SparkSession, folder: str, key: list[str]) -> DataFrame:
    """Current rows: for each key those of its newest batch, by run and then by batch.

    Rows of a compacted base (the first run) are only looked up among the keys of later batches; the
    base itself has one batch per key and is not grouped.
    """
    rows = spark.read.parquet(folder).withColumn("_based", F.col("run") == F.lit(BASE))
    later = rows.filter("NOT _based")
    newest = later.groupBy(*key).agg(F.max(F.struct("run", "batch_id")).alias("_new"))
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in key]
    keys = newest.select("_new", *[F.col(k).alias(f"_key_{k}") for k in key])
    current = later.join(keys, [*same, F.struct("run", "batch_id") == F.col("_new")], "left_semi")
    kept = rows.filter("_based").join(keys, same, "left_anti")
    return kept.unionByName(current).filter("NOT _gone").drop("_gone", "_based", "run", "batch_id")


def compact(spark: SparkSession, folder: str, key: list[str], new_folder: str) -> None:
    """The current rows as the base of a new folder; readers and jobs move over when it is complete.

    The base is a run of its own, older than any job's, so a job that starts over cannot replace it.
    """
    rows = read_latest(spark, folder, key).withColumn("_gone", F.lit(False))
    rows.write.mode("errorifexists").parquet(f"{new_folder}/run={BASE}/batch_id=0")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
