"""Loads of several tables that readers see whole or not at all.

A load writes the rows of each table to a folder of its own attempt and then publishes one manifest, a small
file that names these folders. The manifests are numbered; a number is taken by a rename that fails if
another load took it first. Readers look at folders of published loads only, so a load that stops between two
tables has not happened. A load's name says what it loads (a stream's run and batch, say): a name that is
published already is not written again, so a replayed batch changes nothing.

Rows of a key belong to the newest load that brings the key, by the number of its manifest. :func:`compact`
replaces all published loads of a table by their current rows. The driver reads one small row per load.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from noticeloom.session import few_rows

LOG = "commits"
MANIFEST = "load string, base boolean, tables map<string,string>"


@dataclass(frozen=True)
class Commit:
    number: int
    load: str
    base: bool
    tables: dict[str, str]  # table to the folder of its rows, below the store


class _Files:
    """The store's file system, through the session."""

    def __init__(self, spark: SparkSession, store: str):
        self.fs = spark._jvm.org.apache.hadoop.fs
        conf = spark._jsc.hadoopConfiguration()
        self.system = self.path(store).getFileSystem(conf)
        self.context = self.fs.FileContext.getFileContext(self.system.getUri(), conf)
        kind = getattr(self.fs, "Options$Rename")
        self.keep = spark.sparkContext._gateway.new_array(kind, 1)
        self.keep[0] = kind.NONE

    def path(self, name: str):
        return self.fs.Path(name)

    def write(self, name: str, text: str) -> None:
        out = self.system.create(self.path(name), False)
        try:
            out.write(text.encode())
        finally:
            out.close()

    def take_name(self, hidden: str, name: str) -> bool:
        """Rename unless the new name is taken."""
        if self.system.exists(self.path(name)):
            return False
        try:
            self.context.rename(self.path(hidden), self.path(name), self.keep)
        except Exception:
            if self.system.exists(self.path(name)):  # another load was first
                return False
            raise
        return True

    def remove(self, name: str) -> None:
        self.system.delete(self.path(name), True)


def commits(spark: SparkSession, store: str) -> list[Commit]:
    """Published loads in order, from the last compaction on for the tables it covers."""
    files = _Files(spark, store)
    if not files.system.exists(files.path(f"{store}/{LOG}")):
        return []
    rows = spark.read.schema(MANIFEST).json(f"{store}/{LOG}").select("*", F.col("_metadata.file_name").alias("name"))
    return sorted((Commit(int(r["name"].split(".")[0]), r["load"], bool(r["base"]), r["tables"]) for r in rows.collect()), key=lambda c: c.number)


def committed(spark: SparkSession, store: str, load: str) -> bool:
    return any(c.load == load for c in commits(spark, store))


def _publish(spark: SparkSession, store: str, load: str, tables: dict[str, str], base: bool) -> int | None:
    """The manifest's number, or None where the load has been published by someone else."""
    files = _Files(spark, store)
    hidden = f"{store}/{LOG}/.{uuid.uuid4().hex}"
    files.write(hidden, json.dumps({"load": load, "base": base, "tables": tables}))
    while True:
        known = commits(spark, store)
        if any(c.load == load for c in known):
            files.remove(hidden)
            return None
        number = known[-1].number + 1 if known else 1
        if files.take_name(hidden, f"{store}/{LOG}/{number:012d}.json"):
            return number


def with_gone(df: DataFrame, key: list[str] | None = None, keys: DataFrame | None = None) -> DataFrame:
    """Rows of a load; ``keys`` names keys that it replaces even when it brings no row for them."""
    rows = df.withColumn("_gone", F.lit(False))
    if keys is None:
        return rows
    marks = keys.select(*key).distinct().withColumn("_gone", F.lit(True))
    return rows.unionByName(marks, allowMissingColumns=True)


def commit(spark: SparkSession, store: str, load: str, tables: dict[str, DataFrame]) -> bool:
    """Write and publish a load; False where a load of this name has been published before.

    Frames come as they are or from :func:`with_gone`.
    """
    if committed(spark, store, load):
        return False
    attempt = uuid.uuid4().hex
    folders = {name: f"{name}/attempt={attempt}" for name in tables}
    for name, df in tables.items():
        rows = df if "_gone" in df.columns else with_gone(df)
        rows.write.parquet(f"{store}/{folders[name]}")
    return _publish(spark, store, load, folders, False) is not None


def _rows(spark: SparkSession, store: str, table: str) -> DataFrame | None:
    """All rows of the table's published loads with ``_number`` and ``_base``."""
    own = [c for c in commits(spark, store) if table in c.tables]
    bases = [i for i, c in enumerate(own) if c.base]
    own = own[bases[-1] :] if bases else own
    if not own:
        return None
    loads = [{"attempt": c.tables[table].split("=")[1], "_number": c.number, "_base": c.base} for c in own]
    numbers = few_rows(spark, loads, "attempt string, _number long, _base boolean")
    base_path = f"{store}/{table}"
    rows = spark.read.option("basePath", base_path).option("mergeSchema", True).parquet(*[f"{store}/{c.tables[table]}" for c in own])
    return rows.join(F.broadcast(numbers), "attempt").drop("attempt")  # a row per load since the last compaction


def read_all(spark: SparkSession, store: str, table: str) -> DataFrame | None:
    """Every row of the table's published loads, also those a later load replaces; None before the first load."""
    rows = _rows(spark, store, table)
    return None if rows is None else rows.filter("NOT _gone").drop("_gone", "_number", "_base")


def read_current(spark: SparkSession, store: str, table: str, key: list[str]) -> DataFrame | None:
    """For each key the rows of the newest load that brings it; None before the first load.

    The rows of a compacted base are only looked up among the keys of later loads and not grouped.
    """
    rows = _rows(spark, store, table)
    if rows is None:
        return None
    later = rows.filter("NOT _base")
    newest = later.groupBy(*key).agg(F.max("_number").alias("_newest"))
    keys = newest.select("_newest", *[F.col(k).alias(f"_key_{k}") for k in key])
    same: list[Column] = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in key]
    current = later.join(keys, [*same, F.col("_number") == F.col("_newest")], "left_semi")
    kept = rows.filter("_base").join(keys, same, "left_anti")
    return kept.unionByName(current).filter("NOT _gone").drop("_gone", "_number", "_base")


def compact(spark: SparkSession, store: str, table: str, key: list[str]) -> bool:
    """The table's current rows as its base; False where another compaction or load came in between.

    Loads published meanwhile would be older than the base and yet not in it, so the base is only published
    under the number right behind the loads it was read from.
    """
    known = commits(spark, store)
    if not any(table in c.tables for c in known):
        return False
    attempt = uuid.uuid4().hex
    folder = f"{table}/attempt={attempt}"
    with_gone(read_current(spark, store, table, key)).write.parquet(f"{store}/{folder}")
    files = _Files(spark, store)
    hidden = f"{store}/{LOG}/.{attempt}"
    files.write(hidden, json.dumps({"load": f"compact:{attempt}", "base": True, "tables": {table: folder}}))
    if files.take_name(hidden, f"{store}/{LOG}/{known[-1].number + 1:012d}.json"):
        return True
    files.remove(hidden)
    files.remove(f"{store}/{folder}")
    return False


def sweep(spark: SparkSession, store: str, table: str, older_than_ms: int) -> int:
    """Remove folders of attempts that were never published or lie behind the base; their number.

    ``older_than_ms`` (epoch) protects loads that are being written and readers of folders just replaced.
    """
    files = _Files(spark, store)
    own = [c for c in commits(spark, store) if table in c.tables]
    bases = [i for i, c in enumerate(own) if c.base]
    live = {c.tables[table].split("/")[1] for c in (own[bases[-1] :] if bases else own)}
    root = files.path(f"{store}/{table}")
    found = files.system.listStatus(root) if files.system.exists(root) else []
    dead = [f.getPath() for f in found if f.getPath().getName() not in live and f.getModificationTime() < older_than_ms]
    for path in dead:
        files.system.delete(path, True)
    return len(dead)


def retrying(work: Callable[[], None], tries: int, give_up: Callable[[Exception], None], spark: SparkSession) -> None:
    """Run ``work`` up to ``tries`` times; what still fails goes to ``give_up``, unless the session itself has ended."""
    for left in reversed(range(tries)):
        try:
            return work()
        except Exception as error:
            if spark.sparkContext._jsc.sc().isStopped():
                raise
            if not left:
                return give_up(error)
