"""Named drops (``task#table#stamp...json``) as a data source of their own: batch, stream and writer.

    register_drops(spark)
    spark.read.format("named_drops").option("table", "orders,users").load(folder)
    spark.readStream.format("named_drops").option("maxFiles", 8).load(folder)
    lines.write.format("named_drops").option("task", "bid").option("table", "orders").option("stamp", 7).mode("append").save(folder)

Rows are lines with the parts of the name: ``value, task, table, stamp, file``; :func:`parsed_drops` turns
lines into columns on the JVM side. Files are chosen by their names alone (``task``, ``table``, ``since``,
``until``), so others are never opened; large files are read in byte ranges that end at line ends.

A stream's offset is the set of names it has read above a low-water mark of stamps: names in the end offset
and not in the start offset are a batch, so a file that arrives with an older stamp than one already read is
still found. The mark follows the newest stamp at a distance of ``late`` (by default it stays, and nothing
is ever left behind); ``archive`` moves finished files away, which also keeps the offset short. ``maxFiles``
bounds a batch once the stream is under way; a run that has just started, or one with ``availableNow``, takes
all files at hand as one batch, as Spark does for sources without admission control.

A writer's task writes its own file under a hidden name and renames it when it is complete: names follow
from the write and the partition, so an attempt that is repeated replaces its own file only, and the driver
renames nothing. An aborted write removes what it had finished.

Paths are local, or URIs of a file system that pyarrow knows; names are taken apart at ``#``, files with
fewer than three parts have a null table and stamp. A blank line is no row.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from noticeloom.sources.files import CORRUPT, open_folder

LINES = "value string, task string, table string, stamp bigint, file string"
SPLIT_BYTES = 64 << 20
CHUNK_BYTES = 4 << 20
MAX_FILES = 8
LOW_WATER = 8  # files waiting below which more are written


def name_parts(name: str) -> tuple[str | None, str | None, int | None]:
    """Task, table and stamp of a file name; the stamp is the number its third part begins with."""
    parts = name.removesuffix(".json").split("#")
    digits = parts[2].split("-")[0] if len(parts) > 2 else ""
    return parts[0], parts[1] if len(parts) > 1 else None, int(digits) if digits.isdigit() else None


class Wanted:
    """Which names the options ask for."""

    def __init__(self, options):
        def listed(key):
            return set(options[key].split(",")) if options.get(key) else None

        self.tasks, self.tables = listed("task"), listed("table")
        self.since, self.until = (int(options[k]) if options.get(k) else None for k in ("since", "until"))

    def __call__(self, name: str) -> bool:
        task, table, stamp = name_parts(name)
        return (
            (self.tasks is None or task in self.tasks)
            and (self.tables is None or table in self.tables)
            and (self.since is None or (stamp is not None and stamp >= self.since))
            and (self.until is None or (stamp is not None and stamp <= self.until))
        )


@dataclass
class Range(InputPartition):
    """The lines of a file that begin in ``[start, stop)``."""

    name: str
    start: int
    stop: int


class Folder:
    """The drops of a folder and their lines."""

    def __init__(self, options):
        self.path = options["path"]
        self.wanted = Wanted(options)
        self.split = int(options.get("splitBytes", SPLIT_BYTES))

    def files(self) -> dict[str, int]:
        """Sizes of the wanted files by name."""
        system, path = open_folder(self.path)
        found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
        named = ((f.base_name, f.size) for f in found if f.type == fs.FileType.File and f.base_name.endswith(".json") and f.base_name[0] not in "._")
        return {name: size for name, size in sorted(named) if self.wanted(name)}

    def ranges(self, sizes: dict[str, int]) -> list[Range]:
        cut = ((name, at, min(at + self.split, size)) for name, size in sizes.items() for at in range(0, size, self.split))
        return [Range(*c) for c in cut]

    def lines(self, part: Range) -> Iterator[pa.RecordBatch]:
        system, path = open_folder(self.path)
        task, table, stamp = name_parts(part.name)
        with system.open_input_file(f"{path}/{part.name}") as file:
            for lines in _lines_between(file, part.start, part.stop):
                rows = [line.rstrip(b"\r\n").decode("utf-8", "replace") for line in lines if line.strip()]
                if rows:
                    n = len(rows)
                    columns = [
                        pa.array(rows, pa.string()), pa.array([task] * n, pa.string()), pa.array([table] * n, pa.string()),
                        pa.array([stamp] * n, pa.int64()), pa.array([part.name] * n, pa.string()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["value", "task", "table", "stamp", "file"])


def _lines_between(file, start: int, stop: int) -> Iterator[list[bytes]]:
    """Lists of the lines that begin in ``[start, stop)``; the last one is read to its end."""
    buffer = io.BufferedReader(file, CHUNK_BYTES)
    if start > 0:  # a line begins at ``start`` only if a line end stands before it
        buffer.seek(start - 1)
        buffer.readline()
    at, held, size = buffer.tell(), [], 0
    while at < stop and (line := buffer.readline()):
        at += len(line)
        size += len(line)
        held.append(line)
        if size > CHUNK_BYTES:
            yield held
            held, size = [], 0
    yield held


class DropReader(DataSourceReader):
    def __init__(self, options):
        self.folder = Folder(options)

    def partitions(self) -> list[Range]:
        return self.folder.ranges(self.folder.files()) or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.folder.lines(partition) if partition.name else iter(())


class DropStreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.folder = Folder(options)
        self.most = int(options.get("maxFiles", MAX_FILES))
        self.late = int(options["late"]) if options.get("late") else None
        self.archive = options.get("archive")
        self.at: dict | None = None  # the end of the last planned batch

    def initialOffset(self) -> dict:
        return {"low": -1, "seen": []}

    def latestOffset(self) -> dict:
        present = self.folder.files()
        if self.at is None:  # where the stream stands is not known yet, so all that is there is the offset
            return {"low": -1, "seen": sorted(present)}
        seen = set(self.at["seen"])
        fresh = [n for n in present if n not in seen and (name_parts(n)[2] or 0) > self.at["low"]]
        taken = sorted(fresh, key=lambda n: (name_parts(n)[2] or 0, n))[: self.most]
        if not taken:
            return self.at
        low = self.at["low"]
        if self.late is not None:
            stamps = [name_parts(n)[2] or 0 for n in taken]
            low = max(low, min(max(stamps) - self.late, min(stamps) - 1))
        kept = {n for n in seen if n in present and (name_parts(n)[2] or 0) > low}
        self.at = {"low": low, "seen": sorted(kept | set(taken))}
        return self.at

    def partitions(self, start: dict, end: dict) -> list[Range]:
        if self.at is None:
            self.at = end
        before, present = set(start["seen"]), self.folder.files()
        names = [n for n in end["seen"] if n not in before and (name_parts(n)[2] or 0) > start["low"]]
        gone = [n for n in names if n not in present]
        if gone:
            raise FileNotFoundError(f"{len(gone)} files of a batch are gone, the first is {gone[0]}")
        return self.folder.ranges({n: present[n] for n in names})

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        return self.folder.lines(partition)

    def commit(self, end: dict) -> None:
        if not self.archive:
            return
        system, path = open_folder(self.folder.path)
        _, done = open_folder(self.archive)
        system.create_dir(done)
        for name in set(end["seen"]) & set(self.folder.files()):  # a batch's files, plus those of a run that stopped before
            system.move(f"{path}/{name}", f"{done}/{name}")


@dataclass
class Written(WriterCommitMessage):
    name: str | None


class DropWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path, self.write_id = options["path"], uuid.uuid4().hex
        self.prefix = f"{options['task']}#{options['table']}#{int(options['stamp'])}-{self.write_id}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """The lines' bytes as they come from the JVM: no row or string of Python is made of them."""
        from pyspark import TaskContext

        context = TaskContext.get()
        system, path = open_folder(self.path)
        name = f"{self.prefix}-{context.partitionId():05d}.json"
        hidden = f"{path}/.{name}-{context.taskAttemptId()}"
        first = next((batch for batch in iterator if batch.num_rows), None)
        if first is None:
            return Written(None)
        with system.open_output_stream(hidden) as file:
            for batch in chain([first], iterator):
                for line in batch.column(0):
                    file.write(line.as_buffer())
                    file.write(b"\n")
        system.move(hidden, f"{path}/{name}")
        return Written(name)

    def abort(self, messages) -> None:
        system, path = open_folder(self.path)
        for name in [m.name for m in messages if m is not None and m.name]:
            system.delete_file(f"{path}/{name}")


class NamedDrops(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_drops"

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> DropReader:
        return DropReader(self.options)

    def streamReader(self, schema) -> DropStreamReader:
        return DropStreamReader(self.options)

    def writer(self, schema, overwrite: bool) -> DropWriter:
        if overwrite:
            raise ValueError("drops are only added to a folder")
        system, path = open_folder(self.options["path"])
        system.create_dir(path)
        return DropWriter(self.options)


def register_drops(spark: SparkSession) -> None:
    spark.dataSource.register(NamedDrops)


def parsed_drops(lines: DataFrame, schema: str | StructType) -> DataFrame:
    """Columns of the lines' JSON by a given schema, with task and table; a broken line keeps its text in ``_corrupt_record``."""
    fields = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    wide = StructType([f for f in fields if f.name != CORRUPT]).add(CORRUPT, "string")
    record = F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return lines.select(record.alias("_record"), "task", "table").select("_record.*", "task", "table")


def read_drops(spark: SparkSession, folder: str, schema: str | StructType, **options) -> DataFrame:
    """Rows of the drops whose names the options ask for."""
    register_drops(spark)
    return parsed_drops(spark.read.format("named_drops").options(**options).load(folder), schema)


def drop_stream(spark: SparkSession, folder: str, schema: str | StructType, **options) -> DataFrame:
    """Rows of the drops as they arrive."""
    register_drops(spark)
    return parsed_drops(spark.readStream.format("named_drops").options(**options).load(folder), schema)


def write_drops(df: DataFrame, folder: str, task: str, table: str, stamp: int) -> None:
    """Rows as JSON lines in files named ``task#table#stamp-...``, one per partition, written by the executors."""
    register_drops(df.sparkSession)
    lines = df.select(F.to_json(F.struct("*")).alias("value"))
    lines.write.format("named_drops").options(task=task, table=table, stamp=stamp).mode("append").save(folder)


def waiting(folder: str) -> int:
    """Files of a folder that no archiving stream has finished yet."""
    return len(Folder({"path": folder}).files())


def top_up(queue: DataFrame, source: DataFrame, folder: str, task: str, table: str, stamp: int, low: int = LOW_WATER, key: str = "id") -> bool:
    """Source rows of the queued keys written as a drop, if fewer than ``low`` files wait; tells whether it did.

    The queue is any frame of keys, such as a micro-batch; a caller keeps it until it has been written.
    """
    if waiting(folder) >= low:
        return False
    write_drops(source.join(queue.select(key).distinct(), key, "left_semi"), folder, task, table, stamp)
    return True
