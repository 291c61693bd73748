"""File-drop streams: documents, notice loads and category tags.

Micro-batches are bounded by files per trigger, the checkpoint replaces a work queue, and every sink
is keyed by the checkpoint and the batch id, so a replayed batch replaces its own output, or finds it
published, and no other run's is touched.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from noticeloom.operators import notices as N
from noticeloom.plans.notice_load import load_notices
from noticeloom.plans.tagging import tag_notices
from noticeloom.session import shared_copy
from noticeloom.sources.commits import commit, read_all, retrying, with_gone
from noticeloom.sources.files import CORRUPT
from noticeloom.sources.tables import append_batch, run_of

FILES_PER_TRIGGER = 8
TRIES = 2  # of a load, before its rows are set aside
WINNERS = "final_winning_bidder"
NOWHERE = "quarantine"
REASON_CHARS = 500  # of an error message kept beside the rows it stopped
log = logging.getLogger(__name__)


def sample_schema(spark: SparkSession, path: str) -> StructType:
    """Schema of a static sample, for the stream that follows."""
    return spark.read.json(path).schema


def document_stream(
    spark: SparkSession, folder: str, schema: StructType | str, max_files: int = FILES_PER_TRIGGER,
    latest_first: bool = True, archive: str | None = None,
) -> DataFrame:
    """JSON lines of a folder as they arrive; finished files go to ``archive`` when one is given."""
    reader = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files)
        .option("latestFirst", latest_first)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(folder)


def append_stream(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """All available rows appended as parquet, then stop."""
    return (
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )


def per_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """``work`` on every available micro-batch, then stop."""
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_stream(stream: DataFrame, folder: str, key: list[str], order: str, checkpoint: str) -> StreamingQuery:
    """Rows upserted by key; within a batch the last by ``order`` stays."""

    def work(batch: DataFrame, batch_id: int) -> None:
        others = [c for c in batch.columns if c not in key]
        last = batch.groupBy(*key).agg(F.max_by(F.struct(*others), order).alias("_r")).select(*key, "_r.*")
        append_batch(last, folder, batch_id, run=run_of(checkpoint))

    return per_batch(stream, work, checkpoint)


def notice_stream(
    stream: DataFrame, store: str, gold: dict[str, DataFrame], with_spans: Callable[[DataFrame], DataFrame],
    as_of_year: int, checkpoint: str, origins: list[str] | None = None,
) -> StreamingQuery:
    """Rows of notice drops with the ``table`` they come from, loaded into the target tables of a store.

    Parents and winners of an origin table are published as one load (:mod:`noticeloom.sources.commits`), so
    readers see both or neither, and a replayed batch whose load is published is not written again. Broken
    lines and rows of unknown tables go to ``quarantine``. An origin whose load keeps failing, one without
    gold included, is logged and its rows go to ``failed`` with the reason; the other origins and the stream
    go on. A batch is stored once by table in the shared folder and removed when it is done.
    """
    known = origins or [r[0] for r in N.ROUTES]
    run = run_of(checkpoint)

    def tables_of(own: DataFrame, origin: str) -> dict[str, DataFrame]:
        target, task = N.route_of(origin)
        parents, winners = load_notices(own, origin, gold[task], with_spans, as_of_year)
        tables = {target: parents}
        if winners is not None:
            keys = own.select(F.lit(origin).alias("table_name"), F.col("id").alias("announcement_id"))
            tables[WINNERS] = with_gone(winners, ["table_name", "announcement_id"], keys)
        return tables

    def work(batch: DataFrame, batch_id: int) -> None:
        spark, load = batch.sparkSession, f"{run}:{batch_id}"
        readable = F.col(CORRUPT).isNull() & F.col("table").isin(known) & F.col("id").isNotNull()
        origin = F.when(F.coalesce(readable, F.lit(False)), F.col("table")).otherwise(F.lit(NOWHERE))
        with shared_copy(batch.withColumn("_origin", origin), "notices", "_origin") as rows:
            present = [r["_origin"] for r in rows.select("_origin").distinct().collect()]  # at most the known tables and one
            for name in sorted(present):
                own = rows.filter(F.col("_origin") == name).drop("_origin")
                if name == NOWHERE:
                    commit(spark, store, f"{load}:{name}", {"quarantine": own})
                    continue
                own = own.drop(CORRUPT, "task", "table")

                def failed(error: Exception, own: DataFrame = own, name: str = name) -> None:
                    log.error("batch %s of %s could not be loaded", batch_id, name, exc_info=error)
                    reason = f"{type(error).__name__}: {error}"[:REASON_CHARS]
                    commit(spark, store, f"{load}:{name}:failed", {f"failed/{name}": own.withColumn("reason", F.lit(reason))})

                def publish(own: DataFrame = own, name: str = name) -> None:
                    commit(spark, store, f"{load}:{name}", tables_of(own, name))

                retrying(publish, TRIES, failed, spark)

    return per_batch(stream, work, checkpoint)


def registry_stream(stream: DataFrame, store: str, checkpoint: str, key: str = "md5", keep: str = "7 days", table: str = "registry") -> StreamingQuery:
    """Rows whose key has not been seen before, published to a table of the store; one row per key stays.

    Keys of the last ``keep`` are held in the stream's state, so most repeats never reach the table; state
    expires by the time of arrival, which no row misses however old its own times are. Keys that come back
    after that are looked up among the keys of the table, so the result is that of one batch over all rows.
    A null key counts as one key. Of repeats within a micro-batch any one stays.
    """
    run = run_of(checkpoint)
    arrived = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", keep)
    first = arrived.dropDuplicatesWithinWatermark([key]).drop("_arrived")

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        known = read_all(spark, store, table)
        fresh = batch
        if known is not None:
            seen = known.select(F.col(key).alias("_seen")).distinct()
            fresh = batch.join(seen, F.col(key).eqNullSafe(F.col("_seen")), "left_anti")
        commit(spark, store, f"{run}:{batch_id}", {table: fresh})

    return per_batch(first, work, checkpoint)


def tag_stream(
    stream: DataFrame, source: DataFrame, gold: DataFrame, with_cats: Callable[[DataFrame], DataFrame],
    folder: str, checkpoint: str,
) -> StreamingQuery:
    """Queued (table, id) rows to category updates, kept by key and batch."""

    def work(batch: DataFrame, batch_id: int) -> None:
        append_batch(tag_notices(batch, source, gold, with_cats), folder, batch_id, run=run_of(checkpoint))

    return per_batch(stream, work, checkpoint)
