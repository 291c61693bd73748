"""Queries of the streaming jobs: tables dropped as files, streamed, and read from the sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.functions import text as T
from noticeloom.operators.annotate import annotate, term_matcher
from noticeloom.operators.spans import phrase_spans
from noticeloom.plans.catalog import query, table
from noticeloom.plans.data import GOLD, documents
from noticeloom.plans.q_curate import category_scores
from noticeloom.plans.q_load import NOTICE_TERMS, NOTICES, _notices, _us
from noticeloom.plans.q_spans import GOLD_SQL, rows_out
from noticeloom.session import few_rows, fresh_folder
from noticeloom.sources.commits import read_all, read_current
from noticeloom.sources.drops import drop_stream, write_drops
from noticeloom.sources.files import CORRUPT
from noticeloom.sources.tables import append_batch, read_latest
from noticeloom.streaming import jobs as J


def several(df: DataFrame, least: int = 4) -> DataFrame:
    """Rows of a table as they are read, where that makes ``least`` files or more; a small table is dealt over so many.

    So the rows of a file grow with a task of the scan and not with the table.
    """
    return df if df.rdd.getNumPartitions() >= least else df.repartition(least)


@query("str1_document_stream", "SELECT doc_id, lang, md5(text) AS md5 FROM documents")
def str1(spark, folder):
    drops, out = fresh_folder(spark, "in"), fresh_folder(spark, "out")
    several(table(spark, folder, "documents").select("doc_id", "lang", "text")).write.json(drops)
    stream = J.document_stream(spark, drops, J.sample_schema(spark, drops), max_files=2)
    J.append_stream(stream, out, fresh_folder(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(out).select("doc_id", "lang", F.md5("text").alias("md5"))


@query("str2_annotated_stream", f'{GOLD_SQL} SELECT doc_id, "start", "end", label FROM spans')
def str2(spark, folder):
    drops, out = fresh_folder(spark, "in"), fresh_folder(spark, "out")
    several(table(spark, folder, "documents").select("doc_id", "text")).write.json(drops)
    stream = annotate(J.document_stream(spark, drops, "doc_id bigint, text string"), term_matcher(GOLD))
    J.append_stream(stream.select("doc_id", "label"), out, fresh_folder(spark, "checkpoint")).awaitTermination()
    return rows_out(spark.read.parquet(out), "doc_id")


def _notice_stream(spark, folder) -> str:
    drops, out = fresh_folder(spark, "in"), fresh_folder(spark, "out")
    notices = _notices(spark, folder)
    write_drops(notices, drops, "bid", "test_tender_bid_result", 100)
    write_drops(notices.filter("title LIKE 'https%'"), drops, "bid", "table_nobody_knows", 300)
    gold = few_rows(spark, [], "md5 string, label array<struct<start:int,end:int,label:string>>")
    stream = drop_stream(spark, drops, notices.schema)
    query_ = J.notice_stream(
        stream, out, {"bid": gold}, lambda df: df.withColumn("label", phrase_spans(F.col("text"), NOTICE_TERMS)), 2024,
        fresh_folder(spark, "checkpoint"),
    )
    query_.awaitTermination()
    return out


@query(
    "str3_notice_stream",
    f"""{NOTICES}, a AS (SELECT page_id, string_agg(val, '_' ORDER BY pos) FILTER (WHERE label = '中标单位') AS winning_bidder FROM v GROUP BY 1)
SELECT p.page_id AS id, coalesce(a.winning_bidder, '') AS winning_bidder, CAST((SELECT count(DISTINCT val) FROM v WHERE v.page_id = p.page_id AND label = '中标单位') AS BIGINT) AS winners FROM pages p LEFT JOIN a USING (page_id)""",
)
def str3(spark, folder):
    out = _notice_stream(spark, folder)
    parents = read_current(spark, out, "final_tender_bid_result", ["id"])
    winners = read_current(spark, out, J.WINNERS, ["table_name", "announcement_id"])
    counts = winners.groupBy(F.col("announcement_id").alias("id")).agg(F.count("*").alias("winners"))
    return parents.select("id", "winning_bidder").join(counts, "id", "left").fillna(0, ["winners"])


@query("str3_quarantine", "SELECT page_id AS id, 'table_nobody_knows' AS \"table\" FROM pages WHERE url LIKE 'https%'")
def str3_quarantine(spark, folder):
    rows = read_all(spark, _notice_stream(spark, folder), "quarantine")
    return rows.select("id", "table")


@query("str4_bounded_batches", "SELECT event_id, event_type FROM events")
def str4(spark, folder):
    """One file per trigger: the checkpoint is the queue."""
    drops, out = fresh_folder(spark, "in"), fresh_folder(spark, "out")
    table(spark, folder, "events").select("event_id", "event_type").repartition(5).write.json(drops)
    stream = J.document_stream(spark, drops, "event_id bigint, event_type string", max_files=1)

    def work(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, out, batch_id)

    J.per_batch(stream, work, fresh_folder(spark, "checkpoint")).awaitTermination()
    return read_latest(spark, out, ["event_id"])


@query(
    "str5_tag_stream",
    """SELECT 'final_tender_bid' AS "table", doc_id AS id, CASE WHEN lang = 'en' THEN '人工' ELSE c END AS classify_type FROM (
SELECT doc_id, any_value(lang) AS lang, arg_max(c, (s, -i)) AS c FROM (SELECT doc_id, lang, c, i, CAST(('0x' || substring(md5(c || source), 1, 2)) AS INTEGER) AS s FROM documents, (VALUES ('货物', 0), ('工程', 1), ('服务', 2)) t(c, i)) GROUP BY 1)""",
)
def str5(spark, folder):
    drops, out = fresh_folder(spark, "in"), fresh_folder(spark, "out")
    docs = documents(spark, folder).select(
        F.lit("final_tender_bid").alias("table"), F.col("doc_id").alias("id"), "source", "lang",
        F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("text")).alias("detail_content"),
    )
    gold = docs.filter("lang = 'en'").select(T.fingerprint(T.clean_html(F.col("detail_content"))).alias("md5"), F.lit("人工").alias("classify_type"))
    docs.select("table", "id").repartition(4).write.json(drops)
    stream = J.document_stream(spark, drops, "table string, id bigint", max_files=2)
    J.tag_stream(stream, docs, gold, category_scores, out, fresh_folder(spark, "checkpoint")).awaitTermination()
    return read_latest(spark, out, ["table", "id"])


@query(
    "str6_upsert_stream",
    "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1",
)
def str6(spark, folder):
    """Events in time order, a third at a time, each a new run from the checkpoint: the last event of each user stays."""
    drops, out, checkpoint = (fresh_folder(spark, name) for name in ("in", "out", "checkpoint"))
    events = table(spark, folder, "events").select("user_id", "event_id", "event_type", _us("ts").alias("at"))
    cuts = events.select(F.percentile_approx("at", [1 / 3, 2 / 3]).alias("c")).scalar()
    third = F.when(F.col("at") < F.get(cuts, F.lit(0)), 0).when(F.col("at") < F.get(cuts, F.lit(1)), 1).otherwise(2)
    parts = events.withColumn("third", third)
    for i in range(3):
        write_drops(parts.filter(F.col("third") == i).drop("third"), drops, "user", "events", 100 + i)
        stream = drop_stream(spark, drops, "user_id bigint, event_id bigint, event_type string, at bigint").drop("task", "table", CORRUPT)
        J.upsert_stream(stream.withColumn("place", F.struct("at", "event_id")), out, ["user_id"], "place", checkpoint).awaitTermination()
    return read_latest(spark, out, ["user_id"]).select("user_id", "event_id", "event_type")


@query("ded1_registry_stream", "SELECT md5(text) AS md5, CAST(any_value(length(text)) AS INTEGER) AS n_chars FROM documents WHERE text IS NOT NULL GROUP BY 1")
def ded1_stream(spark, folder):
    """All documents in two runs of which the second brings the first one's rows again: each text enters the registry once."""
    drops, out, checkpoint = (fresh_folder(spark, name) for name in ("in", "out", "checkpoint"))
    docs = documents(spark, folder).filter("text IS NOT NULL").select("doc_id", F.md5("text").alias("md5"), F.length("text").alias("n_chars"))
    for part in (docs.filter("doc_id % 3 = 0"), docs):
        part.write.mode("append").json(drops)
        stream = J.document_stream(spark, drops, "doc_id bigint, md5 string, n_chars int")
        J.registry_stream(stream, out, checkpoint).awaitTermination()
    return read_all(spark, out, "registry").select("md5", "n_chars")
