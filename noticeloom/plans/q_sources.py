"""Queries of file sources and sinks: data of the given tables written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.operators.curate import combine
from noticeloom.plans.catalog import query, table
from noticeloom.plans.data import GOLD, annotated, documents, quoted
from noticeloom.operators.notices import ROUTES
from noticeloom.plans.q_spans import GOLD_SQL
from noticeloom.session import fresh_folder
from noticeloom.sources import drops as D
from noticeloom.sources import extract as X
from noticeloom.sources import files as S

KEPT = ROUTES[0][0], ROUTES[4][0]
ORDER_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
ORDERS = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"


WANTED_IDS = list(range(1, 1500, 7))


def _orders(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query(
    "src1_src2_documents_json",
    f"""{GOLD_SQL}, c AS (SELECT doc_id, count(*) AS n, sum("start") AS s FROM spans GROUP BY 1)
SELECT CAST(doc_id AS VARCHAR) AS id, md5(text) AS md5, source, CAST(NULL AS VARCHAR) AS task, CAST(coalesce(c.n, 0) AS INTEGER) AS spans, CAST(coalesce(c.s, 0) AS INTEGER) AS starts FROM documents LEFT JOIN c USING (doc_id)""",
)
def src1(spark, folder):
    out = fresh_folder(spark, "documents")
    docs = annotated(spark, folder, GOLD, "source").withColumns({"id": F.col("doc_id").cast("string"), "task": F.lit(None).cast("string")})
    S.write_documents(docs.drop("doc_id"), out)
    good, _ = S.split_corrupt(S.read_documents(spark, out))
    starts = F.aggregate("label", F.lit(0), lambda acc, s: acc + s["start"])
    return good.select("id", F.md5("text").alias("md5"), "source", "task", F.size("label").alias("spans"), starts.alias("starts"))


@query(
    "src3_text_lines",
    r"""SELECT md5(line) AS line_md5, count(*) AS n FROM (SELECT regexp_replace(unnest(string_split(replace(text, chr(13), chr(10)), chr(10))), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS line FROM documents) WHERE line <> '' GROUP BY 1""",
)
def src3(spark, folder):
    out = fresh_folder(spark, "lines")
    S.write_lines(documents(spark, folder), "text", out)
    return S.read_lines(spark, out).groupBy(F.md5("line").alias("line_md5")).agg(F.count("*").alias("n"))


@query("src4_src5_csv", ORDER_SQL)
def src4(spark, folder):
    out = fresh_folder(spark, "csv")
    S.write_delimited(_orders(spark, folder), out)
    return S.read_delimited(spark, out, ORDERS)


@query("src4_tab_separated", "SELECT doc_id, lang, md5(text) AS md5 FROM documents")
def src4_tabs(spark, folder):
    out = fresh_folder(spark, "tsv")
    rows = documents(spark, folder).select("doc_id", "lang", F.base64(F.encode("text", "UTF-8")).alias("text"))
    rows.write.option("header", True).option("sep", "\t").csv(out)
    back = S.read_delimited(spark, out, "doc_id bigint, lang string, text string", "\t", multi_line=True)
    return back.select("doc_id", "lang", F.md5(F.unbase64("text")).alias("md5"))


@query(
    "src6_select_sql",
    "SELECT o_orderpriority, count(*) AS n, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1",
)
def src6(spark, folder):
    tables = {"o": table(spark, folder, "orders"), "l": table(spark, folder, "lineitem")}
    return X.select_sql(
        spark,
        "SELECT o_orderpriority, count(*) AS n, sum(cast(l_quantity AS bigint)) AS quantity FROM {o} JOIN {l} ON l_orderkey = o_orderkey GROUP BY 1",
        tables,
    )


@query("src7_rows_by_id", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def src7(spark, folder):
    from noticeloom.operators.lookup import listed

    wanted = table(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return listed(table(spark, folder, "orders").select("o_orderkey", "o_custkey"), wanted, "o_custkey")


@query("src7_rows_of_id_list", f"SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN ({', '.join(map(str, WANTED_IDS))})")
def src7_list(spark, folder):
    """An id list as a user gives it."""
    return X.rows_by_id(spark, table(spark, folder, "orders").select("o_orderkey", "o_custkey"), WANTED_IDS, "o_custkey")


@query(
    "src11_partitioned_drops",
    f"""SELECT event_id, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS dt, CASE WHEN event_type = 'click' THEN {quoted(KEPT[0])} ELSE {quoted(KEPT[1])} END AS "table" FROM events WHERE event_type IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-15'""",
)
def src11(spark, folder):
    base = fresh_folder(spark, "drops")
    events = table(spark, folder, "events").withColumn("dt", F.date_format("ts", "yyyyMMdd"))
    kinds = {KEPT[0]: ["click"], KEPT[1]: ["view"], "not_allowed": ["error", "signup", "purchase"]}
    for name, kind in kinds.items():
        events.filter(F.col("event_type").isin(kind)).select("event_id", "value", "dt").write.partitionBy("dt").json(f"{base}/{name}")
    rows = S.read_partitioned_drops(spark, base, list(KEPT), "event_id bigint, value double")
    good, _ = S.split_corrupt(rows.filter("dt >= 20240115"))
    return good.select("event_id", "dt", "table")


@query(
    "src12_named_drops",
    "SELECT event_id, event_type, CASE WHEN event_type = 'click' THEN 'bid' ELSE 'tender' END AS task, CASE WHEN event_type = 'click' THEN 'test_tender_bid_result' ELSE 'test_tender_bid' END AS \"table\" FROM events",
)
def src12(spark, folder):
    base = fresh_folder(spark, "named")
    events = table(spark, folder, "events").select("event_id", "event_type")
    D.write_drops(events.filter("event_type = 'click'"), base, "bid", "test_tender_bid_result", 100)
    D.write_drops(events.filter("event_type <> 'click'"), base, "tender", "test_tender_bid", 200)
    good, _ = S.split_corrupt(D.read_drops(spark, base, "event_id bigint, event_type string"))
    return good


@query("src12_drops_by_name", "SELECT event_id, 'click' AS \"table\" FROM events WHERE event_type = 'click' AND ts >= TIMESTAMP '2024-01-15'")
def src12_by_name(spark, folder):
    """One table's drops from a stamp on: the other files are not opened."""
    base = fresh_folder(spark, "named")
    events = table(spark, folder, "events").select("event_id", "event_type", (F.col("ts") >= "2024-01-15").alias("late"))
    for kind, name in (("event_type = 'click'", "click"), ("event_type <> 'click'", "other")):
        for late, stamp in ((False, 100), (True, 200)):
            D.write_drops(events.filter(kind).filter(F.col("late") == late).select("event_id"), base, "user", name, stamp)
    good, _ = S.split_corrupt(D.read_drops(spark, base, "event_id bigint", table="click", since=150))
    return good.select("event_id", "table")


@query("src11_array_records", "SELECT conv_id, turn, md5(text) AS md5 FROM conversations")
def src11_records(spark, folder):
    turns = table(spark, folder, "conversations")
    packed = turns.select(F.to_json(F.array(F.struct("conv_id", "turn", "text"))).alias("records"))
    rows = S.array_records(packed, "records", "conv_id:bigint,turn:bigint,text:string")
    return rows.select("conv_id", "turn", F.md5("text").alias("md5"))


def _page_files(spark, folder) -> str:
    """Each page as a file of its own, named by its number, its text as the only line."""
    out = fresh_folder(spark, "pages")
    line = F.concat(F.coalesce(F.translate("html", "\n\r", "  "), F.lit("")), F.lit("\n"))
    rows = table(spark, folder, "pages").select(F.concat("page_id", F.lit(".txt")).alias("name"), line.alias("text"))
    S.write_whole_files(rows.repartition("name"), out)
    return out


def _page_id():
    return F.substring_index("name", ".", 1).cast("bigint").alias("page_id")


PAGE_FILES = "SELECT page_id, translate(html, chr(10) || chr(13), '  ') || chr(10) AS t FROM pages"


@query("src13_pages_as_files", f"SELECT page_id, md5(t) AS md5 FROM ({PAGE_FILES})")
def src13(spark, folder):
    files = S.read_whole_files(spark, _page_files(spark, folder))
    return files.select(_page_id(), F.md5("text").alias("md5"))


@query("src14_file_sizes", f"SELECT page_id, CAST(strlen(t) AS BIGINT) AS size FROM ({PAGE_FILES})")
def src14(spark, folder):
    sizes = S.file_sizes(spark, _page_files(spark, folder))
    return sizes.select(_page_id(), "size")


@query("src14_size_summary", f"SELECT CAST(sum(strlen(t)) AS BIGINT) AS total, CAST(max(strlen(t)) AS BIGINT) AS largest FROM ({PAGE_FILES})")
def src14_summary(spark, folder):
    return S.size_summary(S.file_sizes(spark, _page_files(spark, folder)))


def _posts(spark, folder) -> DataFrame:
    """Documents as posts, their lines as comments."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("id"), x.alias("body"), F.length(x).alias("score")))
    return documents(spark, folder).select("doc_id", F.col("source").alias("subreddit"), F.col("n_chars").alias("score"), lines.alias("comments"))


@query("src15_posts", "SELECT doc_id, source AS subreddit, n_chars AS score FROM documents")
def src15(spark, folder):
    return S.posts(_posts(spark, folder))


@query(
    "src15_comments",
    "SELECT doc_id AS post_id, CAST(i AS INTEGER) AS id, nullif(x, '') AS body, CAST(length(x) AS INTEGER) AS score FROM (SELECT doc_id, unnest(p) AS x, unnest(range(len(p))) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents))",
)
def src15_comments(spark, folder):
    return S.post_comments(_posts(spark, folder), "doc_id")


@query(
    "src16_combine_datasets",
    "SELECT doc_id, lang, NULL::BIGINT AS item_id, md5(text) AS md5 FROM documents UNION ALL SELECT NULL, NULL, item_id, md5(text) FROM benchmark",
)
def src16(spark, folder):
    both = combine([documents(spark, folder).select("doc_id", "lang", "text"), table(spark, folder, "benchmark")])
    return both.select("doc_id", "lang", "item_id", F.md5("text").alias("md5"))


@query(
    "src18_combine_files",
    "SELECT o_orderkey AS \"order key\", o_orderstatus AS status, NULL::VARCHAR AS priority FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'F'",
)
def src18(spark, folder):
    """Two files whose headers differ as spreadsheet exports do, read back and put together."""
    orders = table(spark, folder, "orders")
    first = orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("order_ - key"), F.col("o_orderstatus").alias("status_ - "))
    second = orders.filter("o_orderstatus <> 'F'").select(
        F.col("o_orderkey").alias("order key"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("_ - priority")
    )
    back = []
    for name, df in (("first", first), ("second", second)):
        out = fresh_folder(spark, name)
        S.write_delimited(df, out)
        back.append(S.read_delimited(spark, out, df.schema))
    return S.combine_files(back)


@query("ext4_written_batches", "SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 2500 AS batch FROM events")
def ext4_written(spark, folder):
    out = fresh_folder(spark, "batches")
    events = table(spark, folder, "events").select("event_id", "ts")
    X.write_batches(X.in_batches(events, ["ts", "event_id"], 2500), out)
    back = spark.read.schema("event_id bigint, batch bigint").json(out)
    return back.select("event_id", "batch")


