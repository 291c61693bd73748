"""Queries of incremental pulls, label columns, loads and the notice flow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.functions import text as T
from noticeloom.functions import values as V
from noticeloom.operators import notices as N
from noticeloom.operators.ranking import distinct_first
from noticeloom.operators.spans import phrase_spans
from noticeloom.plans.catalog import query, spread, table
from noticeloom.plans.data import clean_sql, documents, pages, spans_sql
from noticeloom.plans.notice_load import load_notices
from noticeloom.plans.q_clean import PRICE_SQL, _prices, amount_sql
from noticeloom.plans.q_curate import CAT_NAMES, SCORE_SQL, category_scores
from noticeloom.plans.tagging import tag_notices
from noticeloom.session import few_rows, fresh_folder
from noticeloom.sources import digests as G
from noticeloom.sources import extract as X
from noticeloom.sources import tables as TB


@query("ext1_pull_all", "SELECT event_id, epoch_us(ts) AS us FROM events")
def ext1(spark, folder):
    return X.pull_all(table(spark, folder, "events"), ["ts", "event_id"]).select("event_id", _us("ts").alias("us"))


def _us(column: str) -> F.Column:
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', {column})")


@query("ext2_pull_new", "SELECT event_id, user_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'click' AND ts < TIMESTAMP '2024-01-20')")
def ext2(spark, folder):
    events = table(spark, folder, "events")
    target = events.filter("event_type = 'click' AND ts < TIMESTAMP_NTZ '2024-01-20 00:00:00'")
    return X.pull_new(events, target, "ts").select("event_id", "user_id")


@query("ext2_pull_new_empty_target", "SELECT event_id FROM events")
def ext2_empty(spark, folder):
    events = table(spark, folder, "events")
    return X.pull_new(events, events.filter("event_type = 'none'"), "ts").select("event_id")


@query("ext3_pull_missing", "SELECT o_orderkey AS id, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def ext3(spark, folder):
    source = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), "o_custkey")
    return X.pull_missing(source, table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id")))


def _kept(spark, name: str, loads: list[DataFrame]) -> str:
    """A table stored with its digests, one load after the other."""
    out = fresh_folder(spark, name)
    for number, rows in enumerate(loads):
        G.append(rows, out, ["id"], number)
    return out


@query(
    "ext3_changed_buckets",
    "SELECT o_orderkey AS id, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')",
)
def ext3_changed(spark, folder):
    """The orders a target lacks, from the buckets whose digests differ; the target was loaded in two batches."""
    orders = table(spark, folder, "orders")
    rows = orders.select(F.col("o_orderkey").alias("id"), "o_custkey")
    source = _kept(spark, "source", [rows])
    target = _kept(spark, "target", [rows.filter(orders["o_orderstatus"] == s).select("id") for s in ("F", "O")])
    return G.pull_missing(spark, source, target, "id bigint, o_custkey bigint", ["id"], "id bigint")


@query(
    "agg7_missing_by_digest",
    "SELECT (SELECT count(*) FROM orders) AS origin_count, (SELECT count(*) FROM lineitem) AS target_count, count(*) AS a_not_b FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def agg7_by_digest(spark, folder):
    source = _kept(spark, "origin", [table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))])
    target = _kept(spark, "done", [table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("id"))])
    return G.missing_count(spark, source, target, "id bigint", ["id"])


@query("ext4_batches", "SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 200 AS batch FROM events")
def ext4(spark, folder):
    return X.in_batches(table(spark, folder, "events").select("event_id", "ts"), ["ts", "event_id"], 200).select("event_id", "batch")


@query(
    "ext5_pending_tags",
    "SELECT o_orderkey AS id, 'final_tender_bid' AS \"table\", 'tendercats' AS task FROM orders WHERE o_orderstatus = 'O' AND o_orderkey % 3 > 0 UNION ALL SELECT c_custkey, 'final_tender_bid_result', 'bidcats' FROM customer WHERE c_mktsegment <> 'MACHINERY'",
)
def ext5(spark, folder):
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") != "O", F.lit("服务")).alias("classify_type"),
        F.when(F.col("o_orderkey") % 3 > 0, 1).otherwise(0).alias("is_full_data"),
    )
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("货物")).alias("classify_type"), F.lit(1).alias("is_full_data")
    )
    return X.pending_tags([("final_tender_bid", "tendercats", orders), ("final_tender_bid_result", "bidcats", customers)])


@query(
    "ext6_missing_value_sample",
    "SELECT doc_id, source FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS NULL AND md5(d.text) NOT IN (SELECT md5(text) FROM documents JOIN labels USING (doc_id)) ORDER BY doc_id LIMIT 100",
)
def ext6(spark, folder):
    docs = documents(spark, folder).select("doc_id", "source", T.fingerprint(F.col("text")).alias("md5"))
    labelled = docs.join(table(spark, folder, "labels"), "doc_id", "left")
    used = labelled.filter(F.col("quality").isNotNull())
    return X.missing_value_sample(labelled, "quality", used, "doc_id", 100).select("doc_id", "source")


@query("ext7_unsampled", "SELECT doc_id FROM documents WHERE md5(text) NOT IN (SELECT md5(text) FROM documents JOIN labels USING (doc_id))")
def ext7(spark, folder):
    docs = documents(spark, folder).select("doc_id", T.fingerprint(F.col("text")).alias("md5"))
    known = docs.join(table(spark, folder, "labels"), "doc_id", "left_semi")
    return X.pull_missing(docs, known, "md5").select("doc_id")


@query("ext8_new_pages", "SELECT page_id, url AS name FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE url LIKE 'https%')")
def ext8(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", F.col("url").alias("name"))
    return X.pull_missing(pages, pages.filter("name LIKE 'https%'"), "name").select("page_id", "name")


@query("ext9_of_task", "SELECT doc_id, source FROM documents WHERE contains(source, 'src1')")
def ext9(spark, folder):
    from noticeloom.operators.curate import of_task

    return of_task(table(spark, folder, "documents").select("doc_id", "source"), "src1", "source", part=True)


@query("ext10_first_by_source", "SELECT source, min(doc_id) AS doc_id, arg_min(md5(text), doc_id) AS md5 FROM documents GROUP BY 1")
def ext10(spark, folder):
    docs = documents(spark, folder).select("source", "doc_id", F.md5("text").alias("md5"))
    return distinct_first(docs, ["source"], ["doc_id"])


def _label_lists(spark, folder) -> DataFrame:
    """Extracted (label, value) lists of bid notices, one per order."""
    rows = _prices(spark, folder, "o_custkey", "o_totalprice", "o_orderpriority", "o_orderdate")

    def item(label: str, value) -> F.Column:
        return F.struct(F.lit(label).alias("label"), value.alias("value"))

    def winner(n: int) -> F.Column:
        return F.concat(F.lit("供应商 "), (F.col("o_custkey") % n).cast("string"))

    labels = F.array(
        item("项目名称", F.lit("旧名")),
        item("中标单位", winner(7)),
        item("中标金额", F.col("v")),
        item("中标金额单位", F.when(F.col("o_orderkey") % 2 == 0, F.lit("万元")).otherwise(F.lit("元"))),
        item("中标单位", winner(5)),
        item("中标金额", F.floor("o_totalprice").cast("string")),
        item("项目名称", F.col("o_orderpriority")),
    )
    cleaned = N.apply_units(N.clean_labels(labels, "bid", 2024))
    return rows.withColumn("labels", labels).withColumn("cleaned", cleaned)


LISTS = f"""l AS (SELECT o_orderkey, o_orderdate, o_orderpriority, '供应商' || (o_custkey % 7) AS w1, '供应商' || (o_custkey % 5) AS w2,
 CAST(CAST(floor(o_totalprice) AS BIGINT) * CASE WHEN o_orderkey % 2 = 0 THEN 10000 ELSE 1 END AS BIGINT) AS total, {PRICE_SQL} AS v FROM orders)"""


@query("prj13_amount_times_unit", f"WITH {LISTS} SELECT o_orderkey, total || ';' || total AS amounts FROM l")
def prj13(spark, folder):
    own = F.filter("cleaned", lambda x: x["label"] == "中标金额")
    return _label_lists(spark, folder).select("o_orderkey", F.array_join(F.transform(own, lambda x: x["value"]), ";").alias("amounts"))


@query("prj14_label_map", f"WITH {LISTS} SELECT o_orderkey, w1 || '#' || w2 AS winners, o_orderpriority AS project_name, CAST(total AS VARCHAR) AS amount FROM l".replace("o_orderpriority AS", "replace(o_orderpriority, ' ', '') AS"))
def prj14(spark, folder):
    rows = _label_lists(spark, folder).select("o_orderkey", N.label_map(F.col("cleaned"), F.lit(True)).alias("m"))
    return rows.select(
        "o_orderkey", F.element_at("m", "中标单位").alias("winners"), F.element_at("m", "项目名称").alias("project_name"),
        F.element_at("m", "中标金额").alias("amount"),
    )


@query("prj15_winners_text", f"WITH {LISTS} SELECT o_orderkey, w1 || '_' || w2 AS winning_bidder FROM l")
def prj15(spark, folder):
    return _label_lists(spark, folder).select("o_orderkey", N.winners_text(F.col("cleaned")).alias("winning_bidder"))


@query(
    "prj16_widen",
    f"WITH {LISTS} SELECT o_orderkey, replace(o_orderpriority, ' ', '') AS project_name, CAST(total AS VARCHAR) AS amount, 'N' || o_orderkey AS notice_num, CAST(NULL AS VARCHAR) AS project_leader FROM l",
)
def prj16(spark, folder):
    rows = _label_lists(spark, folder).withColumn("m", N.label_map(F.col("cleaned"), F.lit(True)))
    source = rows.select("o_orderkey", "m", F.col("v").alias("amount"), F.concat(F.lit("N"), F.col("o_orderkey").cast("string")).alias("notice_num"))
    return N.widen(source, "bid", "m").drop("m")


@query(
    "prj17_amount_fallback",
    f"WITH {LISTS}, m AS (SELECT o_orderkey, total, CAST(coalesce({amount_sql('v')}, 0) AS DOUBLE) AS money FROM l) SELECT o_orderkey, CASE WHEN money = 0 THEN total::DOUBLE ELSE money END AS amount FROM m",
)
def prj17(spark, folder):
    rows = _label_lists(spark, folder).withColumn("m", N.label_map(F.col("cleaned"), F.lit(True)))
    extracted = F.element_at("m", "中标金额").try_cast("decimal(24,6)")
    return rows.select("o_orderkey", V.amount_fallback(V.money(F.col("v")), extracted).cast("double").alias("amount"))


def _flags(spark, folder) -> DataFrame:
    rows = table(spark, folder, "orders")
    text = F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))
    key = F.col("o_orderkey")
    return rows.select(
        "o_orderkey",
        F.when(key % 4 > 0, F.lit("四川")).otherwise(F.lit("")).alias("province"),
        F.when(key % 8 > 0, F.lit("成都")).alias("city"),
        F.lit(None).cast("string").alias("county"),
        text.alias("title"),
        F.col("o_orderdate").alias("publish_time"),
        F.when(key % 5 == 0, F.lit("3万元")).when(key % 5 == 1, F.lit("50")).when(key % 5 == 2, F.lit("123456789012.00")).otherwise(F.col("o_totalprice").cast("decimal(20,2)").cast("string")).alias("amount"),
        F.when(key % 3 > 0, text).alias("notice_num"),
        text.alias("tenderee"),
        text.alias("project_name"),
        F.lit("2024-01-01").alias("tender_document_stime"),
        F.when(key % 7 > 0, F.lit("2024-01-02")).alias("tender_etime"),
        F.when(key % 6 > 0, F.array(*[F.lit(x) for x in N.REQUIRED_LABELS])).otherwise(F.array(F.lit("项目名称"))).alias("names"),
    ).withColumn("budget", F.col("amount"))


@query(
    "prj18_is_full",
    """WITH f AS (SELECT o_orderkey AS k, o_orderkey % 4 = 0 AND o_orderkey % 8 = 0 AS nowhere, o_orderkey % 5 IN (0, 1) AS bad, o_orderkey % 5 = 2 AS big, o_totalprice < 100 AS low FROM orders)
SELECT k AS o_orderkey, CASE WHEN nowhere OR bad OR (k % 5 > 2 AND low) OR k % 3 = 0 OR k % 7 = 0 THEN 0 ELSE 1 END AS tender,
 CASE WHEN nowhere OR bad OR big OR (k % 5 > 2 AND low) OR k % 6 = 0 THEN 0 ELSE 1 END AS bid, CASE WHEN nowhere OR k % 3 = 0 THEN 0 ELSE 1 END AS contract FROM f""",
)
def prj18(spark, folder):
    rows = _flags(spark, folder)
    return rows.select(
        "o_orderkey", N.is_full("tender").alias("tender"), N.is_full("bid", F.col("names")).alias("bid"), N.is_full("contract").alias("contract")
    )


@query(
    "ded2_winner_rows",
    f"""WITH {LISTS}, m AS (SELECT *, coalesce({amount_sql('v')}, 0) AS money FROM l), t AS (SELECT *, CASE WHEN money <> 0 THEN money::DOUBLE ELSE total::DOUBLE END AS amt FROM m)
SELECT w1 AS winning_bidder, amt AS amount, 'test_tender_bid_result' AS table_name, o_orderkey AS announcement_id FROM t UNION ALL SELECT w2, 0, 'test_tender_bid_result', o_orderkey FROM t WHERE w1 <> w2""",
)
def ded2(spark, folder):
    rows = _label_lists(spark, folder).withColumns(
        {"m": N.label_map(F.col("cleaned"), F.lit(True)), "money": V.money(F.col("v")), "publish_time": F.col("o_orderdate")}
    )
    out = N.winner_rows(rows, "test_tender_bid_result", "m", "money", "o_orderkey")
    return out.withColumn("amount", F.col("amount").cast("double")).drop("publish_time")


NOTICE_TERMS = [("中标单位", "the"), ("中标单位", "and"), ("项目名称", "tion"), ("中标公告编号", "erth"), ("中标金额", "der")]


def _notices(spark, folder) -> DataFrame:
    key = F.col("page_id")
    return pages(spark, folder).select(
        key.alias("id"),
        F.col("url").alias("title"),
        F.col("html").alias("detail_content"),
        F.col("url").alias("source_website_address"),
        F.lit("2024-01-05 08:00:00").alias("publish_time"),
        F.lit("2024-01-06 08:00:00").alias("update_time"),
        F.when(key % 3 == 0, F.lit("12万元")).when(key % 3 == 1, F.lit("5,000.50元")).alias("amount"),
        F.when(key % 2 == 0, F.lit("四川")).alias("province"),
        F.lit("").alias("city"),
        F.lit(None).cast("string").alias("county"),
    )


def _load(spark, folder, gold: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    if gold is None:
        gold = few_rows(spark, [], "md5 string, label array<struct<start:int,end:int,label:string>>")
    return load_notices(
        _notices(spark, folder), "test_tender_bid_result", gold,
        lambda df: df.withColumn("label", phrase_spans(F.col("text"), NOTICE_TERMS)), 2024,
    )


NOTICES = f"""WITH clean AS (SELECT page_id, url, {clean_sql('html')} AS text FROM pages), {spans_sql(NOTICE_TERMS, source='clean', key='page_id')},
v AS (SELECT s.page_id, s.pos, s.label, replace(substring(c.text, s."start" + 1, s."end" - s."start"), chr(10), '') AS val FROM spans s JOIN clean c USING (page_id)),
money AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN 120000.0::DOUBLE WHEN 1 THEN 5000.5::DOUBLE ELSE 0.0::DOUBLE END AS money FROM pages)"""


@query(
    "flow_notice_winners",
    f"""{NOTICES}, w AS (SELECT page_id, val, min(pos) AS pos FROM v WHERE label = '中标单位' GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM w)
SELECT val AS winning_bidder, CASE WHEN rn = 1 THEN money ELSE 0 END AS amount, 'test_tender_bid_result' AS table_name, page_id AS announcement_id FROM r JOIN money USING (page_id)""",
)
def flow_winners(spark, folder):
    _, winners = _load(spark, folder)
    return winners.withColumn("amount", F.col("amount").cast("double")).drop("publish_time")


@query(
    "flow_notice_parents",
    f"""{NOTICES}, a AS (SELECT page_id, string_agg(val, '_' ORDER BY pos) FILTER (WHERE label = '中标单位') AS winning_bidder, arg_max(val, pos) FILTER (WHERE label = '项目名称') AS project_name,
 arg_max(val, pos) FILTER (WHERE label = '中标公告编号') AS notice_num, bool_or(label = '中标金额') AS has_amount, count(*) AS n FROM v GROUP BY 1)
SELECT p.page_id AS id, coalesce(a.winning_bidder, '') AS winning_bidder, a.project_name, a.notice_num, CASE WHEN m.money <> 0 THEN m.money WHEN has_amount THEN 0 END AS amount,
 CASE WHEN p.page_id % 2 = 0 AND a.winning_bidder IS NOT NULL AND a.project_name IS NOT NULL AND a.notice_num IS NOT NULL AND has_amount THEN 1 ELSE 0 END AS is_full_data, coalesce(a.n, 0) AS n_labels
FROM pages p JOIN money m USING (page_id) LEFT JOIN a USING (page_id)""",
)
def flow_parents(spark, folder):
    parents, _ = _load(spark, folder)
    return parents.select(
        "id", "winning_bidder", "project_name", "notice_num", F.col("amount").cast("double").alias("amount"), "is_full_data",
        F.size(F.from_json("labels", "array<map<string,string>>")).cast("bigint").alias("n_labels"),
    )


DATED = "<p>2024年2月3日</p>"
TENDER_TERMS = [
    ("项目名称", "tion"), ("项目招标编号", "erth"), ("招标单位", "this"), ("招标单位联系人", "nicht"), ("招标文件领取开始时间", "2024年2月3日"), ("投标截止时间", "2024年2月3日"),
]
CONTRACT_TERMS = [("项目名称", "tion"), ("项目编号", "erth"), ("招标公司", "this"), ("开工时间", "2024年2月3日")]


def _dated(spark, folder) -> DataFrame:
    """Notices of which four in five name a date."""
    rows = _notices(spark, folder)
    return rows.withColumn("detail_content", F.when(F.col("id") % 5 > 0, F.concat("detail_content", F.lit(DATED))).otherwise(F.col("detail_content")))


def _parents(spark, rows: DataFrame, origin: str, terms: list[tuple[str, str]]) -> DataFrame:
    gold = few_rows(spark, [], "md5 string, label array<struct<start:int,end:int,label:string>>")
    parents, winners = load_notices(rows, origin, gold, lambda df: df.withColumn("label", phrase_spans(F.col("text"), terms)), 2024)
    assert winners is None
    return parents


def held_sql(term: str) -> str:
    return f"CASE WHEN contains(text, '{term}') THEN '{term}' END"


DATED_SQL = f"""WITH c AS (
  SELECT page_id, url, page_id % 5 > 0 AS dated, {clean_sql(f"(html || CASE WHEN page_id % 5 > 0 THEN '{DATED}' ELSE '' END)")} AS text FROM pages),
f AS (SELECT *, {held_sql('tion')} AS project_name, {held_sql('erth')} AS notice_num, {held_sql('this')} AS tenderee, {held_sql('nicht')} AS liaison,
  CASE WHEN dated THEN TIMESTAMP '2024-02-03 00:00:00' END AS day FROM c)"""


@query(
    "flow_tender_notices",
    f"""{DATED_SQL}, g AS (SELECT *, CASE page_id % 3 WHEN 0 THEN 120000.0::DOUBLE WHEN 1 THEN 5000.5::DOUBLE END AS budget FROM f)
SELECT page_id AS id, project_name, notice_num, tenderee, liaison AS tenderee_liaison, day AS tender_etime, budget,
  CASE WHEN page_id % 2 = 0 AND dated AND project_name IS NOT NULL AND notice_num IS NOT NULL AND tenderee IS NOT NULL AND budget IS NOT NULL THEN 1 ELSE 0 END AS is_full_data FROM g""",
)
def flow_tenders(spark, folder):
    rows = _dated(spark, folder).withColumnRenamed("amount", "budget")
    parents = _parents(spark, rows, "test_tender_bid", TENDER_TERMS)
    return parents.select(
        "id", "project_name", "notice_num", "tenderee", "tenderee_liaison", F.col("tender_etime").cast("timestamp_ntz").alias("tender_etime"),
        F.col("budget").cast("double").alias("budget"), "is_full_data",
    )


@query(
    "flow_contract_notices",
    f"""{DATED_SQL} SELECT page_id AS id, project_name, notice_num, tenderee, day AS start_time,
  CASE WHEN page_id % 2 = 0 AND notice_num IS NOT NULL AND tenderee IS NOT NULL THEN 1 ELSE 0 END AS is_full_data FROM f""",
)
def flow_contracts(spark, folder):
    parents = _parents(spark, _dated(spark, folder), "test_tender_trade_result", CONTRACT_TERMS)
    start = F.col("start_time").cast("timestamp_ntz").alias("start_time")
    return parents.select("id", "project_name", "notice_num", "tenderee", start, "is_full_data")


@query(
    "flow_tag_notices",
    f"""WITH human AS (SELECT md5({clean_sql('html')}) AS md5 FROM pages WHERE url LIKE 'https%'), clean AS (SELECT page_id, url, md5({clean_sql('html')}) AS md5 FROM pages WHERE url NOT LIKE '%.org/%'),
s AS (SELECT page_id, md5, {', '.join(SCORE_SQL.format("'" + n + "'").replace('source', 'url') + f' AS s{i}' for i, n in enumerate(CAT_NAMES))} FROM clean)
SELECT 'final_tender_bid' AS "table", page_id AS id, CASE WHEN md5 IN (SELECT md5 FROM human) THEN '人工' WHEN s0 >= s1 AND s0 >= s2 THEN '货物' WHEN s1 >= s2 THEN '工程' ELSE '服务' END AS classify_type FROM s""",
)
def flow_tag(spark, folder):
    source = _notices(spark, folder).withColumn("table", F.lit("final_tender_bid"))
    pending = source.filter("title NOT LIKE '%.org/%'").select("table", "id")
    gold = source.filter("title LIKE 'https%'").select(T.fingerprint(T.clean_html(F.col("detail_content"))).alias("md5"), F.lit("人工").alias("classify_type"))
    return tag_notices(pending, source, gold, lambda df: category_scores(df, "title"))


@query(
    "src8_split_insertable",
    "SELECT o_orderkey, CASE WHEN o_custkey % 50 = 0 THEN 'owner' WHEN o_totalprice < 5000 THEN 'price' END AS reason FROM orders",
)
def src8(spark, folder):
    owner = F.when(F.col("o_custkey") % 50 > 0, F.col("o_custkey"))
    rows = table(spark, folder, "orders").withColumn("owner", owner)
    good, bad = TB.split_insertable(rows, {"owner": F.col("owner").isNotNull(), "price": F.col("o_totalprice") >= 5000})
    return good.select("o_orderkey", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("o_orderkey", "reason"))


@query(
    "src9_replace_by_key",
    "SELECT o_orderkey AS id, CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN 'new' ELSE o_orderstatus END AS status FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' OR o_orderdate >= TIMESTAMP '1997-01-01'",
)
def src9(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"), "o_orderdate", F.col("o_orderstatus").alias("status"))
    target = orders.filter("o_orderdate < TIMESTAMP_NTZ '1998-01-01 00:00:00'")
    batch = orders.filter("o_orderdate >= TIMESTAMP_NTZ '1997-01-01 00:00:00'").withColumn("status", F.lit("new"))
    return TB.replace_by_key(target, batch, ["id"]).select("id", "status")


@query(
    "src9_replace_winners",
    "SELECT 'a' AS table_name, l_orderkey AS announcement_id, l_suppkey AS winner FROM lineitem WHERE l_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') UNION ALL SELECT 'a', l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 25",
)
def src9_winners(spark, folder):
    lines = table(spark, folder, "lineitem").withColumns({"table_name": F.lit("a"), "announcement_id": F.col("l_orderkey")})
    target = lines.select("table_name", "announcement_id", F.col("l_suppkey").alias("winner"))
    loaded = lines.filter("l_returnflag = 'R'")
    batch = loaded.filter("l_quantity > 25").select("table_name", "announcement_id", F.col("l_partkey").alias("winner"))
    return TB.replace_by_key(target, batch, ["table_name", "announcement_id"], loaded)


@query(
    "src10_update_columns",
    """WITH u AS (SELECT l_orderkey, arg_max(l_linestatus, (l_shipdate, l_linenumber, l_partkey, l_suppkey)) AS s FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1)
SELECT o_orderkey, o_custkey, coalesce(u.s, o_orderstatus) AS o_orderstatus FROM orders LEFT JOIN u ON l_orderkey = o_orderkey""",
)
def src10(spark, folder):
    lines = table(spark, folder, "lineitem")
    updates = lines.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.when(F.col("l_returnflag") != "R", F.col("l_linestatus")).alias("o_orderstatus"),
        F.struct("l_shipdate", "l_linenumber", "l_partkey", "l_suppkey").alias("order"),
    )
    target = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return TB.update_columns(target, updates, "o_orderkey", ["o_orderstatus"])


GOLD_NOTICES = f"""{NOTICES}, known AS (SELECT DISTINCT md5(text) AS m FROM clean WHERE page_id % 5 = 0),
v2 AS (SELECT v.page_id, v.pos, v.label, v.val FROM v JOIN clean c USING (page_id) WHERE md5(c.text) NOT IN (SELECT m FROM known)
  UNION ALL SELECT page_id, 1, '中标单位', replace(substring(text, 1, 3), chr(10), '') FROM clean WHERE md5(text) IN (SELECT m FROM known)),
w AS (SELECT page_id, val, min(pos) AS pos FROM v2 WHERE label = '中标单位' GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rn FROM w)
SELECT val AS winning_bidder, CASE WHEN rn = 1 THEN money ELSE 0 END AS amount, 'test_tender_bid_result' AS table_name, page_id AS announcement_id FROM r JOIN money USING (page_id)"""


@query("flow_notice_winners_with_gold", GOLD_NOTICES)
def flow_winners_gold(spark, folder):
    """Every fifth page has labels by hand, which stand for all pages of its text."""
    label = F.expr("array(named_struct('start', 0, 'end', 3, 'label', '中标单位'))")
    known = pages(spark, folder).filter(F.col("page_id") % 5 == 0).select(T.clean_html(F.col("html")).alias("text"))
    _, winners = _load(spark, folder, known.select(F.md5("text").alias("md5"), label.alias("label")))
    return winners.withColumn("amount", F.col("amount").cast("double")).drop("publish_time")
