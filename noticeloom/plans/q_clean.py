"""Queries of the cleaning and scalar operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.functions import text as T
from noticeloom.functions import values as V
from noticeloom.operators import curate as C
from noticeloom.operators.ranking import distinct_first, first_per_group
from noticeloom.operators.spans import phrase_spans, span_rows
from noticeloom.plans.catalog import query, spread, table
from noticeloom.plans.data import ASTRAL_SQL, GOLD, clean_sql, marked_sql, pages, quoted, spans_sql, visible_sql
from noticeloom.sources.files import standard_documents

LABEL_TERMS = [("中标单位", "the"), ("中标金额", "and"), ("项目名称", "tion"), ("开标时间", "&")]


@query(
    "flagship_page_labels",
    f"""WITH clean AS (SELECT page_id, {clean_sql('html')} AS text FROM pages),
kept AS (SELECT md5(text) AS md5, min(page_id) AS page_id, any_value(text) AS text FROM clean GROUP BY 1),
{spans_sql(LABEL_TERMS, source='kept', key='page_id')}
SELECT label AS label_type, count(*) AS n_spans, count(DISTINCT page_id) AS n_pages FROM spans GROUP BY 1""",
)
def flagship_page_labels(spark, folder) -> DataFrame:
    cleaned = pages(spark, folder).select("page_id", T.clean_html(F.col("html")).alias("text"))
    kept = distinct_first(cleaned.withColumn("md5", T.fingerprint(F.col("text"))), ["md5"], ["page_id"])
    spans = span_rows(kept.withColumn("label", phrase_spans(F.col("text"), LABEL_TERMS)), ["page_id"])
    per_page = spans.groupBy("label_type", "page_id").agg(F.count("*").alias("n"))
    return per_page.groupBy("label_type").agg(F.sum("n").alias("n_spans"), F.count("*").alias("n_pages"))


@query(
    "prj1_clean_html",
    f"SELECT page_id, md5(t) AS text_md5, length(t) AS n_chars FROM (SELECT page_id, {clean_sql('html')} AS t FROM pages)",
)
def prj1(spark, folder):
    t = pages(spark, folder).select("page_id", T.clean_html(F.col("html")).alias("t"))
    return t.select("page_id", F.md5("t").alias("text_md5"), F.length("t").cast("bigint").alias("n_chars"))


@query(
    "prj1_clean_html_short",
    f"""SELECT page_id, md5(t) AS text_md5, length(t) AS n_chars FROM (
SELECT page_id, regexp_replace(replace(replace(translate(regexp_replace({visible_sql(marked_sql('html'))}, {ASTRAL_SQL}, '', 'g'),
 chr(13) || chr(12), chr(10) || chr(10)), chr(9), ''), ' ', ''), '\\n+', chr(10), 'g') AS t FROM pages)""",
)
def prj1_short(spark, folder):
    t = pages(spark, folder).select("page_id", T.clean_html_short(F.col("html")).alias("t"))
    return t.select("page_id", F.md5("t").alias("text_md5"), F.length("t").cast("bigint").alias("n_chars"))


@query(
    "prj2_standard_documents",
    f"""WITH c AS (SELECT page_id, url, {clean_sql('html')} AS t FROM pages WHERE html IS NOT NULL AND url IS NOT NULL)
SELECT md5(t) AS md5, min(page_id) AS page_id, arg_min(url, page_id) AS source, 'tender' AS task, '2024-01-01 00:00:00' AS "time",
 any_value(length(t)) AS n_chars FROM c GROUP BY 1""",
)
def prj2(spark, folder):
    docs = standard_documents(pages(spark, folder), "tender", "2024-01-01 00:00:00", "page_id", "html", "url")
    return docs.select("md5", "page_id", "source", "task", "time", F.length("text").cast("bigint").alias("n_chars"))


def _old_sql(column: str) -> str:
    s = column
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        s = f"replace({s}, '&{name};', {quoted(char)})"
    for pattern, by in (
        (T.CDATA, "''"), (T.OLD_SCRIPT, "''"), (T.OLD_STYLE, "''"), (T.OLD_BREAK, "chr(10)"),
        ("</td>", "' '"), (T.OLD_TAG, "''"), (T.OLD_OTHER, "''"), (T.OLD_COMMENT, "''"),
    ):
        s = f"regexp_replace({s}, {quoted(pattern)}, {by}, 'g')"
    return _entities_sql(s)


def _entities_sql(column: str) -> str:
    s = column
    for _ in range(2):
        s = f"regexp_replace({s}, '&(?:#?(?:amp|38);)+', '&', 'g')"
        for names, by in (("nbsp|160", " "), ("lt|60", "<"), ("gt|62", ">"), ("quot|34", '"')):
            s = f"regexp_replace({s}, '&#?(?:{names});', '{by}', 'g')"
        s = f"regexp_replace({s}, '&#?[\\p{{L}}\\p{{N}}_]+;', '', 'g')"
    return s


@query("prj3_strip_tags_plain", f"SELECT page_id, md5({_old_sql('html')}) AS text_md5 FROM pages")
def prj3(spark, folder):
    text = F.when(F.col("html").isNotNull(), T.strip_tags_plain(F.col("html")))
    return pages(spark, folder).select("page_id", F.md5(text).alias("text_md5"))


@query("prj4_replace_entities", f"SELECT page_id, md5({_entities_sql('html')}) AS text_md5 FROM pages")
def prj4(spark, folder):
    return spread(table(spark, folder, "pages")).select("page_id", F.md5(T.replace_entities(F.col("html"))).alias("text_md5"))


@query(
    "prj5_word_content",
    f"""SELECT page_id, md5(CASE WHEN w = '' THEN '' ELSE '''' || w || '''' END) AS text_md5 FROM (
SELECT page_id, regexp_replace(regexp_replace({visible_sql('html')}, {ASTRAL_SQL}, '', 'g'), '[^\\p{{L}}\\p{{N}}_]', '', 'g') AS w FROM pages)""",
)
def prj5(spark, folder):
    words = F.when(F.col("html").isNotNull(), T.word_content(F.col("html")))
    return pages(spark, folder).select("page_id", F.md5(words).alias("text_md5"))


@query("prj6_fingerprint", "SELECT doc_id, md5(text) AS md5 FROM documents")
def prj6(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.fingerprint(F.col("text")).alias("md5"))


GENERAL_SQL = r"replace(translate(regexp_replace({c}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'), chr(10) || chr(13) || chr(9), ''), ' ', '')"


@query("prj7_general_value", f"SELECT doc_id, substring({GENERAL_SQL.format(c='text')}, 1, 300) AS value FROM documents")
def prj7(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.general_value(F.col("text"), T.VALUE_LIMIT).alias("value"))


PRICE_SQL = """CASE o_orderkey % 4
 WHEN 0 THEN CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || '.125万元'
 WHEN 1 THEN CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) || ',' || lpad(CAST(CAST(floor(o_totalprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0') || '.50元'
 WHEN 2 THEN '折扣' || CAST(o_custkey % 100 AS VARCHAR) || '%'
 ELSE '面议 ' END"""


def _prices(spark, folder, *keep: str) -> DataFrame:
    """Prices of orders written the ways notices write them."""
    whole = F.floor("o_totalprice")
    text = (
        F.when(F.col("o_orderkey") % 4 == 0, F.concat(whole.cast("string"), F.lit(".125万元")))
        .when(
            F.col("o_orderkey") % 4 == 1,
            F.concat(
                F.floor(F.col("o_totalprice") / 1000).cast("string"), F.lit(","),
                F.lpad((whole % 1000).cast("string"), 3, "0"), F.lit(".50元"),
            ),
        )
        .when(F.col("o_orderkey") % 4 == 2, F.concat(F.lit("折扣"), (F.col("o_custkey") % 100).cast("string"), F.lit("%")))
        .otherwise(F.lit("面议 "))
    )
    return spread(table(spark, folder, "orders")).select("o_orderkey", *keep, text.alias("v"))


def amount_sql(v: str) -> str:
    n = f"TRY_CAST(nullif(regexp_extract(replace({v}, ',', ''), '[0-9]+\\.[0-9]+|[0-9]+'), '') AS DECIMAL(24,6))"
    return f"""CASE WHEN contains({v}, '万') THEN CAST(round(CAST({n} * 10000 AS DECIMAL(38,6)), 2) AS DECIMAL(24,6)) WHEN contains({v}, '%') THEN NULL ELSE {n} END"""


@query(
    "prj8_amount",
    f"SELECT o_orderkey, CAST({amount_sql('v')} AS DOUBLE) AS amount, CAST(coalesce({amount_sql('v')}, 0) AS DOUBLE) AS money FROM (SELECT o_orderkey, {PRICE_SQL} AS v FROM orders)",
)
def prj8(spark, folder):
    return _prices(spark, folder).select(
        "o_orderkey", V.amount(F.col("v")).cast("double").alias("amount"), V.money(F.col("v")).cast("double").alias("money")
    )


@query("prj8_first_amount_of_text", f"SELECT doc_id, CAST({amount_sql('text')} AS DOUBLE) AS amount FROM documents")
def prj8_documents(spark, folder):
    return table(spark, folder, "documents").select("doc_id", V.amount(F.col("text")).cast("double").alias("amount"))


@query("prj9_unit", f"SELECT o_orderkey, CASE WHEN contains(v, '万') THEN 10000 ELSE 1 END AS unit FROM (SELECT o_orderkey, {PRICE_SQL} AS v FROM orders)")
def prj9(spark, folder):
    return _prices(spark, folder).select("o_orderkey", V.unit(F.col("v")).alias("unit"))


DATE_SQL = """CASE o_orderkey % 6
 WHEN 0 THEN year(o_orderdate) || '年' || month(o_orderdate) || '月' || day(o_orderdate) || '日'
 WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 24:00'
 WHEN 2 THEN (year(o_orderdate) % 100) || '年' || month(o_orderdate) || '月' || day(o_orderdate) || '日'
 WHEN 3 THEN month(o_orderdate) || '月' || (day(o_orderdate) + 3) || '日 9时30分'
 WHEN 4 THEN year(o_orderdate) || '年' || month(o_orderdate) || '月'
 ELSE strftime(o_orderdate, '%Y%m%d') END"""


def _dates(spark, folder, *keep: str) -> DataFrame:
    """Order dates written the ways notices write them."""
    d = F.col("o_orderdate")
    y, m, day = F.year(d).cast("string"), F.month(d).cast("string"), F.dayofmonth(d).cast("string")
    style = F.col("o_orderkey") % 6
    text = (
        F.when(style == 0, F.concat(y, F.lit("年"), m, F.lit("月"), day, F.lit("日")))
        .when(style == 1, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 24:00")))
        .when(style == 2, F.concat((F.year(d) % 100).cast("string"), F.lit("年"), m, F.lit("月"), day, F.lit("日")))
        .when(style == 3, F.concat(m, F.lit("月"), (F.dayofmonth(d) + 3).cast("string"), F.lit("日 9时30分")))
        .when(style == 4, F.concat(y, F.lit("年"), m, F.lit("月")))
        .otherwise(F.date_format(d, "yyyyMMdd"))
    )
    return spread(table(spark, folder, "orders")).select("o_orderkey", *keep, text.alias("v"))


def date_sql(v: str, year: int) -> str:
    def two(i: int) -> str:
        part = f"coalesce(g[{i}], '0')"
        return f"CASE WHEN length({part}) <= 2 THEN lpad({part}, 2, '0') ELSE 'none' END"

    return f"""(SELECT CASE WHEN len(g0) = 0 THEN NULL ELSE coalesce(strftime(TRY_CAST(
   g[1] || '-' || {two(2)} || '-' || {two(3)} || ' ' ||
   CASE WHEN coalesce(g[4], '0') = '24' THEN '23:59:59' ELSE {two(4)} || ':' || {two(5)} || ':' || {two(6)} END
   AS TIMESTAMP), '%Y-%m-%d %H:%M:%S'), '') END
 FROM (SELECT g0, CASE WHEN length(g0[1]) = 4 THEN g0
   WHEN length(g0[1]) = 2 AND CAST(g0[1] AS INTEGER) > 12 THEN list_concat(['20' || g0[1]], g0[2:])
   ELSE list_concat(['{year}'], g0) END AS g FROM (SELECT regexp_extract_all({v}, '[0-9]+') AS g0)))"""


@query("prj10_clean_date", f"SELECT o_orderkey, v, {date_sql('v', 2024)} AS cleaned FROM (SELECT o_orderkey, {DATE_SQL} AS v FROM orders)")
def prj10(spark, folder):
    return _dates(spark, folder).select("o_orderkey", "v", V.clean_date(F.col("v"), 2024).alias("cleaned"))


@query(
    "prj11_parse_times",
    """SELECT event_id, strftime(TRY_CAST(CASE WHEN event_type = 'error' THEN props ELSE CAST(ts AS VARCHAR) END AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') AS published FROM events""",
)
def prj11(spark, folder):
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("ts").cast("string"))
    rows = table(spark, folder, "events").select("event_id", text.alias("publish_time"))
    parsed = V.parse_times(rows, V.DATE_COLUMNS["bid"])
    return parsed.select("event_id", F.date_format("publish_time", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("published"))


RULE_LABELS = ["中标金额", "预算", "金额", "中标金额单位", "开标时间", "开工时间", "项目名称"]


@query(
    "prj12_clean_by_rule",
    f"""WITH p AS (SELECT o_orderkey, o_custkey, {PRICE_SQL} AS price, {DATE_SQL} AS day FROM orders),
r AS (SELECT o_orderkey, ['bid', 'tender', 'contract'][o_custkey % 3 + 1] AS task, {RULE_LABELS!r}[o_orderkey % 7 + 1] AS label,
  CASE WHEN contains({RULE_LABELS!r}[o_orderkey % 7 + 1], '时间') THEN day ELSE price END AS value FROM p),
g AS (SELECT *, {GENERAL_SQL.format(c='value')} AS plain FROM r)
SELECT o_orderkey, task, label, CASE
  WHEN (task, label) IN (('bid', '中标金额'), ('contract', '金额'), ('tender', '预算'))
    THEN regexp_replace(CAST(CAST(coalesce({amount_sql('plain')}, 0) AS DECIMAL(24,6)) AS VARCHAR), '\\.?0+$', '')
  WHEN (task, label) IN (('bid', '中标金额单位'), ('contract', '金额单位'), ('tender', '预算单位')) THEN CASE WHEN contains(plain, '万') THEN '10000' ELSE '1' END
  WHEN (task, label) IN (('tender', '开标时间'), ('contract', '开工时间')) THEN {date_sql('plain', 2024)}
  ELSE plain END AS cleaned FROM g""",
)
def prj12(spark, folder):
    prices = _prices(spark, folder, "o_custkey")
    dates = _dates(spark, folder).select("o_orderkey", F.col("v").alias("day"))
    rows = prices.join(dates, "o_orderkey").select(
        "o_orderkey",
        F.get(F.array(*[F.lit(t) for t in ("bid", "tender", "contract")]), (F.col("o_custkey") % 3).cast("int")).alias("task"),
        F.get(F.array(*[F.lit(t) for t in RULE_LABELS]), (F.col("o_orderkey") % 7).cast("int")).alias("label"),
        "v",
        "day",
    )
    value = F.when(F.contains(F.col("label"), F.lit("时间")), F.col("day")).otherwise(F.col("v"))
    return rows.select(
        "o_orderkey", "task", "label", V.clean_value(F.col("task"), F.col("label"), value, 2024).alias("cleaned")
    )


@query(
    "prj19_upload_and_export",
    f"""WITH {spans_sql(GOLD)},
v AS (SELECT s.doc_id, s.label, string_agg(substring(d.text, s."start" + 1, s."end" - s."start"), ',' ORDER BY s.pos) AS joined, count(*) AS n
  FROM spans s JOIN documents d USING (doc_id) GROUP BY 1, 2)
SELECT d.doc_id, md5(d.text || '@crazy@' || md5(d.text)) AS marked, md5(split_part(d.text, '@crazy@', 1)) AS plain,
 CAST(coalesce((SELECT sum(n) FROM v WHERE v.doc_id = d.doc_id), 0) AS INTEGER) AS label_counts,
 coalesce((SELECT joined FROM v WHERE v.doc_id = d.doc_id AND label = '项目名称'), '') AS project_names,
 coalesce((SELECT joined FROM v WHERE v.doc_id = d.doc_id AND label = '开标时间'), '') AS opening_times
FROM documents d""",
)
def prj19(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", T.fingerprint(F.col("text")).alias("md5"))
    up = C.upload_columns(docs.withColumn("label", phrase_spans(F.col("text"), GOLD)), ["项目名称", "开标时间"])
    up = up.withColumn("marked", F.md5("text")).withColumnsRenamed({"项目名称": "project_names", "开标时间": "opening_times"})
    return up.select(
        "doc_id", "marked", F.md5(T.drop_md5_mark(F.col("text"))).alias("plain"), "label_counts", "project_names", "opening_times"
    )


@query(
    "prj20_links",
    """SELECT doc_id, 'http://' || source || '/#:~:text=' || substring(text, 1, 20) AS url,
 'http://host/projects/' || CASE WHEN doc_id % 5 = 0 THEN '38' ELSE '37' END || '/text-classification?page=1&q=' || md5(text) AS document_url FROM documents""",
)
def prj20(spark, folder):
    name = F.when(F.col("doc_id") % 5 == 0, F.lit("bidcats_dev")).otherwise(F.lit("bidcats_train"))
    source = F.concat(F.lit("http://"), F.col("source"), F.lit("/"))
    return table(spark, folder, "documents").select(
        "doc_id",
        T.text_link(source, F.substring("text", 1, 20)).alias("url"),
        C.document_url("http://host", C.project_id(name, 37, 38), T.fingerprint(F.col("text")), "text-classification").alias("document_url"),
    )


@query(
    "prj20_span_links",
    f"""WITH {spans_sql(GOLD)} SELECT s.doc_id, s."start", s.label AS label_type, 'http://' || d.source || '/#:~:text=' || substring(d.text, s."start" + 1, s."end" - s."start") AS url
FROM spans s JOIN documents d USING (doc_id)""",
)
def prj20_spans(spark, folder):
    """A link to each label in its source page."""
    docs = table(spark, folder, "documents").withColumn("label", phrase_spans(F.col("text"), GOLD))
    rows = span_rows(docs, ["doc_id", "source"])
    source = F.concat(F.lit("http://"), F.col("source"), F.lit("/"))
    return rows.select("doc_id", "start", "label_type", T.text_link(source, F.col("value")).alias("url"))


@query(
    "prj21_bracket_fields",
    """SELECT doc_id, lang AS language, source AS origin, CAST(n_chars AS VARCHAR) AS size, md5(regexp_replace(text, '【.*', '', 's')) AS body FROM documents""",
)
def prj21(spark, folder):
    parts = F.concat(
        F.lit("【语 言】"), "lang", F.lit("【来源\t】旧【来源】"), "source", F.lit("【字数】"), F.col("n_chars").cast("string"), F.lit("【正文】"), "text"
    )
    fields = table(spark, folder, "documents").select("doc_id", T.bracket_fields(parts).alias("f"))
    return fields.select(
        "doc_id",
        F.element_at("f", "语言").alias("language"),
        F.element_at("f", "来源").alias("origin"),
        F.element_at("f", "字数").alias("size"),
        F.md5(F.element_at("f", "正文")).alias("body"),
    )


@query(
    "prj22_post_fields",
    """SELECT conv_id, turn, role AS sender, CASE WHEN contains(text, chr(10)) THEN NULL ELSE regexp_replace(regexp_extract('站内' || text || '--', '站内(.+?)--', 1), '^ +| +$', '', 'g') END AS content FROM conversations""",
)
def prj22(spark, folder):
    post = F.concat(F.lit("发信人: "), "role", F.lit(", 信区: Work 站内"), "text", F.lit("--"))
    return table(spark, folder, "conversations").select("conv_id", "turn", T.post_fields(post).alias("p")).select(
        "conv_id", "turn", "p.sender", "p.content"
    )


RESIDENCE_SQL = """WITH lines AS (SELECT CAST(o_orderdate AS DATE) AS d, '居住于' || ['金牛区', '武侯区', '高新区', '城南区'][o_custkey % 4 + 1] || o_orderstatus || '小区，系' ||
 CASE WHEN o_orderkey % 3 = 0 THEN '主动就诊发现' ELSE '愿检尽检' END || '。' AS line FROM orders)"""


def _residences(spark, folder) -> DataFrame:
    district = F.get(F.array(*[F.lit(x) for x in ("金牛区", "武侯区", "高新区", "城南区")]), (F.col("o_custkey") % 4).cast("int"))
    how = F.when(F.col("o_orderkey") % 3 == 0, F.lit("主动就诊发现")).otherwise(F.lit("愿检尽检"))
    text = F.concat(F.lit("通报\n居住于"), district, "o_orderstatus", F.lit("小区，系"), how, F.lit("。\n完"))
    rows = table(spark, folder, "orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), text.alias("text"))
    return C.residence_records(rows, "date", "text")


@query(
    "prj23_residence_records",
    RESIDENCE_SQL + """ SELECT strftime(d, '%Y-%m-%d') AS "date", regexp_extract(line, '居住于(金牛区|武侯区|高新区)(.*?)，系(.*?)。', 1) AS district,
 regexp_extract(line, '居住于(金牛区|武侯区|高新区)(.*?)，系(.*?)。', 2) AS estate, regexp_extract(line, '居住于(金牛区|武侯区|高新区)(.*?)，系(.*?)。', 3) AS circumstance
 FROM lines WHERE regexp_matches(line, '居住于(金牛区|武侯区|高新区)')""",
)
def prj23(spark, folder):
    return _residences(spark, folder)


@query(
    "agg3_residence_counts",
    RESIDENCE_SQL + """ SELECT regexp_extract(line, '居住于(金牛区|武侯区|高新区)', 1) AS district, strftime(d, '%Y-%m-%d') AS "date", count(*) AS n
 FROM lines WHERE regexp_matches(line, '居住于(金牛区|武侯区|高新区)') GROUP BY 1, 2""",
)
def agg3(spark, folder):
    return C.group_counts(_residences(spark, folder), ["district", "date"], "estate")


@query(
    "prj26_summary_pairs",
    """WITH t AS (SELECT conv_id, turn, role, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS answer FROM conversations)
SELECT conv_id, turn, md5('summarize: ' || text) AS source_md5, md5(answer) AS target_md5 FROM t WHERE role = 'user' AND text <> '' AND answer IS NOT NULL AND answer <> ''""",
)
def prj26(spark, folder):
    pairs = C.summary_pairs(turn_pairs(spark, folder), "text", "answer", "summarize: ")
    return pairs.select("conv_id", "turn", F.md5("text").alias("source_md5"), F.md5("answer").alias("target_md5"))


def turn_pairs(spark, folder) -> DataFrame:
    """User turns beside the turn that follows: an equi join on the next turn number, no window."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    follow = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    return turns.filter(F.col("role") == "user").join(follow, ["conv_id", "turn"], "left")


@query("prj29_cap_text", "SELECT doc_id, md5(substring(text, 1, 10000)) AS text_md5, length(substring(text, 1, 10000)) AS n FROM documents")
def prj29(spark, folder):
    capped = table(spark, folder, "documents").select("doc_id", T.cap(F.col("text"), 10000).alias("t"))
    return capped.select("doc_id", F.md5("t").alias("text_md5"), F.length("t").cast("bigint").alias("n"))


@query(
    "prj30_protein_fractions",
    "SELECT p_partkey, p_retailprice / (p_size * 28.35) AS fraction FROM part WHERE p_brand = 'Brand#2' AND p_size > 0",
)
def prj30(spark, folder):
    return fractions(table(spark, folder, "part").filter(F.col("p_brand") == "Brand#2"))


def fractions(parts: DataFrame) -> DataFrame:
    return parts.filter("p_size > 0").select("p_partkey", (F.col("p_retailprice") / (F.col("p_size") * F.lit(28.35))).alias("fraction"))


@query("flt1_length_filter", "SELECT doc_id, length(text) AS len FROM documents WHERE length(text) > 50 AND length(text) < 3000")
def flt1(spark, folder):
    return C.length_between(table(spark, folder, "documents"), "text", 50, 3000).select("doc_id", F.col("len").cast("bigint").alias("len"))


@query(
    "srt1_order_by_length",
    "SELECT doc_id, len, row_number() OVER (ORDER BY len DESC, doc_id) AS place FROM (SELECT doc_id, length(text) AS len FROM documents)",
)
def srt1(spark, folder):
    from noticeloom.operators.ranking import number_wide

    rows = table(spark, folder, "documents").select("doc_id", F.length("text").cast("bigint").alias("len")).withColumn("_neg", -F.col("len"))
    return number_wide(rows, ["_neg", "doc_id"], "place").drop("_neg")


@query(
    "top1_first_per_file",
    "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) WHERE rn <= 10",
)
def top1(spark, folder):
    return first_per_group(table(spark, folder, "documents").select("source", "doc_id"), ["source"], ["doc_id"], 10)


@query(
    "ded1_distinct_by_md5",
    "SELECT md5(text) AS md5, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source FROM documents GROUP BY 1",
)
def ded1(spark, folder):
    docs = spread(table(spark, folder, "documents")).select(T.fingerprint(F.col("text")).alias("md5"), "doc_id", "source")
    return distinct_first(docs, ["md5"], ["doc_id"])
