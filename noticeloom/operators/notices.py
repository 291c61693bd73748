"""From label lists of notices to business columns, the winners table and the completeness flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeloom.functions.arrays import bind, unnest
from noticeloom.functions.values import AMOUNT, MONEY, PRODUCT_AMOUNTS, PRODUCT_UNITS, clean_value

WINNER, WINNER_COLUMN = "中标单位", "winning_bidder"

# Label names and their business columns per task, and the table routing.
COLUMNS = {
    "bid": {
        "中标公告编号": "notice_num",
        "项目名称": "project_name",
        "中标单位": "winning_bidder",
        "项目负责人": "project_leader",
        "中标金额": "amount",
    },
    "tender": {
        "项目名称": "project_name",
        "项目招标编号": "notice_num",
        "预算": "budget",
        "报名开始时间": "sign_up_stime",
        "报名结束时间": "sign_up_etime",
        "招标文件领取开始时间": "tender_document_stime",
        "招标文件领取结束时间": "tender_document_etime",
        "投标截止时间": "tender_etime",
        "开标时间": "bid_opening_time",
        "招标单位": "tenderee",
        "招标单位地址": "tenderee_address",
        "招标单位联系人": "tenderee_liaison",
        "招标单位联系电话": "tenderee_pnumber",
        "招标代理机构": "agency",
        "招标代理机构地址": "agency_address",
        "代理机构联系人": "agency_liaison",
        "代理联系人电话": "agency_pnumber",
        "招标文件获取网址": "tender_document_access",
        "建设地点": "address",
        "招标公告类型": "tender_announcement_type",
    },
    "contract": {
        "项目名称": "project_name",
        "项目编号": "notice_num",
        "开工时间": "start_time",
        "结束时间": "end_time",
        "建筑面积": "build_area",
        "建筑全长": "build_length",
        "项目地址": "address",
        "项目概况": "project_overview",
        "金额": "amount",
        "建设/采购公司": "procurement_company",
        "建设/采购联系人": "procurement_contact",
        "建设/采购联系方式": "procurement_pnumber",
        "招标公司": "tenderee",
        "招标联系人": "tenderee_liaison",
        "招标联系方式": "tenderee_pnumber",
        "面积单位": "area_unit",
        "长度单位": "length_unit",
        "金额单位": "amount_unit",
    },
}
ROUTES = [
    ("test_other_tender_bid_result", "final_other_tender_bid_result", "bid"),
    ("test_other_tender_bid", "final_other_tender_bid", "tender"),
    ("test_procurement_bid", "final_procurement_bid", "tender"),
    ("test_procurement_bid_result", "final_procurement_bid_result", "bid"),
    ("test_tender_bid", "final_tender_bid", "tender"),
    ("test_tender_bid_result", "final_tender_bid_result", "bid"),
    ("test_tender_trade_result", "final_tender_trade_result", "contract"),
    ("test_other_tender_trade_result", "final_other_tender_trade_result", "contract"),
    ("test_procurement_trade_result", "final_procurement_trade_result", "contract"),
]
FLAGGED_TABLES = ["test_tender_bid", "test_tender_bid_result", "test_tender_trade_result"]
MONEY_COLUMN = {"bid": "amount", "tender": "budget"}
REQUIRED = {
    "tender": ["project_name", "notice_num", "budget", "tenderee", "tender_document_stime", "tender_etime", "publish_time", "title"],
    "bid": ["publish_time", "title"],
    "contract": ["notice_num", "tenderee"],
}
REQUIRED_LABELS = ["项目名称", "中标公告编号", "中标金额", "中标单位"]


def routes(spark) -> DataFrame:
    """Table routing (origin, target, task)."""
    return spark.createDataFrame(ROUTES, "origin string, target string, task string")


def tag_routes(spark) -> DataFrame:
    """Tag routing (target, task)."""
    return routes(spark).select(F.col("target").alias("table"), F.concat("task", F.lit("cats")).alias("task"))


def route_of(origin: str) -> tuple[str, str]:
    """(target, task) of one origin table."""
    return next((target, task) for name, target, task in ROUTES if name == origin)


def clean_labels(labels: Column, task: Column | str, as_of_year: int) -> Column:
    """Values of a (label, value) list cleaned by the rules of the task."""
    return F.transform(
        labels,
        lambda x: F.struct(x["label"].alias("label"), clean_value(task, x["label"], x["value"], as_of_year).alias("value")),
    )


def apply_units(labels: Column) -> Column:
    """Every amount becomes the last amount times the last unit of the list."""

    def last(names: list[str]) -> Column:
        return F.try_element_at(F.filter(labels, lambda x: x["label"].isin(names)), F.lit(-1))["value"].try_cast(AMOUNT)

    product = last(PRODUCT_AMOUNTS) * F.coalesce(last(PRODUCT_UNITS), F.lit(1).cast(AMOUNT))
    text = F.regexp_replace(product.cast("decimal(30,6)").cast("string"), r"\.?0+$", "")
    return bind(
        text,
        lambda t: F.transform(
            labels,
            lambda x: F.struct(
                x["label"].alias("label"), F.when(x["label"].isin(PRODUCT_AMOUNTS), t).otherwise(x["value"]).alias("value")
            ),
        ),
    )


def label_map(labels: Column, joined: Column) -> Column:
    """Label list to a map: winners joined by ``#`` where ``joined`` holds, else the last value wins."""

    def value(name: Column) -> Column:
        own = F.transform(F.filter(labels, lambda x: x["label"] == name), lambda x: x["value"])
        return F.when(joined & (name == WINNER), F.array_join(own, "#")).otherwise(F.try_element_at(own, F.lit(-1)))

    names = F.array_distinct(F.transform(labels, lambda x: x["label"]))
    return F.map_from_arrays(names, F.transform(names, value))


def winners_text(labels: Column) -> Column:
    """All winners of a list joined by ``_`` in order."""
    return F.array_join(F.transform(F.filter(labels, lambda x: x["label"] == WINNER), lambda x: x["value"]), "_")


def widen(df: DataFrame, task: str, values: str) -> DataFrame:
    """Business columns of a task from a label map; a label value replaces the source value."""
    columns = {}
    for label, column in COLUMNS[task].items():
        if task == "bid" and column == WINNER_COLUMN:
            continue
        extracted = F.element_at(F.col(values), label)
        columns[column] = F.coalesce(extracted, F.col(column).cast("string")) if column in df.columns else extracted
    return df.withColumns(columns)


def winner_rows(df: DataFrame, origin: str, values: str, money: str, id_col="id", publish="publish_time") -> DataFrame:
    """One row per distinct winner of a notice; the amount stands on the first, the others get 0."""
    winners = F.array_distinct(F.split(F.element_at(F.col(values), WINNER), "#"))
    extracted = F.element_at(F.col(values), "中标金额").try_cast(AMOUNT)
    total = F.when(F.col(money) != 0, F.col(money)).otherwise(F.coalesce(extracted, F.lit(0)))
    return unnest(df, [id_col, publish, total.alias("_total")], winners, WINNER_COLUMN, "_pos").select(
        WINNER_COLUMN,
        F.when(F.col("_pos") == 0, F.col("_total")).otherwise(F.lit(0)).cast(MONEY).alias("amount"),
        F.lit(origin).alias("table_name"),
        F.col(id_col).alias("announcement_id"),
        F.col(publish).alias("publish_time"),
    )


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("")) == ""


def _bad_amount(name: str) -> Column:
    text = F.coalesce(F.col(name).cast("string"), F.lit(""))
    number = text.try_cast("decimal(38,6)")
    return F.contains(text, F.lit("元")) | F.contains(text, F.lit("万")) | number.isNull() | ((number > 0) & (number < 100))


def is_full(task: str, label_names: Column | None = None) -> Column:
    """1 when a notice has what its task requires, else 0."""
    missing = _blank("province") & _blank("city") & _blank("county")
    for name in REQUIRED[task]:
        missing = missing | _blank(name)
    if task == "tender":
        missing = missing | _bad_amount("budget")
    if task == "bid":
        whole = F.length(F.floor(F.abs(F.col("amount").cast("string").try_cast("decimal(38,6)"))).cast("string"))
        missing = missing | _bad_amount("amount") | F.coalesce(whole > 11, F.lit(True))
        for label in REQUIRED_LABELS:
            missing = missing | ~F.array_contains(label_names, label)
    return F.when(missing, F.lit(0)).otherwise(F.lit(1))
