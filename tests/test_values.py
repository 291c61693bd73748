from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from noticeloom.functions import values as V
from noticeloom.operators import notices as N


def apply(spark, fn, value):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("1,234.5", "1234.5"), ("12万元", "120000"), ("5%", None), ("无", None), ("", None), ("3 and 4", "3"),
        ("2.675万", "26750"), ("0.00012345万", "1.23"), ("约 7.5 万（8%）", "75000"),
    ],
)
def test_amount(spark, text, want):
    assert apply(spark, V.amount, text) == (None if want is None else Decimal(want))


def test_money_and_unit(spark):
    assert apply(spark, V.money, "无") == 0
    assert apply(spark, V.unit, "万元") == 10000
    assert apply(spark, V.unit, "元") == 1


@pytest.mark.parametrize(
    "text, want",
    [
        ("2023年1月5日", "2023-01-05 00:00:00"), ("2023-01-05 24:00", "2023-01-05 23:59:59"), ("23年1月5日", "2023-01-05 00:00:00"),
        ("1月5日", "2020-01-05 00:00:00"), ("12月5日8时", "2020-12-05 08:00:00"), ("2023年1月", ""), ("20230105", ""), ("无", None),
        ("2023-02-30", ""), ("2023-01-05 10:20:60", ""), ("2023-1-5 1:2:3:4", "2023-01-05 01:02:03"), ("99999999999999999999", ""),
    ],
)
def test_clean_date(spark, text, want):
    assert apply(spark, lambda c: V.clean_date(c, 2020), text) == want


@pytest.mark.parametrize(
    "task, label, value, want",
    [
        ("bid", "中标金额", " 1 2万 ", "120000"), ("bid", "中标金额", "无", "0"), ("tender", "预算", "10.50", "10.5"),
        ("bid", "中标金额单位", "万元", "10000"), ("tender", "开标时间", "2023年1月5日", "2023-01-05 00:00:00"),
        ("bid", "开标时间", "2023年1月5日", "2023年1月5日"), ("bid", "项目名称", " a\tb ", "ab"), ("contract", "金额", "100", "100"),
    ],
)
def test_clean_value(spark, task, label, value, want):
    assert apply(spark, lambda c: V.clean_value(F.lit(task), F.lit(label), c, 2024), value) == want


def test_column_rules(spark):
    got = apply(spark, lambda c: V.clean_value(F.lit("tender"), F.lit("budget"), c, 2024, V.COLUMN_RULES), "3万")
    assert got == "30000"


def test_parse_times_keeps_bad_as_null(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05", "x")], "publish_time string, other string")
    row = V.parse_times(df, V.DATE_COLUMNS["bid"]).first()
    assert str(row["publish_time"]) == "2024-01-02 03:04:05" and row["other"] == "x"
    assert V.parse_times(df.withColumn("publish_time", F.lit("no")), ["publish_time"]).first()["publish_time"] is None


def labels(spark, pairs):
    return spark.createDataFrame([(pairs,)], "l array<struct<label:string,value:string>>")


def test_units_last_amount_and_unit_win(spark):
    df = labels(spark, [("中标金额", "1"), ("中标金额单位", "1"), ("中标金额", "2.5"), ("中标金额单位", "10000"), ("项目名称", "x")])
    got = df.select(N.apply_units(F.col("l")).alias("r")).first()["r"]
    assert [tuple(x) for x in got] == [
        ("中标金额", "25000"), ("中标金额单位", "1"), ("中标金额", "25000"), ("中标金额单位", "10000"), ("项目名称", "x"),
    ]


def test_label_map_joins_winners_else_last_wins(spark):
    df = labels(spark, [("中标单位", "a"), ("项目名称", "p"), ("中标单位", "b"), ("项目名称", "q"), ("中标单位", "a")])
    bid = df.select(N.label_map(F.col("l"), F.lit(True)).alias("m")).first()["m"]
    assert bid == {"中标单位": "a#b#a", "项目名称": "q"}
    other = df.select(N.label_map(F.col("l"), F.lit(False)).alias("m")).first()["m"]
    assert other["中标单位"] == "a"
    assert df.select(N.winners_text(F.col("l")).alias("w")).first()["w"] == "a_b_a"
    none = labels(spark, []).select(N.label_map(F.col("l"), F.lit(True)).alias("m")).first()["m"]
    assert none == {}


def test_winner_rows_amount_on_first_only(spark):
    df = spark.createDataFrame(
        [(1, "t", {"中标单位": "a#b#a", "中标金额": "9"}, Decimal(0)), (2, "t", {"中标单位": "c"}, Decimal(5)), (3, "t", {}, Decimal(5))],
        "id int, publish_time string, m map<string,string>, money decimal(24,6)",
    )
    got = sorted((r["announcement_id"], r["winning_bidder"], float(r["amount"])) for r in N.winner_rows(df, "o", "m", "money").collect())
    assert got == [(1, "a", 9.0), (1, "b", 0.0), (2, "c", 5.0)]


BASE = {"province": "p", "city": "", "county": None, "title": "t", "publish_time": "2024", "amount": "500", "budget": "500",
        "notice_num": "n", "tenderee": "e", "project_name": "x", "tender_document_stime": "s", "tender_etime": "e"}


@pytest.mark.parametrize(
    "task, change, want",
    [
        ("tender", {}, 1), ("tender", {"budget": "99"}, 0), ("tender", {"budget": "0"}, 1), ("tender", {"budget": "5万"}, 0),
        ("tender", {"tender_etime": None}, 0), ("tender", {"province": ""}, 0), ("bid", {}, 1), ("bid", {"amount": "12345678901.5"}, 1),
        ("bid", {"amount": "123456789012"}, 0), ("bid", {"title": ""}, 0), ("bid", {"amount": None}, 0), ("contract", {}, 1), ("contract", {"notice_num": ""}, 0),
    ],
)
def test_is_full(spark, task, change, want):
    row = {**BASE, **change}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} string" for k in row))
    names = F.array(*[F.lit(x) for x in N.REQUIRED_LABELS])
    assert df.select(N.is_full(task, names).alias("f")).first()["f"] == want
    if task == "bid":
        assert df.select(N.is_full(task, F.array(F.lit("项目名称"))).alias("f")).first()["f"] == 0
