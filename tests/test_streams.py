import pytest
from pyspark.sql import functions as F

from conftest import tuples
from noticeloom.operators.annotate import annotate, term_matcher
from noticeloom.operators.spans import phrase_spans
from noticeloom.plans.notice_load import load_notices
from noticeloom.sources import commits as C
from noticeloom.sources.commits import read_all, read_current
from noticeloom.sources.drops import drop_stream, write_drops
from noticeloom.sources.files import CORRUPT
from noticeloom.streaming import jobs as J

TERMS = [("中标单位", "甲公司"), ("中标单位", "乙公司"), ("项目名称", "大桥"), ("中标金额", "12万元"), ("中标公告编号", "N-1")]
COLUMNS = "id string, title string, detail_content string, source_website_address string, publish_time string, update_time string, amount string, province string, city string, county string"
ROWS = [
    ("1", "t", "<p>甲公司 乙公司 甲公司 大桥 N-1 12万元</p>", "u", "2024-01-05 08:00:00", "x", None, "四川", "", None),
    ("2", "t", "<p>无</p>", "u", "bad", "x", "300", "四川", "", None),
    ("3", "t", None, "u", "2024-01-05", "x", None, "", "", None),
]


def spans(df):
    return df.withColumn("label", phrase_spans(F.col("text"), TERMS))


def gold(spark):
    return spark.createDataFrame([], "md5 string, label array<struct<start:int,end:int,label:string>>")


def test_load_bid_notices(spark):
    parents, winners = load_notices(spark.createDataFrame(ROWS, COLUMNS), "test_tender_bid_result", gold(spark), spans, 2024)
    got = {r["id"]: r for r in parents.collect()}
    one = got["1"]
    assert (one["winning_bidder"], one["project_name"], one["notice_num"], float(one["amount"]), one["is_full_data"]) == ("甲公司_乙公司_甲公司", "大桥", "N-1", 120000.0, 1)
    assert one["result_detail"] == "'甲公司乙公司甲公司大桥N112万元'" and str(one["publish_time"]) == "2024-01-05 08:00:00"
    assert one["labels"].startswith('[{"中标单位":"甲公司"}') and "detail_content" not in parents.columns
    assert (got["2"]["winning_bidder"], float(got["2"]["amount"]), got["2"]["is_full_data"], got["2"]["publish_time"]) == ("", 300.0, 0, None)
    assert got["3"]["is_full_data"] == 0 and got["3"]["result_detail"] == ""
    assert tuples(winners.select("winning_bidder", F.col("amount").cast("double"), "table_name", "announcement_id").collect()) == [
        ("乙公司", 0.0, "test_tender_bid_result", "1"), ("甲公司", 120000.0, "test_tender_bid_result", "1"),
    ]


def test_gold_labels_replace_predicted_ones(spark):
    rows = spark.createDataFrame(ROWS[:1], COLUMNS)
    known = spark.createDataFrame([("甲公司乙公司甲公司大桥N-112万元\n",)], "t string").select(
        F.md5("t").alias("md5"), F.array(F.struct(F.lit(3).alias("start"), F.lit(6).alias("end"), F.lit("中标单位").alias("label"))).alias("label")
    )
    parents, winners = load_notices(rows, "test_tender_bid_result", known, spans, 2024)
    assert parents.first()["winning_bidder"] == "乙公司" and [r["winning_bidder"] for r in winners.collect()] == ["乙公司"]


@pytest.mark.parametrize("origin, flagged", [("test_tender_bid", True), ("test_procurement_bid", False)])
def test_load_tender_notices(spark, origin, flagged):
    terms = [("预算", "12万元"), ("开标时间", "2024年2月3日"), ("项目名称", "大桥")]
    rows = spark.createDataFrame(ROWS[:1], COLUMNS).withColumns({"budget": F.lit(None).cast("string"), "detail_content": F.lit("大桥 2024年2月3日 12万元")})
    parents, winners = load_notices(rows, origin, gold(spark), lambda d: d.withColumn("label", phrase_spans(F.col("text"), terms)), 2024)
    row = parents.first()
    assert winners is None and float(row["budget"]) == 120000.0 and str(row["bid_opening_time"]) == "2024-02-03 00:00:00"
    assert ("is_full_data" in parents.columns) == flagged


def test_load_contract_notices(spark):
    rows = spark.createDataFrame(ROWS[:1], COLUMNS).withColumn("winning_bidder", F.lit("old"))
    terms = [("招标公司", "甲公司"), ("项目编号", "N-1"), ("金额", "12万元")]
    parents, _ = load_notices(rows, "test_tender_trade_result", gold(spark), lambda d: d.withColumn("label", phrase_spans(F.col("text"), terms)), 2024)
    row = parents.first()
    assert (row["tenderee"], row["notice_num"], row["amount"], row["is_full_data"]) == ("甲公司", "N-1", "120000", 1)
    assert "winning_bidder" not in parents.columns


def test_notice_stream_equals_batch_and_restarts_clean(spark, tmp_path):
    drops, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    rows = spark.createDataFrame(ROWS, COLUMNS)
    write_drops(rows.coalesce(1), drops, "bid", "test_tender_bid_result", 1)
    write_drops(rows.limit(1).coalesce(1), drops, "bid", "unknown", 2)
    (tmp_path / "in" / "bid#test_tender_bid_result#3.json").write_text("{broken\n")

    def run():
        stream = drop_stream(spark, drops, rows.schema)
        J.notice_stream(stream, out, {"bid": gold(spark)}, spans, 2024, check).awaitTermination()
        parents = read_current(spark, out, "final_tender_bid_result", ["id"])
        winners = read_current(spark, out, J.WINNERS, ["table_name", "announcement_id"])
        return tuples(parents.select("id", "winning_bidder", "is_full_data").collect()), tuples(winners.select("announcement_id", "winning_bidder").collect())

    parents, winners = load_notices(spark.createDataFrame(ROWS, COLUMNS), "test_tender_bid_result", gold(spark), spans, 2024)
    want = tuples(parents.select("id", "winning_bidder", "is_full_data").collect()), tuples(winners.select("announcement_id", "winning_bidder").collect())
    assert run() == want
    bad = read_all(spark, out, "quarantine")
    assert sorted((r["table"], r[CORRUPT]) for r in bad.collect()) == [("test_tender_bid_result", "{broken"), ("unknown", None)]
    assert run() == want
    again = spark.createDataFrame([(*ROWS[0][:2], "<p>乙公司</p>", *ROWS[0][3:])], COLUMNS)
    write_drops(again.coalesce(1), drops, "bid", "test_tender_bid_result", 9)
    got = run()
    assert got[1] == [("1", "乙公司")] and len(got[0]) == 3


def test_restart_adds_no_rows_and_archives(spark, tmp_path):
    drops, out, check, done = (str(tmp_path / n) for n in ("in", "out", "check", "done"))
    spark.createDataFrame([(1, "甲公司"), (2, "x")], "id int, text string").coalesce(1).write.json(drops)
    schema = J.sample_schema(spark, drops)
    for _ in range(2):
        stream = annotate(J.document_stream(spark, drops, schema, archive=done), term_matcher(TERMS))
        J.append_stream(stream, out, check).awaitTermination()
    rows = spark.read.parquet(out).orderBy("id").collect()
    assert [(r["id"], [tuple(s) for s in r["label"]]) for r in rows] == [(1, [(0, 3, "中标单位")]), (2, [])]


def test_a_failing_batch_does_not_stop_the_stream(spark, tmp_path):
    drops, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    rows = spark.createDataFrame(ROWS, COLUMNS)
    write_drops(rows.limit(1).coalesce(1), drops, "tender", "test_tender_bid", 1)  # no gold for its task
    poison = spark.createDataFrame([("9", *ROWS[0][1:2], "<p>poison</p>", *ROWS[0][3:])], COLUMNS)

    def fragile(df):
        broken = F.when(F.contains("text", F.lit("poison")), F.raise_error(F.lit("model broke")))
        return spans(df.withColumn("text", F.coalesce(broken.cast("string"), F.col("text"))))

    for drop in (poison, None):  # one batch with the poison, one without
        if drop is not None:
            write_drops(drop.coalesce(1), drops, "bid", "test_tender_bid_result", 3)
        else:
            write_drops(rows.coalesce(1), drops, "bid", "test_tender_bid_result", 4)
        J.notice_stream(drop_stream(spark, drops, rows.schema), out, {"bid": gold(spark)}, fragile, 2024, check).awaitTermination()
    assert read_current(spark, out, "final_tender_bid_result", ["id"]).count() == len(ROWS)
    failed = read_all(spark, out, "failed/test_tender_bid_result").collect()
    assert [r["id"] for r in failed] == ["9"] and "model broke" in failed[0]["reason"]
    assert "KeyError" in read_all(spark, out, "failed/test_tender_bid").first()["reason"]


class Killed(BaseException):
    """The process ends here: nothing below may catch it."""


def test_parents_and_winners_come_together_or_not_at_all(spark, tmp_path, monkeypatch):
    store, frames = str(tmp_path / "store"), {}
    parents = spark.createDataFrame([("1", "old")], "id string, v string")
    frames = {"parents": parents, "winners": parents.withColumnRenamed("v", "w")}
    assert C.commit(spark, store, "run:0", frames)

    def killed(*_):
        raise Killed

    newer = {name: df.select("id", F.lit("new").alias(df.columns[1])) for name, df in frames.items()}
    with monkeypatch.context() as patch:
        patch.setattr(C, "_publish", killed)  # both tables are written, nothing is published
        with pytest.raises(Killed):
            C.commit(spark, store, "run:1", newer)
    one = {"parents": newer["parents"], "winners": newer["winners"].withColumn("w", F.raise_error(F.lit("lost")))}
    with pytest.raises(Exception, match="lost"):
        C.commit(spark, store, "run:1", one)  # the second table fails after the first one is written

    def state():
        return [read_current(spark, store, t, ["id"]).first()[1] for t in ("parents", "winners")]

    assert state() == ["old", "old"]
    assert C.commit(spark, store, "run:1", newer) and state() == ["new", "new"]
    assert not C.commit(spark, store, "run:1", frames) and state() == ["new", "new"]  # a replay changes nothing
    assert C.sweep(spark, store, "parents", 1 << 62) == 2 and state() == ["new", "new"]


def test_loads_that_publish_at_once_take_different_numbers(spark, tmp_path, monkeypatch):
    store, plain = str(tmp_path / "store"), C.commits
    df = spark.createDataFrame([("1", "a")], "id string, v string")
    stale = []

    def seen_before(*args):  # the first look is older than a load published meanwhile
        if not stale:
            stale.append(plain(*args))
            C_publish_other()
            return stale[0]
        return plain(*args)

    def C_publish_other():
        monkeypatch.setattr(C, "commits", plain)
        C.commit(spark, store, "other:0", {"t": df.withColumn("v", F.lit("other"))})
        monkeypatch.setattr(C, "commits", seen_before)

    C.commit(spark, store, "first:0", {"t": df})
    publish = C._publish

    def racing(*args):
        monkeypatch.setattr(C, "commits", seen_before)
        return publish(*args)

    monkeypatch.setattr(C, "_publish", lambda *a: publish(*a) if a[2].startswith("other") else racing(*a))
    assert C.commit(spark, store, "mine:0", {"t": df.withColumn("v", F.lit("mine"))})
    monkeypatch.undo()
    assert [(c.number, c.load) for c in C.commits(spark, store)] == [(1, "first:0"), (2, "other:0"), (3, "mine:0")]
    assert read_current(spark, store, "t", ["id"]).first()["v"] == "mine"


def test_compaction_and_marks_of_keys_that_go(spark, tmp_path):
    store = str(tmp_path / "store")

    def rows(*pairs):
        return spark.createDataFrame(pairs, "id string, v string")

    assert read_current(spark, store, "t", ["id"]) is None and not C.compact(spark, store, "t", ["id"])
    C.commit(spark, store, "a", {"t": rows(("1", "a"), ("1", "b"), ("2", "c"), (None, "n"))})
    C.commit(spark, store, "b", {"t": C.with_gone(rows(("3", "d")), ["id"], rows(("1", ""), ("3", "")))})
    want = [("2", "c"), ("3", "d")]

    def current():
        return sorted(tuple(r) for r in read_current(spark, store, "t", ["id"]).collect() if r["id"])

    assert current() == want
    assert C.compact(spark, store, "t", ["id"]) and current() == want
    C.commit(spark, store, "c", {"t": rows(("2", "e"))})
    assert current() == [("2", "e"), ("3", "d")] and not C.commit(spark, store, "a", {"t": rows(("9", "z"))})
    assert C.sweep(spark, store, "t", 1 << 62) == 2 and current() == [("2", "e"), ("3", "d")]
    assert read_current(spark, store, "t", ["id"]).filter("id IS NULL").count() == 1


def test_notice_stream_killed_between_two_tables(spark, tmp_path, monkeypatch):
    drops, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    rows = spark.createDataFrame(ROWS, COLUMNS)
    write_drops(rows.coalesce(1), drops, "bid", "test_tender_bid_result", 1)

    def run():
        J.notice_stream(drop_stream(spark, drops, rows.schema), out, {"bid": gold(spark)}, spans, 2024, check).awaitTermination()

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch:
        patch.setattr(C, "_publish", killed)  # nothing can be published any more, not even the rows that are set aside
        with pytest.raises(Exception, match="killed"):
            run()
    assert read_current(spark, out, "final_tender_bid_result", ["id"]) is None and read_current(spark, out, J.WINNERS, ["announcement_id"]) is None
    run()
    run()
    assert read_current(spark, out, "final_tender_bid_result", ["id"]).count() == 3
    assert read_all(spark, out, J.WINNERS).count() == 2


def test_registry_stream_equals_batch_over_restarts(spark, tmp_path):
    drops, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    parts = [[("a", "2024-01-03"), ("b", "2024-01-03"), ("a", "2024-01-01")], [("c", "1999-01-01"), ("a", "2024-01-04"), (None, "x")], [("b", "1990-01-01"), ("d", None), (None, "y"), ("d", "z")]]

    def run(keep):
        stream = J.document_stream(spark, drops, "md5 string, time string", max_files=1, latest_first=False)
        J.registry_stream(stream, out, check, keep=keep).awaitTermination()
        return sorted((r["md5"] or "" for r in read_all(spark, out, "registry").collect()))

    seen = set()
    for i, part in enumerate(parts):  # with no time to keep, only the table can know the earlier rows
        spark.createDataFrame(part, "md5 string, time string").coalesce(1).write.mode("append").json(drops)
        seen |= {m or "" for m, _ in part}
        assert run("0 seconds") == sorted(seen)
    assert run("0 seconds") == sorted(seen)


def test_registry_state_expires(spark, tmp_path):
    drops, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    held = []
    for i in range(4):
        spark.range(i * 100, i * 100 + 150).selectExpr("cast(id as string) md5").coalesce(1).write.mode("append").json(drops)
        query = J.registry_stream(J.document_stream(spark, drops, "md5 string"), out, check, keep="1 second")
        query.awaitTermination()
        held.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert sorted(int(r["md5"]) for r in read_all(spark, out, "registry").collect()) == list(range(450))
    assert max(held) < 450


def test_drop_source_reads_by_name_and_in_ranges(spark, tmp_path):
    folder = str(tmp_path / "in")
    for table, stamp in (("a", 1), ("a", 5), ("b", 5)):
        write_drops(spark.range(stamp * 1000, stamp * 1000 + 500).selectExpr("id", "repeat('é\n', id % 7) AS t").repartition(3), folder, "bid", table, stamp)
    (tmp_path / "in" / "bid#broken.json").write_text('{"id": 1, "t": "x"}\n\n{oops')
    from noticeloom.sources.drops import read_drops

    for split in (64 << 20, 1700):
        got = read_drops(spark, folder, "id bigint, t string", table="a", since=2, splitBytes=split).collect()
        assert sorted(r["id"] for r in got) == list(range(5000, 5500)) and all(r["t"] == "é\n" * (r["id"] % 7) and r["table"] == "a" for r in got)
    every = read_drops(spark, folder, "id bigint, t string")
    assert every.count() == 1502 and [r[CORRUPT] for r in every.filter(f"{CORRUPT} IS NOT NULL").collect()] == ["{oops"]
    assert read_drops(spark, str(tmp_path / "nowhere"), "id bigint").count() == 0


def test_drop_stream_bounds_batches_finds_late_stamps_and_archives(spark, tmp_path):
    drops, out, check, done = (str(tmp_path / n) for n in ("in", "out", "check", "done"))
    one = spark.range(1).selectExpr("id")
    for stamp in range(10, 15):
        write_drops(one.selectExpr(f"{stamp} AS id"), drops, "t", "x", stamp)

    def start(trigger):
        stream = drop_stream(spark, drops, "id bigint", maxFiles=2, archive=done)
        return stream.select("id").writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(**trigger).start()

    def ids():
        return sorted(r["id"] for r in spark.read.parquet(out).collect())

    query = start({"processingTime": "0 seconds"})
    query.processAllAvailable()
    assert ids() == [10, 11, 12, 13, 14]
    for stamp in (3, 20, 21, 22, 23):  # the first has a stamp below those already read
        write_drops(one.selectExpr(f"{stamp} AS id"), drops, "t", "x", stamp)
    query.processAllAvailable()
    batches = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    query.stop()
    assert ids() == [3, 10, 11, 12, 13, 14, 20, 21, 22, 23] and max(batches[1:]) <= 2
    assert len(list((tmp_path / "done").iterdir())) >= 8
    write_drops(one.selectExpr("30 AS id"), drops, "t", "x", 30)
    start({"availableNow": True}).awaitTermination()
    start({"availableNow": True}).awaitTermination()
    assert ids() == [3, 10, 11, 12, 13, 14, 20, 21, 22, 23, 30]


def test_low_water_mark(spark, tmp_path):
    from noticeloom.sources.drops import read_drops, top_up, waiting

    folder = str(tmp_path / "in")
    source = spark.range(100).selectExpr("id", "id * 2 AS v")
    written = [top_up(spark.range(i * 10, i * 10 + 10), source.coalesce(1), folder, "t", "x", i, low=3) for i in range(5)]
    assert written == [True, True, True, False, False] and waiting(folder) == 3
    assert sorted(r["id"] for r in read_drops(spark, folder, "id bigint, v bigint").collect()) == list(range(30))


def test_drops_are_written_as_bytes_of_the_batch(spark, tmp_path):
    import pyarrow as pa
    from noticeloom.sources.drops import DropWriter
    from pyspark.sql.datasource import DataSourceArrowWriter

    assert issubclass(DropWriter, DataSourceArrowWriter)  # rows of Python would hold a batch many times over
    rows = spark.sql("SELECT id, repeat('é😀', 3) AS t FROM range(5)")
    write_drops(rows.repartition(3), str(tmp_path / "in"), "bid", "a", 1)
    lines = sorted(line for f in (tmp_path / "in").glob("*.json") for line in f.read_text().splitlines())
    assert lines == [f'{{"id":{i},"t":"{"é😀" * 3}"}}' for i in range(5)]


def test_small_frames_and_stream_files_grow_with_the_scan(spark):
    from noticeloom.plans.q_streams import several
    from noticeloom.session import few_rows

    rows = few_rows(spark, [{"a": "x", "n": 1}], "a string, n long")
    assert [tuple(r) for r in rows.collect()] == [("x", 1)] and few_rows(spark, [], "a string, n long").count() == 0
    assert "ExistingRDD" not in rows._jdf.queryExecution().toString()
    assert several(spark.range(100, numPartitions=9)).rdd.getNumPartitions() == 9
    assert several(spark.range(100, numPartitions=2)).rdd.getNumPartitions() == 4
