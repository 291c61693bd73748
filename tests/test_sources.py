import json
import os

from pyspark.sql import functions as F

from conftest import tuples
from noticeloom.plans.q_sources import _page_files
from noticeloom.sources import drops as D
from noticeloom.sources import extract as X
from noticeloom.sources import files as S
from noticeloom.sources import tables as TB


def test_documents_and_broken_lines(spark, tmp_path):
    path = tmp_path / "d.json"
    path.write_text(json.dumps({"id": "1", "text": "中", "label": [{"start": 0, "end": 1, "label": "x"}]}, ensure_ascii=False) + "\n{broken\n", encoding="utf-8")
    df = S.read_documents(spark, str(path))
    good, bad = S.split_corrupt(df)
    assert [(r["id"], r["text"], r["source"]) for r in good.collect()] == [("1", "中", None)]
    assert [r[S.CORRUPT] for r in bad.collect()] == ["{broken"]
    out = str(tmp_path / "out")
    S.write_documents(good, out)
    assert S.split_corrupt(S.read_documents(spark, out))[0].collect() == good.collect()


def test_lines_and_whole_files(spark, tmp_path):
    (tmp_path / "a b#c.txt").write_text(" x \n\n　\ny\n", encoding="utf-8")
    assert [r["line"] for r in S.read_lines(spark, str(tmp_path)).collect()] == ["x", "y"]
    whole = S.read_whole_files(spark, str(tmp_path)).first()
    assert (whole["name"], whole["text"]) == ("a b#c.txt", " x \n\n　\ny\n")
    sizes = S.file_sizes(spark, str(tmp_path))
    total = S.size_summary(sizes).first()
    assert (total["total"], total["largest"]) == (len(" x \n\n　\ny\n".encode()),) * 2


def test_files_of_one_row_are_dealt_over_a_fixed_number_of_folders(spark, tmp_path):
    html = F.when(F.col("id") != 7, F.concat(F.lit("<p>é\r\n"), F.col("id").cast("string")))
    spark.range(700).select(F.col("id").alias("page_id"), html.alias("html")).write.parquet(f"{tmp_path}/pages.parquet")
    out = _page_files(spark, str(tmp_path))
    folders = os.listdir(out)
    assert len([f for f in folders if "=" in f]) <= S.FOLDERS
    names = [n for f in folders if "=" in f for n in os.listdir(f"{out}/{f}")]
    assert sorted(names) == sorted(f"{i}.txt" for i in range(700))
    whole = {r["name"]: r["text"] for r in S.read_whole_files(spark, out).collect()}
    want = {f"{i}.txt": "\n" if i == 7 else f"<p>é  {i}\n" for i in range(700)}
    assert whole == want
    assert {r["name"]: r["size"] for r in S.file_sizes(spark, out).collect()} == {n: len(t.encode()) for n, t in want.items()}


def test_csv_with_line_ends_in_quotes(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q", b\nc'), (2, None)], "id int, t string")
    S.write_delimited(df, str(tmp_path / "csv"))
    assert tuples(S.read_delimited(spark, str(tmp_path / "csv"), "id int, t string", multi_line=True).filter("id = 1").collect()) == [(1, 'a "q", b\nc')]


def test_standard_documents(spark):
    df = spark.createDataFrame(
        [(2, "<p>a</p>", "u2"), (1, "<b>a</b>\n", "u1"), (3, None, "u"), (4, "x", None)],
        "id int, detail_content string, source_website_address string",
    )
    rows = S.standard_documents(df, "bid", "2024-01-01", "id").collect()
    assert [(r["id"], r["text"], r["source"], r["task"], r["time"]) for r in rows] == [(1, "a\n", "u1", "bid", "2024-01-01")]


def test_named_drops(spark, tmp_path):
    df = spark.createDataFrame([("1", "a")], "id string, text string")
    D.write_drops(df.coalesce(1), str(tmp_path / "in"), "bid", "test_tender_bid", 7)
    assert len(list((tmp_path / "in").glob("bid#test_tender_bid#7-*.json"))) == 1
    good, _ = S.split_corrupt(D.read_drops(spark, str(tmp_path / "in"), "id string, text string"))
    assert tuples(good.collect()) == [("1", "a", "bid", "test_tender_bid")]


def test_partitioned_drops_prune_by_day(spark, tmp_path):
    for name in ("t1", "t2"):
        spark.createDataFrame([(1, 20230105), (2, 20230106)], "id int, dt int").write.partitionBy("dt").json(str(tmp_path / name))
    df = S.read_partitioned_drops(spark, str(tmp_path), ["t1"], "id int").filter("dt = 20230106")
    assert tuples(df.select("id", "dt", "table").collect()) == [(2, 20230106, "t1")]
    assert "PartitionFilters: [isnotnull(dt" in df._jdf.queryExecution().executedPlan().toString()


def test_comments_and_headers(spark):
    posts = spark.createDataFrame([(1, [("a", 1), ("", 2), (None, 3)]), (2, [])], "id int, comments array<struct<body:string,score:int>>")
    assert sorted(S.post_comments(posts, "id").collect(), key=lambda r: r["score"])[1]["body"] is None
    assert S.posts(posts).columns == ["id"]
    both = S.combine_files([spark.createDataFrame([(1,)], "`a_ - b ` int"), spark.createDataFrame([(2, 3)], "`a b` int, c int")])
    assert both.columns == ["a b", "c"] and both.count() == 2
    recs = S.array_records(spark.createDataFrame([('[{"a":1},{"a":2}]',)], "j string"), "j", "a:int")
    assert tuples(recs.collect()) == [(1,), (2,)]


def test_pulls(spark):
    source = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03"), (None, "2024-01-04")], "id int, t string")
    target = spark.createDataFrame([(1, "2024-01-02"), (None, None)], "id int, t string")
    assert {r["id"] for r in X.pull_new(source, target, "t").collect()} == {3, None}
    assert X.pull_new(source, target.filter("false"), "t").count() == 4
    assert {r["id"] for r in X.pull_missing(source, target).collect()} == {2, 3, None}
    assert tuples(X.rows_by_id(spark, source, [1, 3, 99]).collect()) == [(1, "2024-01-01"), (3, "2024-01-03")]
    batches = X.in_batches(source.filter("id is not null"), ["t", "id"], 2)
    assert sorted((r["id"], r["batch"]) for r in batches.collect()) == [(1, 0), (2, 0), (3, 1)]
    assert X.pull_all(source, ["t"]).first()["t"] == "2024-01-01"


def test_validity_split(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (3, None), (4, -1)], "id int, v int")
    good, bad = TB.split_insertable(df, {"id": F.col("id").isNotNull(), "v": F.col("v") > 0})
    assert tuples(good.collect()) == [(1, 5)]
    assert sorted((str(r["id"]), r["reason"]) for r in bad.collect()) == [("3", "v"), ("4", "v"), ("None", "id")]


def test_replace_by_key_twice_is_once(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "C")], "id int, v string")
    once = TB.replace_by_key(target, batch, ["id"])
    assert sorted(map(str, once.collect())) == sorted(map(str, TB.replace_by_key(once, batch, ["id"]).collect()))
    assert {r["v"] for r in once.collect()} == {"a", "B", "C", "n"}
    assert TB.replace_by_key(target, batch.filter("false"), ["id"]).count() == 3


def test_update_columns_last_value_wins(spark):
    target = spark.createDataFrame([(1, "a", "k"), (2, "b", "k")], "id int, v string, w string")
    updates = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (1, None, 3), (9, "z", 1)], "id int, v string, order int")
    assert tuples(TB.update_columns(target, updates, "id", ["v"]).collect()) == [(1, "y", "k"), (2, "b", "k")]


def test_batches_replay_and_tombstones(spark, tmp_path):
    folder = str(tmp_path / "t")
    ddl = "k int, w string"
    one = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], ddl)
    TB.append_batch(one, folder, 0)
    two = spark.createDataFrame([(1, "z")], ddl)
    keys = spark.createDataFrame([(1,), (2,)], "k int")
    for _ in range(2):
        TB.append_batch(two, folder, 1, ["k"], keys)
        assert tuples(TB.read_latest(spark, folder, ["k"]).collect()) == [(1, "z")]
    TB.compact(spark, folder, ["k"], str(tmp_path / "u"))
    assert tuples(TB.read_latest(spark, str(tmp_path / "u"), ["k"]).collect()) == [(1, "z")]


def test_runs_do_not_replace_each_other(spark, tmp_path):
    folder, ddl = str(tmp_path / "t"), "k int, w string"
    frame = lambda *rows: spark.createDataFrame(list(rows), ddl)
    TB.append_batch(frame((1, "a"), (2, "a"), (None, "a")), folder, 0, run="one")
    TB.append_batch(frame((3, "a")), folder, 1, run="one")
    TB.append_batch(frame((2, "b"), (4, "b")), folder, 0, run="two")
    current = lambda f: sorted(map(str, tuples_of(TB.read_latest(spark, f, ["k"]))))
    want = sorted(map(str, [(1, "a"), (2, "b"), (3, "a"), (4, "b"), (None, "a")]))
    assert current(folder) == want
    TB.append_batch(frame((3, "a")), folder, 1, run="one")  # a replay is older than the second run
    assert current(folder) == want
    new = str(tmp_path / "u")
    TB.compact(spark, folder, ["k"], new)
    assert current(new) == want
    TB.append_batch(frame((1, "c")), new, 0, run="three")  # a fresh job starts at batch 0 again
    assert current(new) == sorted(map(str, [(1, "c"), (2, "b"), (3, "a"), (4, "b"), (None, "a")]))


def tuples_of(df):
    return [tuple(r) for r in df.collect()]


def test_near_stamps_keep_every_file(spark, tmp_path):
    folder = str(tmp_path / "drops")
    for stamp in (100, 102, 102):
        D.write_drops(spark.range(8).selectExpr("cast(id as string) id").repartition(4), folder, "bid", "t", stamp)
    back = D.read_drops(spark, folder, "id string")
    assert back.count() == 24
    assert {(r["task"], r["table"]) for r in back.select("task", "table").distinct().collect()} == {("bid", "t")}
