import hashlib

from pyspark.sql import functions as F

from conftest import tuples
from noticeloom.operators import curate as C
from noticeloom.operators import ranking as K


def test_numbers_follow_the_order_over_partitions(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("t"), F.lit("x" * 20).alias("pad")).repartition(8)
    got = [(r["rn"], r["t"], r["id"]) for r in K.number_rows(df, ["t", "id"]).orderBy("rn").collect()]
    assert [g[0] for g in got] == list(range(1, 1001))
    assert [(g[1], g[2]) for g in got] == sorted((i % 7, i) for i in range(1000))


def test_wide_rows_are_numbered_by_their_keys(spark):
    df = spark.range(300).select("id", F.when(F.col("id") % 7 > 0, F.col("id") % 7).alias("t"), F.lit("x").alias("pad"))
    got = sorted((r["rn"], r["id"], r["pad"]) for r in K.number_wide(df, ["t", "id"]).collect())
    want = sorted(range(300), key=lambda i: (i % 7, i))  # a null time comes first
    assert got == [(n + 1, i, "x") for n, i in enumerate(want)]


def test_numbers_when_one_time_holds_most_rows(spark):
    df = spark.range(900).select("id", F.when(F.col("id") < 600, 5).otherwise(F.col("id") % 9).alias("t"))
    got = [r["id"] for r in K.number_rows(df, ["t", "id"]).orderBy("rn").collect()]
    assert got == [i for _, i in sorted((5 if i < 600 else i % 9, i) for i in range(900))]


def test_running_offsets(spark):
    df = spark.range(200).select("id", (F.col("id") % 5).alias("w"))
    got = {r["id"]: r["off"] for r in K.running_offsets(df, ["id"], {"w": "off"}).collect()}
    assert got == {i: sum(k % 5 for k in range(i)) for i in range(200)}


def order(ids, seed):
    return sorted(ids, key=lambda i: hashlib.md5(f"{seed}{i}".encode()).hexdigest())


def test_exact_split_is_disjoint_and_complete(spark):
    for n in (1, 5, 333):
        got = {r["id"]: r["part"] for r in K.split_by_hash(spark.range(n), "id", 0.8, "s").collect()}
        assert len(got) == n
        assert {i for i, p in got.items() if p == "train"} == set(order(range(n), "s")[: int(n * 0.8)])


def test_cuts_scan_twice(spark, tmp_path):
    spark.range(500).select("id", (F.col("id") % 3 == 0).cast("int").alias("need")).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    for cut in (K.split_by_hash(df, "id", 0.8, "s"), K.balance_and_split(df, "id", "need", 0.8, "s")):
        cut.collect()
        plan = cut._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert "ReusedExchange" in plan or "ReusedSubquery" in plan, final


def test_split_counts_repeated_keys(spark):
    df = spark.range(90).select((F.col("id") % 3).alias("id"))
    sizes = {r["part"]: r["count"] for r in K.split_by_hash(df, "id", 0.5, "s").groupBy("part").count().collect()}
    assert sizes == {"train": 60, "dev": 30}  # equal keys stay together, so the cut takes the whole second key
    assert K.split_by_hash(df.limit(0), "id", 0.5, "s").count() == 0


def test_share_split_is_complete(spark):
    parts = K.split_by_share(spark.range(2000), "id", 0.7, "s").groupBy("part").count().collect()
    sizes = {r["part"]: r["count"] for r in parts}
    assert sum(sizes.values()) == 2000 and abs(sizes["train"] - 1400) < 100


def test_balance_and_split(spark):
    df = spark.range(100).select("id", (F.col("id") < 30).cast("int").alias("need"))
    got = {r["id"]: (r["need"], r["part"]) for r in K.balance_and_split(df, "id", "need", 0.8, "s").collect()}
    pos, neg = order(range(30), "s"), order(range(30, 100), "s")[:30]
    want = {i: (1, "train" if k < 24 else "dev") for k, i in enumerate(pos)} | {i: (0, "train" if k < 24 else "dev") for k, i in enumerate(neg)}
    assert got == want


def test_balance_without_one_class_is_empty(spark):
    df = spark.range(10).select("id", F.lit(1).alias("need"))
    assert K.balance_and_split(df, "id", "need", 0.8, "s").count() == 0


def test_sample_and_first_per_group(spark):
    assert {r["id"] for r in K.sample_by_hash(spark.range(50), "id", 7, "s").collect()} == set(order(range(50), "s")[:7])
    df = spark.range(30).select("id", (F.col("id") % 3).alias("g"))
    assert tuples(K.first_per_group(df, ["g"], ["id"], 2).collect()) == sorted((i, i % 3) for i in range(6))


def test_distinct_first_and_registry(spark):
    df = spark.createDataFrame([("k", 3, "c"), ("k", 1, "a"), ("j", 2, None), (None, 5, "n")], "key string, id int, v string")
    assert sorted(map(str, K.distinct_first(df, ["key"], ["id"]).collect())) == sorted(
        map(str, spark.createDataFrame([("k", 1, "a"), ("j", 2, None), (None, 5, "n")], "key string, id int, v string").collect())
    )
    merged = C.add_to_registry(df.filter("id = 3"), df, "key", ["id"])
    assert {r["key"]: r["id"] for r in merged.collect()} == {"k": 3, "j": 2, None: 5}


def test_curation_small_cases(spark, docs):
    df = docs([(1, "abc", [(0, 1, "预算"), (1, 2, "x")]), (2, "abc", [])])
    cats = {r["id"]: r["c"] for r in df.select("id", C.cats_by_label(F.col("label")).alias("c")).collect()}
    assert cats == {1: {"需要": 1, "不需要": 0}, 2: {"需要": 0, "不需要": 1}}
    same = df.select("id", C.cats_by_disagreement(F.col("label"), F.reverse("label")).alias("c")).collect()
    assert all(r["c"]["需要"] == 0 for r in same)
    up = C.upload_columns(df.withColumn("md5", F.lit("m")), ["预算"]).orderBy("id").collect()
    assert [(r["text"], r["label_counts"], r["预算"]) for r in up] == [("abc@crazy@m", 2, "a"), ("abc@crazy@m", 0, "")]
    scores = spark.createDataFrame([({"a": 0.5, "b": 0.9, "c": 0.9},), ({"a": 0.1},)], "cats map<string,double>")
    got = scores.select(C.best_category(F.col("cats")).alias("b"), C.tags_above(F.col("cats")).alias("t")).collect()
    assert [(r["b"], sorted(r["t"])) for r in got] == [("b", ["b", "c"]), ("a", ["其他"])]
    names = spark.createDataFrame([("bid_train",), ("bid_dev",), ("bid",)], "d string")
    assert [r["p"] for r in names.select(C.project_id(F.col("d"), 37, 38).alias("p")).collect()] == [37, 38, 0]


def test_replace_task_is_by_equality(spark):
    registry = spark.createDataFrame([("tender", 1), ("tendercats", 2), (None, 3)], "task string, id int")
    fresh = spark.createDataFrame([("tender", 9)], "task string, id int")
    assert {r["id"] for r in C.replace_task(registry, fresh, "tender").collect()} == {2, 3, 9}


def test_residences_and_keywords(spark):
    df = spark.createDataFrame([("d", "居住于金牛区甲小区，系主动就诊发现。\n居住于别处乙，系x。\nz")], "date string, text string")
    assert [tuple(r) for r in C.residence_records(df, "date", "text").collect()] == [("d", "金牛区", "甲小区", "主动就诊发现")]
    hits = C.keyword_labels(df, [("A", "甲"), ("B", "乙"), ("A", "没有")], ["text"], ["date"])
    assert tuples(hits.select("label", "keyword").collect()) == [("A", "甲"), ("B", "乙")]
    assert C.without_keywords(df, [("A", "没有")], "text").count() == 1
