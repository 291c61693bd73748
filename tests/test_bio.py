import random

from pyspark.sql import functions as F

from noticeloom.operators import bio as B
from noticeloom.operators.relations import number_entities


def tags_of(text, spans):
    tags = ["O"] * len(text)
    for s, e, n in spans:
        tags[s] = "B-" + n
        for k in range(s + 1, e):
            tags[k] = "I-" + n
    return tags


def test_tags_match_painting_in_order(spark, docs):
    rng = random.Random(4)
    rows = []
    for i in range(30):
        text = "中" * rng.randint(1, 60)
        spans = []
        for _ in range(rng.randint(0, 6)):
            a = rng.randrange(len(text))
            spans.append((a, rng.randint(a + 1, len(text)), rng.choice("XY")))
        rows.append((i, text, spans))
    got = docs(rows).select("id", B.bio_tags(F.length("text"), F.col("label")).alias("t")).orderBy("id").collect()
    for (i, text, spans), row in zip(rows, got):
        want = tags_of(text, spans)
        assert [t[2:] for t in row["t"]] == [t[2:] for t in want]
        flat = all(a[1] <= b[0] for a, b in zip(sorted(spans), sorted(spans)[1:]))
        if flat:
            assert row["t"] == want


def test_round_trip_of_separate_spans(spark, docs):
    rows = [(1, "abcdefgh", [(0, 2, "x"), (2, 4, "y"), (5, 6, "x")]), (2, "ab", []), (3, "a", [(0, 1, "z")])]
    df = docs(rows).withColumn("t", B.bio_tags(F.length("text"), F.col("label")))
    got = df.select("id", B.tag_spans(F.col("t")).alias("s"), B.merge_tokens(B.token_slices(F.col("t"), 3), 3).alias("m")).orderBy("id").collect()
    assert [[tuple(s) for s in r["s"]] for r in got] == [spans for _, _, spans in rows]
    assert [[tuple(s) for s in r["m"]] for r in got] == [spans for _, _, spans in rows]


def one(spark, tags, fn):
    return [tuple(s) for s in spark.createDataFrame([(tags,)], "t array<string>").select(fn(F.col("t")).alias("r")).first()["r"]]


def test_run_type_is_most_frequent_then_first(spark):
    tags = ["B-date", "I-date", "O", "B-sum", "I-unit", "I-unit", "O", "O", "I-sum"]
    assert one(spark, tags, B.tag_spans) == [(0, 2, "date"), (3, 6, "unit"), (8, 9, "sum")]
    assert one(spark, ["B-a", "I-b", "O", "I-c"], B.tag_spans) == [(0, 2, "a"), (3, 4, "c")]


def test_merge_keeps_last_and_skips_other_labels(spark):
    tokens = [(0, 1, 2, "I-a"), (0, 3, 4, "I-a"), (0, 5, 6, "B-b"), (0, 6, 7, "I-c"), (1, 0, 1, "I-b")]
    df = spark.createDataFrame([(tokens,)], "t array<struct<slice:int,start:int,end:int,entity:string>>")
    got = df.select(B.merge_tokens(F.col("t")).alias("r")).first()["r"]
    assert [tuple(s) for s in got] == [(1, 4, "a"), (5, 501, "b")]


def test_vocabulary_and_ids(spark):
    df = spark.createDataFrame([(["x", "y"], ["O", "I-y", "B-x"])], "l array<string>, t array<string>")
    row = df.select(B.tag_vocabulary(F.col("l")).alias("v"), B.tag_ids(F.col("t"), ["O", "B-x", "I-x", "B-y", "I-y"]).alias("i")).first()
    assert row["v"] == ["O", "B-x", "I-x", "B-y", "I-y"] and row["i"] == [0, 4, 1]


def test_tag_windows(spark):
    """A text of 600 in windows of 100: steps of 85, 7 added on either side, 14 where one side is the text's edge."""
    letters = [chr(0x4E00 + i) for i in range(600)]
    rows = [(1, letters, [str(i) for i in range(600)]), (2, list("ab"), ["O", "O"])]
    df = spark.createDataFrame(rows, "id int, data array<string>, label array<string>")
    found = B.tag_windows(df, ["id"], 100, F.size("label")).orderBy("id", "window").collect()
    long = [r for r in found if r["id"] == 1]
    assert [(r["start"], r["end"]) for r in (long[0], long[1], long[2], long[6])] == [(0, 99), (78, 177), (163, 262), (496, 595)]
    assert [(r["start"], r["end"]) for r in found if r["id"] == 2] == [(0, 2)]
    for row in found:
        text, tags = rows[row["id"] - 1][1:]
        assert row["data"] == text[row["start"] : row["end"]] and row["label"] == tags[row["start"] : row["end"]]


def test_tag_windows_leave_no_gap(spark):
    sizes = [1, 9, 10, 11, 57, 100, 333, 1200]
    df = spark.createDataFrame([(n, ["x"] * n) for n in sizes], "id int, data array<string>").withColumn("label", F.col("data"))
    for most in (10, 50, 510):
        found = B.tag_windows(df, ["id"], most, F.size("label")).orderBy("id", "window").collect()
        for n in sizes:
            own = [(r["start"], r["end"]) for r in found if r["id"] == n]
            assert own[0][0] == 0 and len(own) == n // most + 1
            assert all(0 <= s < e <= n and e - s <= most for s, e in own)
            assert all(a[0] < b[0] <= a[1] for a, b in zip(own, own[1:]))


def test_tag_rows(spark, docs):
    df = docs([(1, "a😀", [(1, 2, "e")])]).withColumn("tags", B.bio_tags(F.length("text"), F.col("label")))
    assert [tuple(r) for r in B.tag_rows(df, ["id"]).orderBy("pos").collect()] == [(1, 0, "a", "O"), (1, 1, "😀", "B-e")]


def test_entity_numbers(spark, docs):
    row = docs([(1, "ab", [(0, 1, "x"), (1, 2, "y")])]).select(number_entities(F.col("label")).alias("e")).first()["e"]
    assert [(e["id"], e["label"]) for e in row] == [(1, "x"), (2, "y")]
