import random

import pytest
from pyspark.sql import functions as F

from conftest import tuples
from noticeloom.operators import compare as X
from noticeloom.operators import spans as S


def rows(docs, data):
    return S.span_rows(docs(data), ["id"]).withColumnRenamed("label_type", "label")


def test_by_position(docs):
    text = "x" * 100
    human = rows(docs, [(1, text, [(0, 2, "a"), (10, 12, "b"), (30, 32, "c"), (60, 62, "d")]), (2, text, [(5, 6, "a")])])
    machine = rows(docs, [(1, text, [(0, 2, "a"), (10, 12, "z"), (33, 35, "c"), (40, 41, "e")]), (2, text, [])])
    got = tuples(X.compare_by_position(human, machine, "id").collect())
    assert got == sorted(
        [
            (1, X.WRONG_TYPE_ANSWER, X.HUMAN, 10, 12, "b"), (1, X.WRONG_TYPE, X.MACHINE, 10, 12, "z"),
            (1, X.WRONG_PLACE_ANSWER, X.HUMAN, 30, 32, "c"), (1, X.WRONG_PLACE, X.MACHINE, 33, 35, "c"),
            (1, X.MISSED_ANSWER, X.HUMAN, 60, 62, "d"), (1, X.EXTRA, X.MACHINE, 40, 41, "e"), (2, X.MISSED_ANSWER, X.HUMAN, 5, 6, "a"),
        ]
    )


def test_by_type(docs):
    text = "x" * 100
    human = rows(docs, [(1, text, [(0, 2, "a"), (4, 6, "a"), (10, 12, "b")])])
    machine = rows(docs, [(1, text, [(0, 2, "a"), (20, 21, "c"), (30, 31, "c")])])
    got = tuples(X.compare_by_type(human, machine, "id").collect())
    assert got == sorted(
        [
            (1, X.HUMAN_TWICE, X.HUMAN, 4, 6, "a"), (1, X.WRONG_PLACE, X.MACHINE, 0, 2, "a"), (1, X.WRONG_PLACE_ANSWER, X.HUMAN, 4, 6, "a"),
            (1, X.MISSED_ANSWER, X.HUMAN, 10, 12, "b"), (1, X.MACHINE_TWICE, X.MACHINE, 30, 31, "c"),
            (1, X.EXTRA, X.MACHINE, 20, 21, "c"), (1, X.EXTRA_FIX, X.HUMAN, 20, 21, "c"), (1, X.EXTRA, X.MACHINE, 30, 31, "c"), (1, X.EXTRA_FIX, X.HUMAN, 30, 31, "c"),
        ]
    )


def test_report_classes(docs):
    text = "".join(chr(97 + i % 26) for i in range(100))
    human = rows(docs, [(1, text, [(0, 3, "near"), (10, 12, "far"), (40, 41, "gone"), (50, 52, "two"), (60, 62, "two"), (70, 71, "same")])])
    machine = rows(docs, [(1, text, [(2, 3, "near"), (20, 22, "far"), (16, 18, "far"), (80, 81, "more"), (50, 52, "two"), (60, 62, "two"), (70, 71, "same")])])
    got = {(r["wrong_type"], r["label_type"]): r for r in X.comparison_report(human, machine, "id").collect()}
    assert set(got) == {(X.AI_WRONG_PLACE, "near"), (X.AI_WRONG, "far"), (X.AI_MISSED, "gone"), (X.AI_EXTRA, "more"), (X.TWICE, "two")}
    far = got[(X.AI_WRONG, "far")]
    assert (far["ai_start"], far["n_candidates"]) == (16, 2)
    assert got[(X.AI_WRONG_PLACE, "near")]["rule_analysis"] == "预测前面多标2个字符"
    missed, extra = got[(X.AI_MISSED, "gone")], got[(X.AI_EXTRA, "more")]
    assert missed["ai_start"] is None and missed["rule_analysis"] == X.AI_MISSED
    assert extra["human_start"] is None and extra["ai_label"] == "c"


def test_report_by_brute_force_without_windows(spark, docs):
    rng = random.Random(6)
    text = "".join(chr(97 + i % 26) for i in range(60))

    def spans():
        return sorted((s, s + rng.randint(1, 3), rng.choice("xy")) for s in (rng.randrange(0, 57, 3) for _ in range(rng.randint(0, 6))))

    sides = [[(i, text, spans()) for i in range(60)] for _ in "hm"]
    report = X.comparison_report(*[rows(docs, side) for side in sides], "id")
    assert "Window" not in report._jdf.queryExecution().executedPlan().toString()  # a sort each, all held by the task
    want = []
    for (i, _, human), (_, _, machine) in zip(*sides):
        for label in "xy":
            h, m = ([s[:2] for s in side if s[2] == label] for side in (human, machine))
            if len(h) > 1:
                want.append((i, label, X.TWICE, *h[0], *h[1], len(m)))
            want += [(i, label, X.AI_MISSED, *s, None, None, 0) for s in h if not m]
            want += [(i, label, X.AI_EXTRA, None, None, *s, len(m)) for s in m if not h]
            for s in (s for s in h if m and s not in m):
                hit = min(m, key=lambda t: (abs(t[0] - s[0]), t))
                want.append((i, label, X.AI_WRONG_PLACE if abs(hit[0] - s[0]) < X.NEAR_BY_TYPE else X.AI_WRONG, *s, *hit, len(m)))
    got = report.select("id", "label_type", "wrong_type", "human_start", "human_end", "ai_start", "ai_end", "n_candidates").collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


@pytest.mark.parametrize(
    "h, a, want",
    [
        ((2, 6), (2, 5), "标签和预测结果相同，但是标签后面有空格"), ((2, 5), (2, 6), "标签和预测结果相同，但是预测后面有空格"), ((2, 5), (1, 5), "标签和预测结果相同，但是预测前面有空格"),
        ((1, 5), (2, 5), "标签和预测结果相同，但是标签前面有空格"), ((1, 6), (2, 5), "标签和预测结果相同，但是标注位置不同"), ((2, 5), (2, 4), "预测后面少标1个字符"),
        ((2, 4), (2, 5), "预测后面多标1个字符"), ((3, 5), (2, 5), "预测前面少标1个字符"), ((2, 5), (4, 5), "预测前面多标2个字符"), ((2, 4), (3, 5), "未分析成功"),
    ],
)
def test_rule_analysis(spark, h, a, want):
    text = "x abc y"
    df = spark.createDataFrame([(*h, text[h[0]:h[1]], *a, text[a[0]:a[1]])], "hs int, he int, hv string, s int, e int, v string")
    assert df.select(X.rule_analysis(*[F.col(c) for c in ("hs", "he", "hv", "s", "e", "v")]).alias("r")).first()["r"] == want


REPORT = "task string, md5 string, human_start int, human_end int, human_label string, ai_start int, ai_end int, ai_label string, label_type string"


def test_fingerprints_review_and_merge(spark):
    report = spark.createDataFrame([("t", "m", 1, 5, "x", None, None, None, "a"), ("t", "m", 15, None, "x", None, None, None, "a")], REPORT)
    marks = X.with_fingerprints(report).select("checked_md5", "human_md5").distinct().count()
    assert marks == 2
    answered = report.withColumn("is_human_correct", F.lit("y"))
    registry = X.with_fingerprints(answered.limit(1)).withColumn("is_human_correct", F.lit("Y"))
    merged = X.merge_reviewed(registry, answered, ["md5"])
    assert sorted(r["is_human_correct"] for r in merged.collect()) == ["Y", "y"]
    assert X.merge_reviewed(registry, answered.withColumn("is_human_correct", F.lit("n")), ["md5"]).count() == 1
    flags = {r["human_start"]: (r["is_human_correct"], r["is_checked"]) for r in X.with_review_flags(report, registry, "checked_md5").collect()}
    assert flags == {1: ("Y", "Y"), 15: (None, None)}


def test_corrections_delete_or_replace_the_first_of_a_type(spark, docs):
    df = docs([(1, "x" * 20, [(0, 1, "a"), (2, 3, "b"), (4, 5, "a")]), (2, "x", [(0, 1, "a")])])
    fixes = spark.createDataFrame(
        [(1, X.MISSED_ANSWER, "a", None, None), (1, X.EXTRA_FIX, "b", 7, 9), (2, "other", "a", None, None)],
        "id int, wrong_type string, label_type string, new_start int, new_end int",
    )
    got = {r["id"]: [tuple(s) for s in r["label"]] for r in X.apply_corrections(df, fixes, "id").collect()}
    assert got == {1: [(7, 9, "b"), (4, 5, "a")], 2: [(0, 1, "a")]}


def test_corrections_of_many_spans(spark):
    spans = [(i, i + 1, f"t{i % 5}") for i in range(30_000)] + [(7, 8, None)]
    df = spark.createDataFrame([(1, spans), (2, [])], "id int, label array<struct<start:int,end:int,label:string>>")
    fixes = spark.createDataFrame([(i, X.HUMAN_TWICE, "t3", None, None) for i in (1, 2)] + [(1, X.HUMAN_TWICE, "t1", 5, 6)], "id int, wrong_type string, label_type string, new_start int, new_end int")
    got = {r["id"]: [tuple(s) for s in r["label"]] for r in X.apply_corrections(df, fixes, "id").collect()}
    assert got == {1: [s if s[0] != 1 else (5, 6, "t1") for s in spans if s[0] != 3], 2: []}


def test_review_rows_show_the_text_around(spark):
    text = "a" * 250 + "XYZ" + "b" * 30 + "Q"
    docs = spark.createDataFrame([(1, text), (2, "no rows")], "doc int, text string")
    rows = spark.createDataFrame(
        [(1, "k1", "人", 250, 253, "T"), (1, "k2", "机器", 283, 284, "U"), (1, "k1", "人", 0, 2, "T"), (1, "k1", "人", 0, 2, "T")],
        "doc int, wrong_type string, labeler string, start int, end int, label string",
    )
    got = X.review_rows(rows, docs, "doc", with_kind=True)
    assert got.columns == ["doc", "wrong_type", "labeler", "label_type", "text", "label", "s_start", "s_end"]
    found = sorted((r["s_start"], r["s_end"], r["text"], tuple(r["label"][0])) for r in got.collect())
    assert found == sorted([
        (50, 284, text[50:] + "\n错误类型T错误种类k1", (200, 203, "T")), (83, 284, text[83:] + "\n错误类型U错误种类k2", (200, 201, "U")),
        *[(0, 202, text[:202] + "\n错误类型T错误种类k1", (0, 2, "T"))] * 2,
    ])
    plain = X.review_rows(rows, docs, "doc", reach=0).filter("s_start = 250").first()
    assert plain["text"] == "XYZ\n错误类型T"
