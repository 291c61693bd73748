import random

import pytest

from conftest import tuples
from pyspark.sql import functions as F

from noticeloom.operators import relations as R
from noticeloom.operators import spans as S


def scores(spark, seed=5):
    rng = random.Random(seed)
    rows = [(d, t, rng.random(), rng.random()) for d in range(4) for t in range(40)]
    return rows, spark.createDataFrame(rows, "doc int, token int, start_score double, end_score double")


@pytest.mark.parametrize("low, high", [(0, 5), (2, 3), (1, 100)])
def test_candidates_match_all_pairs(spark, low, high):
    rows, df = scores(spark)
    got = tuples(R.span_candidates(df, "doc", 0.6, low, high).collect())
    want = sorted(
        (a[0], a[1], b[1] + 1)
        for a in rows for b in rows
        if a[0] == b[0] and a[2] >= 0.6 and b[3] >= 0.6 and 0 < b[1] + 1 - a[1] <= high and b[1] + 1 - a[1] >= low
    )
    assert got == want


def test_unbounded_candidates_are_counted(spark):
    rows, df = scores(spark)
    with pytest.raises(ValueError):
        R.span_candidates(df, "doc", 0.6, 0, 0)
    got = tuples(R.span_candidate_ranges(df, "doc", 0.6, 3).collect())
    want = sorted((a[0], a[1], sum(1 for b in rows if b[0] == a[0] and b[3] >= 0.6 and b[1] + 1 - a[1] >= 3)) for a in rows if a[2] >= 0.6)
    assert got == want


def test_boundary_truth(spark, docs):
    df = docs([(1, "abcd", [(0, 2, "x"), (1, 2, "x"), (9, 12, "x")]), (2, "", []), (3, "ab", []), (4, "a😀", [(1, 2, "x")])])
    want = [(1, 0, 1, 0), (1, 1, 1, 1), (1, 2, 0, 0), (1, 3, 0, 0), (3, 0, 0, 0), (3, 1, 0, 0), (4, 0, 0, 0), (4, 1, 1, 1)]
    rows = R.boundary_truth(df, ["id"], F.length("text"))
    assert tuples(rows.collect()) == want
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("reach", [0, 1, 7, 100])
def test_near_pairs_match_all_pairs(spark, docs, reach):
    rng = random.Random(6)
    rows = [(i, "x" * 200, sorted({(s, s + 3, "e") for s in rng.sample(range(190), 12)})) for i in range(3)]
    got = tuples(R.near_pairs(S.bare_spans(docs(rows), ["id"]), "id", reach).collect())
    want = sorted(
        (i, p, q, a[0], b[0])
        for i, _, spans in rows for p, a in enumerate(spans) for q, b in enumerate(spans)
        if p != q and reach and abs(a[0] - b[0]) <= reach
    )
    assert got == want


def test_truth_keeps_far_relations(spark):
    pairs = spark.createDataFrame([(1, 0, 1), (1, 1, 0)], "doc int, from_pos int, to_pos int")
    rels = spark.createDataFrame([(1, 0, 1, "a"), (1, 0, 9, "b")], "doc int, from_pos int, to_pos int, type string")
    got = {(r["from_pos"], r["to_pos"]): r["truth"] for r in R.relation_truth(pairs, rels, "doc", ["a", "b"]).collect()}
    assert got == {(0, 1): {"a": 1.0, "b": 0.0}, (1, 0): {"a": 0.0, "b": 0.0}, (0, 9): {"a": 0.0, "b": 1.0}}
    assert tuples(R.relation_types(rels).collect()) == [("a",), ("b",)]


def test_blocks_expand_to_the_listed_relations(spark, docs):
    names = ["中标单位", "中标金额", "中标金额单位", "其他"]
    rng = random.Random(7)
    rows = [(i, "x" * 30, [(k, k + 1, rng.choice(names)) for k in range(12)]) for i in range(4)]
    df = docs(rows)
    got = tuples(R.expand_blocks(R.relation_blocks(df, "id"), df, "id").collect())
    want = []
    for i, _, spans in rows:
        n = 0
        for a, (_, _, la) in enumerate(spans):
            for source, to in R.NER_PAIRS:
                if la == source:
                    for b, (_, _, lb) in enumerate(spans):
                        if lb == to:
                            n += 1
                            want.append((i, n, a + 1, b + 1, f"{source}-{to}"))
    assert got == sorted(want)


def test_label_relations_number_on_over_documents(spark):
    df = spark.createDataFrame(
        [(i, [(0, 1, "a")] * (i % 3), [(0, 1, "t", 0.9 if i % 2 else 0.2)] * (i % 3)) for i in range(50)],
        "doc int, label array<struct<start:int,end:int,label:string>>, scores array<struct<from_pos:int,to_pos:int,type:string,score:double>>",
    )
    rows = R.label_relations(df, "doc", 100, 500).orderBy("doc").collect()
    assert [e["id"] for r in rows for e in r["entities"]] == list(range(100, 100 + sum(i % 3 for i in range(50))))
    rel = [x["id"] for r in rows for x in r["relations"]]
    assert rel == list(range(500, 500 + len(rel))) and len(rel) == sum(i % 3 for i in range(50) if i % 2)
    first = rows[1]
    assert (first["relations"][0]["from_id"], first["relations"][0]["to_id"]) == (first["entities"][0]["id"], first["entities"][0]["id"] + 1)
    last = R.last_ids(R.label_relations(df, "doc", 100, 500)).first()
    assert (last["ent_id"], last["rel_id"]) == (100 + sum(i % 3 for i in range(50)) - 1, 500 + len(rel) - 1)


def test_views_merge_events_of_an_entity(spark):
    df = spark.createDataFrame(
        [(
            1, "甲乙丙丁",
            [(10, "e", 0, 1), (11, "e", 1, 2), (12, "e", 2, 3), (13, "e", 3, 4)],
            [(1, 10, 11, "实体事件"), (2, 10, 12, "实体时间"), (3, 10, 13, "实体事件"), (4, 11, 12, "概念解释"), (5, 12, 13, "实体观点")],
        )],
        "doc int, text string, entities array<struct<id:int,label:string,start_offset:int,end_offset:int>>, relations array<struct<id:int,from_id:int,to_id:int,type:string>>",
    )
    views = R.relation_views(df, "doc")
    assert tuples(views["concepts"].collect()) == [(1, "乙", "丙")]
    assert tuples(views["views"].collect()) == [(1, "丙", "丁")]
    assert [tuple(r) for r in views["events"].collect()] == [(1, 10, "甲", "丁", "丙", None)]
