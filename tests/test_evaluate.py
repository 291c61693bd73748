import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import tuples
from noticeloom.operators import bio as B
from noticeloom.operators import evaluate as E

SPANS = "doc int, start int, end int, label string"


def test_span_scores_per_type_and_all(spark):
    gold = spark.createDataFrame([(1, 0, 1, "a"), (1, 2, 3, "b"), (2, 0, 1, "a")], SPANS)
    pred = spark.createDataFrame([(1, 0, 1, "a"), (1, 2, 3, "a"), (2, 5, 6, "c")], SPANS)
    got = {r["item"]: (r["tp"], r["fp"], r["fn"], round(r["f"], 4)) for r in E.span_scores(gold, pred, "doc").collect()}
    assert got == {"a": (1, 1, 1, 0.5), "b": (0, 0, 1, 0.0), "c": (0, 1, 0, 0.0), "ALL": (1, 2, 2, 0.3333)}
    loose = E.span_scores(gold, pred, "doc", labelled=False).first()
    assert (loose["tp"], loose["fp"], loose["fn"]) == (2, 1, 1)


def test_empty_sides_score_zero(spark):
    none = spark.createDataFrame([], SPANS)
    some = spark.createDataFrame([(1, 0, 1, "a")], SPANS)
    row = E.span_scores(none, some, "doc").filter("item = 'a'").first()
    assert (row["tp"], row["fp"], row["fn"], row["p"], row["r"], row["f"]) == (0, 1, 0, 0.0, 0.0, 0.0)


def test_relation_scores_count_predicted_misses_only(spark):
    key = "doc int, a int, b int, type string"
    gold = spark.createDataFrame([(1, 0, 1, "x"), (1, 1, 2, "x"), (1, 2, 3, "x")], key)
    pred = spark.createDataFrame([(1, 0, 1, "x", 0.5), (1, 1, 2, "x", 0.4), (1, 9, 9, "x", 0.9)], key + ", score double")
    plain = E.relation_scores(gold, pred, ["doc", "a", "b", "type"], 0.5).first()
    assert (plain["tp"], plain["fp"], plain["fn"]) == (1, 1, 1)
    strict = E.relation_scores(gold, pred, ["doc", "a", "b", "type"], 0.5, True).first()
    assert (strict["tp"], strict["fp"], strict["fn"]) == (1, 1, 2)


def test_tag_scores_skip_ignored(spark):
    df = spark.createDataFrame(
        [(1, ["B-a", "I-a", "-100", "O", "B-b"], ["B-a", "I-a", "B-c", "O", "O"])], "doc int, gold_tags array<string>, pred_tags array<string>"
    )
    row = E.tag_scores(df, "doc").first()
    assert (row["precision"], row["recall"], round(row["f1"], 4), row["accuracy"]) == (1.0, 0.5, 0.6667, 0.75)


def test_piece_scores_are_the_tag_scores_of_the_painted_tags(spark, docs, monkeypatch):
    rng = random.Random(4)

    def spans(n):
        starts = [rng.randrange(n - 1) for _ in range(rng.choice([0, 1, 3, 9]))]
        return [(s, rng.randint(s + 1, min(n, s + 6)), rng.choice("xyz")) for s in starts]

    sizes = [rng.choice([2, 12, 40]) for _ in range(120)]
    gold, pred = [[spans(n) for n in sizes] for _ in "gp"]
    pred[:10] = gold[:10]
    df = docs([(i, "a" * n, g) for i, (n, g) in enumerate(zip(sizes, gold))])
    other = docs([(i, "", p) for i, p in enumerate(pred)]).select("id", F.col("label").alias("pred"))
    both = df.join(other, "id").select("id", F.length("text").alias("n"), "label", "pred")
    tags = both.select("id", "n", *[B.bio_tags(F.col("n"), F.col(c)).alias(t) for c, t in (("label", "gold_tags"), ("pred", "pred_tags"))])
    pieces = both.select("id", "n", B.tag_pieces(F.col("label")).alias("g"), B.tag_pieces(F.col("pred")).alias("p"))
    want = [
        (r["id"], r["g"], r["p"], sum(a == b for a, b in zip(r["gold_tags"], r["pred_tags"])))
        for r in tags.select("*", B.tag_spans(F.col("gold_tags")).alias("g"), B.tag_spans(F.col("pred_tags")).alias("p")).collect()
    ]
    same = B.same_tags(F.col("n"), F.col("g"), F.col("p"))
    assert tuples(pieces.select("id", B.piece_spans(F.col("g")), B.piece_spans(F.col("p")), same).collect()) == sorted(want)
    scores = E.tag_scores(tags, "id").first()
    assert 0 < scores["f1"] < 1
    monkeypatch.setattr(E, "tag_spans", None)  # no tag per character is made of the pieces
    assert E.piece_scores(pieces, "id", "n", "g", "p").first() == scores


def test_tag_scores_read_their_rows_once(spark, tmp_path):
    rows = [(1, ["B-a", "I-a"], ["B-a", "O"]), (1, ["B-a", "I-a"], ["B-a", "O"])]  # rows of one id count twice in the accuracy
    spark.createDataFrame(rows, "doc int, gold_tags array<string>, pred_tags array<string>").write.parquet(str(tmp_path / "t"))
    scores = E.tag_scores(spark.read.parquet(str(tmp_path / "t")), "doc")
    assert scores.first()["accuracy"] == 0.5
    assert scores._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_overlap_scores(spark):
    df = spark.createDataFrame([(1, "the cat the", "The cat!"), (2, "", "x")], "id int, pred string, ref string")
    row = E.overlap_scores(df, "pred", "ref", 1).first()
    assert (row["rouge1"], row["gen_len"], row["pairs"]) == (40.0, 1.5, 2)
    two = E.overlap_scores(df, "pred", "ref", 2).first()
    assert two["rouge2"] == round(2 * 1 / 3 / 2 * 100, 4)


def test_overlap_scores_count_repeats(spark):
    rng = np.random.default_rng(5)
    pairs = [[" ".join(rng.choice(list("abcd"), rng.integers(0, 15))) for _ in "pr"] for _ in range(30)]
    df = spark.createDataFrame([tuple(p) for p in pairs], "pred string, ref string")
    for n in (1, 2, 3):
        total = 0.0
        for p, r in pairs:
            p, r = ([tuple(t.split()[k : k + n]) for k in range(len(t.split()) - n + 1)] for t in (p, r))
            hit = sum(min(p.count(g), r.count(g)) for g in set(p))
            total += 2 * hit / (len(p) + len(r)) if p or r else 0
        assert abs(E.overlap_scores(df, "pred", "ref", n).first()[f"rouge{n}"] - total / 30 * 100) < 1e-3


def test_batch_similarity_against_a_matrix(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=5).astype("float32").tolist()) for i in range(11)]
    df = spark.createDataFrame(rows, "id bigint, v array<float>")
    got = {r["id"]: r for r in E.batch_similarity(df, F.floor(F.col("id") / 4), "id", "v").collect()}
    x = np.array([v for _, v in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for lo in (0, 4, 8):
        own = list(range(lo, min(lo + 4, 11)))
        for k, i in enumerate(own):
            others = {j: float(x[i] @ x[j]) for j in own if j != i}
            best = max(others, key=others.get)
            target = own[(k + len(own) // 2) % len(own)]
            loss = np.log(sum(np.exp(s / 0.05) for s in others.values())) - others[target] / 0.05
            assert got[i]["nearest"] == best and abs(got[i]["loss"] - loss) < 1e-6


@pytest.mark.parametrize("size, block", [(1, 1024), (7, 3), (40, 8), (40, 1)])
def test_batches_of_any_size_in_blocks(spark, size, block):
    rng = np.random.default_rng(size)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(size)] + [(100, None), (101, [None] * 4)]
    if size > 7:
        rows[3] = (3, [0.0] * 4)
        rows[5] = (5, rows[6][1])
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    for batch in (F.lit(None), F.lit(1)):
        got = {r["id"]: r for r in E.batch_similarity(df, batch, "id", "v", block=block).collect()}
        assert sorted(got) == list(range(size))
        x = np.array([v for _, v in rows[:size]])
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-8)
        sims = x @ x.T
        for i in range(size):
            others = [j for j in range(size) if j != i]
            if not others:
                assert got[i]["nearest"] is got[i]["similarity"] is got[i]["loss"] is None
                continue
            loss = np.log(np.exp(sims[i, others] / 0.05).sum()) - sims[i, (i + size // 2) % size] / 0.05
            assert abs(got[i]["similarity"] - sims[i, others].max()) < 1e-9 and abs(sims[i, got[i]["nearest"]] - got[i]["similarity"]) < 1e-9
            assert abs(got[i]["loss"] - loss) < 1e-6


def test_longest_common_sequences(spark):
    rng = random.Random(2)

    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]

    cases = [([], []), (["a"], []), ([], ["a"])] + [([rng.choice("abcd") for _ in range(rng.randint(0, 150))] for _ in range(2)) for _ in range(60)]
    cases = [tuple(c) for c in cases]
    for a, b in cases:
        assert E.common_length(a, b) == slow(a, b)
    df = spark.createDataFrame([(" ".join(a), " ".join(b)) for a, b in cases] + [(None, "a b")], "p string, r string")
    scores = [2 * slow(a, b) / (len(a) + len(b)) if a or b else 0.0 for a, b in cases] + [0.0]
    row = E.sequence_overlap(df, "p", "r").first()
    assert abs(row["rougeL"] - 100 * sum(scores) / len(scores)) < 1e-3 and row["pairs"] == len(scores)


def test_label_accuracy_multiplies_repeats(spark):
    ddl = "doc int, label_type string, value string"
    gold = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (1, "b", "y")], ddl)
    pred = spark.createDataFrame([(1, "a", "x"), (1, "a", "x"), (1, "c", "z")], ddl)
    assert tuples(E.label_accuracy(gold, pred, "doc").collect()) == [("a", 2, 4, 2.0), ("b", 1, 0, 0.0)]


def test_metrics_table(spark):
    df = spark.createDataFrame(
        [("bid", "0101", 0.1, 0.2, 0.3, 9.0, {"a": {"p": 0.5}})],
        "task string, date string, ents_p double, ents_r double, ents_f double, speed double, ents_per_type map<string,map<string,double>>",
    )
    assert tuples(E.metrics_table(df).collect()) == sorted(
        [("bid", "0101", "总体", "p", 0.1), ("bid", "0101", "总体", "r", 0.2), ("bid", "0101", "总体", "f", 0.3), ("bid", "0101", "速度", "speed", 9.0), ("bid", "0101", "a", "p", 0.5)]
    )


@pytest.mark.parametrize("sides, most, strip", [(2, 8192, 256), (4, 3, 2), (32, 7, 5)])
def test_closest_vectors_without_loss_in_blocks_of_any_shape(spark, monkeypatch, sides, most, strip):
    monkeypatch.setattr(E, "SIDES", sides)
    monkeypatch.setattr(E, "MOST", most)
    monkeypatch.setattr(E, "STRIP", strip)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(41)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    got = E.batch_similarity(df, F.lit(None), "id", "v", block=2, loss=False)
    assert got.columns == ["batch", "id", "nearest", "similarity"]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sims = x @ x.T
    np.fill_diagonal(sims, -np.inf)
    assert {r["id"]: r["nearest"] for r in got.collect()} == dict(enumerate(sims.argmax(axis=1).tolist()))
    assert sorted(round(r["similarity"], 9) for r in got.collect()) == sorted(sims.max(axis=1).round(9).tolist())
