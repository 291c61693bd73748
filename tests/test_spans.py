import random

import numpy as np

from pyspark.sql import functions as F

from conftest import tuples
from noticeloom.operators import spans as S
from noticeloom.operators import terms as TM
from noticeloom.operators.terms import term_hits
from noticeloom.operators.annotate import annotate, annotate_with_terms, term_matcher


def found(text, terms):
    out = []
    for label, term in terms:
        at = text.find(term)
        while at >= 0:
            out.append((at, at + len(term), label))
            at = text.find(term, at + len(term))
    return sorted(out)


TERMS = [("A", "ab"), ("B", "b中"), ("C", "aa"), ("A", "😀")]
TEXTS = ["", "abab中😀ab", "aaaa b中b中", "none", "😀" * 70 + "ab" * 200 + "中"]


def test_phrase_spans_all_routes(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    want = [found(t, TERMS) for t in TEXTS]
    jvm = df.withColumn("label", S.phrase_spans(F.col("text"), TERMS)).orderBy("id").collect()
    assert [[tuple(s) for s in r["label"]] for r in jvm] == want
    py = annotate(df, term_matcher(TERMS)).orderBy("id").collect()
    assert [[tuple(s) for s in r["label"]] for r in py] == want


def test_term_table(spark):
    texts = TEXTS + ["", None, TEXTS[0], "a.b\\Ec 12345678901 12345678901", "😀" * 9 + "abcdefghij"]
    ids = [1, 1, None, *range(len(texts) - 3)]
    df = spark.createDataFrame(list(zip(ids, texts)), "id int, text string")
    known = TERMS + [("x", "a.b\\E"), ("y", "1234567890"), ("z", "12345678901"), ("z", ""), ("w", "😀😀abcdefgh"), ("w", "j")]
    rows = annotate_with_terms(df, spark.createDataFrame(known, "label string, term string"))
    got = [(r["id"], r["text"], [tuple(s) for s in r["label"]]) for r in rows.collect()]
    want = [(i, t, found(t or "", [k for k in known if k[1]])) for i, t in zip(ids, texts)]
    assert sorted(got, key=str) == sorted(want, key=str)
    none = annotate_with_terms(df, spark.createDataFrame([], "label string, term string"))
    assert all(r["label"] == [] for r in none.collect())


def test_many_terms_of_one_prefix(spark):
    rng = random.Random(9)
    terms = sorted({"https://a.b/" + "".join(rng.choices("xy中1", k=rng.randint(0, 9))) for _ in range(4000)} | {"y", "x中", "aa" * 40})
    texts = [" ".join(rng.choices(terms, k=rng.randint(0, 30))) + "a" * rng.randint(0, 200) for _ in range(40)] + [None, "", "中" * 300_000 + terms[7]]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(3)
    known = [(str(i % 97), t) for i, t in enumerate(terms)] + [("again", terms[3])]
    got = tuples(term_hits(df, spark.createDataFrame(known, "label string, term string"), ["id"]).collect())
    want = sorted((i, *s) for i, t in enumerate(texts) for s in found(t or "", known))
    assert got == want


def test_candidates_beyond_the_hits_are_few():
    rng = random.Random(10)
    terms = ["prefix--" + "".join(rng.choices("abcdefgh", k=8)) for _ in range(2000)]
    maps = [np.zeros(1 << (bits - 6), np.uint64) for bits in (TM.GRAM_BITS, TM.TERM_BITS)]
    for term in terms:
        prefixes = TM.Prefixes(16)
        sums = prefixes.of(TM._codes(term))
        for words, n, bits in ((maps[0], 8, TM.GRAM_BITS), (maps[1], 16, TM.TERM_BITS)):
            for turn in range(2):
                place = int(TM._place(prefixes.parts(sums, np.zeros(1, np.int64), n), bits, turn)[0])
                words[place >> 6] |= np.uint64(1 << (place & 63))
    known = TM.Known(*maps, [16])
    text = " ".join("prefix--" + "".join(rng.choices("abcdefgh", k=8)) for _ in range(20000)) + terms[0]
    hits = known.hits(text)
    assert terms[0] in {t for *_, t in hits} and len(hits) < 30


def test_short_texts_are_hashed_together(monkeypatch):
    """A length of terms costs a step per chunk: tests of many short texts do not grow with their number."""
    rng = random.Random(8)
    terms = sorted({"".join(rng.choices("ab中😀", k=rng.randint(1, 40))) for _ in range(60)})
    maps = [np.zeros(1 << (bits - 6), np.uint64) for bits in (TM.GRAM_BITS, TM.TERM_BITS)]
    for term in terms:
        prefixes = TM.Prefixes(len(term))
        sums = prefixes.of(TM._codes(term))
        for which, length, bits in [(1, len(term), TM.TERM_BITS)] + ([(0, TM.GRAM, TM.GRAM_BITS)] if len(term) >= TM.GRAM else []):
            own = prefixes.parts(sums, np.zeros(1, np.int64), length)
            for turn in range(2):
                place = int(TM._place(own, bits, turn)[0])
                maps[which][place >> 6] |= np.uint64(1 << (place & 63))
    known = TM.Known(*maps, sorted({len(t) for t in terms}))
    halves = [(t[: len(t) // 2], t[len(t) // 2 :]) for t in terms]  # a term across two texts is no occurrence
    texts = ["", *[h for pair in halves for h in pair], *["".join(rng.choices(terms + ["-", ""], k=4)) for _ in range(400)], "", "a" * 70]
    calls = []
    tested = TM.Known._tested
    monkeypatch.setattr(TM.Known, "_tested", lambda *a: calls.append(1) or tested(*a))

    def places(hits):
        return sorted((s, e, t) for s, e, t in hits if t in terms)

    for chunk in (TM.CHUNK, 100):  # 100: texts of several pieces between those that share a chunk
        monkeypatch.setattr(TM, "CHUNK", chunk)
        got = [places(hits) for hits in known.hits_of(texts)]
        assert got == [found(text, [(t, t) for t in terms]) for text in texts]
        if chunk > 100:
            assert len(calls) <= 1 + len(known.short) + len(known.long)


def test_term_with_regex_text(spark):
    df = spark.createDataFrame([(1, r"a.b\Ec a.b")], "id int, text string")
    got = df.select(S.phrase_spans(F.col("text"), [("x", "a.b"), ("y", r"\E")]).alias("l")).first()["l"]
    assert [tuple(s) for s in got] == [(0, 3, "x"), (3, 5, "y"), (7, 10, "x")]


def test_phrase_documents_takes_first_in_order(spark):
    df = spark.createDataFrame([(3, "ab"), (1, "zab"), (2, "q")], "id int, text string")
    rows = S.phrase_documents(df, ["ab"], 2).orderBy("id").collect()
    assert [(r["id"], [tuple(s) for s in r["label"]]) for r in rows] == [(1, [(1, 3, "其他")]), (2, [])]


def random_docs(n, seed, long=1500):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = "".join(rng.choice("ab中😀 \n。") for _ in range(rng.randint(1, long)))
        spans = set()
        for _ in range(rng.randint(0, 12)):
            a = rng.randrange(len(text))
            spans.add((a, min(len(text), a + rng.randint(1, 60)), rng.choice("XYZ")))
        rows.append((i, text, sorted(spans)))
    return rows


def test_windows_stitch_back_to_the_input(spark, docs):
    rows = random_docs(20, 1)
    back = S.stitch_windows(S.sliding_windows(docs(rows), ["id"]), ["id"]).orderBy("id").collect()
    assert [(r["id"], r["text"], [tuple(s) for s in r["label"]]) for r in back] == rows


def walk(text, spans, size, pad):
    """Borders one at a time over the merged spans."""
    isles = []
    for s, e, _ in sorted(spans):
        if isles and s < isles[-1][1]:
            isles[-1][1] = max(isles[-1][1], e)
        else:
            isles.append([s, e])
    borders, at = [0], size
    while at < len(text):
        hit = next((i for i in isles if i[0] < at < i[1]), None)
        while hit:
            at = hit[1] + pad
            hit = next((i for i in isles if i[0] < at < i[1]), None)
        if at < len(text):
            borders.append(at)
        at += size
    return borders + [len(text)]


def test_chunks_match_a_border_walk_and_cut_no_span(spark, docs):
    rows = random_docs(40, 2, 400)
    got = {}
    for r in S.chunk_documents(docs(rows), ["id"], 50, 7).collect():
        got.setdefault(r["id"], []).append((r["chunk_start"], r["text"], [tuple(s) for s in r["label"]]))
    for i, text, spans in rows:
        if len(text) < 50:
            assert got[i] == [(0, text, spans)]
            continue
        borders = walk(text, spans, 50, 7)
        want = []
        for b, e in zip(borders, borders[1:]):
            own = [(s - b, t - b, n) for s, t, n in spans if s >= b and t <= e]
            if own:
                want.append((b, text[b:e], own))
        assert sorted(got.get(i, [])) == want
        assert sum(len(c[2]) for c in got.get(i, [])) == len(spans)


def test_chunk_border_cases(spark, docs):
    text = "x" * 25
    rows = [(1, text, [(8, 10, "on"), (10, 12, "from"), (18, 22, "over")])]
    got = [(r["chunk_start"], len(r["text"])) for r in S.chunk_documents(docs(rows), ["id"], 10, 1).orderBy("chunk").collect()]
    assert got == [(0, 10), (10, 13)]
    cells = S.chunk_export(S.chunk_documents(docs(rows), ["id"], 10, 1), ["chunk"]).orderBy("chunk").first()["cells"]
    assert cells == ["x" * 10, "[8, 10],on"]


def test_context_windows_and_back(spark, docs):
    text = "a" * 300 + "KEY" + "b" * 300
    df = docs([(1, text, [(300, 303, "k"), (0, 2, "z")])])
    row = S.context_windows(df, ["id"], ["k"]).first()
    assert (row["s_start"], row["s_end"], tuple(row["label"][0])) == (100, 503, (200, 203, "k"))
    windows = S.context_windows(df, ["id"], ["k"]).withColumn("label", F.transform("label", lambda s: S.span(s["start"], s["end"] - 1, s["label"])))
    back = S.replace_from_windows(df, windows, ["k"]).first()["label"]
    assert [tuple(s) for s in back] == [(0, 2, "z"), (300, 302, "k")]
    start = S.context_windows(docs([(2, "ab", [(0, 1, "k")])]), ["id"]).first()
    assert (start["s_start"], start["s_end"]) == (0, 2)


def test_replace_from_windows_removes_dropped_spans(spark, docs):
    df = docs([(1, "abcd", [(0, 1, "k"), (1, 2, "k"), (2, 3, "z")]), (2, "abcd", [(0, 1, "k")])])
    windows = spark.createDataFrame([(1, 0, [])], "id int, s_start int, label array<struct<start:int,end:int,label:string>>")
    back = {r["id"]: [tuple(s) for s in r["label"]] for r in S.replace_from_windows(df, windows, ["k"]).collect()}
    assert back == {1: [(2, 3, "z")], 2: [(0, 1, "k")]}


def test_trim_edges_is_idempotent_and_drops_blank(spark, docs):
    df = docs([(1, "  a b\n　 ", [(0, 8, "x"), (0, 2, "blank"), (2, 5, "same")])])
    once = df.withColumn("label", S.trim_span_edges(F.col("text"), F.col("label")))
    twice = once.withColumn("label", S.trim_span_edges(F.col("text"), F.col("label")))
    want = [(2, 5, "x"), (2, 5, "same")]
    assert [tuple(s) for s in once.first()["label"]] == want == [tuple(s) for s in twice.first()["label"]]


def test_sentences_have_true_offsets_and_clip(spark, docs):
    text = "甲乙。\n\n丙😀丁。戊"
    df = docs([(1, text, [(1, 6, "cross"), (8, 10, "tail"), (0, 1, "head")])])
    rows = S.sentence_rows(df, ["id"]).orderBy("sentence").collect()
    got = [(r["start"], r["text"], [tuple(s) for s in r["label"]]) for r in rows]
    assert got == [
        (0, "甲乙。", [(1, 3, "cross"), (0, 1, "head")]),
        (5, "丙😀丁。", [(0, 1, "cross"), (3, 4, "tail")]),
        (9, "戊", [(0, 1, "tail")]),
    ]


def test_overlaps_match_brute_force(spark, docs):
    rows = random_docs(15, 3, 300)
    got = tuples(S.overlapping_spans(S.bare_spans(docs(rows), ["id"]), "id", 16).collect())
    want = sorted(
        (i, a[0], a[1], a[2], b[0], b[1], b[2])
        for i, _, spans in rows for a in spans for b in spans if a[2] != b[2] and a[0] <= b[1] and b[0] <= a[1]
    )
    assert got == want


def test_duplicates_and_validity(spark, docs):
    df = docs([(1, "abc", [(0, 1, "x"), (1, 2, "x"), (0, 1, "w"), (1, 2, "w")]), (2, "a😀", [(0, 2, "x"), (1, 3, "y"), (1, 1, "z"), (-1, 1, "n")])])
    assert tuples(S.duplicate_labels(df, ["id"], ["w"]).collect()) == [(1, "x", 2)]
    good, bad = S.split_valid(df, ["id"])
    assert [tuple(s) for s in good.filter("id = 2").first()["label"]] == [(0, 2, "x")]
    assert tuples(bad.collect()) == [(2, -1, 1, "n"), (2, 1, 1, "z"), (2, 1, 3, "y")]


def test_gold_override_takes_known_texts(spark):
    span = "array<struct<start:int,end:int,label:string>>"
    df = spark.createDataFrame([("m1", [(0, 1, "a")]), ("m2", [(0, 1, "b")]), (None, [])], f"md5 string, label {span}")
    gold = spark.createDataFrame([("m1", []), ("m9", [(1, 2, "c")])], f"md5 string, label {span}")
    got = {r["md5"]: [tuple(s) for s in r["label"]] for r in S.gold_override(df, gold).collect()}
    assert got == {"m1": [], "m2": [(0, 1, "b")], None: []}


def test_inner_explode_is_not_inferred_to_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, "abab")], "id int, text string").write.parquet(str(tmp_path / "d"))
    df = spark.read.parquet(str(tmp_path / "d")).withColumn("label", S.phrase_spans(F.col("text"), TERMS))
    plan = S.bare_spans(df, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(text") == 1
