import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from noticeloom.llm import paragraph_sketch as ps
from noticeloom.llm.paragraph_sketch import version_fingerprints

from .samples import documents, rows

PIECE = re.compile(ps.PIECE)
COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def brute(data):
    """``{(id, text): (n_chars, edited_sha256, near_edited, near_next)}`` from sets of paragraphs."""
    docs = {(i, t or "") for i, t, *_ in data}

    def key(d):
        own = hashlib.md5(d[1].encode()).hexdigest()
        return hashlib.md5((own if d[0] is None else f"{own}|{d[0]}").encode()).digest()

    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, key(d)), reverse=True)
    out = {}

    def like(a, b):
        a, b = set(PIECE.findall(a)), set(PIECE.findall(b))
        return len(a & b) / len(a | b) if a | b else 1.0

    for at, (i, text) in enumerate(order):
        after = order[(at + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        out[i, text] = len(text), hashlib.sha256(edited.encode()).hexdigest(), like(text, edited), like(text, after)
    return out


def check(found, data):
    assert found.columns == COLUMNS
    want, got = brute(data), found.collect()
    assert len(got) == len(data)
    by = {}
    for (i, _), w in want.items():
        by.setdefault(i, []).append(w)
    for r in got:
        assert any(
            (r["n_chars"], r["edited_sha256"]) == w[:2] and r["near_edited"] == pytest.approx(w[2], abs=1e-12) and r["near_next"] == pytest.approx(w[3], abs=1e-12)
            for w in by[r["doc_id"]]
        ), r
    return got


def prose(rng, n):
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n)]
    return "".join(w + rng.choice([" ", " ", " ", " ", ". ", "\n"]) for w in words)


def test_likeness_is_that_of_the_paragraph_sets(spark):
    rng = random.Random(5)
    data = rows() + [(500 + i, prose(rng, rng.choice([3, 40, 200, 1500])), "en", "a") for i in range(40)]
    got = check(version_fingerprints(documents(spark, data)), data)
    texts = {}
    for r in got:
        texts.setdefault(r["doc_id"], r)
    base = [texts[60 + k]["fingerprint"] for k in range(12)]  # exact copies
    assert len(set(base)) == 1
    assert len({r["fingerprint"] for r in got}) > 80


def test_what_is_stuck_after_the_last_turn_is_settled(spark):
    rng = random.Random(6)
    data = [(i, prose(rng, 3000 if i % 2 else 30), "en", "a") for i in range(6)]
    check(version_fingerprints(documents(spark, data), turns=1), data)


def test_small_and_empty_tables(spark):
    check(version_fingerprints(documents(spark, [])), [])
    got = check(version_fingerprints(documents(spark, [(7, "One line here. Two.", None, None)])), [(7, "One line here. Two.", None, None)])
    assert (got[0]["near_edited"] < 1.0) and got[0]["near_next"] == 1.0
    data = [(None, None, None, None), (3, "", "en", "a"), (3, "x", "en", "a"), (3, "x", "en", "b"), (None, "y é😀", None, None)]
    check(version_fingerprints(documents(spark, data)), data)


def test_long_words_lines_and_punctuation_end(spark):
    data = [(1, "w" * 2_000_000, "en", "a"), (2, "." * 100_000 + " " * 100_000 + "a", "en", "a"), (3, "a. " * 50_000, "en", "a")]
    check(version_fingerprints(documents(spark, data)), data)


def test_peeling_names_the_differing_digests(spark):
    rng = random.Random(8)
    cases = []
    for n, own in [(100, 0), (500, 2), (2000, 4), (40, 20), (0, 300), (1000, 1000)]:
        both = [rng.getrandbits(63) for _ in range(n)]
        cases.append((both + [rng.getrandbits(63) for _ in range(own)], both + [rng.getrandbits(63) for _ in range(own // 2)]))
    df = spark.createDataFrame(cases, "a array<long>, b array<long>")
    a, b = F.col("a"), F.col("b")
    got = df.select("a", "b", ps.differences(a, b, ps.cells(ps.sided(a, 1), F.lit(0)), ps.cells(ps.sided(b, 1), F.lit(0))).alias("d"))
    for r in got.collect():
        assert len(r["d"]) == len(set(r["a"]) ^ set(r["b"]))
        assert {(x["digest"], x["side"]) for x in r["d"]} == {(d, 1) for d in set(r["a"]) - set(r["b"])} | {(d, -1) for d in set(r["b"]) - set(r["a"])}


def test_plan_has_no_python(spark):
    docs = documents(spark).withColumnRenamed("n", "meta.n")
    plan = version_fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
