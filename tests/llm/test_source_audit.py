import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from noticeloom.llm import source_audit
from noticeloom.llm.source_audit import divergence

from .samples import documents, rows

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
AZ = {c: c + 32 for c in range(65, 91)}


def brute(data, least, top):
    held, groups, whole = defaultdict(set), defaultdict(Counter), defaultdict(Counter)
    for row, (_, text, lang, source) in enumerate(data):
        terms = TERM.findall((text or "").translate(AZ))
        groups[lang or "", source or ""].update(terms)
        whole[lang or ""].update(terms)
        for t in set(terms):
            held[lang or "", t].add(row)
    out = []
    for (lang, source), own in groups.items():
        kept = [t for (g, t), docs in held.items() if g == lang and len(docs) >= least]

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def gap(p, q):
            return (p - q) ** 2 // (p + q)

        p, base = shares(own), shares(whole[lang])
        pairs = []
        for (g, other), counts in groups.items():
            if g == lang and other != source:
                q = shares(counts)
                pairs.append((-sum(gap(p[t], q[t]) for t in kept), other))
        terms = sorted((-gap(p[t], base[t]), t) for t in kept if own[t] and p[t] > base[t])[:top]
        for part, found in (("pair", sorted(pairs)), ("term", terms)):
            out += [(lang, source, part, item, -v, i) for i, (v, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("held, least", [(3_000_000, 10), (40, 3), (40, 1)])
def test_against_brute_force(spark, monkeypatch, held, least):
    monkeypatch.setattr(source_audit, "HELD_WORDS", held)
    data = rows() + [(900 + i, f"Rare-{'RARE' if i % 2 else 'rare,'} word{i % 4}; 'Quote", "en", f"s{i % 5}") for i in range(14)]
    found = divergence(documents(spark, data).repartition(3), least_docs=least, top=10)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, found.collect())) == brute(data, least, 10)


def test_terms_whose_documents_are_spread_over_chunks(spark):
    shapes = ["ship", "Ship", "ship,", "(SHIP)", "ship.", "SHIP;", "Ship!", "ship?", "ship:", "'ship"]
    spread = [(i, shapes[i], "en", "a" if i % 2 else "b") for i in range(10)]
    twice = [(100 + i, f"{shapes[i]} boat {shapes[i]}boat", "de", "a") for i in range(9)]
    twice.append((200, "Boat boat boat, boat", "de", "b"))
    found = divergence(documents(spark, spread + twice))
    assert sorted(map(tuple, found.collect())) == brute(spread + twice, 10, 10)


def test_without_terms_and_empty(spark):
    data = [(1, None, "en", "a"), (2, "12 34", "en", None), (3, "", None, "c"), (4, "\x00 \x7f", None, "d")]
    got = sorted(map(tuple, divergence(documents(spark, data)).collect()))
    assert got == [("", "c", "pair", "d", 0, 1), ("", "d", "pair", "c", 0, 1), ("en", "", "pair", "a", 0, 1), ("en", "a", "pair", "", 0, 1)]
    assert divergence(documents(spark, [])).count() == 0


def test_one_long_chunk_and_a_hot_source(spark):
    data = [(1, "x" * 3_000_000, "en", "a"), (2, "word " * 200_000, "en", "a")] + [(3 + i, "word other", "en", "b") for i in range(10)]
    assert sorted(map(tuple, divergence(documents(spark, data)).collect())) == brute(data, 10, 10)


def test_names_with_dots_and_clashes(spark):
    data = rows(seed=3, n=30)
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string").withColumnsRenamed({"lang": "meta.lang", "source": "term"})
    docs = docs.withColumns({"lang": F.lit("x"), "n": F.lit(1), "chunk": F.lit("y")})
    found = divergence(docs, lang_col="`meta.lang`", source_col="term")
    assert sorted(map(tuple, found.collect())) == brute(data, 10, 10)


def test_shares_are_exact_for_large_counts(spark):
    n, total, v = 123_456_789_012_345_678, 9_000_000_000_000_000_000, 7
    row = spark.range(1).select(source_audit.share(F.lit(n), F.lit(total), F.lit(v)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (n + 2) // (total + 2 * v)
