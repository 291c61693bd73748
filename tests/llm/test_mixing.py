import re

import pytest

from noticeloom.llm.mixing import Flight, mix, mixed

from .samples import documents, key, rows


def targets(sizes):
    """Targets by the words of the rule: shares, stops, and the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    full, left = {}, 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in order if s not in full]
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return full | share
        for s in over:
            full[s] = 2 * sizes[s]
            left -= full[s]


@pytest.mark.parametrize("block_rows", [4096, 16])
def test_mix(spark, block_rows):
    data = rows(n=300)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, _, s in data:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = targets(sizes)
    docs = documents(spark, data)
    got = mixed(docs.drop("row"), block_rows=block_rows).join(docs.select("doc_id", "source").dropna(subset=["doc_id"]).distinct(), "doc_id", "left").collect()
    assert len(got) == len(data)
    taken = {}
    for r in got:
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        taken[r["source_size"]] = taken.get(r["source_size"], 0) + r["taken"]
    for s, n in sizes.items():
        row = next(r for r in got if r["source_size"] == n)
        assert abs(row["target"] - want[s]) < 1e-6
        assert abs(taken[n] - want[s]) <= max(0.02 * want[s], 40 if n < 20000 else 30001)
    again = mixed(docs.drop("row"), block_rows=block_rows).collect()
    pick = lambda found: sorted([(r["doc_id"], r["size"], r["taken"]) for r in found], key=key)
    assert pick(again) == pick(got)


def test_rows_are_repeated(spark):
    docs = documents(spark)
    out = mix(docs)
    assert out.columns == docs.columns
    assert out.count() == mixed(docs.drop("row")).selectExpr("sum(copies)").first()[0]


def test_empty_and_wordless(spark):
    assert mixed(documents(spark, [])).count() == 0 == mix(documents(spark, [])).count()
    got = mixed(documents(spark, [(1, None, None, None), (2, "", None, "a")])).collect()
    assert {(r["size"], r["target"], r["taken"]) for r in got} == {(0, 0.0, 0)}


def test_flight_keeps_both_totals():
    flight, done = Flight("x"), []
    units = [[i, (7 * i) % 13 + (i == 5) * 1000, 0.37] for i in range(200)]
    for u in units:
        done += flight.add(list(u))
    assert len(flight.open) <= 2
    settled = done + flight.open
    assert {x[2] for x in done} <= {0.0, 1.0}
    assert abs(sum(x[2] for x in settled) - 0.37 * 200) < 1e-6
    assert abs(sum(x[1] * x[2] for x in settled) - 0.37 * sum(u[1] for u in units)) < 1e-4
