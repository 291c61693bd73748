import hashlib
import re
from collections import defaultdict

import pytest

from noticeloom.llm.exact_dedup import directory, exact_dedup, exact_groups

from .samples import documents, key, rows


def brute(data):
    groups = defaultdict(list)
    for i, t, *_ in data:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i or 0, i))
    out = []
    for norm, members in groups.items():
        keep = min(members)[3]
        out += [(m[3], keep, len(members), m[3] == keep, hashlib.sha256(norm.encode()).hexdigest()) for m in members]
    return sorted(out, key=key)


@pytest.mark.parametrize("capacity", [2, 4096])
def test_groups(spark, capacity):
    data = rows()
    got = exact_groups(documents(spark, data), capacity=capacity)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == brute(data)


def test_one_row_of_each_text_stays(spark):
    docs = documents(spark)
    left = exact_dedup(docs, capacity=4)
    texts = {re.sub(r"\s", "", t or "") for _, t, *_ in rows()}
    assert left.columns == docs.columns
    assert left.count() == len(texts)
    assert exact_dedup(documents(spark, [])).count() == 0 == exact_groups(documents(spark, [])).count()


def test_directory_splits_only_overfull_buckets(spark):
    hashes = [0] * 3 + [1 << 62] * 3 + [(1 << 63) - 1] * 2 + [-(1 << 63)] * 2  # 00, 01, 01, 10
    found = directory(spark.createDataFrame([(h,) for h in hashes], "h long"), 4).collect()
    depth = found[0]["depth"]
    assert {r["slot"] >> (depth - 2): r["bucket"].split("/")[0] for r in found}[2] == "1"
    held = defaultdict(int)
    buckets = {r["slot"]: r["bucket"] for r in found}
    for h in hashes:
        held[buckets[(h % (1 << 64)) >> (64 - depth)]] += 1
    assert held[buckets[0]] == 3
    assert sum(held.values()) == len(hashes)
