import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from noticeloom.llm import near_dedup as N

from .samples import documents, key, prose, rows


def shingle_set(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(found[k : k + words]) for k in range(len(found) - words + 1)} or ({tuple(found)} if found else set())


def brute(data, words):
    """Component of each row by comparing all pairs."""
    sets = [shingle_set(t, words) for _, t, *_ in data]
    label = list(range(len(data)))
    changed = True
    links = [(a, b) for a in range(len(data)) for b in range(a) if data[a][0] is not None and data[b][0] is not None and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != label[b]
            label[a] = label[b] = low
    smallest = defaultdict(list)
    for (i, *_), c in zip(data, label):
        smallest[c].append(i)
    out = []
    for (i, *_), s, c in zip(data, sets, label):
        ids = [x for x in smallest[c] if x is not None]
        component = min(ids) if i is not None else None
        out.append((i, len(s), component, i is None or i == component))
    return sorted(out, key=key)


def near_copies(seed):
    """A group whose members are close to one original only, a chain, and unrelated texts with a shared passage."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base = [word() for _ in range(120)]
    out = []
    for i in range(25):
        copy = list(base)
        for at in rng.sample(range(120), 3):
            copy[at] = word()
        out.append(" ".join(copy))
    out.append(" ".join(base).upper())
    chain = [word() for _ in range(100)]
    for i in range(8):
        out.append(" ".join(chain[i * 5 : i * 5 + 60]))
    passage = " ".join(word() for _ in range(30))
    out += [passage + " " + " ".join(word() for _ in range(25)) for _ in range(30)]
    rng.shuffle(out)
    return [(i, t, "en", "a") for i, t in enumerate(out)]


@pytest.mark.parametrize("block_rows", [1024, 3])
@pytest.mark.parametrize("data, words", [(rows(), 5), (near_copies(1), 4), (near_copies(2), 5)])
def test_components(spark, monkeypatch, data, words, block_rows):
    monkeypatch.setattr(N, "BLOCK_ROWS", block_rows)
    got = N.components(documents(spark, data), words=words).select("id", "n_shingles", "component_id", "kept")
    assert sorted(map(tuple, got.collect()), key=key) == brute(data, words)


def test_one_document_of_each_component_stays(spark):
    data = [(i, t, lang, s) for i, t, lang, s in rows() if i is not None]
    docs = documents(spark, data)
    left = N.near_dedup(docs)
    assert left.columns == docs.columns
    want = [i for i, _, _, kept in brute(data, 5) if kept]
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(want)


def test_empty_table(spark):
    assert N.components(documents(spark, [])).count() == 0 == N.near_dedup(documents(spark, [])).count()


def test_chain_of_links_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "x long, y long")
    assert Counter(r["comp"] for r in N._components(links).collect()) == {0: 41, 100: 2}


def test_sets_have_no_collisions_and_keys_are_few():
    text = " ".join(f"w{i}" for i in range(5000)).encode()
    found = N.Shingles(4).of(text)
    assert len(found) == 4997
    keys = N.collections([found, found[:10], found[:10]], N.SIDE)
    assert keys.shape == (3, 2 * N.SIDE) and np.array_equal(keys[1], keys[2])
    assert prose(random.Random(1), "en", 3)


def test_null_and_repeated_ids_keep_one_document(spark):
    """Near copies among rows without an id, and two near copies under one id, leave one row each."""
    rng = random.Random(5)
    one, two, three = (" ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(80)) for _ in range(3))
    data = [(None, one, "en", "a"), (None, one + " end", "en", "a"), (None, one, "en", "a"), (7, two, "en", "a"), (7, two + " end", "en", "a")]
    data += [(None, three, "en", "a"), (9, three + " end", "en", "a"), (8, three + " last", "en", "a"), (None, "", "en", "a"), (None, None, "en", "a")]
    left = [(r["doc_id"], r["text"]) for r in N.near_dedup(documents(spark, data)).collect()]
    assert len(left) == 5 and (8, three + " last") in left and (None, "") in left and (None, None) in left
    assert sum(i == 7 for i, _ in left) == 1 and sum(i is None and (t or "").startswith(one) for i, t in left) == 1
