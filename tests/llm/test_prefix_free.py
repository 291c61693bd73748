import hashlib
import random

import numpy as np
import pytest

from noticeloom.llm import prefix_free as R

from .samples import documents, key, rows


def brute(data, length=50):
    first = {}
    docs = [(R.LAST_ID if i is None else i, (t or "").encode()) for i, t, *_ in data]
    for i, t in docs:
        for p in range(len(t) - length + 1):
            w = t[p : p + length]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in docs:
        gone = np.zeros(len(t) + 1, bool)
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < i:
                gone[p : p + length] = True
        gone = gone[:-1]
        left = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(t)))
        out.append((None if i == R.LAST_ID else i, len(t), int(gone.sum()), int(spans), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=key)


def sample(seed):
    rng = random.Random(seed)
    letters = rng.choice(["ab", "abcdefgh ", "abcdefghijklmnopqrstuvwxyz \n"])
    word = lambda low, high: "".join(rng.choice(letters) for _ in range(rng.randint(low, high)))
    pool = [word(10, 300) for _ in range(5)] + ["=" * 120, "ab" * 60, "abc" * 50]
    out = []
    for i in range(25):
        text = "".join(rng.choice([rng.choice(pool), word(0, 120), rng.choice(pool)[rng.randint(0, 9) : -rng.randint(1, 60)]]) for _ in range(rng.randint(0, 6)))
        out.append((rng.choice([i, i, i, 3, None]), text, "en", "a"))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_repeats(spark, monkeypatch, seed):
    monkeypatch.setattr(R, "BLOCK_BYTES", 700)
    data = sample(seed) + [(i, t, lang, s) for i, t, lang, s in rows(seed, 20) if len(t or "") < 20000]
    got = R.remove_repeats(documents(spark, data))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == brute(data)


def test_kept_text_and_other_lengths(spark):
    text = "0123456789" * 3
    docs = documents(spark, [(1, "x" + text, "en", "a"), (2, "é" + text + "y", "en", "a")])
    got = {r["doc_id"]: r for r in R.remove_repeats(docs, length=20, with_text=True).collect()}
    assert bytes(got[2]["kept"]).decode() == "éy" and got[2]["n_spans"] == 1
    assert got[1]["n_removed"] == 0
    with pytest.raises(ValueError):
        R.remove_repeats(docs, length=16)


def test_empty_table(spark):
    assert R.remove_repeats(documents(spark, [])).count() == 0


def test_rolling_hashes_of_equal_strings_are_equal():
    text = np.frombuffer(b"abcabcabcabcabcabcabc" * 4, np.uint8)
    found = R.rolling(text, [16, 33, 50])
    for size, hashes in found.items():
        assert len(hashes) == len(text) - size + 1
        assert len(np.unique(hashes)) == 3
