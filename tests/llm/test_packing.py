import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from noticeloom.llm import packing as P
from noticeloom.llm.queries import vocabulary_path

from .samples import documents, rows

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary_path())


def test_words_give_the_tokenizers_ids(tokenizer):
    words = P.WordTokens(vocabulary_path())
    odd = ["Don't STOP, a\u00a0b\tc", "x\u0301 É é ß İstanbul ΣΑΣ", "<|endoftext|> <|ENDOFTEXT|>", "can't. it's, 'tis ''s we'll!!", "a,b abc., 1,234.5", "\x1c a\x85b", "", " \n", "...", "straße. straße"]
    for text in odd + [t or "" for _, t, *_ in rows()]:
        assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text[:50]


def test_plan_uses_each_length_once_and_keeps_to_the_budget():
    rng = random.Random(4)
    for _ in range(200):
        budget = rng.choice([7, 30, 64])
        counts = {rng.randint(1, budget): rng.randint(1, 50) for _ in range(rng.randint(1, budget))}
        used = Counter()
        for lengths, times in P.plan(counts, budget):
            assert sum(lengths) <= budget and times > 0
            for n in lengths:
                used[n] += times
        assert used == Counter(counts)


def test_exact_fillings_are_found():
    assert P.Complements({30: 1, 50: 2, 20: 1}, 100).filling(50) == (50,)
    assert P.Complements({30: 1, 20: 1}, 100).filling(50) == (30, 20)
    assert sorted(P.Complements({25: 2}, 100).filling(50)) == [25, 25]
    assert sorted(P.Complements({10: 1, 15: 1, 25: 1}, 100).filling(50)) == [10, 15, 25]
    assert P.Complements({25: 1}, 100).filling(50) is None
    assert len(P.plan({60: 5, 40: 5, 50: 4, 30: 3, 35: 6}, 100)) == 3  # 60+40, 50+50, 30+35+35
    assert sum(t for _, t in P.plan({60: 5, 40: 5, 50: 4, 30: 3, 35: 6}, 100)) == 10


@pytest.mark.parametrize("budget", [64, 4096])
def test_pieces(spark, tokenizer, budget):
    data = rows()
    got = P.pack(documents(spark, data), vocabulary_path(), budget=budget, with_ids=True).collect()
    want = Counter()
    for i, t, *_ in data:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), budget):
            part = np.array(ids[k : k + budget], "<u4").tobytes()
            want[i, k // budget, k, len(part) // 4, zlib.crc32(part), part] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], bytes(r["ids"])) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for members in sequences.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= budget
    assert len(sequences) <= -(-sum(r["length"] for r in got) // budget) + 1


def test_empty_table(spark):
    assert P.pack(documents(spark, []), vocabulary_path()).count() == 0
