import math
import random

import numpy as np
import pytest

from noticeloom.llm.top_k import DualSearch, top_k, tree_of


def brute(rows, k=10, every=100):
    vectors = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors.append((i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    out = []
    for at, (q, v) in enumerate(vectors):
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for n, (i, w) in enumerate(vectors) if n != at and len(w) == len(v))
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def sample(seed, n, dim):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(4)]
    rows = [(i, [c + rng.gauss(0, 0.1) for c in rng.choice(centres)]) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(40)]  # ties
    rows += [(n + 50, None), (n + 51, [None] * dim), (n + 52, [float("nan")] * dim), (n + 53, [float("inf")] * dim), (None, rows[0][1])]
    rows += [(n + 54, [1.0] * (dim + 1)), (1000000, [2.0] * (dim + 1)), (n + 55, []), (5, rows[5][1]), (7, [9.0] * dim)]
    return rows


@pytest.mark.parametrize("block_rows, every", [(4096, 100), (37, 10)])
def test_against_brute_force(spark, block_rows, every):
    rows = sample(3, 400, 6)
    vectors = spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id long, embedding array<float>, id int, rank int, score int")
    got = top_k(vectors, block_rows=block_rows, every=every)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, every=every)


def test_few_rows_and_empty_table(spark):
    schema = "vec_id long, embedding array<float>"
    assert top_k(spark.createDataFrame([], schema)).count() == 0
    assert top_k(spark.createDataFrame([(0, [1.0, 2.0])], schema)).count() == 0
    assert [tuple(r) for r in top_k(spark.createDataFrame([(0, [1.0]), (1, [2.0])], schema)).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]


def test_rows_that_repeat_an_id_are_all_candidates(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [9.0, 0.0]), (2, [2.0, 0.0]), (0, [3.0, 0.0])]
    got = [(r["query_id"], r["vec_id"], r["score"] >> 20) for r in top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()]
    assert sorted(got) == [(0, 0, 3), (0, 0, 3), (0, 1, 0), (0, 1, 1), (0, 1, 9), (0, 1, 27), (0, 2, 2), (0, 2, 6)]


def test_large_components_stay_exact(spark):
    rows = [(0, [1e6, 1.0]), (1, [1e6, 2.0]), (2, [1e6, 3.0])]
    got = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [r["vec_id"] for r in got] == [2, 1]


def test_tree_covers_its_points_and_prunes():
    rng = np.random.default_rng(1)
    data = np.concatenate([c + rng.normal(size=(300, 4)) for c in rng.normal(size=(6, 4)) * 100])
    seen = []

    def walk(node):
        away = np.sqrt(((data[node.points] - node.centre) ** 2).sum(axis=1))
        assert away.max() <= node.radius + 1e-9
        if node.children is None:
            seen.extend(node.points.tolist())
        else:
            assert sum(len(c.points) for c in node.children) == len(node.points)
            for child in node.children:
                assert child.radius <= node.radius / 1.3 + 1e-9
                walk(child)

    walk(tree_of(data))
    assert sorted(seen) == list(range(len(data)))
    compared = 0

    class Counting(DualSearch):
        def compare(self, some, points):
            nonlocal compared
            compared += len(some) * len(points)
            super().compare(some, points)

    ints = np.floor(data * 10).astype(np.int64)
    Counting(np.arange(50), ints[:50], np.arange(len(ints)), np.arange(len(ints)), ints, 5)
    assert compared < 50 * len(ints) / 2
