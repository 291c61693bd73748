import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from noticeloom.llm import whitening
from noticeloom.llm.whitening import whiten

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def table(spark, data):
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, label int, n string, whitened string, x string").drop("label")


def rows(vectors, first=0):
    return [(first + i, None if v is None else [None if c is None else float(c) for c in v], 1, "n", "w", "x") for i, v in enumerate(vectors)]


def brute(vectors, components=4):
    """Per kept vector its deviation and, by component, its whitened values; then shares of the variance."""
    sound = [(i, v) for i, v in enumerate(vectors) if v is not None and all(c is not None and math.isfinite(np.float32(c)) for c in v)]
    dim = max(len(v) for _, v in sound)
    x = [[math.floor(256 * float(np.float32(c))) for c in v] + [0] * (dim - len(v)) for _, v in sound]
    fit = np.array(sorted({tuple(v) for v in x}), float)
    n, s = len(fit), [int(t) for t in fit.sum(axis=0)]
    centred = fit - fit.mean(axis=0)
    values, right = np.linalg.eigh(centred.T @ centred / n)
    values, right = values[::-1], right[:, ::-1]
    kept = [k for k in range(min(components, dim)) if values[k] > 1e-12 * values[0]]
    out = {}
    for (i, _), v in zip(sound, x):
        own = np.array(v) - fit.mean(axis=0)
        out[i] = sum((n * c - t) ** 2 for c, t in zip(v, s)), [float(own @ right[:, k] / math.sqrt(values[k])) for k in kept]
    return n, out, [values[k] / values.sum() for k in kept]


def check(found, vectors, components=4, rel=1e-8):
    assert found.columns == COLUMNS
    n, want, shares = brute(vectors, components)
    got = {}
    for r in found.collect():
        assert r["n"] == n and r["identity_error"] < 1e-7
        assert int(r["deviation"]) == want[r["vec_id"]][0]
        assert r["explained"] == pytest.approx(shares[r["component"] - 1], rel=1e-8)
        got.setdefault(r["component"], {})[r["vec_id"]] = r["whitened"]
    assert sorted(got) == list(range(1, len(shares) + 1))
    for k, column in got.items():
        assert column.keys() == want.keys()
        a, b = np.array([column[i] for i in want]), np.array([want[i][1][k - 1] for i in want])
        sign = 1 if a @ b > 0 else -1
        assert np.abs(a - sign * b).max() < rel * max(1, np.abs(b).max()) * 10
    return got


def test_against_eigenvectors(spark):
    rng = np.random.default_rng(3)
    vectors = [list(v) for v in rng.normal(size=(400, 12)) * np.geomspace(3, 0.05, 12) + 1.5]
    vectors += [vectors[0]] * 50 + [None, [None] * 12, [float("nan")] * 12, [float("inf")] + [0.0] * 11, [0.0] * 12, [-0.0] * 12]
    check(whiten(table(spark, rows(vectors)).repartition(3)), vectors)


def test_few_dimensions_and_short_vectors(spark):
    vectors = [[1.0, 2.0], [3.0, -1.0], [0.5], [], [2.0, 2.0], [1.0, 2.0]]
    check(whiten(table(spark, rows(vectors))), vectors)


def test_rows_that_span_fewer_dimensions(spark):
    rng = np.random.default_rng(4)
    flat = np.round(rng.normal(size=(60, 2)) * 40) / 256
    vectors = [[a, b, a + b, 2 * a - b, 0.0, 1.0] for a, b in flat.tolist()]
    got = check(whiten(table(spark, rows(vectors))), vectors, rel=1e-6)
    assert sorted(got) == [1, 2]


def test_badly_scaled_dimensions(spark):
    rng = np.random.default_rng(5)
    vectors = [list(v) for v in rng.normal(size=(300, 6)) * [40000.0, 3000.0, 200.0, 10.0, 1.0, 0.1]]
    check(whiten(table(spark, rows(vectors))), vectors, rel=1e-6)


def test_nothing_to_scale(spark):
    assert whiten(table(spark, [])).count() == 0
    assert whiten(table(spark, rows([None, [None], [float("nan")]]))).count() == 0
    found = whiten(table(spark, rows([[1.0, 2.0]] * 5)))
    assert found.columns == COLUMNS and found.count() == 0
    assert whiten(table(spark, rows([[], []]))).count() == 0


def test_null_and_repeated_ids_stay_and_ids_keep_their_type(spark):
    data = [(i, [float(i), float(i * i % 7)], 1, "", "", "") for i in range(20)] + [(None, [1.0, 1.0], 1, "", "", ""), (3, [3.0, 2.0], 1, "", "", "")]
    docs = table(spark, data)
    assert whiten(docs).filter("vec_id IS NULL").count() == 2 and whiten(docs).filter("vec_id = 3").count() == 4
    named = docs.select(F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("meta.id"), F.col("embedding").alias("a.b"), "n")
    found = whiten(named, "meta.id", "a.b")
    assert found.columns[0] == "meta.id" and found.schema[0].dataType.simpleString() == "string"
    assert found.count() == 44


def test_deviations_beyond_64_bits(spark):
    big = 2.0**40  # squares of the deviations take up to 116 bits
    vectors = [[big * (i + 1), -big * (i * i % 11)] for i in range(30)]
    check(whiten(table(spark, rows(vectors))), vectors, rel=1e-6)
    exact = whitening.Centre(2**40, [3, -5]).exact(np.array([[2**40, -(2**41)]]))
    assert exact.tolist() == [[2**80 - 3, -(2**81) + 5]]
