import random

from pyspark.sql import functions as F

from conftest import tuples
from noticeloom.operators import intervals
from noticeloom.operators.intervals import overlapping


def table(spark, rows, names):
    return spark.createDataFrame(rows, f"k string, {names[0]} long, {names[1]} long, {names[2]} int")


def brute(left, right):
    return sorted((k, s, e, i, rs, re, j) for k, s, e, i in left for rk, rs, re, j in right if k is not None and k == rk and None not in (s, e, rs, re) and s < e and rs < re and s < re and rs < e)


def drawn(rng, n, longest):
    rows = []
    for i in range(n):
        start = rng.randint(-50, 3000)
        rows.append((rng.choice("ab"), start, start + rng.choice([0, 1, 1, 2, 3, rng.randint(1, 60), rng.randint(1, longest)]), i))
    return rows + [("a", None, 5, n), (None, 1, 5, n + 1), ("b", 3, None, n + 2), ("c", 1, 2, n + 3), ("a", 7, 3, n + 4)] + rows[:3]


def test_against_brute_force(spark):
    for seed, top in ((1, 14), (2, 4), (3, 0)):
        rng = random.Random(seed)
        left, right = drawn(rng, 60, 2500), drawn(rng, 80, 900)
        got = overlapping(table(spark, left, ("start", "end", "i")), table(spark, right, ("r_start", "r_end", "j")), ["k"], top=top)
        assert got.columns == ["k", "start", "end", "i", "r_start", "r_end", "j"]
        assert tuples(got.collect()) == brute(left, right)


def test_empty_sides(spark):
    some, none = table(spark, [("a", 1, 5, 0)], ("start", "end", "i")), table(spark, [], ("r_start", "r_end", "j"))
    assert overlapping(some, none, ["k"]).count() == 0


def test_no_cell_holds_a_large_part(spark, monkeypatch):
    """One interval of a million characters in each table over 40,000 of one character: the largest join group stays small."""
    ones = spark.range(40000).select(F.lit("d").alias("k"), (F.col("id") * 25).alias("start"), (F.col("id") * 25 + 1).alias("end"))
    left = ones.unionByName(spark.createDataFrame([("d", 0, 1_000_000)], "k string, start long, end long"))
    right = left.withColumnsRenamed({"start": "r_start", "end": "r_end"})
    got = overlapping(left, right, ["k"])
    assert got.count() == 40000 + 40000 + 40000 + 1
    cells = ones.groupBy(F.floor(F.col("start") / (1 << intervals.TOP))).count().agg(F.max("count")).first()[0]
    assert cells < 700


def test_totals_without_a_pair_per_copy(spark):
    from noticeloom.operators.intervals import overlap_totals

    many = 200000  # copies of one interval on each side: 4e10 pairs
    left = spark.range(many).selectExpr("1L AS k", "0L AS start", "10L AS end").unionByName(spark.sql("SELECT 2L AS k, 3L AS start, 5L AS end"))
    right = spark.range(many).selectExpr("1L AS k", "4L AS r_start", "7L AS r_end").unionByName(spark.sql("SELECT 2L AS k, 5L AS r_start, 9L AS r_end"))
    assert [tuple(r) for r in overlap_totals(left, right, ["k"]).collect()] == [(1, many * many, 3 * many * many)]
