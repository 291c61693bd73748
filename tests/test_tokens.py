import random

import pytest
from pyspark.sql import functions as F

from conftest import tuples
from noticeloom.functions.arrays import unnest
from noticeloom.operators import bio as B
from noticeloom.operators.tokens import merged_tokens, token_spans


def tags(rng, n):
    out, kind = [], "x"
    for _ in range(n):
        kind = rng.choice(["x", "y", kind, kind])
        out.append(rng.choice(["O", f"B-{kind}", f"I-{kind}", f"I-{kind}", f"I-{kind}"]) if rng.random() < 0.6 else f"I-{kind}")
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    made = [(i, tags(rng, rng.choice([1, 3, 16, 17, 200]))) for i in range(60)]
    return made + [(100, []), (101, ["O"] * 40), (102, ["B-x"] + ["I-x"] * 300), (103, ["I-y"] * 64), (104, ["O"] * 31 + ["I-x", "I-x", "O"])]


def apart(df):
    return unnest(df, ["id"], "label", "_s").select("id", "_s.*")


@pytest.mark.parametrize("cell", [1, 8, 64, 4096])
def test_spans_of_rows_are_those_of_the_document_in_one_row(spark, rows, cell):
    whole = spark.createDataFrame(rows, "id int, tags array<string>")
    each = spark.createDataFrame([(i, p, t) for i, ts in rows for p, t in enumerate(ts)], "id int, pos int, tag string").repartition(5)
    want = tuples(apart(whole.withColumn("label", B.tag_spans(F.col("tags")))).collect())
    assert tuples(token_spans(each, ["id"], cell=cell).collect()) == want
    want = tuples(apart(whole.withColumn("label", B.merge_tokens(B.token_slices(F.col("tags"))))).collect())
    assert tuples(merged_tokens(each, ["id"], cell=cell).collect()) == want


def test_empty_table(spark):
    none = spark.createDataFrame([], "id int, pos int, tag string")
    assert token_spans(none, ["id"]).count() == 0 == merged_tokens(none, ["id"]).count()


def test_a_long_document_spreads_over_cells(spark):
    one = spark.range(200_000).select(F.lit(1).alias("id"), F.col("id").alias("pos"), F.when(F.col("id") % 50_000 == 0, "B-x").otherwise("I-x").alias("tag"))
    assert tuples(token_spans(one, ["id"]).collect()) == [(1, i * 50_000, (i + 1) * 50_000, "x") for i in range(4)]
