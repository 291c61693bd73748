import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import tuples
from noticeloom.session import fresh_folder
from noticeloom.sources import digests as D
from noticeloom.sources import extract as X

SCHEMA = "id bigint, v string"


def kept(spark, loads, key=("id",)):
    folder = fresh_folder(spark, "kept")
    for number, rows in enumerate(loads):
        D.append(spark.createDataFrame(rows, SCHEMA), folder, list(key), number)
    return folder


def pulled(spark, source, target):
    return D.pull_missing(spark, source, target, SCHEMA, ["id"], "id bigint")


@pytest.mark.parametrize("seed", range(3))
def test_same_rows_as_the_anti_join(spark, seed):
    draw = random.Random(seed)
    ids = [draw.choice([None, *range(40)]) for _ in range(60)]
    source = [(i, f"v{n}") for n, i in enumerate(ids)]
    target = [(i, "t") for i in draw.sample(ids, 30)]
    got = pulled(spark, kept(spark, [source[:20], source[20:]]), kept(spark, [target]))
    want = X.pull_missing(spark.createDataFrame(source, SCHEMA), spark.createDataFrame(target, SCHEMA))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_equal_tables_read_nothing_and_empty_ones_work(spark):
    rows = [(i, "x") for i in range(200)]
    one, two, none = kept(spark, [rows]), kept(spark, [rows[:90], rows[90:]]), kept(spark, [[]])
    assert D.changed(D.read_digests(spark, one), D.read_digests(spark, two)) == []
    assert pulled(spark, one, two).count() == 0 == pulled(spark, none, one).count()
    assert pulled(spark, one, none).count() == 200
    assert D.missing_count(spark, one, none, "id bigint", ["id"]).first().asDict() == {"origin_count": 200, "target_count": 0, "a_not_b": 200}


def test_repeated_keys_do_not_cancel(spark):
    one, two = kept(spark, [[(1, "a"), (1, "b")]]), kept(spark, [[(2, "a"), (2, "b")]])
    assert tuples(pulled(spark, one, two).collect()) == [(1, "a"), (1, "b")]
    assert D.roll_up(D.read_digests(spark, one), 0).collect()[0]["n"] == 2


def test_only_changed_parts_are_read(spark):
    rows = [(i, "x") for i in range(300)]
    source, target = kept(spark, [rows]), kept(spark, [rows[1:]])
    leaves = D.changed(D.read_digests(spark, source), D.read_digests(spark, target))
    plan = D.read_rows(spark, source, SCHEMA, leaves)._jdf.queryExecution().executedPlan().toString()
    part = spark.createDataFrame([rows[0]], SCHEMA).select(D.part_of(D.leaf_of(["id"]))).first()[0]
    assert len(leaves) == 1 and re.search(rf"PartitionFilters: \[[^\]]*_part#\d+ (IN \(|= ){part}\b", plan)
    assert tuples(pulled(spark, source, target).collect()) == [rows[0]]


def test_a_load_without_digests_is_not_seen_and_a_repeated_one_replaces_itself(spark, monkeypatch):
    folder, empty = kept(spark, [[(1, "a")]]), kept(spark, [[]])

    def killed(*_):
        raise RuntimeError("killed between the rows and the digests")

    with monkeypatch.context() as broken:
        broken.setattr(D, "digests", killed)
        with pytest.raises(RuntimeError):
            D.append(spark.createDataFrame([(2, "b")], SCHEMA), folder, ["id"], 1)
    assert tuples(pulled(spark, folder, empty).collect()) == [(1, "a")]
    for _ in range(2):
        D.append(spark.createDataFrame([(2, "b")], SCHEMA), folder, ["id"], 1)
    assert tuples(pulled(spark, folder, empty).collect()) == [(1, "a"), (2, "b")]


def test_ranges_cover_the_leaves():
    assert D.ranges([]) == [] and D.ranges([7]) == [(7, 7)] and D.ranges([1, 2, 3]) == [(1, 3)]
    assert D.ranges([-1, 4, 5, 60, 61, 90], 3) == [(-1, 5), (60, 61), (90, 90)]
    assert D.ranges([1, 5, 9], 1) == [(1, 9)]
