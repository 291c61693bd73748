"""Joins and set lookups between corpora, registries and tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_meta(registry: DataFrame, corpus: DataFrame, key: str) -> DataFrame:
    """Registry rows joined to the corpus; rows with any null are dropped, so an inner join does."""
    return registry.join(corpus, key).dropna()


def universe_counts(universe: DataFrame, counts: DataFrame, key: str) -> DataFrame:
    """Every label of the universe with its count, null where it never occurs."""
    return universe.join(counts, key, "left")


def distinct_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    return df.select(key).distinct()


def unknown(df: DataFrame, known: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows whose key is not known; a null on the known side hides nothing.

    Known keys are made distinct first: a frequent one collapses before the shuffle, and the join
    reuses the partitioning of that step.
    """
    return df.join(distinct_keys(known, key), key, "left_anti")


def listed(df: DataFrame, ids: DataFrame, key: str | list[str]) -> DataFrame:
    return df.join(distinct_keys(ids, key), key, "left_semi")


def first_match(df: DataFrame, side: DataFrame, key: str, value: str, order: str, name: str) -> DataFrame:
    """First value of a key on the other side; no match stays null."""
    return df.join(side.groupBy(key).agg(F.min_by(value, order).alias(name)), key, "left")


def completion(pairs: list[tuple[str, str, str, DataFrame, DataFrame]], id_col: str = "id") -> DataFrame:
    """Done, open and completion ratio per table pair and per task.

    ``pairs`` holds (task, origin, target, origin frame, target frame). Ids present on both sides are
    counted through one grouped union per pair.
    """

    def one(task: str, origin: str, target: str, source: DataFrame, done: DataFrame) -> DataFrame:
        marks = source.select(F.col(id_col).alias("id"), F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(
            done.select(F.col(id_col).alias("id"), F.lit(0).alias("s"), F.lit(1).alias("t"))
        )
        return (
            marks.groupBy("id")
            .agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
            .agg(
                F.sum("s").alias("origin_count"),
                F.sum("t").alias("target_count"),
                F.sum(F.when(F.col("t") == 0, F.col("s")).otherwise(F.lit(0))).alias("a_not_b"),
            )
            .select(F.lit(task).alias("task"), F.lit(origin).alias("origin"), F.lit(target).alias("target"), "*")
        )

    each = reduce(DataFrame.unionByName, [one(*p) for p in pairs])
    totals = each.groupBy("task").agg(
        F.concat("task", F.lit("_test_total")).alias("origin"),
        F.concat("task", F.lit("_final_total")).alias("target"),
        *[F.sum(c).alias(c) for c in ("origin_count", "target_count", "a_not_b")],
    )
    return each.unionByName(totals).withColumns(
        {
            "diff": F.col("origin_count") - F.col("target_count"),
            "ratio": F.when(F.col("origin_count") > 0, F.col("target_count") / F.col("origin_count")),
        }
    )


def best_named(df: DataFrame, fractions: DataFrame, key: str, score: str) -> DataFrame:
    """The name with the highest score among ``df``; of equals the last by name."""
    return df.join(fractions, key).agg(F.max(F.struct(score, key))[key].alias(key), F.max(score).alias(score))
