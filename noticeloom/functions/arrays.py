"""Array expressions that keep per-document work inside one row, without a shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN_TYPE = "array<struct<start:int,end:int,label:string>>"
_BLOCK = 64


def empty(ddl: str) -> Column:
    return F.array().cast(ddl)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda acc, x: acc + x)


def running_totals(values: Column) -> Column:
    """Inclusive running sums of an int array.

    Sums go by blocks of 64: a plain prefix sum inside an expression would read the whole prefix for
    every element, and ``slice`` copies the whole array for every cut.
    """

    def cut(b: Column) -> Column:
        last = F.least(b * _BLOCK + _BLOCK, F.size(values)) - 1
        return F.transform(F.sequence(b * _BLOCK, last), lambda i: F.get(values, i))

    blocks = F.when(
        F.size(values) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / _BLOCK).cast("int")), cut)
    ).otherwise(empty("array<array<int>>"))

    def spread(packed: Column, sums: Column) -> Column:
        def place(block: Column, b: Column) -> Column:
            return bind(
                total(F.slice(sums, F.lit(1), b)),
                lambda before: F.transform(block, lambda _, i: before + total(F.slice(block, F.lit(1), i + 1))),
            )

        return F.flatten(F.transform(packed, place))

    return bind(blocks, lambda packed: bind(F.transform(packed, total), lambda sums: spread(packed, sums)))


def bind(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (a let-binding for expressions)."""
    return F.try_element_at(F.transform(F.array(value), body), F.lit(1))


def overlap_free(spans: Column) -> Column:
    """True when spans sorted by start do not overlap."""
    return bind(
        F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))),
        lambda ordered: F.forall(
            F.transform(
                ordered,
                lambda s, i: (i == 0) | (F.get(ordered, i - 1)["end"] <= s["start"]),
            ),
            lambda ok: ok,
        ),
    )


def index_range(n: Column) -> Column:
    """0..n-1, empty when n is 0."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(empty("array<int>"))


def lower_bound(values: Column, least: Column) -> Column:
    """First index of a sorted array whose value is at least ``least``, by bisection; the size if none is."""

    def step(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["low"] + acc["high"]) / 2).cast("int")
        open_ = acc["low"] < acc["high"]
        right = open_ & (F.get(values, middle) < least)
        return F.struct(
            F.when(right, middle + 1).otherwise(acc["low"]).alias("low"),
            F.when(open_ & ~right, middle).otherwise(acc["high"]).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.size(values).alias("high"))
    return F.aggregate(F.sequence(F.lit(0), F.length(F.bin(F.size(values)))), start, step, lambda acc: acc["low"])


def items(values: Column, first: Column, stop: Column, make) -> Column:
    """``make`` of the elements from ``first`` up to ``stop``; other elements are not read or copied."""
    places = F.when(stop > first, F.sequence(first, stop - 1)).otherwise(empty("array<int>"))
    return F.transform(places, lambda i: make(F.get(values, i)))


def unnest(df: DataFrame, keep: list, array: Column | str, value: str, pos: str | None = None) -> DataFrame:
    """One row per array element, none for an empty array.

    An inner explode makes the optimizer infer ``size(array) > 0`` and push it to the scan, where the
    whole expression behind the array is evaluated once more. The outer form with a filter on the
    element keeps that work to one evaluation.
    """
    rows = F.explode_outer(array).alias(value) if pos is None else F.posexplode_outer(array).alias(pos, value)
    return df.select(*keep, rows).filter(F.col(value).isNotNull())
