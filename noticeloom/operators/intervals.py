"""Joins of intervals of very unequal length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOP = 14  # cells are at most two to this long: longer intervals are filed in several


def _level(length: Column, top: int) -> Column:
    """The smallest level whose cells are as long as the interval, ``top`` at most."""
    bits = F.when(length > 1, F.length(F.bin((length - 1).cast("long")))).otherwise(F.lit(0))
    return F.least(bits, F.lit(top))


def _levels(df: DataFrame) -> list[int]:
    return sorted(r[0] for r in df.select("_own").distinct().collect())  # at most one more than ``top``


def overlapping(
    left: DataFrame, right: DataFrame, on: list[str], left_span=("start", "end"), right_span=("r_start", "r_end"), top: int = TOP,
) -> DataFrame:
    """Pairs of rows with equal ``on`` whose half-open intervals overlap; both sides' columns, names distinct.

    An interval belongs to the level whose cells are about its length, and is filed in the one or two cells
    of that level that it touches. Shorter ones of the other side are filed in larger cells as well, for each
    level that the other side has. So a pair meets at the level of its longer interval, and every candidate
    pair has at least one interval that covers a good part of its cell: short intervals never meet each
    other in large cells. Levels end at ``top``: a longer interval is spread over many cells, and so are the
    short ones that it meets. A pair that shares two cells counts in the one where the later one starts.
    Empty intervals and null bounds overlap nothing.
    """
    def sized(df: DataFrame, start: str, end: str) -> DataFrame:
        return df.filter(F.col(end) > F.col(start)).withColumn("_own", _level(F.col(end) - F.col(start), top))

    a, b = sized(left, *left_span), sized(right, *right_span)
    levels = {"a": _levels(a), "b": _levels(b)}

    def filed(df: DataFrame, span: tuple[str, str], at: Column) -> DataFrame:
        """Rows in the cells of the levels ``at``."""
        rows = df.withColumn("_level", F.explode(at))
        width = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_level"))
        first, last = F.floor(F.col(span[0]) / width), F.floor((F.col(span[1]) - 1) / width)
        return rows.withColumn("_cell", F.explode(F.sequence(first, last)))

    def above(other: str, same: bool) -> Column:
        wanted = F.array(*[F.lit(n) for n in levels[other]]).cast("array<int>")
        return F.filter(wanted, lambda n: (n >= F.col("_own")) if same else (n > F.col("_own")))

    place = [*on, "_level", "_cell"]
    starts = F.greatest(F.col(left_span[0]), F.col(right_span[0]))
    width = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_level"))
    meet = (F.col(left_span[0]) < F.col(right_span[1])) & (F.col(right_span[0]) < F.col(left_span[1])) & (F.floor(starts / width) == F.col("_cell"))
    own_a, own_b = filed(a, left_span, F.array("_own")), filed(b, right_span, F.array("_own"))
    longer_left = own_a.drop("_own").join(filed(b, right_span, above("a", True)).drop("_own"), place)
    longer_right = filed(a, left_span, above("b", False)).drop("_own").join(own_b.drop("_own"), place)
    out = [*left.columns, *[c for c in right.columns if c not in on]]
    return longer_left.unionByName(longer_right).filter(meet).select(*out)


def overlap_totals(left: DataFrame, right: DataFrame, on: list[str], left_span=("start", "end"), right_span=("r_start", "r_end"), top: int = TOP) -> DataFrame:
    """Per ``on`` the ``pairs`` of rows whose half-open intervals overlap, and the summed length they have in ``common``.

    Equal intervals of a side are counted first and meet once, so copies make no pairs.
    """
    def counted(df: DataFrame, span: tuple[str, str], n: str) -> DataFrame:
        return df.groupBy(*on, *span).agg(F.count("*").alias(n))

    met = overlapping(counted(left, left_span, "_ln"), counted(right, right_span, "_rn"), on, left_span, right_span, top)
    times = F.col("_ln") * F.col("_rn")
    common = F.least(left_span[1], right_span[1]) - F.greatest(left_span[0], right_span[0])
    return met.groupBy(*on).agg(F.sum(times).alias("pairs"), F.sum(times * common).alias("common"))
