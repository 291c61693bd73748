"""Spans from one row per token, for documents of any length.

A document's positions are cut into cells of fixed size, and everything inside a cell is a window over that
cell. What crosses a border is carried: a cell's last position also stands in the next cell, and the place
where the last run before a cell began comes from a window over one row per cell. Runs are put together by
aggregates, so a long document spreads over many tasks and its spans are those of the document in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELL = 4096
OUTSIDE = "O"


def _kind(tag: Column) -> Column:
    return F.upper(F.substring(tag, 1, 1))


def _pieces(df: DataFrame, doc: list[str], pos: str, tag: str, adjoining: bool, cell: int) -> DataFrame:
    """Per run and type ``doc, run, type, n, first, last``; ``run`` is the place where the run begins.

    A run begins at B, and where tokens must be ``adjoining`` also behind a gap. Without that a document's
    first token begins a run too, whose place is null here.
    """
    tagged = df.filter(F.col(tag) != OUTSIDE).select(*doc, F.col(pos).cast("long").alias("_pos"), F.col(tag).alias("_tag"))
    rows = tagged.withColumns({"_cell": F.floor(F.col("_pos") / cell), "_carried": F.lit(False)})
    if adjoining:
        edge = rows.filter(F.col("_pos") % cell == cell - 1).withColumns({"_cell": F.col("_cell") + 1, "_carried": F.lit(True)})
        rows = rows.unionByName(edge)
    inside = Window.partitionBy(*doc, "_cell").orderBy("_pos")
    opens = _kind(F.col("_tag")) == "B"
    if adjoining:
        opens = opens | F.coalesce(F.lag("_pos").over(inside) != F.col("_pos") - 1, F.lit(True))
    rows = rows.withColumn("_opens", opens).filter(~F.col("_carried"))
    rows = rows.withColumn("_run", F.max(F.when(F.col("_opens"), F.col("_pos"))).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    kind = F.substr("_tag", F.lit(3))
    parts = rows.groupBy(*doc, "_cell", "_run", kind.alias("type")).agg(F.count("*").alias("n"), F.min("_pos").alias("first"), F.max("_pos").alias("last"))

    by_cell = parts.groupBy(*doc, "_cell").agg(F.max("_run").alias("_last_run"))
    before = Window.partitionBy(*doc).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)  # a row per cell
    carried = by_cell.select(*doc, "_cell", F.last("_last_run", ignorenulls=True).over(before).alias("_before"))
    joined = parts.join(carried, [*doc, "_cell"]).withColumn("run", F.coalesce("_run", "_before"))
    return joined.groupBy(*doc, "run", "type").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))


def token_spans(df: DataFrame, doc: list[str], pos: str = "pos", tag: str = "tag", cell: int = CELL) -> DataFrame:
    """Rows ``doc, start, end, label`` of runs of tags; a run begins at B, or at I behind a gap or O.

    Its type is the most frequent one, of equally frequent ones the first met. Each token has a row of its own.
    """
    runs = _pieces(df, doc, pos, tag, True, cell).groupBy(*doc, "run").agg(
        F.max_by("type", F.struct(F.col("n"), -F.col("first"))).alias("label"), (F.max("last") + 1).alias("end")
    )
    return runs.select(*doc, F.col("run").cast("int").alias("start"), F.col("end").cast("int").alias("end"), "label")


def merged_tokens(df: DataFrame, doc: list[str], pos: str = "pos", tag: str = "tag", cell: int = CELL) -> DataFrame:
    """Rows ``doc, start, end, label`` of token predictions: B opens, tokens of the same label extend, gaps do not matter.

    The first token of a document opens whatever its tag is; a span ends with its last token of the opening label.
    """
    runs = _pieces(df, doc, pos, tag, False, cell).groupBy(*doc, "run").agg(
        F.min("first").alias("start"), F.min_by("type", "first").alias("label"), (F.min_by("last", "first") + 1).alias("end")
    )
    return runs.select(*doc, F.col("start").cast("int").alias("start"), F.col("end").cast("int").alias("end"), "label")
