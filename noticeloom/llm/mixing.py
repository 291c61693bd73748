"""Sources mixed to target weights by balanced sampling with the cube method.

A document of a source with target ``t`` and size ``s`` is wanted ``t / s`` times: its whole part is
taken for sure, its fraction is the document's inclusion probability. The cube method moves these
probabilities along the null space of the balancing constraints (documents and words of the source)
until they are 0 or 1, so each step keeps both totals exactly. Three open documents always leave a
direction free, so the flight is a stream that holds three at a time; a block ends with two or fewer
open. Open documents of all blocks fly again in fewer blocks, and the last dozen of a source land on the
rounding nearest to its target.

Sources are cut into blocks by a hash of id and text, so a source with a third of the rows is many
tasks; memory in a task is three documents and a batch. The driver sees two sums per pass over the
source table. Draws are seeded by source, block and round: reruns agree.

Defined results: a null text has size 0 and is taken 0 words; a null source is a source of its own,
last in order; null ids and repeated rows are mixed each on their own; a source without words has
target 0; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import random
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeloom.llm.common import ROW, WORD, columns_of, stored, text_of, with_rows
from noticeloom.operators.ranking import number_rows

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2.0
BLOCK_ROWS = 4096
LANDING = 10  # documents of a source that are rounded together at the end, with the two the flight leaves
NEAR = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size, n`` with the number ``s`` of each source in order and its ``target``.

    Targets are ``level * weight`` up to ``most`` times the source. The level rises as full sources
    hand on what they cannot take; each pass gets two sums from the table of sources.
    """
    named = sizes.withColumn("no_source", F.col("source").isNull())
    ranked = number_rows(named, ["no_source", "source"], "s").drop("no_source")
    table = ranked.withColumns({
        "weight": F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("s") - 1) % len(weights) + 1).cast("int")),
        "cap": F.col("source_size") * F.lit(float(most)),
    })
    table = stored(table, "mixing-sources")
    total, weight = table.agg(F.sum("source_size"), F.sum("weight")).first()
    wanted, level = share * (total or 0), 0.0
    higher = wanted / weight if weight else 0.0
    while higher > level:
        level = higher
        full = F.col("cap") <= F.col("weight") * level
        capped, rest = table.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        higher = (wanted - capped) / rest if rest else level
    return table.withColumn("target", F.least("cap", F.col("weight") * F.lit(level))).drop("cap", "weight")


class Flight:
    """The open documents of one block; ``fly`` settles at least one of three."""

    def __init__(self, seed: str):
        self.draw = random.Random(seed).random
        self.open: list[list] = []  # [place, size, probability]

    def add(self, unit: list) -> list[list]:
        self.open.append(unit)
        return self.fly() if len(self.open) > 2 else []

    def fly(self) -> list[list]:
        a, b, c = (u[1] for u in self.open)
        u = (c - b, a - c, b - a) if not a == b == c else (1, -1, 0)
        p = [x[2] for x in self.open]
        up = min((1 - q) / v if v > 0 else q / -v for q, v in zip(p, u) if v)
        down = min(q / v if v > 0 else (1 - q) / -v for q, v in zip(p, u) if v)
        step = up if self.draw() * (up + down) < down else -down
        done, still = [], []
        for x, v in zip(self.open, u):
            x[2] = min(1.0, max(0.0, x[2] + step * v))
            if x[2] < NEAR or x[2] > 1 - NEAR:
                x[2] = float(round(x[2]))
                done.append(x)
            else:
                still.append(x)
        self.open = still
        return done

    def land(self, held: list[list]) -> list[list]:
        """The few documents left get the rounding that misses least words and documents together."""
        units, self.open = self.open + held, []
        if units:
            size, p = np.array([x[1] for x in units], float), np.array([x[2] for x in units])
            choices = (np.arange(1 << len(units))[:, None] >> np.arange(len(units))) & 1
            off = choices - p
            miss = np.abs(off @ size) + np.abs(off.sum(axis=1)) * size.mean() / 10
            for x, r in zip(units, choices[int(np.argmin(miss))].tolist()):
                x[2] = float(r)
        return units


def _flights(batches: Iterator[pa.RecordBatch], last: bool, seed: str) -> Iterator[pa.RecordBatch]:
    """``row, p`` of each document of a stream sorted by source and block."""
    key, flight, held = None, None, deque()

    def end() -> list[list]:
        left = flight.land(list(held)) if last else flight.open
        held.clear()
        return left

    for batch in batches:
        done: list[list] = []
        rows, sources, blocks, sizes, probabilities = (batch.column(i).to_pylist() for i in range(5))
        for row, s, block, size, p in zip(rows, sources, blocks, sizes, probabilities):
            if (s, block) != key:
                done += end() if flight else []
                key, flight = (s, block), Flight(f"{seed}/{s}/{block}")
            if last:  # the last few documents stay open for the landing
                held.append([row, size, p])
                if len(held) <= LANDING:
                    continue
                row, size, p = held.popleft()
            done += flight.add([row, size, p])
        yield _rows(done)
    if flight:
        yield _rows(end())


def _rows(done: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.float64())], names=["row", "p"])


def mixed(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE, most: float = MOST, seed: str = "mix", block_rows: int = BLOCK_ROWS, row_col: str | None = None,
) -> DataFrame:
    """Per row: ``id_col, size, source_size, target, copies, taken`` (and ``row_col`` if the rows have one)."""
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    text = text_of(text_col)
    units = stored(
        df.select(
            row.alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(F.col(id_col), text, F.lit(seed)).alias("h"),
        ),
        "mixing-units",
    )
    sizes = units.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = stored(source_targets(sizes, weights, share, most), "mixing-targets")
    wanted = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    near = sources.withColumn("wanted", wanted).withColumn("whole", F.floor(F.col("wanted") + NEAR)).withColumn("p", F.greatest(F.lit(0.0), F.col("wanted") - F.col("whole")))
    joined = units.join(near.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        "row", "id", "size", "h", "s", "source_size", "target", "whole", "p"
    )
    units = stored(joined, "mixing-wanted")

    open_units, settled = units.filter(F.col("p") > NEAR), []
    for turn in range(64):
        held = stored(open_units.groupBy("s").agg(F.count("*").alias("n")), "mixing-open")
        most_open = held.agg(F.max("n")).first()[0]
        if not most_open:
            break
        last = most_open <= block_rows
        blocks = F.when(F.lit(last), F.lit(1)).otherwise(F.ceil(F.col("n") / block_rows))
        dealt = open_units.join(held, "s").withColumn("block", F.pmod("h", blocks.cast("long")))
        stream = dealt.select("row", "s", "block", F.col("size"), "p", "h").repartition("s", "block").sortWithinPartitions("s", "block", "h", "size", "row")
        name = f"{seed}/{turn}"
        flown = stored(stream.drop("h").mapInArrow(lambda b, last=last, name=name: _flights(b, last, name), "row long, p double"), "mixing-flown")
        settled.append(flown.filter(F.col("p").isin(0.0, 1.0)))
        open_units = open_units.drop("p").join(flown.filter(~F.col("p").isin(0.0, 1.0)), "row")
        if last:
            break
        open_units = stored(open_units, "mixing-left")

    drawn = units.filter(F.col("p") <= NEAR).select("row", F.lit(0.0).alias("p"))
    for part in settled:
        drawn = drawn.unionByName(part)
    copies = (F.col("whole") + F.col("drawn")).cast("long")
    out = units.drop("p").join(drawn.withColumnRenamed("p", "drawn"), "row").withColumn("copies", copies)
    kept = [F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")]
    return out.select(*kept, *([F.col("row").alias(row_col)] if row_col else []))


def mix(df: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``df`` as often as it is taken, with the columns of ``df``."""
    rows = with_rows(df, "mixing-rows")
    taken = mixed(rows, row_col=ROW, **options).filter(F.col("copies") > 0).select(ROW, F.col("copies").alias("__llm_copies"))
    many = rows.join(taken, ROW).withColumn("__llm_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__llm_copies"))))
    return many.select(columns_of(df))

