"""Exact duplicates through an extendible-hash index on shared files. DataFrame functions only.

A text's place in the index is the 64-bit hash of its normalised form. The directory is the list of
hash prefixes: it starts as one bucket and doubles (one more bit) as long as a bucket holds more than
``capacity`` texts; only overfull buckets are split, so a bucket is a range of hashes with a depth of
its own. One owner task writes each bucket. Texts that share a hash form a chain; two texts are the
same only where their bytes are, since the texts themselves are the grouping key of the build.

Copies collapse before each shuffle (partial aggregates), so a group of any size costs one row per
task; the look-up joins two tables of files, which Spark splits where a key is hot.

Defined results: a null text is empty; empty texts are one group; a null id sorts last; rows that
repeat an id and a text are all listed and counted, and ``exact_dedup`` keeps one of them; an empty
table gives an empty result; other columns are untouched whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.llm.common import ROW, SPACE, columns_of, stored, text_of, with_rows

CAPACITY = 4096  # texts a bucket holds before it is split


def normalised(text: Column) -> Column:
    """The text without any character of ``[\\x20\\x09-\\x0D]``."""
    return F.translate(text, SPACE, "")


def directory(hashes: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Slots of the doubled directory: ``slot, bucket``; ``hashes`` has one ``h`` per text.

    The directory's depth follows from the number of texts. Counts of all nodes of the doubling come from one
    pass over the slots; a slot's bucket is its first node that is not overfull, or the slot itself.
    """
    n = hashes.count()
    depth = math.ceil(math.log2(n / capacity)) + 2 if n > capacity else 0
    slots = hashes.groupBy(slot_of(F.col("h"), depth).alias("slot")).agg(F.count("*").alias("n"))
    nodes = slots.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("d"))
    nodes = nodes.withColumn("prefix", F.expr(f"shiftright(slot, {depth} - d)"))
    full = nodes.groupBy("d", "prefix").agg(F.sum("n").alias("held"))
    fitting = nodes.join(full, ["d", "prefix"]).filter((F.col("held") <= capacity) | (F.col("d") == depth))
    first = fitting.groupBy("slot").agg(F.min(F.struct("d", "prefix")).alias("node"))
    name = F.concat_ws("/", F.col("node.d"), F.col("node.prefix"))
    return first.select("slot", name.alias("bucket")).withColumn("depth", F.lit(depth))


def slot_of(h: Column, depth: int) -> Column:
    """The first ``depth`` bits of a hash."""
    return F.shiftrightunsigned(h, 64 - depth) if depth else F.lit(0).cast("long")


def build_index(entries: DataFrame, texts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The stored index: ``bucket, h, chain, text_sha256, group_size, best`` with one row per distinct text.

    ``entries`` has ``h, text_sha256, n_cp, id, row`` of each document, ``texts`` has ``h, norm``. The build
    stops where two texts with different bytes share both hashes: the look-up could not tell them apart.
    """
    same_bytes = texts.groupBy("h", "norm").agg(F.count("*").alias("copies"))
    distinct = stored(same_bytes.select("h", F.sha2("norm", 256).alias("text_sha256"), "copies"), "dedup-texts")
    order = F.struct((-F.col("n_cp")).alias("n"), F.col("id").isNull().alias("no_id"), "id", "row")
    owners = entries.groupBy("h", "text_sha256").agg(F.min(order).alias("best"))
    slots = stored(directory(distinct.select("h"), capacity), "dedup-directory")
    depth = slots.agg(F.max("depth")).first()[0] or 0
    placed = distinct.withColumn("slot", slot_of(F.col("h"), depth)).join(slots.drop("depth"), "slot")
    owned = placed.join(owners, ["h", "text_sha256"]).repartition("bucket")
    chained = Window.partitionBy("bucket", "h").orderBy("text_sha256")
    twin = F.lag("text_sha256").over(chained) == F.col("text_sha256")
    index = owned.select(
        "bucket", "h", F.row_number().over(chained).alias("chain"), "text_sha256",
        F.col("copies").alias("group_size"), "best",
        F.when(twin, F.raise_error(F.lit("two texts share both hashes"))).alias("clash"),
    )
    return stored(index.filter(F.col("clash").isNull()).drop("clash").sortWithinPartitions("bucket", "h", "chain"), "dedup-index")


def _look_up(df: DataFrame, id_col: str, text_col: str, row: Column, capacity: int) -> DataFrame:
    norm = normalised(text_of(text_col))
    h = F.xxhash64(norm)
    entries = stored(
        df.select(
            F.col(id_col).alias("id"), row.alias("row"), F.length(text_of(text_col)).alias("n_cp"),
            h.alias("h"), F.sha2(norm, 256).alias("text_sha256"),
        ),
        "dedup-entries",
    )
    index = build_index(entries, df.select(h.alias("h"), norm.alias("norm")), capacity)
    return entries.join(index.select("h", "text_sha256", "group_size", "best"), ["h", "text_sha256"])


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Per row: ``id_col, keep_id, group_size, kept, text_sha256``.

    Of equal texts the one with the most code points stays, then the smallest id. Rows that repeat the id
    that stays are all marked as kept: they are one document.
    """
    found = _look_up(df, id_col, text_col, F.lit(0).cast("long"), capacity)
    keep = F.col("best.id")
    return found.select(
        F.col("id").alias(id_col), keep.alias("keep_id"), F.col("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"), "text_sha256",
    )


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """The rows that stay, one per distinct text, with the columns of ``df``."""
    rows = with_rows(df, "dedup-rows")
    found = _look_up(rows, id_col, text_col, F.col(ROW), capacity)
    return rows.join(found.select(F.col("best.row").alias(ROW)).distinct(), ROW, "left_semi").select(columns_of(df))
